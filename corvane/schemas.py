"""Declared schemas of all tables, as DDL; nothing is inferred."""

from __future__ import annotations

EMBEDDING_SIZE, CLASSES, SAMPLE_RATE, CHUNK_SECONDS = 1536, 14_795, 32_000, 5
CHUNK_SAMPLES = SAMPLE_RATE * CHUNK_SECONDS

RECORDINGS = "path string, modificationTime timestamp, length long, content binary"
CHUNKS = "file_path string, chunk_idx int, samples array<float>, start_time double, end_time double"
KEY_NAMES = ("file", "file_path", "chunk_idx", "start_time", "end_time")
KEYS = "file string, file_path string, chunk_idx int, start_time double, end_time double"
EMBEDDINGS = f"{KEYS}, embedding array<float>"
PREDICTIONS = f"{KEYS}, topk array<struct<rank: int, idx: int, species: string, score: double>>"
FAULTS = "file_path string, reason string"
DAILY = "date date, species string, n long"
CLASS_NAMES = "idx int, species string"
CHECKPOINT = "processed_files array<string>, total_processed long, total_batches long, checkpoint_id int, last_updated string"
MODEL = "version int, system string, embedding_size int, sample_duration int, sample_rate int, num_classes int"
STATS = "struct<count: long, mean: double, median: double, min: double, max: double, range: double, stdev: double, variance: double, coefficient_of_variation: double, percentile_25: double, percentile_75: double, percentile_95: double>"
CONFIG = "struct<workers: int, batch_size: int, loader_threads: int, use_float16: boolean>"
BENCHMARK = (
    "benchmark_metadata struct<timestamp: string, script_path: string, model_path: string, num_test_files: int, iterations_per_config: int, "
    "total_benchmark_time_seconds: double, configurations_tested: int, successful_configurations: int>, "
    "test_parameters struct<workers_tested: array<int>, batch_sizes_tested: array<int>, timeout_seconds: int>, "
    f"results array<struct<config: {CONFIG}, iterations_successful: int, iterations_requested: int, elapsed_time_stats: {STATS}, "
    f"throughput_stats: {STATS}, cpu_stats: {STATS}, memory_stats: {STATS}, files_processed: long, chunks_processed: long>>"
)


def wide_predictions(k: int = 10, checkpoint: bool = True) -> str:
    """The CSV layout of predictions: keys, then top1..topk and score1..scorek."""
    fields = KEYS + (", checkpoint_id int" if checkpoint else "")
    return fields + "".join(f", top{i} string" for i in range(1, k + 1)) + "".join(f", score{i} double" for i in range(1, k + 1))
