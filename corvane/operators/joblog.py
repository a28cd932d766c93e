"""Logs of batch jobs: text to one row a job, to a summary, to CSV columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Field, label in the log, pattern of the value. Configuration rows.
CONFIGURATION = (
    ("total_files", "Total Files", "([0-9,]+)"),
    ("to_process", "To Process", "([0-9,]+)"),
    ("avg_chunks_per_file", "Avg Chunks/File", "([0-9.]+)"),
    ("ram_budget_gb", "RAM Budget", "([0-9.]+) GB"),
    ("files_per_group", "Files per Group", "([0-9,]+)"),
    ("total_groups", "Total Groups", "([0-9,]+)"),
    ("system_cpus", "System CPUs", "([0-9,]+)"),
    ("max_cpus", r"Max CPUs \(limit\)", "([0-9,]+)"),
    ("inference_workers", "Inference Workers", "([0-9,]+)"),
    ("threads_per_worker", "Threads per Worker", "([0-9,]+)"),
    ("loader_threads", "Loader Threads", "([0-9,]+)"),
    ("batch_size", "Batch Size", "([0-9,]+)"),
    ("embedding_format", "Embedding Format", r"(\S+)"),
)
# Performance rows.
PERFORMANCE = (
    ("files_processed", "Files Processed", "([0-9,]+)"),
    ("running_time_s", "Total Running Time", "([0-9.]+)s"),
    ("speed_realtime", "Speed", "([0-9.]+)x realtime"),
    ("throughput_files_sec", "Throughput", "([0-9.]+) files/sec"),
    ("cpu_efficiency_pct", "CPU Efficiency", "([0-9.]+)%"),
)
# Size lines.
SIZES = (("embeddings_gb", "Embeddings size: ([0-9.]+) GB"), ("predictions_mb", "Predictions size: ([0-9.]+) MB"))
# Columns of the exported CSV, in order.
EXPORTED = (
    "name", "start_time", "end_time", "total_files", "files_processed", "running_time_s", "throughput_files_sec", "speed_realtime", "cpu_efficiency_pct",
    "embeddings_gb", "predictions_mb", "inference_workers", "threads_per_worker", "batch_size", "ram_budget_gb", "total_groups", "embedding_format",
)
START = r"\[(\d+:\d+:\d+)\] Starting: (\S+)"


def _found(text: Column, pattern: str) -> Column:
    return F.nullif(F.replace(F.regexp_extract(text, pattern, 1), F.lit(","), F.lit("")), F.lit(""))


def parse(logs: DataFrame, text: str = "value", keys: tuple[str, ...] = ()) -> DataFrame:
    """A row for each job of each log: keys, ordinal, name, start_time, end_time (null unless DONE) and the log's fields, all strings."""
    parts = logs.select(*keys, F.posexplode(F.split(text, r"(?=\[\d+:\d+:\d+\] Starting: \S)")).alias("ordinal", "t")).where(F.col("t").rlike("^" + START))
    t, name = F.col("t"), F.regexp_extract("t", START, 2)
    done = F.call_function("regexp_extract", t, F.concat(F.lit(r"\[(\d+:\d+:\d+)\] DONE: \Q"), name, F.lit(r"\E")), F.lit(1))
    fields = [_found(t, rf"│ {label}\s+│\s+{value}").alias(f) for f, label, value in CONFIGURATION]
    fields += [_found(t, rf"║ {label}\s+│\s+{value}").alias(f) for f, label, value in PERFORMANCE]
    fields += [_found(t, pattern).alias(f) for f, pattern in SIZES]
    return parts.select(*keys, "ordinal", name.alias("name"), F.regexp_extract(t, START, 1).alias("start_time"), F.nullif(done, F.lit("")).alias("end_time"), *fields)


def summary(jobs: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Sums, unweighted means and ranges over jobs that have a field; the configuration is the first job's, of several logs that of the log
    whose keys come first."""
    num = lambda c: F.expr(f"try_cast({c} AS DOUBLE)")
    order = F.struct(*[c for c in jobs.columns[: jobs.columns.index("ordinal")] if c not in by], "ordinal")
    first = lambda c: F.min_by(c, order).alias(c)
    return jobs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("jobs"),
        F.sum(F.expr("try_cast(files_processed AS BIGINT)")).alias("files"),
        F.sum(num("running_time_s")).alias("seconds"),
        F.avg(num("throughput_files_sec")).alias("mean_throughput"),
        F.min(num("throughput_files_sec")).alias("min_throughput"),
        F.max(num("throughput_files_sec")).alias("max_throughput"),
        F.avg(num("speed_realtime")).alias("mean_speed"),
        F.min(num("speed_realtime")).alias("min_speed"),
        F.max(num("speed_realtime")).alias("max_speed"),
        F.sum(num("embeddings_gb")).alias("embeddings_gb"),
        (F.sum(num("predictions_mb")) / 1024).alias("predictions_gb"),
        *[first(c) for c in ("inference_workers", "threads_per_worker", "batch_size", "ram_budget_gb", "embedding_format")],
    )


def exported(jobs: DataFrame) -> DataFrame:
    return jobs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in EXPORTED])
