"""Recordings: files to chunks, headers and spectra, each file decoded within one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.functions import signal

#: Chunks in an Arrow batch; a chunk has 640 kB of samples.
CHUNKS_EACH = 16
#: Bytes that a header is looked for in first.
HEAD = 4096
#: Steps of a decibel in which percentiles are taken.
DB_STEPS = 100


def recordings(spark: SparkSession, folder: str, pattern: str = "*.{wav,WAV}") -> DataFrame:
    """Files with their contents. A row holds a whole file; Spark bounds Arrow batches by bytes, so few are in one."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)


def _flush(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.list_(pa.float32()), pa.float64(), pa.float64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["file_path", "chunk_idx", "samples", "start_time", "end_time", "reason"])


def decoded(files: DataFrame, size: int = signal.CHUNK, rate: int = signal.RATE, silent: bool = False) -> DataFrame:
    """chunks of files (path, content) and a column reason; a file that can't be decoded gives one row with a reason and no samples, or, if
    silent, one whole chunk of silence without a reason."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                try:
                    x = signal.load(content.as_buffer().to_pybytes() if content.is_valid else b"", rate)
                except signal.BadAudio as e:
                    if not silent:
                        rows.append((path, None, None, None, None, str(e)))
                        continue
                    x = np.zeros(size, np.float32)
                for i, part in enumerate(signal.frames(x, size)):
                    rows.append((path, i, part, i * size / rate, min((i + 1) * size, len(x)) / rate, None))
                    if len(rows) >= CHUNKS_EACH:
                        yield _flush(rows)
                        rows = []
        if rows:
            yield _flush(rows)

    return files.select("path", "content").mapInArrow(run, "file_path string, chunk_idx int, samples array<float>, start_time double, end_time double, reason string")


def chunks(files: DataFrame, silent: bool = False) -> DataFrame:
    return decoded(files, silent=silent).where("reason IS NULL").select("file_path", "chunk_idx", "samples", "start_time", "end_time")


def faults(files: DataFrame) -> DataFrame:
    """Files that can't be decoded, and why; nothing is made up for them."""
    return decoded(files).where("reason IS NOT NULL").select("file_path", "reason")


def headers(files: DataFrame) -> DataFrame:
    """path, channels, rate, bits, duration from the header and the file's length; nulls if it can't be read.

    Only the beginning of a file goes to Python, unless its samples begin beyond that."""
    head = F.substring("content", 1, HEAD)
    files = files.select("path", F.when(F.instr(head.cast("string"), "data") > 0, head).otherwise(F.col("content")).alias("head"), F.octet_length("content").cast("long").alias("length"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for head, length in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                try:
                    h = signal.wav_header(head or b"", length or 0)
                    rows.append((h["channels"], h["rate"], h["bits"], h["length"] / (h["channels"] * h["bits"] / 8) / h["rate"]))
                except signal.BadAudio:
                    rows.append((None, None, None, None))
            c = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(c[0], pa.int32()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int32()), pa.array(c[3], pa.float64())], ["path", "channels", "rate", "bits", "duration"])

    return files.mapInArrow(run, "path string, channels int, rate long, bits int, duration double")


def spectrogram(chunked: DataFrame, n_fft: int = 2048, hop: int = 512, rate: int = signal.RATE, most_hz: float = 12_000.0) -> DataFrame:
    """(file_path, chunk_idx, frame, seconds, db: one value for each bin up to most_hz)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = int(np.floor(most_hz * n_fft / rate)) + 1
        for b in batches:
            for path, i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                db = signal.stft_db(x.values.to_numpy(), n_fft, hop)[:keep].T
                n = len(db)
                yield pa.RecordBatch.from_arrays([pa.array([path] * n), pa.array([i] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array(np.arange(n) * hop / rate), pa.array(list(db), pa.list_(pa.float64()))], ["file_path", "chunk_idx", "frame", "seconds", "db"])

    return chunked.select("file_path", "chunk_idx", "samples").mapInArrow(run, "file_path string, chunk_idx int, frame int, seconds double, db array<double>")


def clip_range(spectra: DataFrame) -> DataFrame:
    """The 5th and 99th percentile of all decibels, to the nearest 1 / DB_STEPS: from counts by step, of which there are few however many
    values there are. Between two steps percentiles are interpolated; without values there is no row but nulls."""
    steps = spectra.select(F.explode("db").alias("db")).where("db IS NOT NULL AND NOT isnan(db)").groupBy(F.round(F.col("db") * DB_STEPS).cast("long").alias("step")).agg(F.count(F.lit(1)).alias("c"))
    ranked = steps.withColumn("upto", F.sum("c").over(Window.orderBy("step"))).withColumn("n", F.sum("c").over(Window.partitionBy()))
    out = []
    for share, name in ((0.05, "low"), (0.99, "high")):
        at = F.lit(share) * (F.col("n") - 1)
        value = lambda place: F.min(F.when(F.col("upto") > place, F.col("step")))
        below, above = value(F.floor(at)), value(F.ceil(at))
        out.append(((below + (above - below) * F.max(at - F.floor(at))) / DB_STEPS).alias(name))
    return ranked.agg(*out)
