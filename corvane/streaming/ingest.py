"""Incremental inference: new recordings to embeddings, predictions and faults, exactly once for each file."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane import schemas
from corvane.plans.models import Runner, infer


def _write(df: DataFrame, path: str, batch_id: int) -> None:
    # A batch that is run again replaces what it wrote before.
    df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


def ingest(spark: SparkSession, folder: str, out: str, make: Callable[[], Runner], names: list[str], k: int = 10, files_each: int = 1000, pattern: str = "*.{wav,WAV}") -> int:
    """Runs the model over the files of folder that no earlier call has seen, and ends. Returns the number of batches.

    out has embeddings, predictions and faults, by batch_id, and the checkpoint from which a later call goes on. A file is either
    in a committed batch as a whole or taken again."""
    files = spark.readStream.format("binaryFile").schema(schemas.RECORDINGS).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_each).load(folder)
    seen: list[int] = []
    key = uuid.uuid4().hex  # one runner for all batches of this call

    def batch(df: DataFrame, batch_id: int) -> None:
        rows = infer(df, make, names, k, key=key).persist()
        _write(rows.where("reason IS NULL").select(*schemas.KEY_NAMES, "embedding"), f"{out}/embeddings", batch_id)
        _write(rows.where("reason IS NULL").select(*schemas.KEY_NAMES, "topk"), f"{out}/predictions", batch_id)
        _write(rows.where("reason IS NOT NULL").select("file_path", "reason"), f"{out}/faults", batch_id)
        rows.unpersist()
        seen.append(batch_id)

    files.writeStream.foreachBatch(batch).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return len(seen)
