"""Readers and writers of embeddings, predictions, class names, logs and reports."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane import schemas
from corvane.functions.arrays import to_wide, wide_names
from corvane.operators.topk import wide_from_topk

#: A site's folder of predictions.
PARTITIONED = "predictions_partitioned"


def listing(spark: SparkSession, folder: str, pattern: str = "*.{wav,WAV}", limit: int | None = None) -> DataFrame:
    """(path, length) of matching files, contents unread; with a limit the first by path."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "length")
    return files if limit is None else files.orderBy("path").limit(limit)


def either_case(pattern: str) -> str:
    """A glob for a pattern and the same in upper case."""
    return pattern if pattern == pattern.upper() else "{" + pattern + "," + pattern.upper() + "}"


def output_size(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def legacy_embeddings(spark: SparkSession, folder: str, files_each: int | None = None) -> DataFrame:
    """Wide embeddings below plain numbered folders, as arrays with checkpoint_id; unreadable files are left out.

    files_each: only the first files, by path, of each folder. Half-precision columns can't be read by Spark."""
    reader = spark.read.option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true")
    wide = reader.parquet(folder).withColumn("_file", F.col("_metadata.file_path"))
    if files_each is not None:
        paths = wide.select(F.col("_file").alias("p")).distinct().withColumn("d", F.regexp_extract("p", r"^(.*)/[^/]+$", 1))
        first = paths.withColumn("rn", F.row_number().over(Window.partitionBy("d").orderBy("p"))).where(F.col("rn") <= files_each)
        wide = wide.join(first.select("p").hint("merge"), F.col("_file") == F.col("p"), "left_semi")
    names = wide_names(wide.columns)
    keys = [c for c in ("file", "file_path", "chunk_idx", "start_time", "end_time") if c in wide.columns]
    id_ = F.regexp_extract(F.col("_file"), r"/(\d+)/[^/]+$", 1)
    return wide.select(*keys, F.array(*[F.col(n).cast("float") for n in names]).alias("embedding"), F.nullif(id_, F.lit("")).cast("int").alias("checkpoint_id"))


@F.pandas_udf(T.ArrayType(T.FloatType()))
def half(x: pd.Series) -> pd.Series:
    """Embeddings with the precision of half floats, as floats: Spark has no half type and can't read Parquet's."""
    there = x.notna().to_numpy()
    values = [np.asarray(v, np.float32) for v in x[there]]
    with np.errstate(over="ignore"):
        flat = np.concatenate(values).astype(np.float16).astype(np.float32) if values else np.empty(0, np.float32)
    parts = iter(np.split(flat, np.cumsum([len(v) for v in values])[:-1])) if values else iter(())
    return pd.Series([next(parts) if t else None for t in there], index=x.index, dtype=object)


def write_embeddings(df: DataFrame, path: str, wide: int | None = None, half_precision: bool = False) -> None:
    """Parquet by checkpoint_id; the partitions that df has are replaced, others stay. Without that column one plain table, replaced as a whole.
    wide: as so many emb_ columns."""
    if half_precision:
        df = df.withColumn("embedding", half("embedding"))
    if wide:
        df = df.select(*[c for c in df.columns if c != "embedding"], *to_wide(F.col("embedding"), wide))
    writer = df.write.mode("overwrite").option("compression", "snappy")
    if "checkpoint_id" in df.columns:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy("checkpoint_id")
    writer.parquet(path)


def null_names(df: DataFrame) -> DataFrame:
    """Species that a CSV writes as nothing, NA or nan are null."""
    tops = [c for c in df.columns if c.startswith("top") and c[3:].isdigit()]
    return df.withColumns({c: F.when(~F.col(c).isin("", "NA", "nan", "NaN", "null", "N/A"), F.col(c)) for c in tops})


def predictions(spark: SparkSession, paths: str | list[str], k: int = 10, lenient: bool = False) -> DataFrame:
    """Wide predictions from CSV files with headers. lenient: broken files and rows are left out, and no rows at all is an error."""
    reader = spark.read.schema(schemas.wide_predictions(k)).option("header", True).option("enforceSchema", False)
    if lenient:
        reader = reader.option("mode", "DROPMALFORMED").option("ignoreCorruptFiles", "true").option("enforceSchema", True)
    out = null_names(reader.csv(paths))
    if lenient and not out.limit(1).count():
        raise ValueError(f"no predictions in {paths}")
    return out


def write_predictions(df: DataFrame, path: str, one_file: bool = False) -> None:
    """Wide predictions as CSV with headers, by the tasks that have them; one_file: by one task, for what fits one."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("header", True).csv(path)


def export_predictions(spark: SparkSession, ingested: str, path: str, k: int = 10, checkpoint: bool = True) -> None:
    """What ingest wrote, as wide CSV files: with checkpoint a folder for each batch, its number in the column checkpoint_id too."""
    rows = spark.read.parquet(f"{ingested}/predictions")
    keys = [*schemas.KEY_NAMES, F.col("batch_id").cast("int").alias("checkpoint_id")] if checkpoint else [*schemas.KEY_NAMES]
    wide = wide_from_topk(rows, keys, k)
    if checkpoint:
        wide.withColumn("checkpoint", F.format_string("checkpoint_%04d", "checkpoint_id")).write.mode("overwrite").option("header", True).partitionBy("checkpoint").csv(path)
    else:
        write_predictions(wide, path)


def export_embeddings(spark: SparkSession, ingested: str, path: str, size: int = schemas.EMBEDDING_SIZE, half_precision: bool = False) -> None:
    """What ingest wrote, as wide Parquet files by checkpoint_id."""
    rows = spark.read.parquet(f"{ingested}/embeddings").withColumnRenamed("batch_id", "checkpoint_id")
    write_embeddings(rows, path, size, half_precision)


def related_folders(spark: SparkSession, folder: str, legacy: bool = False) -> list[str]:
    """The folders of predictions of all deployments of a site: for .../A4-2/predictions_partitioned that of each folder beside A4-2 whose
    name is A4 or A4-<n> (with legacy, starts with A4), by name. Any other folder stands for itself."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder.rstrip("/"))
    site = path.getParent()
    if path.getName() != PARTITIONED or site is None or site.getParent() is None:
        return [folder]
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    base = site.getName().split("-")[0]
    names = [s.getPath().getName() for s in fs.listStatus(site.getParent()) if s.isDirectory()] if fs.exists(site.getParent()) else []
    own = [n for n in names if (n.startswith(base) if legacy else n == base or n.startswith(base + "-"))]
    found = [jvm.org.apache.hadoop.fs.Path(jvm.org.apache.hadoop.fs.Path(site.getParent(), n), PARTITIONED) for n in sorted(own)]
    return [p.toString() for p in found if fs.exists(p)] or [folder]


def site_predictions(spark: SparkSession, folder: str, k: int = 10, legacy: bool = False) -> DataFrame:
    """Predictions of all deployments of a folder's site: a column site, and null where a deployment's files lack a column."""
    own = [predictions(spark, f, k, lenient=True).withColumn("site", F.lit(f.rstrip("/").split("/")[-2])) for f in related_folders(spark, folder, legacy)]
    out = own[0]
    for more in own[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def class_names(spark: SparkSession, path: str) -> DataFrame:
    """(idx, species) of a JSON list of names."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.posexplode(F.from_json("value", "array<string>")).alias("idx", "species"))


def model_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.MODEL).option("multiLine", True).json(path)


def checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """The processed files of a checkpoint; none from a broken one."""
    read = spark.read.schema(schemas.CHECKPOINT).option("multiLine", True).json(path)
    return read.select(F.explode("processed_files").alias("file_path")).distinct()


def processed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("file_path").distinct()


def job_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def benchmark_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.BENCHMARK).option("multiLine", True).json(path)


def write_json(df: DataFrame, path: str, one_file: bool = False) -> None:
    (df.coalesce(1) if one_file else df).write.mode("overwrite").json(path)


def sites(paths: DataFrame, path: str = "path") -> DataFrame:
    """Each file's site: the folder that holds it."""
    return paths.withColumn("site", F.element_at(F.split(F.col(path), "/"), -2))
