"""Joins of embeddings, predictions and processed files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_with_suffix(left: DataFrame, right: DataFrame, keys: list[str], suffix: str = "_pred", one_each: bool = False) -> DataFrame:
    """left join on keys; columns that both have get the suffix on the right. Rows that share a key meet each other; with
    one_each the right side has one row for a key, its smallest."""
    if one_each:
        others = [c for c in right.columns if c not in keys]
        right = right.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in others])
    same = set(left.columns) & set(right.columns) - set(keys)
    return left.join(right.select(*[F.col(c).alias(c + suffix if c in same else c) for c in right.columns]), keys, "left")


def not_processed(files: DataFrame, processed: DataFrame, key: str = "file_path") -> DataFrame:
    return files.join(processed.select(key), key, "left_anti")


def completion(expected: DataFrame, chunks: DataFrame, key: str = "file_path") -> DataFrame:
    """key, expected, done, complete: for each file how many chunks it has and how many are there."""
    done = chunks.groupBy(key).agg(F.count(F.lit(1)).alias("done"))
    out = expected.select(key, F.col("expected").cast("long").alias("expected")).join(done, key, "left")
    return out.select(key, "expected", F.coalesce("done", F.lit(0)).alias("done"), (F.coalesce("done", F.lit(0)) >= F.col("expected")).alias("complete"))


def related_sites(predictions: DataFrame, base: str, legacy: bool = False, site: str = "site") -> DataFrame:
    from corvane.functions.paths import related_site

    return predictions.where(related_site(F.col(site), base, legacy))


def first_files(files: DataFrame, k: int, by: str, order: str) -> DataFrame:
    """The first k files of each group."""
    from pyspark.sql import Window

    w = Window.partitionBy(by).orderBy(order)
    return files.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)


def numbered_groups(files: DataFrame, size: int, by: str, order: list[str]) -> DataFrame:
    """grp: rows in order, `size` to a group, within each value of `by`."""
    from pyspark.sql import Window

    rn = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return files.withColumn("grp", F.floor((rn - 1) / size).cast("long"))
