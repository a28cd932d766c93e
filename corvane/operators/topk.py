"""Top-k of score arrays, in array, long and wide form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.functions.arrays import topk


def topk_long(df: DataFrame, scores: str, keys: list[str], k: int = 10) -> DataFrame:
    """keys, rank (from 1), idx, score."""
    best = df.select(*keys, F.posexplode(topk(F.col(scores), k)).alias("p", "b"))
    return best.select(*keys, (F.col("p") + 1).alias("rank"), F.col("b.i").alias("idx"), F.col("b.v").alias("score"))


def topk_wide(df: DataFrame, scores: str, keys: list[str], names: DataFrame | list[str] | None = None, k: int = 10) -> DataFrame:
    """keys, top1..topk, score1..scorek; nulls where there are fewer scores. names: the labels in the order of their index, a bounded
    vocabulary, as a list or a table (idx, species); else the index itself is the label."""
    best = df.select(*keys, topk(F.col(scores), k).alias("b"))
    if isinstance(names, DataFrame):
        names = [r["species"] for r in names.orderBy("idx").collect()]
    labels = F.array(*[F.lit(n) for n in names]) if names else None
    label = lambda i: F.get(labels, i) if names else i.cast("string")
    at = lambda j: F.get("b", F.lit(j))
    return best.select(*keys, *[label(at(j)["i"]).alias(f"top{j + 1}") for j in range(k)], *[at(j)["v"].alias(f"score{j + 1}") for j in range(k)])


def label(df: DataFrame, names: DataFrame, idx: str = "idx") -> DataFrame:
    """df with the species of each index; names (idx, species) is a vocabulary of fixed size."""
    return df.join(F.broadcast(names.select(F.col("idx").alias(idx), "species")), idx)


def from_topk(df: DataFrame, keys: list[str], k: int | None = None, column: str = "topk") -> DataFrame:
    """keys, rank, idx, species, score: a row for each prediction that inference kept, up to rank k."""
    rows = df.select(*keys, F.explode(column).alias("_t")).select(*keys, "_t.rank", "_t.idx", "_t.species", "_t.score")
    return rows if k is None else rows.where(F.col("rank") <= k)


def wide_from_topk(df: DataFrame, keys: list[str], k: int = 10, column: str = "topk") -> DataFrame:
    """keys, top1..topk, score1..scorek, the layout of prediction files; nulls where there are fewer."""
    at = lambda j: F.get(column, F.lit(j))
    return df.select(*keys, *[at(j)["species"].alias(f"top{j + 1}") for j in range(k)], *[at(j)["score"].alias(f"score{j + 1}") for j in range(k)])
