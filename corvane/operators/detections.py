"""From wide predictions to daily series: unpivot, thresholds, daily counts, top species, zero-filled days, centred means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unpivot_topk(wide: DataFrame, keys: list[str], k: int = 10) -> DataFrame:
    """keys, rank, species, score: a row for each topN/scoreN pair that wide has, in one pass. Missing pairs are left out."""
    have = [i for i in range(1, k + 1) if f"top{i}" in wide.columns and f"score{i}" in wide.columns]
    if not have:
        raise ValueError("no topN and scoreN columns")
    args = ", ".join(f"{i}, `top{i}`, CAST(`score{i}` AS DOUBLE)" for i in have)
    return wide.select(*keys, F.expr(f"stack({len(have)}, {args})").alias("rank", "species", "score"))


def passing(score: Column, threshold: float = 0.0) -> Column:
    """score >= threshold; never for NaN, which Spark orders above all numbers."""
    return (score >= threshold) & ~F.isnan(score)


def valid_species(species: Column) -> Column:
    return species.isNotNull() & (species != "") & (species != "nan")


def detections(long: DataFrame, threshold: float = 0.0) -> DataFrame:
    return long.where(passing(F.col("score"), threshold) & valid_species(F.col("species")))


def daily_counts(found: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(date, species, n) and the columns in `by`. Counts are partly summed before the one shuffle."""
    return found.groupBy("date", "species", *by).agg(F.count(F.lit(1)).alias("n"))


def species_totals(daily: DataFrame) -> DataFrame:
    return daily.groupBy("species").agg(F.sum("n").cast("long").alias("total"))


def top_species(daily: DataFrame, n: int = 15) -> DataFrame:
    """(species, total) of the n species with most detections; of equals the first by name."""
    return species_totals(daily).orderBy(F.desc("total"), "species").limit(n)


def of_top_species(daily: DataFrame, n: int = 15) -> DataFrame:
    # The limit bounds what is broadcast.
    return daily.join(F.broadcast(top_species(daily, n).select("species")), "species", "left_semi")


def calendar(daily: DataFrame) -> DataFrame:
    """daily with a row of n = 0 for each species and day between the first and last day of all that has none."""
    days = daily.agg(F.min("date").alias("a"), F.max("date").alias("b")).where("a IS NOT NULL").select(F.explode(F.sequence("a", "b")).alias("date"))
    grid = daily.select("species").distinct().crossJoin(F.broadcast(days))  # species x days is the result's own size; days are one range
    return grid.join(daily.select("date", "species", "n"), ["date", "species"], "left").select("date", "species", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def rolling_mean(series: DataFrame, width: int = 4, value: str = "n", by: str = "species", order: str = "date", to: str = "smooth") -> DataFrame:
    """The mean over a centred window of `width` rows, fewer at the ends; an even width reaches one further back than ahead."""
    back = width // 2
    w = Window.partitionBy(by).orderBy(order).rowsBetween(-back, width - 1 - back)
    return series.withColumn(to, F.avg(F.col(value).cast("double")).over(w))


def totals(daily: DataFrame) -> DataFrame:
    return daily.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("detections"), F.count_distinct("species").alias("species"), F.count_distinct("date").alias("days"))
