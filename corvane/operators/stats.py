"""Statistics of samples and comparisons of configurations."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Ranges of a group's values that are ranked apart from one another.
RANGES = 128


def ranked(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """by, value, _u, _n: for each distinct value of a group how many of its values are no greater, and how many it has. Nulls are left out.

    Values are counted first; approximate percentiles, a bounded row for each group, cut a group into RANGES, and ranks run within a range from where the
    range before it ended. So no task gets a whole group, however large, unless it is of few distinct values."""
    own = rows.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("_v"))
    counts = own.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_c"))
    cuts = own.groupBy(*by).agg(F.percentile_approx("_v", F.array(*[F.lit(i / RANGES) for i in range(1, RANGES)]), 1000).alias("_cuts"))
    same = lambda a, b: functools.reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in by], F.lit(True))
    placed = counts.join(cuts, same(counts, cuts)).select(*[counts[c] for c in by], "_v", "_c", F.size(F.filter("_cuts", lambda x: x < F.col("_v"))).alias("_r"))
    sums = placed.groupBy(*by, "_r").agg(F.sum("_c").alias("_s"))
    before = Window.partitionBy(*by).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("_start", F.coalesce(F.sum("_s").over(before), F.lit(0))).withColumn("_n", F.sum("_s").over(Window.partitionBy(*by)))
    within = Window.partitionBy(*by, "_r").orderBy("_v")
    upto = placed.withColumn("_w", F.sum("_c").over(within))
    out = upto.join(starts, same(upto, starts) & (upto["_r"] == starts["_r"]))
    return out.select(*[upto[c] for c in by], upto["_v"].alias(value), (F.col("_start") + F.col("_w")).alias("_u"), "_n")


def _at(value: str, place: Column) -> Column:
    """The value at a place, from 0, of ranked values in order."""
    return F.min(F.when(F.col("_u") > place, F.col(value)))


def _middle(value: str) -> Column:
    n = F.col("_n")
    return (_at(value, F.floor((n - 1) / 2)) + _at(value, F.ceil((n - 1) / 2))) / 2


def medians(rows: DataFrame, by: list[str], values: dict[str, str]) -> DataFrame:
    """by, and the median of each value under its new name; null where a group has none. Groups with a null key are groups too."""
    out = rows.select(*by).distinct()
    for value, name in values.items():
        own = ranked(rows, by, value).groupBy(*by).agg(_middle(value).alias(name))
        out = _beside(out, own, by, "left")
    return out


def _beside(left: DataFrame, right: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """left with right's other columns where all keys are the same, nulls too."""
    if not by:
        return left.crossJoin(right)  # one row each
    renamed = right.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], *[c for c in right.columns if c not in by])
    on = functools.reduce(lambda x, y: x & y, [left[c].eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(by)])
    return left.join(renamed, on, how).drop(*[f"_k{i}" for i in range(len(by))])


def nearest_percentiles(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """by, median, percentile_25, _75 and _95: these are the values at place int(n * p) of each group in order, for the 95th the largest below 20 values."""
    n = F.col("_n")
    p95 = F.when(n >= 20, F.floor(n * 0.95)).otherwise(n - 1)
    return ranked(rows, by, value).groupBy(*by).agg(_middle(value).alias("median"), _at(value, F.floor(n * 0.25)).alias("percentile_25"), _at(value, F.floor(n * 0.75)).alias("percentile_75"), _at(value, p95).alias("percentile_95"))


def sample_stats(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """count, mean, median, min, max, range, and for more than one value stdev, variance, coefficient_of_variation (percent, 0
    unless the mean is positive) and nearest-place percentiles. Groups without values are left out."""
    own = rows.where(F.col(value).isNotNull())
    v = F.col(value)
    base = own.groupBy(*by).agg(
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"),
        (F.max(v) - F.min(v)).alias("range"), F.stddev_samp(v).alias("stdev"), F.var_samp(v).alias("variance"),
    )
    many = F.col("count") > 1
    cv = F.when(many, F.when(F.col("mean") > 0, F.col("stdev") / F.col("mean") * 100).otherwise(0.0))
    out = _beside(base.withColumn("coefficient_of_variation", cv), nearest_percentiles(own, by, value), by)
    places = {f"percentile_{p}": F.when(many, F.col(f"percentile_{p}")) for p in (25, 75, 95)}
    return out.withColumns(places).select(*by, "count", "mean", "median", *[c for c in base.columns if c not in (*by, "count", "mean")], "coefficient_of_variation", *places)


def monitor_stats(value: str) -> list[Column]:
    """mean, median, max, min and stdev of readings, 0 without any."""
    v = F.col(value)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return [zero(F.avg(v)).alias(f"{value}_mean"), zero(F.median(v)).alias(f"{value}_median"), zero(F.max(v)).alias(f"{value}_max"), zero(F.min(v)).alias(f"{value}_min"), zero(F.stddev_samp(v)).alias(f"{value}_stdev")]


def cpu_readings(readings: DataFrame) -> DataFrame:
    """CPU readings above 0 only; memory readings all."""
    return readings.withColumn("cpu", F.when(F.col("cpu") > 0, F.col("cpu")))


def successful(runs: DataFrame) -> DataFrame:
    return runs.where("returncode = 0")


def speedups(configs: DataFrame, key: str, mean_time: str) -> DataFrame:
    """configs with baseline_time (the slowest's), speedup, percent_faster, time_saved and rank by speedup, of equals by key."""
    from corvane.functions.times import percent_faster, speedup

    base = configs.agg(F.max(mean_time).alias("baseline_time"))  # one row
    t = F.col(mean_time)
    out = configs.crossJoin(F.broadcast(base)).withColumns({"speedup": speedup(F.col("baseline_time"), t), "percent_faster": percent_faster(F.col("baseline_time"), t), "time_saved": F.col("baseline_time") - t})
    return out.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("speedup"), key)))


def speedup_summary(compared: DataFrame) -> DataFrame:
    return compared.agg(F.max("speedup").alias("max_speedup"), F.min("speedup").alias("min_speedup"), F.avg("speedup").alias("avg_speedup"), (F.max("speedup") - F.min("speedup")).alias("speedup_range"), F.count(F.lit(1)).alias("configs"))


def best_by(rows: DataFrame, by: list[str], value: str, key: str) -> DataFrame:
    """by, the key with the largest value (of equals the smallest key) and that value."""
    top = F.min_by(F.struct(key, value), F.struct(-F.col(value), F.col(key)))
    return rows.groupBy(*by).agg(top.alias("_b")).select(*by, F.col("_b")[key].alias(f"best_{key}"), F.col("_b")[value].alias(f"best_{value}"))


def with_matching_config(reports: DataFrame, comparisons: DataFrame, keys: tuple[str, ...] = ("workers", "batch_size", "loader_threads", "use_float16")) -> DataFrame:
    """Reports with the comparison of the same configuration, null where there is none."""
    return reports.join(comparisons, list(keys), "left")
