"""Histograms, rasters and runs of occupied bins; only cells ever reach a driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bin_of(x: Column, low: Column | float, high: Column | float, bins: int) -> Column:
    """The bin of x among `bins` equal ones from low to high; the last holds high itself; null outside, and all in bin 0 if low = high."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    lo, hi = lit(low), lit(high)
    at = F.when(hi > lo, F.floor((x - lo) / (hi - lo) * bins)).otherwise(F.lit(0))
    return F.when((x >= lo) & (x <= hi), F.least(at, F.lit(bins - 1))).cast("int")


def extent(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    return points.agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"))


def raster(points: DataFrame, width: int, height: int, x: str = "x", y: str = "y", value: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, px, py, n, mean of value) for each cell with points, over the points' extent."""
    placed = points.crossJoin(F.broadcast(extent(points, x, y)))  # one row
    px, py = bin_of(F.col(x), F.col("x0"), F.col("x1"), width), bin_of(F.col(y), F.col("y0"), F.col("y1"), height)
    sums = [F.count(F.lit(1)).alias("n")] + ([F.avg(value).alias("mean")] if value else [])
    return placed.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*by, px.alias("px"), py.alias("py")).agg(*sums)


def time_of_day_bins(rows: DataFrame, seconds: Column, width: int = 600) -> DataFrame:
    """(bin, n): rows in each bin of `width` seconds of the day."""
    return rows.select(F.floor(seconds / width).cast("int").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


def occupied(hist: DataFrame, share: float = 0.005) -> DataFrame:
    """Bins with at least `share` of the largest count, one row at least."""
    top = hist.agg(F.greatest(F.lit(1), F.floor(F.max("n") * share)).alias("least"))  # one row
    return hist.crossJoin(F.broadcast(top)).where(F.col("n") >= F.col("least")).drop("least")


def runs(bins: DataFrame) -> DataFrame:
    """(first_bin, last_bin) of each run of neighbouring bins."""
    island = F.col("bin") - F.row_number().over(Window.orderBy("bin"))  # a row for each bin of a day
    return bins.withColumn("g", island).groupBy("g").agg(F.min("bin").alias("first_bin"), F.max("bin").alias("last_bin")).drop("g")


def circular_runs(found: DataFrame, bins: int = 144) -> DataFrame:
    """runs with one that ends in the last bin and one that starts in the first merged into one that wraps (first_bin > last_bin), if
    there are more than one."""
    ends = found.agg(F.max(F.when(F.col("last_bin") == bins - 1, F.col("first_bin"))).alias("tail"), F.max(F.when(F.col("first_bin") == 0, F.col("last_bin"))).alias("head"), F.count(F.lit(1)).alias("k"))
    wraps = F.col("tail").isNotNull() & F.col("head").isNotNull() & (F.col("k") > 1)
    both = found.crossJoin(F.broadcast(ends))  # one row
    gone = wraps & ((F.col("first_bin") == 0))
    return both.where(~gone).select("first_bin", F.when(wraps & (F.col("last_bin") == bins - 1), F.col("head")).otherwise(F.col("last_bin")).alias("last_bin"))


def recording_windows(found: DataFrame, bins: int = 144, legacy: bool = False) -> DataFrame:
    """(kind, start_hour, end_hour): of circular runs the longest, or of two or more the two longest, as morning and evening by
    their centres. A run that wraps is measured around midnight; with legacy its length and centre are those of its ends as
    they stand, a negative length."""
    hour = 24.0 / bins
    raw = F.col("last_bin") + 1 - F.col("first_bin")
    length = raw if legacy else F.when(raw <= 0, raw + bins).otherwise(raw)
    centre = F.col("first_bin") * hour + length * hour / 2
    centre = centre if legacy else centre % 24
    sized = found.select("first_bin", "last_bin", length.alias("length"), centre.alias("centre"))
    order = Window.orderBy(F.desc("length"), "first_bin")
    best = sized.withColumn("rn", F.row_number().over(order)).where("rn <= 2")
    every = Window.partitionBy()
    kind = F.when(F.count(F.lit(1)).over(every) == 1, "single").when(F.row_number().over(Window.orderBy("centre", "first_bin")) == 1, "morning").otherwise("evening")
    return best.select(kind.alias("kind"), F.round(F.col("first_bin") * hour, 6).alias("start_hour"), F.round((F.col("last_bin") + 1) * hour, 6).alias("end_hour"))
