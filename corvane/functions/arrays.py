"""Signals and scores as arrays, by expressions that stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(x: Column) -> Column:
    return x.cast("array<double>")


def mono(channels: Column) -> Column:
    """The mean over interleaved arrays of one frame each: array<array<double>> to array<double>."""
    return F.transform(channels, lambda c: F.aggregate(c, F.lit(0.0), lambda a, v: a + v) / F.size(c))


def mono_interleaved(x: Column, channels: int) -> Column:
    """The mean over channels of interleaved samples."""
    n = (F.size(x) / channels).cast("int")
    frames = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    one = lambda i: F.aggregate(F.slice(x, i * channels + 1, channels), F.lit(0.0).cast("double"), lambda a, v: a + v) / channels
    return F.transform(frames, one)


def frame_numbers(n: Column, size: int) -> Column:
    """0 .. ceil(n / size) - 1, empty for no samples."""
    return F.when(n > 0, F.sequence(F.lit(0), F.ceil(n / size).cast("int") - 1)).otherwise(F.array().cast("array<int>"))


def frame(x: Column, i: Column, size: int) -> Column:
    """The i-th frame of `size` samples without overlap; the last may be short."""
    return F.slice(x, i * size + 1, size)


def start_time(i: Column, seconds: float) -> Column:
    return (i * F.lit(float(seconds))).cast("double")


def end_time(i: Column, n: Column, seconds: float, rate: float) -> Column:
    """The frame's end, no later than the signal's."""
    return F.least((i + 1) * F.lit(float(seconds)), n / F.lit(float(rate)))


def pad_right(x: Column, size: int, zero: Column | None = None) -> Column:
    return F.concat(x, F.array_repeat(F.lit(0.0) if zero is None else zero, F.greatest(F.lit(0), F.lit(size) - F.size(x))))


def peak(x: Column) -> Column:
    return F.array_max(F.transform(x, lambda v: F.abs(v)))


def peak_normal(x: Column, to: float = 0.25, floor: float = 1e-10, always: bool = False) -> Column:
    """x scaled to a peak of `to`. A signal whose peak isn't above floor stays as it is, or is scaled by `to` with always."""
    top = peak(x)
    scaled = F.transform(x, lambda v: v / top * to)
    quiet = F.transform(x, lambda v: v * to) if always else x
    return F.when(top > floor, scaled).otherwise(quiet)


def topk(scores: Column, k: int) -> Column:
    """array<struct<v, i>> of the k largest with their places from 0: NaN first, then by value, of equals the larger place first."""
    pairs = F.transform(scores, lambda v, i: F.struct(v.alias("v"), i.alias("i")))
    return F.slice(F.reverse(F.array_sort(pairs)), 1, k)


def relative(scores: Column, of: int = 5) -> Column:
    """The first `of` scores on a scale of 0 to 100 between their least and largest: 50 if all are equal; empty if none is
    finite; NaN throughout if some are but not all."""
    own = F.slice(scores, 1, of)
    finite = F.filter(own, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    low, high = F.array_min(finite), F.array_max(finite)
    spread = F.when(high > low, F.transform(own, lambda v: (v - low) / (high - low) * 100)).otherwise(F.transform(own, lambda v: F.lit(50.0)))
    nan = F.transform(own, lambda v: F.lit(float("nan")))
    return F.when(F.size(finite) == 0, F.array().cast("array<double>")).when(F.size(finite) < F.size(own), nan).otherwise(spread)


def first_valid(predictions: Column, k: int = 3) -> Column:
    """The first k of array<struct<species, confidence>> with a name and a finite confidence."""
    ok = lambda p: p["species"].isNotNull() & ~p["species"].isin("", "nan") & p["confidence"].isNotNull() & ~F.isnan(p["confidence"]) & (F.abs(p["confidence"]) != float("inf"))
    return F.slice(F.filter(predictions, ok), 1, k)


def confidence_level(x: Column) -> Column:
    return F.when(x >= 75, "very high").when(x >= 50, "high").when(x >= 25, "medium").otherwise("low")


def to_wide(x: Column, n: int, prefix: str = "emb_") -> list[Column]:
    return [F.get(x, F.lit(i)).alias(f"{prefix}{i}") for i in range(n)]


def wide_names(columns: list[str], prefix: str = "emb_") -> list[str]:
    """Columns of the prefix by the number that follows it."""
    return sorted((c for c in columns if c.startswith(prefix) and c[len(prefix) :].isdigit()), key=lambda c: int(c[len(prefix) :]))


def smart_truncate(s: Column, limit: int = 22, cut: int = 19, back: float = 0.6) -> Column:
    """s, or if longer than limit its first `cut` characters and "...", cut at their last space if it stands beyond back * limit."""
    head = F.substring(s, 1, cut)
    last = F.length(head) - F.locate(" ", F.reverse(head))  # from 0; length if there is none
    shorter = F.when((F.locate(" ", head) > 0) & (last > back * limit), last)
    return F.when(F.length(s) <= limit, s).otherwise(F.concat(F.when(shorter.isNotNull(), F.left(head, shorter.cast("int"))).otherwise(head), F.lit("...")))


def display_name(species: Column) -> Column:
    return F.replace(species, F.lit("_"), F.lit(" "))


def bar_width(duration: Column) -> Column:
    return F.greatest(F.lit(16.0), F.least(F.lit(30.0), duration / 3))


def radial_score(density: Column, offset: Column, span: Column) -> Column:
    return 3 * density + F.pow(offset / (0.3 * span), F.lit(1.5))


def least_gap(values: Column) -> Column:
    return F.array_max(values) - F.array_min(values)


def in_view(x: Column, y: Column, low: tuple[float, float], high: tuple[float, float]) -> Column:
    """Whether a point lies within a plot's axes, its edges included."""
    return x.between(low[0], high[0]) & y.between(low[1], high[1])
