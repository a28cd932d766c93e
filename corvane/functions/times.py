"""Times of day and windows of recording."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def second_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def hour_of_day(seconds: Column) -> Column:
    return (seconds / 3600.0) % 24


def hour_fraction(seconds: Column) -> Column:
    return hour_of_day(seconds) / 24


def in_window(hour: Column, start: Column | float, end: Column | float) -> Column:
    """start <= hour <= end, or around midnight if start > end."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    s, e = lit(start), lit(end)
    return F.when(s <= e, (hour >= s) & (hour <= e)).otherwise((hour >= s) | (hour <= e))


def frame_seconds(frame: Column, hop: int = 512, rate: int = 32_000) -> Column:
    return frame * hop / F.lit(float(rate))


def realtime_factor(files: Column, elapsed: Column, seconds_a_file: Column | float = 60.0) -> Column:
    """Seconds of audio for each second of work; null where no time passed. Files count 60 s unless their own length is given."""
    each = seconds_a_file if isinstance(seconds_a_file, Column) else F.lit(seconds_a_file)
    return F.when(elapsed > 0, files * each / elapsed)


def speedup(baseline: Column, current: Column) -> Column:
    return F.when(current > 0, baseline / current).otherwise(F.lit(0.0))


def percent_faster(baseline: Column, current: Column) -> Column:
    return F.when(baseline > 0, (baseline - current) / baseline * 100).otherwise(F.lit(0.0))


def cpu_efficiency(workers: Column, threads: Column, cpus: Column) -> Column:
    """Configured, not measured, use of CPUs in percent."""
    return workers * threads / cpus * 100


def group_size(ram_mb: Column, chunks_a_file: Column, chunk_samples: int = 160_000) -> Column:
    """Files of a group that fits a memory budget: four fifths of what does, one at least."""
    chunk_mb = chunk_samples * 4 / 2**20
    return F.greatest(F.lit(1), F.floor(F.floor(ram_mb / (F.lit(chunk_mb) * 1.5 * chunks_a_file)) * 0.8))


def mean_chunks(durations: Column, chunk_seconds: float = 5.0, default: float = 12.0) -> Column:
    """An aggregate: mean chunks a file, `default` without any file."""
    return F.coalesce(F.avg(F.ceil(durations / chunk_seconds)), F.lit(default))
