"""Names, keys and times that are held in paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """The basename without its last suffix; a name that only starts with a dot, or ends with one, keeps it."""
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]+$", "")


def without_wav(name: Column) -> Column:
    """Without one .wav at the end, in either case."""
    return F.regexp_replace(name, r"(?i)\.wav$", "")


def chunk_key(path: Column, chunk_idx: Column) -> Column:
    """The display key of a chunk. The folder isn't in it, so it may repeat."""
    return F.concat_ws("_", stem(path), chunk_idx.cast("string"))


def trailing_int(key: Column) -> Column:
    """The number after the last underscore, 0 without one."""
    return F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(key, r"_(\d{1,9})$", 1), F.lit("")), F.lit("999999999")).cast("int"), F.lit(0))


def key_stem(key: Column) -> Column:
    """A chunk key without its number."""
    return F.regexp_extract(key, r"^(.*?)(?:_(\d+))?$", 1)


def file_timestamp(path: Column, least_year: int = 2024) -> Column:
    """The time that a file's whole stem gives as yyyyMMdd_HHmmss, without a zone; null if it doesn't or lies before least_year."""
    name = without_wav(basename(path))
    ts = F.try_to_timestamp(F.when(F.regexp_like(name, F.lit(r"^\d{8}_\d{6}$")), name), F.lit("yyyyMMdd_HHmmss")).cast("timestamp_ntz")
    return F.when(F.year(ts) >= least_year, ts)


def key_timestamp(key: Column, least_year: int = 2024) -> Column:
    """file_timestamp of a chunk key, by its first two parts."""
    return file_timestamp(F.concat_ws("_", F.get(F.split(key, "_"), F.lit(0)), F.get(F.split(key, "_"), F.lit(1))), least_year)


def path_timestamp(path: Column) -> Column:
    """The first yyyyMMdd_HHmmss anywhere in a path, " copy" left out."""
    found = F.nullif(F.regexp_extract(F.replace(path, F.lit(" copy"), F.lit("")), r"(\d{8}_\d{6})", 1), F.lit(""))
    return F.try_to_timestamp(found, F.lit("yyyyMMdd_HHmmss")).cast("timestamp_ntz")


def file_matches(file: Column, file_path: Column, audio_stem: Column | str) -> Column:
    """Whether a prediction row belongs to a recording, by its path, its key, or the start of its key."""
    want = audio_stem if isinstance(audio_stem, Column) else F.lit(audio_stem)
    return F.coalesce(stem(file_path) == want, F.lit(False)) | F.coalesce(key_stem(file) == want, F.lit(False)) | F.coalesce(file.startswith(want), F.lit(False))


def related_site(site: Column, base: str, legacy: bool = False) -> Column:
    """Whether a site is `base` or `base-<n>`; with legacy, whether its name starts with base."""
    return site.startswith(base) if legacy else (site == base) | site.rlike("^" + base.replace(".", r"\.") + r"-[^/]*$")


def base_site(site: Column) -> Column:
    return F.get(F.split(site, "-"), F.lit(0))
