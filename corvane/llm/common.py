"""What the training-data operators share: the word pattern, scratch folders that all executors
see, staged Parquet tables and hashing of words."""

from __future__ import annotations

import gc
import math
import re
import tempfile
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: Rows that a worker takes from an Arrow batch at a time; Spark bounds the batch itself by bytes.
BATCH_ROWS = 2_000
#: Seconds between the driver's garbage collections.
TIDY_SECONDS = 4.0

#: Folders made so far, by who owns them.
_made: dict[str, list[str]] = {}
_owner = [""]
_local: dict[str, str] = {}
_tidied = [0.0]


def is_local(spark: SparkSession) -> bool:
    """Whether the driver is the only process, so that its own folders reach all tasks."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def scratch_root(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only where that is unset and the master is local."""
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get().rstrip("/")
    if not is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = "file://" + tempfile.mkdtemp(prefix="corvane-")
    return _local[app]


def unique() -> str:
    return uuid.uuid4().hex


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's URI below the shared root. It belongs to the innermost `owned`."""
    path = f"{scratch_root(spark)}/corvane-{name}-{unique()}"
    _made.setdefault(_owner[-1], []).append(path)
    return path


@contextmanager
def owned(name: str) -> Iterator[None]:
    """Scratch folders made within belong to `name`."""
    _owner.append(name)
    try:
        yield
    finally:
        _owner.pop()


def release(spark: SparkSession, owner: str) -> None:
    """Deletes the owner's scratch folders. Call it only once every result read from them is written; other folders stay."""
    for path in _made.pop(owner, []):
        delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def staged(df: DataFrame, path: str) -> DataFrame:
    """df, written to path as Parquet and read again: lost executors cost no recomputation beyond it."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    tidy(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of plans that nothing refers to any more; it does so when the driver collects garbage. Not more
    often than every TIDY_SECONDS."""
    if time.monotonic() - _tidied[0] > TIDY_SECONDS:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        _tidied[0] = time.monotonic()


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a scratch URI, on a driver or an executor."""
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


def shards(rows_bytes: float, each: float, least: int = 12) -> int:
    """How many partitions of about `each` bytes a table of so many bytes makes."""
    return max(least, math.ceil(rows_bytes / each))


def sliced(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in slices of `rows` rows at most, without empty ones."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch] | pa.RecordBatch], schema) -> DataFrame:
    """mapInArrow with a function from one batch to one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            yield fn(batch)

    return df.mapInArrow(run, schema)


def byte_words(text: str | None, lower: bool = False) -> list[bytes]:
    """The words `[^\\x20\\x09-\\x0D]+` of a text in UTF-8, with `lower` with A-Z lower-cased: bytes are split at just these six characters."""
    if not text:
        return []
    data = text.encode("utf-8", "surrogatepass")
    return (data.translate(_LOWERED) if lower else data).split()


def ascii_lower(text: str) -> str:
    """text with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWERED).decode("utf-8", "surrogatepass")


def gaps(found: list) -> list[int]:
    """The places of None."""
    out, at = [], -1
    try:
        while True:
            at = found.index(None, at + 1)
            out.append(at)
    except ValueError:
        return out


class WordCodes:
    """64-bit codes of words, with a bounded memory of words."""

    def __init__(self, bound: int = 100_000):
        self.bound, self.known = bound, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > self.bound:
            known.clear()
        found = list(map(known.get, words))
        for k in gaps(found):
            w = words[k]
            found[k] = known[w] = xxhash.xxh3_64_digest(w)
        return np.frombuffer(b"".join(found), ">u8").astype(np.uint64)


def word_numbers(texts: pa.Array | pa.ChunkedArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words `[^\\x20\\x09-\\x0D]+` of a column of texts, the number among them of each word of the column, and the place of
    each text's first word, with the number of words at the end."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))  # at just these six characters
    words = lists.flatten()
    some = pc.greater(pc.binary_length(words), 0)
    n = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())]).astype(np.int64)
    words = words.filter(some).dictionary_encode()
    return words.dictionary, words.indices.to_numpy(), n[ends]


def word_codes(names: pa.Array) -> np.ndarray:
    """The codes that WordCodes gives these words."""
    digests = map(xxhash.xxh3_64_digest, names.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist())
    return np.frombuffer(b"".join(digests), ">u8").astype(np.uint64)


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def gram_codes(codes: np.ndarray, n: int, odd: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A 64-bit code for each run of n codes, by doubling; empty if there are fewer."""
    if len(codes) < n:
        return np.empty(0, np.uint64)
    one = (1 << 64) - 1
    done, size, block, width, out = 0, len(codes) - n + 1, codes, 1, None
    base = odd
    left = n
    while left:
        if left & 1:
            part = block[done : done + size]
            out = part if out is None else out * np.uint64(pow(odd, width, 1 << 64)) + part
            done += width
        left >>= 1
        if left:
            block = block[:-width] * np.uint64(base & one) + block[width:]
            base = base * base & one
            width *= 2
    return mix(out + np.uint64(n))
