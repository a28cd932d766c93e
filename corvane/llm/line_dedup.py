"""Line dedup with two Bloom filters: hashes of lines seen once and seen again, a pair of filters for each range of hashes; only lines
that a second filter suspects are shuffled, for exact confirmation and the choice of a first occurrence."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, mix, scratch, staged
from .parts import code_lists, dealt, pack, read_part

STRIP = " \t\n\v\f\r"
#: Bits for each line's hash (at least) and hash functions.
BITS_EACH, PROBES = 12, 4
#: Most bits of one filter (8 MB), and least. More lines make more ranges of hashes, not larger or fuller filters.
SHARD_BITS, LEAST_BITS = 1 << 26, 1 << 10
#: Ranges of hashes at least, if there are as many lines, so that all tasks have some.
LEAST_SHARDS = 16
#: Hashes that go into a filter at once.
TOGETHER = 1 << 16
#: Bytes of text in a part.
PART_BYTES = 8 << 20
NO_ID = -(1 << 63)


def line_key(line: str) -> str:
    return ascii_lower(line.strip(STRIP))


def key_hash(key: str) -> int:
    return xxhash.xxh3_64_intdigest(key.encode("utf-8", "surrogatepass"))


def key_digest(key: str) -> bytes:
    return hashlib.blake2b(key.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def probes(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The PROBES bits of each hash, in a filter whose size is a power of two."""
    a, b = mix(hashes), mix(hashes ^ np.uint64(0x5851F42D4C957F2D)) | np.uint64(1)
    return (a[:, None] + b[:, None] * np.arange(PROBES, dtype=np.uint64)) & np.uint64(bits - 1)


def set_bits(words: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(words, (at >> np.uint64(3)).astype(np.int64), (np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)))


def test_bits(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (words[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


class TwoFilters:
    """Filters for hashes seen once, and seen again."""

    def __init__(self, bits: int):
        self.bits, self.once, self.again = bits, np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        """Adds the hashes of some documents, each as often as documents have it."""
        uniq, counts = np.unique(hashes, return_counts=True)
        at = probes(uniq, self.bits)
        seen = test_bits(self.once, at).all(axis=1) | (counts > 1)
        set_bits(self.again, at[seen].ravel())
        set_bits(self.once, at.ravel())

    def suspects(self, hashes: np.ndarray) -> np.ndarray:
        """Which of the hashes may have been seen again."""
        return test_bits(self.again, probes(hashes, self.bits)).all(axis=1)


def keys_of(text: str | None, min_chars: int) -> dict[str, int]:
    """The keys of a text's lines, with the place of the first line of each."""
    out: dict[str, int] = {}
    for i, line in enumerate((text or "").split("\n")):
        k = line_key(line)
        if len(k) >= min_chars and k not in out:
            out[k] = i
    return out


def describer(min_chars: int):
    """Line counts, and the hashes of distinct keys in the order of their first lines."""

    def describe(texts: list[str | None]) -> tuple[list[int], list[np.ndarray]]:
        return [(t or "").count("\n") + 1 for t in texts], [np.array([key_hash(k) for k in keys_of(t, min_chars)], np.uint64) for t in texts]

    return describe


def filter_plan(n_hashes: int) -> tuple[int, int]:
    """How many ranges of hashes there are, and the bits of each one's filters."""
    n = max(1, -(-BITS_EACH * n_hashes // SHARD_BITS), min(LEAST_SHARDS, BITS_EACH * n_hashes // LEAST_BITS))
    bits = min(8, SHARD_BITS)
    while bits < min(SHARD_BITS, max(LEAST_BITS, BITS_EACH * n_hashes / n)):
        bits *= 2
    return n, bits


def by_range(codes: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """The distinct hashes of a part by range, those of several of its documents twice."""
    names, count = np.unique(codes, return_counts=True)
    names = np.repeat(names, np.minimum(count, 2))
    own = ((names >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)
    edge = np.append(np.flatnonzero(np.diff(own, prepend=-1)), len(own))
    for x, y in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        yield int(own[x]), names[x:y]


def suspected(parts: DataFrame, path: str, n_parts: int, n_hashes: int) -> DataFrame:
    """(p, hashes) of the line hashes that the second filter of their range suspects to stand in several documents."""
    n, bits = filter_plan(n_hashes)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, file in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = list(by_range(code_lists(read_part(path, file, ["codes"])["codes"])[0], n))
                if rows:
                    shards, hashes = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int64()), pa.array([p] * len(rows), pa.int64()), pa.array([h.view(np.int64) for h in hashes], pa.list_(pa.int64()))], ["shard", "p", "hashes"])

    def sift(rows: pa.Table) -> pa.Table:
        # A range's hashes are bounded by the size of its filters.
        rows = rows.combine_chunks()
        lists = rows["hashes"].chunk(0)
        flat, ends = lists.flatten().to_numpy().view(np.uint64), np.cumsum(lists.value_lengths().to_numpy())
        both = TwoFilters(bits)
        for x in range(0, len(flat), TOGETHER):
            both.add(flat[x : x + TOGETHER])
        hit = np.concatenate([both.suspects(flat[x : x + TOGETHER]) for x in range(0, len(flat), TOGETHER)])
        at = np.searchsorted(ends, np.flatnonzero(hit), side="right")
        return pa.table({"p": pa.array(rows["p"].to_numpy()[at], pa.int64()), "h": pa.array(flat[hit].view(np.int64), pa.int64())})

    ranges = dealt(parts.select("p", "file"), n_parts).mapInArrow(split, "shard long, p long, hashes array<long>")
    return ranges.repartition(n, "shard").groupBy("shard").applyInArrow(sift, "p long, h long").distinct()


def dedup_lines(docs: DataFrame, min_docs: int = 2, min_chars: int = 1, keep_first: bool = True, with_text: bool = True) -> DataFrame:
    """One row for each row of docs (doc_id, text): doc_id, n_lines, n_dropped, kept_sha256 and, with_text, kept_text.

    A text is split at newlines; a null or empty one is one empty line. A line's key is the line without white space at its
    ends and with A-Z lower-cased. Lines whose key has min_chars code points at least and stands in min_docs documents at least
    go, but with keep_first each key keeps its first line: that of the smallest doc_id, and in it the smallest line number.

    Rows of one doc_id count as one document, and each loses the lines; rows whose doc_id is null count as one document too.
    No documents give no rows. Extra columns are ignored, whatever their names.

    Texts are packed into part files, with their lines' 64-bit hashes, and stay there. Hashes go to the filters of their range, 8 bytes for
    each distinct line of a part; the number of ranges follows the number of lines, so filters are as full at every size, and a
    line that doesn't recur is suspected at a rate of under one in a hundred. Suspected lines are shuffled as 16-byte digests with their
    documents, counted exactly, and those that are lost come back to the parts that have them, once for each part."""
    at = scratch(docs.sparkSession, "lines")
    parts = pack(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), at, lambda: describer(min_chars), lambda codes: codes[:0], PART_BYTES)
    n_parts, n_hashes = parts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_codes"), F.lit(0))).first()
    files = dealt(parts.select("p", "file"), n_parts).groupBy("p")
    hits = staged(suspected(parts, at, n_parts, n_hashes), f"{at}/suspected")

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if right.num_rows:
            part, names = read_part(at, left["file"][0].as_py(), ["doc_id", "text", "codes"]), np.sort(right["h"].to_numpy().view(np.uint64))
            flat, first = code_lists(part["codes"])
            hit = np.flatnonzero(names[np.minimum(np.searchsorted(names, flat), len(names) - 1)] == flat)
            doc = np.searchsorted(first, hit, side="right") - 1
            ids, now, keys = part["doc_id"].to_pylist(), -1, []
            for d, j, h in zip(doc.tolist(), (hit - first[doc]).tolist(), flat[hit].view(np.int64).tolist(), strict=True):
                if d != now:
                    now, keys = d, list(keys_of(part["text"][d].as_py(), min_chars).items())
                rows.append((left["p"][0].as_py(), NO_ID if ids[d] is None else ids[d], h, key_digest(keys[j][0]), keys[j][1]))
        cols, kinds = list(zip(*rows, strict=True)) or [[]] * 5, [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["p", "rid", "h", "key", "place"])

    occ = staged(files.cogroup(dealt(hits, n_parts).groupBy("p")).applyInArrow(look, "p long, rid long, h long, key binary, place long"), f"{at}/occurrences")
    each = occ.groupBy("key", "rid").agg(F.min("place").alias("place"))
    # Written first, so that a hot key's rows can be split between the tasks of the join.
    counts = staged(each.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("rid", "place")).alias("first")).where(F.col("c") >= min_docs).drop("c"), f"{at}/counts")
    lost = staged(occ.select("p", "h", "key").distinct().join(counts.hint("merge"), "key").select("p", "h", "key", "first.rid", "first.place"), f"{at}/lost")

    def clean(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows:
            part = read_part(at, left["file"][0].as_py(), ["doc_id", "text", "n", "codes"])
            names = np.sort(right["h"].to_numpy().view(np.uint64))
            flat, first = code_lists(part["codes"])
            hit = np.concatenate([[0], np.cumsum(names[np.minimum(np.searchsorted(names, flat), len(names) - 1)] == flat if len(names) else np.zeros(len(flat), bool))])
            loses = (hit[first[1:]] > hit[first[:-1]]).tolist()
            gone = dict(zip(right["key"].to_pylist(), zip(right["rid"].to_pylist(), right["place"].to_pylist(), strict=True), strict=True))
            for i, t, n, some in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), part["n"].to_pylist(), loses, strict=True):
                text, dropped = t or "", 0
                if some:
                    spare, kept = (NO_ID if i is None else i), []
                    for k, line in enumerate(text.split("\n")):
                        key = line_key(line)
                        where = gone.get(key_digest(key)) if len(key) >= min_chars else None
                        if where is None or (keep_first and where == (spare, k)):
                            kept.append(line)
                    text, dropped = "\n".join(kept), n - len(kept)
                out.append((i, n, dropped, hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(), text if with_text else None))
        cols, kinds = list(zip(*out, strict=True)) or [[]] * 5, [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "n_lines", "n_dropped", "kept_sha256", "kept_text"])

    kinds = "doc_id long, n_lines long, n_dropped long, kept_sha256 string, kept_text string"
    done = files.cogroup(dealt(lost, n_parts).groupBy("p")).applyInArrow(clean, kinds)
    return done if with_text else done.drop("kept_text")


ORACLE = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS n FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
b AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
j AS (SELECT k.*, b.key IS NOT NULL AS gone FROM k LEFT JOIN b ON k.key = b.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, sum(gone::INT)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM j GROUP BY doc_id
"""
