"""A content-addressed store of token ids: rolling hashes cut each document's ids into chunks, unique chunks are stored
once, recipes list each document's chunks in ascending doc_id order, and Merkle roots verify what is read back.

Layout, all Parquet: chunks/ (hash, ids: little-endian integers of the store's width), recipes/ (seg, doc_id,
pos, local_start, n_tokens, root, hashes; sorted by doc_id within and across segments), manifest/ (seg, n_docs, n_tokens,
seg_root, start, width; seg_root is that of a Merkle tree over the segment's recipes), root/ (a digest of the manifest)."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .common import delete, mix, scratch, shards, sliced, staged
from .encoding import REMEMBERED, default_path, encoder

#: Ids under the rolling hash, mean chunk (a power of two), longest chunk, ids of one segment of recipes.
WINDOW, MEAN_CHUNK, MOST_CHUNK, SEGMENT_IDS = 16, 512, 4096, 1 << 27
DIGEST = 16
#: Children of a node of a segment's Merkle tree.
GROUP = 1024
MANIFEST = ("seg", "n_docs", "n_tokens", "width", "seg_root", "start")


def _scrambled(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.uint64) + np.uint64(1)) >> np.uint64(32)).astype(np.uint32)


_SMALL = _scrambled(np.arange(1 << 16))


def _rolled(ids: np.ndarray) -> np.ndarray:
    """A 32-bit hash of each WINDOW (a power of two) ids in a row, by doubling."""
    x, width = _SMALL[ids] if ids.dtype.itemsize == 2 else _scrambled(ids), 1
    while width < WINDOW:
        x = x[: max(0, len(x) - width)] * np.uint32(pow(0x9E3779B1, width, 1 << 32)) + x[width:]
        width *= 2
    return x


def cuts(ids: np.ndarray) -> list[int]:
    """Ends of the chunks of an id stream. A cut depends on the WINDOW ids before it alone, so equal passages get equal chunks."""
    return cuts_of([len(ids)], ids)[0]


def cuts_of(sizes: list[int], ids: np.ndarray) -> list[list[int]]:
    """cuts of several streams that lie one after the other in ids, by one rolling hash over all."""
    ends = np.flatnonzero(_rolled(ids) < np.uint32((1 << 32) // MEAN_CHUNK)) + WINDOW
    stops = np.cumsum(sizes)
    starts = stops - sizes
    lo, hi = np.searchsorted(ends, starts + WINDOW), np.searchsorted(ends, stops)
    ends = ends.tolist()
    out = []
    for start, n, a, b in zip(starts.tolist(), sizes, lo.tolist(), hi.tolist(), strict=True):
        own, last = [], 0
        for e in [*(x - start for x in ends[a:b]), n]:
            while e - last > MOST_CHUNK:
                last += MOST_CHUNK
                own.append(last)
            if e > last:
                own.append(e)
                last = e
        out.append(own)
    return out


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=DIGEST).digest()


def merkle(leaves: list[bytes]) -> bytes:
    """The root of a binary tree over digests; an odd last one moves up."""
    level = leaves
    while len(level) > 1:
        level = [digest(b"\1" + level[i] + level[i + 1]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0] if level else digest(b"")


def _times(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    """CRCs after so many zero bytes as the table is for."""
    return table[0][x & 255] ^ table[1][x >> 8 & 255] ^ table[2][x >> 16 & 255] ^ table[3][x >> 24]


@lru_cache(maxsize=1)
def _shifts() -> list[np.ndarray]:
    """For 2**k zero bytes, k = 0..40, what each of the four bytes of a CRC becomes."""
    one = np.array([zlib.crc32(b"\0", i ^ 0xFFFFFFFF) ^ 0xFFFFFFFF for i in range(256)], np.uint32)
    rows = [one]
    for k in range(1, 4):
        rows.append((np.arange(256, dtype=np.uint32) << np.uint32(8 * k - 8)).astype(np.uint32))
    out = [np.stack(rows)]
    for _ in range(40):
        t = out[-1]
        out.append(np.stack([_times(t, row) for row in t]))
    return out


def crc_shift(crcs: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """What CRC-32s contribute to the CRC of a string that goes on for n_bytes after them."""
    out, n, k = crcs.astype(np.uint32), n_bytes.astype(np.int64), 0
    while (n >> k).any():
        at = np.flatnonzero(n >> k & 1)
        out[at] = _times(_shifts()[k], out[at])
        k += 1
    return out


def crc_join(a: int, b: int, n_bytes: int) -> int:
    """The CRC-32 of two strings one after the other, from those of each and the second one's length."""
    return int(crc_shift(np.array([a], np.uint32), np.array([n_bytes]))[0]) ^ b


def _segments(recipes: DataFrame) -> list[Row]:
    """seg, n_docs, n_tokens, width and seg_root, the root of the Merkle tree over its recipes in their order, of each segment, by seg.

    Nodes have GROUP children at most, so no task holds a segment; the driver gets a row for each segment."""
    leaf = F.sha2(F.concat_ws(",", F.hex("root"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), "local_start", "n_tokens", "width"), 256)
    nodes = recipes.select("seg", F.col("pos").alias("i"), leaf.alias("node"), F.lit(1).cast("long").alias("n_docs"), "n_tokens", "width")
    levels, span = 1, (recipes.agg(F.max("pos")).first()[0] or 0) + 1
    while GROUP**levels < span:
        levels += 1
    for _ in range(levels):
        own = F.transform(F.sort_array(F.collect_list(F.struct("i", "node"))), lambda x: x["node"])
        nodes = nodes.groupBy("seg", F.floor(F.col("i") / GROUP).alias("i")).agg(F.sha2(F.array_join(own, ""), 256).alias("node"), F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), F.max("width").alias("width"))
    return sorted(nodes.select("seg", "n_docs", "n_tokens", "width", F.col("node").alias("seg_root")).collect(), key=lambda r: r["seg"])


def _store_root(rows: list) -> str:
    """A digest over the manifest's rows in their order."""
    return hashlib.sha256("\n".join(",".join(str(r[c]) for c in MANIFEST) for r in sorted(rows, key=lambda r: r["seg"])).encode()).hexdigest()


def _check_segments(recipes: DataFrame, manifest: DataFrame, top: DataFrame) -> None:
    """An error unless the manifest is whole, and the recipes as read are those that it tells of, in its order."""
    told = manifest.collect()
    roots = [r[0] for r in top.collect()]
    if roots != [_store_root(told)]:
        raise ValueError("a segment of the manifest is missing or changed")
    read, told = ({r["seg"]: r for r in rows} for rows in (_segments(recipes), told))
    start = 0
    for seg in sorted({*read, *told}):
        if seg not in read or seg not in told:
            raise ValueError(f"segment {seg} is missing from the {'manifest' if seg in read else 'recipes'}")
        if any(read[seg][c] != told[seg][c] for c in ("n_docs", "n_tokens", "width", "seg_root")) or told[seg]["start"] != start:
            raise ValueError(f"the recipes of segment {seg} differ from the manifest")
        start += told[seg]["n_tokens"]


def write_store(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 0, remembered: int = REMEMBERED) -> None:
    """Encodes every whole text of docs (doc_id, text), end_id after each, and writes a store to path.

    A null or empty text is its end_id alone. Documents are ordered by doc_id, null first; rows of one doc_id follow one
    another by content and stay documents of their own. No documents make an empty store. Extra columns are ignored.

    remembered: words that a worker keeps the ids of; more take memory and save encoding them again.

    Texts are encoded once. Only chunks are shuffled, by their digests, and equal ones meet before the shuffle where they
    share a task, so copies cost their digests. Recipes are dealt by ranges of doc_id."""
    spark = docs.sparkSession
    at = scratch(spark, "encode")
    tokenizer = tokenizer or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, remembered)
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        for batch in sliced(batches):
            size, root, hashes, chunks = [], [], [], []
            for ids in enc.encoded(batch.column(1)):
                datas = pc.binary_join_element_wise(ids, end, b"")
                sizes = (pc.binary_length(datas).to_numpy() // enc.width).tolist()
                flat = np.frombuffer(datas.buffers()[2], enc.dtype, sum(sizes))
                for data, n, at in zip(datas.to_pylist(), sizes, cuts_of(sizes, flat), strict=True):
                    own = [data[a * enc.width : b * enc.width] for a, b in zip([0, *at], at, strict=False)]
                    size.append(n)
                    hashes.append([digest(c) for c in own])
                    root.append(merkle(hashes[-1]))
                    chunks.append(own)
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.binary())]
            cols = [size, [enc.width] * len(size), root, hashes, chunks]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], ["doc_id", "n_tokens", "width", "root", "hashes", "chunks"])

    kinds = "doc_id long, n_tokens long, width int, root binary, hashes array<binary>, chunks array<binary>"
    made = staged(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, kinds), f"{at}/made")
    made.select(F.explode(F.arrays_zip("hashes", "chunks")).alias("c")).select(F.col("c.hashes").alias("hash"), F.col("c.chunks").alias("ids")).dropDuplicates(["hash"]).write.option("compression", "zstd").parquet(f"{path}/chunks")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upto = pos = 0
        for batch in batches:
            n = batch.column(2).to_numpy()
            ends = upto + np.cumsum(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends - n, pa.int64()), pa.array(np.arange(pos, pos + len(n)))], [*batch.schema.names, "local_start", "pos"])
            upto, pos = int(ends[-1]) if len(ends) else upto, pos + len(n)

    n_rows, n_ids = made.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    n_seg = shards(n_ids + 16 * n_rows, SEGMENT_IDS, least=8)
    ordered = made.select("doc_id", "root", "n_tokens", "width", "hashes").repartitionByRange(n_seg, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "root")
    numbered = ordered.mapInArrow(place, "doc_id long, root binary, n_tokens long, width int, hashes array<binary>, local_start long, pos long").withColumn("seg", F.spark_partition_id())
    recipes = staged(numbered, f"{path}/recipes")
    rows, start = [], 0
    for r in _segments(recipes):
        rows.append({**r.asDict(), "start": start})
        start += r["n_tokens"]
    spark.createDataFrame([tuple(r[c] for c in MANIFEST) for r in rows], "seg int, n_docs long, n_tokens long, width int, seg_root string, start long").coalesce(1).write.parquet(f"{path}/manifest")
    # Written last: a store without it isn't whole.
    spark.createDataFrame([(_store_root(rows),)], "store_root string").coalesce(1).write.parquet(f"{path}/root")
    delete(spark, f"{at}/made")


def open_store(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The chunks, recipes and manifest of a store, once the recipes and the manifest are found to be whole."""
    recipe = "doc_id long, root binary, n_tokens long, width int, hashes array<binary>, local_start long, pos long, seg int"
    recipes = spark.read.schema(recipe).parquet(f"{path}/recipes")
    manifest = spark.read.schema("seg int, n_docs long, n_tokens long, width int, seg_root string, start long").parquet(f"{path}/manifest")
    _check_segments(recipes, manifest, spark.read.schema("store_root string").parquet(f"{path}/root"))
    return spark.read.schema("hash binary, ids binary").parquet(f"{path}/chunks"), recipes, manifest


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, seg, local_start, ids (array<int>) of every document, put together from its chunks. Recipes are checked against the manifest, chunks
    against their addresses; a missing one is an error."""
    chunks, recipes, _ = open_store(spark, path)
    parts = recipes.select("doc_id", "seg", "local_start", "width", F.posexplode("hashes").alias("ord", "hash")).join(chunks, "hash", "left")
    whole = parts.groupBy("doc_id", "seg", "local_start", "width").agg(F.sort_array(F.collect_list(F.struct("ord", "hash", "ids"))).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            ids = []
            for w, p in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):
                if any(x["ids"] is None for x in p):
                    raise ValueError("a document lacks a chunk")
                if any(digest(x["ids"]) != x["hash"] for x in p):
                    raise ValueError("a chunk doesn't match its address")
                ids.append(np.frombuffer(b"".join(x["ids"] for x in p), f"<u{w}").astype(np.int64).tolist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(ids, pa.list_(pa.int64()))], ["doc_id", "seg", "local_start", "ids"])

    return whole.mapInArrow(run, "doc_id long, seg int, local_start long, ids array<long>")


def store_digests(spark: SparkSession, path: str) -> DataFrame:
    """One row for each document of a store, from its files: doc_id, start, n_tokens, ids_crc32.

    Every stored chunk is read and checked against its address, every document's Merkle root is made again from its chunks'
    addresses, and lengths are compared with the recipes; the recipes of each segment are compared with the manifest. A fault ends
    the run with an error. CRCs of chunks join to those of documents, so no ids are shuffled, and documents of one content are put
    together once."""
    chunks, recipes, manifest = open_store(spark, path)
    width = manifest.agg(F.max("width")).first()[0] or 2

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            names, data = b.column(0).to_pylist(), b.column(1).to_pylist()
            if any(digest(x) != h for h, x in zip(names, data, strict=True)):
                raise ValueError("a chunk doesn't match its address")
            crc = [zlib.crc32(x if width == 4 else np.frombuffer(x, f"<u{width}").astype("<u4").tobytes()) for x in data]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) // width for x in data], pa.int64()), pa.array(crc, pa.int64())], ["hash", "n", "crc"])

    facts = chunks.mapInArrow(verify, "hash binary, n long, crc long")
    unique = recipes.select("root", "hashes").dropDuplicates(["root"])
    refs = unique.select("root", F.posexplode("hashes").alias("ord", "hash"))
    parts = refs.join(facts, "hash", "left").groupBy("root").agg(F.sort_array(F.collect_list(F.struct("ord", "hash", "n", "crc"))).alias("parts"))

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            lists = b.column(1)
            hashes, n, crc = (lists.flatten().field(c) for c in ("hash", "n", "crc"))
            if crc.null_count:
                raise ValueError("a document lacks a chunk")
            hashes, n, crc = hashes.to_pylist(), n.to_numpy(), crc.to_numpy()
            ends = np.cumsum(lists.value_lengths().to_numpy())
            first = np.concatenate([[0], ends[:-1]])
            upto = np.cumsum(n)
            if any(merkle(hashes[x:y]) != root for root, x, y in zip(b.column(0).to_pylist(), first.tolist(), ends.tolist(), strict=True)):
                raise ValueError("a document can't be put together from its chunks")
            after = np.repeat(upto[ends - 1], ends - first) - upto
            crcs = np.bitwise_xor.reduceat(crc_shift(crc, 4 * after), first)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.add.reduceat(n, first)), pa.array(crcs.astype(np.int64))], ["root", "n_read", "ids_crc32"])

    built = parts.mapInArrow(rebuild, "root binary, n_read long, ids_crc32 long")
    placed = recipes.select("doc_id", "seg", "local_start", "n_tokens", "root").join(manifest.select("seg", F.col("start").alias("seg_start")), "seg", "left")
    out = placed.join(built, "root", "left")
    start = F.col("seg_start") + F.col("local_start")
    checked = F.when(F.col("n_read") == F.col("n_tokens"), F.col("n_tokens")).otherwise(F.raise_error(F.lit("a document's length differs from its recipe")).cast("long"))
    return out.select("doc_id", start.cast("long").alias("start"), checked.alias("n_tokens"), "ids_crc32")


def encode_documents(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0, path: str | None = None, remembered: int = REMEMBERED) -> DataFrame:
    """write_store and then store_digests; without a path the store lies in a scratch folder."""
    spark = docs.sparkSession
    path = path or scratch(spark, "store")
    write_store(docs, path, tokenizer, end_id, remembered)
    return store_digests(spark, path)
