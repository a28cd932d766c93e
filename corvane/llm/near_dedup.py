"""Near-duplicate documents by SetSketch registers: exponentially spaced, truncated minima, of which bands are matched,
pairs are estimated by likelihood together with the sizes of their sets, and confirmed on their full sets of shingles."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordCodes, byte_words, gram_codes, mix, scratch, sliced, staged
from .graph import components

#: Words in a shingle; links need 100 * intersection >= SIMILAR * union.
WIDTH, SIMILAR = 5, 75
#: Bands of ROWS registers: two sets with a similarity of 0.75 share no band with probability (1 - 0.75**4)**40 = 2.4e-7 at most.
BANDS, ROWS = 40, 4
REGISTERS = BANDS * ROWS
#: Registers are floor(1 - log(h / RATE) / log(BASE)), cut to 16 bits; h is the least of unit exponentials.
BASE, RATE, MOST = 1.02, 20.0, (1 << 16) - 1
#: A pair goes on to its full sets unless the best likelihood from SIMILAR upwards lies SLACK below the best of all.
SLACK = 14.0
#: Equal registers that a linked pair has at least (5.3 standard deviations below the mean of a pair at the threshold).
LEAST_SAME = 90
#: Nodes of a block in which a group is compared by sketches, and of one in which a dense group is compared by full sets.
BLOCK, DENSE_BLOCK = 128, 512

_FACTORS = (mix(np.arange(1, REGISTERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def shingles(text: str | None, codes: WordCodes) -> np.ndarray:
    """The sorted distinct 64-bit codes of a text's shingles of WIDTH words; a shorter text is one shingle."""
    words = byte_words(text, lower=True)
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(gram_codes(codes(words), min(WIDTH, len(words))))


def set_digest(codes: np.ndarray) -> bytes:
    return hashlib.blake2b(codes.tobytes(), digest_size=16).digest()


def registers(codes: np.ndarray) -> np.ndarray:
    """The SetSketch of a set that isn't empty. Sketches merge by their maximum."""
    x, least = (codes >> np.uint64(32)).astype(np.uint32), np.full(REGISTERS, np.iinfo(np.uint32).max)
    for i in range(0, len(x), 1024):
        np.minimum(least, np.multiply.outer(x[i : i + 1024], _FACTORS).min(axis=0), out=least)
    u = (least.astype(np.float64) + 0.5) / 2.0**32
    h = -np.log1p(-u)
    return np.clip(np.floor(1.0 - np.log(h / RATE) / np.log(BASE)), 0, MOST).astype(np.uint16)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each row of registers."""
    out = np.empty((len(regs), BANDS), np.uint64)
    parts = regs.reshape(len(regs), BANDS, ROWS).astype(np.uint64)
    packed = parts[:, :, 0] << np.uint64(48) | parts[:, :, 1] << np.uint64(32) | parts[:, :, 2] << np.uint64(16) | parts[:, :, 3]
    out[:] = mix(mix(packed) + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
    return out


def likely(nu: np.ndarray, nv: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether pairs with set sizes nu, nv and registers a, b may be as similar as SIMILAR asks, by the joint likelihood of the
    counts of greater, smaller and equal registers."""
    ok = 100 * np.minimum(nu, nv) >= SIMILAR * np.maximum(nu, nv)
    if not ok.any():
        return ok
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = REGISTERS - more - less
    x = (nu / (nu + nv))[:, None]
    y = 1.0 - x
    top = np.minimum(nu, nv) / np.maximum(nu, nv)
    grid = np.concatenate([np.linspace(0.0, 0.74, 38), np.linspace(SIMILAR / 100, 1.0, 26)])[None, :]
    j = np.minimum(grid, top[:, None])
    p = lambda z: -np.log(1.0 - np.clip(z, 0.0, 1.0) * (BASE - 1.0) / BASE) / np.log(BASE)
    up, down = np.maximum(p(x - y * j), 1e-12), np.maximum(p(y - x * j), 1e-12)
    score = more[:, None] * np.log(up) + less[:, None] * np.log(down) + same[:, None] * np.log(np.maximum(1.0 - up - down, 1e-12))
    return ok & (score[:, 38:].max(axis=1) >= score.max(axis=1) - SLACK)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * intersection >= SIMILAR * union, for sorted distinct codes."""
    if 100 * min(len(a), len(b)) < SIMILAR * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= SIMILAR * (len(a) + len(b) - both)


def sketch_table(docs: DataFrame) -> DataFrame:
    """rid, doc_id, n_shingles, node (digest of the set; null if empty), regs for each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for batch in sliced(batches):
            size, node, regs = [], [], []
            for text in batch.column(1).to_pylist():
                own = shingles(text, codes)
                size.append(len(own))
                node.append(set_digest(own) if len(own) else None)
                regs.append(registers(own).tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(node, pa.binary()), pa.array(regs, pa.binary())], ["doc_id", "n_shingles", "node", "regs"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, node binary, regs binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _bands(nodes: DataFrame) -> DataFrame:
    """(key, nid) for each band of each node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                keys = band_keys(_matrix(b.column(1))).astype(np.int64, copy=False).view(np.int64).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(b.column(0).to_numpy(), BANDS))], ["key", "nid"])

    return nodes.select("nid", "regs").mapInArrow(run, "key long, nid long")


def _promising(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (u, v) whose sketches allow a link."""
    side = lambda x: nodes.select(F.col("nid").alias(x), F.col("n").alias(f"n{x}"), F.col("regs").alias(f"r{x}"))
    # Sort-merge joins at every size: a hot node's rows are split between tasks, and nothing is sent to all.
    joined = pairs.hint("merge").join(side("u"), "u").hint("merge").join(side("v"), "v").select("u", "v", "nu", "nv", "ru", "rv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                keep = likely(b.column(2).to_numpy().astype(float), b.column(3).to_numpy().astype(float), _matrix(b.column(4)), _matrix(b.column(5)))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["u", "v"]).filter(pa.array(keep))

    return joined.mapInArrow(run, "u long, v long")


def _confirmed(pairs: DataFrame, docs: DataFrame, path: str) -> DataFrame:
    """The pairs (u, v) of doc_ids whose full sets are similar."""
    pairs = staged(pairs.distinct(), f"{path}/pairs")
    needed = pairs.select(F.col("u").alias("doc_id")).unionAll(pairs.select(F.col("v").alias("doc_id"))).distinct()
    texts = staged(docs.join(needed.hint("merge"), "doc_id", "left_semi"), f"{path}/texts")
    side = lambda x: texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"t{x}"))
    joined = pairs.hint("merge").join(side("v"), "v").hint("merge").join(side("u"), "u").select("u", "v", "tu", "tv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, known = WordCodes(), {}
        for b in sliced(batches):
            keep = []
            for v, tu, tv in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                if (v, len(tv or "")) not in known or known[v, len(tv or "")][0] != tv:  # pairs of one centre follow one another
                    known = {(v, len(tv or "")): (tv, shingles(tv, codes))}
                keep.append(similar(shingles(tu, codes), known[v, len(tv or "")][1]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return staged(joined.mapInArrow(run, "u long, v long").distinct(), f"{path}/links")


def _groups(met: DataFrame, labels: DataFrame, path: str) -> DataFrame:
    """(key, nid, lab) of the nodes that met one centre, for centres whose nodes lie in different components."""
    rows = met.select(F.col("center").alias("key"), "nid").distinct()
    rows = rows.join(labels.withColumnRenamed("node", "nid"), "nid", "left").select("key", "nid", F.coalesce("root", "nid").alias("lab"))
    # Two nodes of one group are a node and its centre, which have been compared.
    rows = staged(rows, f"{path}/labelled")
    several = rows.groupBy("key").agg(F.min("lab").alias("a"), F.max("lab").alias("b"), F.count(F.lit(1)).alias("c")).where("a <> b AND c > 2").select("key")
    # Both sides are written first, so that a hot key's rows can be split between the tasks of the join.
    return rows.join(staged(several, f"{path}/several").hint("merge"), "key", "left_semi")


def _block_pairs(rows: DataFrame, size: int, path: str) -> DataFrame:
    """(key, a, b): pairs of blocks of a group's rows (key, nid, lab, n, load), as lists of structs.

    A component with more than `size` rows in a group has blocks of its own, the others share blocks. Two blocks of one component make no
    pair. So a large component costs its size times what else is in its groups. Pairs are made of the blocks' names first and get
    their rows by name, so that the blocks of one large group are dealt to all tasks."""
    # Both sides are written before they are joined, so that a key with many components can be split between tasks.
    per_lab = staged(rows.groupBy("key", "lab").agg(F.count(F.lit(1)).alias("c")), f"{path}/per-component")
    big = F.col("c") > size
    pool = staged(per_lab.groupBy("key").agg(F.sum(F.when(~big, F.col("c")).otherwise(0)).alias("pool")), f"{path}/pools")
    sizes = staged(per_lab.join(pool.hint("merge"), "key"), f"{path}/sizes")
    own = F.xxhash64("lab", F.pmod(F.xxhash64("nid"), F.ceil(F.col("c") / size)))
    shared = F.pmod(F.xxhash64("lab"), F.ceil(F.col("pool") / size))
    named = rows.join(sizes.hint("merge"), ["key", "lab"]).select("key", F.when(big, own).otherwise(shared).alias("blk"), F.when(big, F.col("lab")).alias("one"), F.struct("nid", "lab", "n", "load").alias("m"))
    blocks = staged(named.groupBy("key", "blk").agg(F.min("one").alias("one"), F.collect_list("m").alias("ms")), f"{path}/blocks")
    names = lambda x: blocks.select("key", F.col("blk").alias(f"{x}_blk"), F.col("one").alias(f"{x}_one"))
    pairs = names("a").join(names("b"), "key").where("a_blk <= b_blk AND NOT (a_one IS NOT NULL AND b_one IS NOT NULL AND a_one = b_one)")
    side = lambda x: blocks.select("key", F.col("blk").alias(f"{x}_blk"), F.col("ms").alias(x))
    return pairs.select("key", "a_blk", "b_blk").join(side("a").hint("merge"), ["key", "a_blk"]).join(side("b").hint("merge"), ["key", "b_blk"]).select("key", "a", "b")


def _columns(block: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    nid, lab, n = (block.field(c).to_numpy(zero_copy_only=False) for c in ("nid", "lab", "n"))
    return nid, lab, n.astype(float), block.field("load").to_pylist()


def _compared(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The key and both blocks of each row, one row at a time."""
    key, a, b = batch.columns
    for k in range(batch.num_rows):
        yield key[k].as_py(), _columns(a[k].values), _columns(b[k].values)


def _crossing(rows: DataFrame, nodes: DataFrame, path: str) -> DataFrame:
    """(key, u, v): pairs of nodes of one group that lie in different components and whose sketches allow a link. Where a pair of blocks has
    more pairs than twice its nodes, it gives none but a row with null u and v, which marks its group as dense."""
    loaded = rows.hint("merge").join(nodes.select("nid", "n", F.col("regs").alias("load")), "nid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, (ai, al, an, ar), (bi, bl, bn, br) in _compared(batch):
                ar, br = (np.frombuffer(b"".join(x), np.uint16).reshape(-1, REGISTERS) for x in (ar, br))
                us, vs, n = [], [], 0
                for i in range(len(ai)):
                    at = np.flatnonzero(((br == ar[i]).sum(axis=1) >= LEAST_SAME) & (bl != al[i]))
                    if len(at):
                        at = at[likely(np.full(len(at), an[i]), bn[at], np.broadcast_to(ar[i], (len(at), REGISTERS)), br[at])]
                    us.append(np.maximum(ai[i], bi[at]))
                    vs.append(np.minimum(ai[i], bi[at]))
                    n += len(at)
                    if n > 2 * (len(ai) + len(bi)):
                        break
                if n > 2 * (len(ai) + len(bi)):
                    yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64())], ["key", "u", "v"])
                elif n:
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, key)), pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["key", "u", "v"])

    return _block_pairs(loaded, BLOCK, path).mapInArrow(run, "key long, u long, v long")


def shared_counts(a: list[np.ndarray], b: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """The sizes of the intersections of each two of the sorted sets of a and b, by products of `width` columns at a time."""
    names = np.intersect1d(np.concatenate(a), np.concatenate(b))
    out = np.zeros((len(a), len(b)), np.float32)

    def cells(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        at = np.minimum(np.searchsorted(names, flat), len(names) - 1)
        ok = names[at] == flat
        order = np.argsort(at[ok], kind="stable")
        return at[ok][order], row[ok][order]

    if len(names):
        (ac, ar), (bc, br) = cells(a), cells(b)
        for first in range(0, len(names), width):
            w = min(width, len(names) - first)
            x, y = np.zeros((len(a), w), np.float32), np.zeros((len(b), w), np.float32)
            for m, c, r in ((x, ac, ar), (y, bc, br)):
                lo, hi = np.searchsorted(c, [first, first + w])
                m[r[lo:hi], c[lo:hi] - first] = 1
            out += x @ y.T
    return out


def _dense_links(rows: DataFrame, docs: DataFrame, path: str) -> DataFrame:
    """Links (u, v) of dense groups (key, nid, lab), enough of them to join all components that links join. Full sets are compared as
    matrices, block by block, so that the many pairs that are nearly similar never become rows."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for b in sliced(batches):
            own = [shingles(t, codes) for t in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array([len(x) for x in own], pa.int64()), pa.array([x.tobytes() for x in own], pa.binary())], ["key", "nid", "lab", "n", "load"])

    texts = docs.join(rows.select(F.col("nid").alias("doc_id")).distinct().hint("merge"), "doc_id", "left_semi").select(F.col("doc_id").alias("nid"), "text")
    loaded = rows.hint("merge").join(texts, "nid").select("key", "nid", "lab", "text").mapInArrow(sets, "key long, nid long, lab long, n long, load binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, (ai, al, an, ar), (bi, bl, bn, br) in _compared(batch):
                both = shared_counts([np.frombuffer(x, np.uint64) for x in ar], [np.frombuffer(x, np.uint64) for x in br])
                ok = (100 * both >= SIMILAR * (an[:, None] + bn[None, :] - both)) & (al[:, None] != bl[None, :])
                root: dict[int, int] = {}
                us, vs = [], []
                for i, j in np.argwhere(ok):
                    x, y = int(al[i]), int(bl[j])
                    while root.get(x, x) != x:
                        x = root[x]
                    while root.get(y, y) != y:
                        y = root[y]
                    if x != y:
                        root[max(x, y)] = min(x, y)
                        us.append(max(ai[i], bi[j]))
                        vs.append(min(ai[i], bi[j]))
                if us:
                    yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    return _block_pairs(staged(loaded, f"{path}/sets"), DENSE_BLOCK, path).mapInArrow(run, "u long, v long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row for each row of docs (doc_id, text): doc_id, n_shingles, component_id (the smallest doc_id reachable over links),
    kept (doc_id = component_id). Texts have A-Z lower-cased and are sets of WIDTH-word shingles; a link needs a similarity of
    SIMILAR / 100 at least, confirmed on full sets.

    A text without words, or null, has an empty set and links with nothing. A null doc_id is measured, never linked, has a null
    component and is kept. Rows of one doc_id are one document: what any of them links with. No documents give no rows. Extra
    columns are ignored.

    Equal sets are one node from the start, however many documents share them. In each bucket of a band all nodes are
    compared with the smallest, its centre, which costs one pair a node. What met one centre and is still in different components is
    compared in blocks of sketches (see _crossing); where nearly similar pairs abound,
    blocks of full sets are compared as matrices (see _dense_links). So no bucket is cut short and no group is expanded into its
    pairs. Links and components stay in tables."""
    spark = docs.sparkSession
    at = scratch(spark, "near")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    table = staged(sketch_table(docs), f"{at}/sketches")
    named = table.where("n_shingles > 0 AND doc_id IS NOT NULL")
    nodes = staged(named.groupBy("node").agg(F.min("doc_id").alias("nid"), F.first("n_shingles").alias("n"), F.first("regs").alias("regs")), f"{at}/nodes")
    # A doc_id that repeats with other texts ties its nodes together.
    ties = named.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("doc_id")
    tied = named.join(ties, "doc_id", "left_semi").select("doc_id", "node").join(nodes.select("node", "nid"), "node").select(F.col("doc_id").alias("u"), F.col("nid").alias("v"))

    rows = _bands(nodes)
    buckets = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("nid").alias("center")).where("c > 1")
    met = staged(rows.join(staged(buckets, f"{at}/buckets").hint("merge"), "key"), f"{at}/met")
    tried = staged(_promising(met.where("nid <> center").select(F.col("nid").alias("u"), F.col("center").alias("v")).distinct(), nodes), f"{at}/tried")
    links = _confirmed(tried, docs, f"{at}/first").unionAll(tied)
    labels = components(links, f"{at}/components")
    left = staged(_groups(met, labels, f"{at}/groups"), f"{at}/left")
    if left.limit(1).count():
        crossing = staged(_crossing(left, nodes, f"{at}/compared"), f"{at}/crossing")
        dense = staged(crossing.where("u IS NULL").select("key").distinct(), f"{at}/dense")
        more = crossing.where("u IS NOT NULL").join(dense, "key", "left_anti").select("u", "v").distinct().join(tried, ["u", "v"], "left_anti")
        new = _confirmed(more, docs, f"{at}/second")
        if dense.limit(1).count():
            new = new.unionAll(staged(_dense_links(left.join(dense, "key", "left_semi"), docs, f"{at}/dense-compared"), f"{at}/third"))
        if new.limit(1).count():
            # What is known of the components goes on as stars.
            labels = components(labels.select(F.col("node").alias("u"), F.col("root").alias("v")).unionAll(new), f"{at}/joined")
    found = nodes.select("node", "nid").join(labels.withColumnRenamed("node", "nid"), "nid", "left").select("node", F.coalesce("root", "nid").alias("component"))
    out = table.join(staged(found, f"{at}/found").hint("merge"), "node", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] || ' ' || ws[i+3] || ' ' || ws[i+4] END AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*)::BIGINT AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.v, r.root FROM r JOIN l ON l.u = r.doc_id WHERE r.root < l.v),
c AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id)
SELECT c.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, c.doc_id = component_id AS kept FROM c LEFT JOIN n ON n.doc_id = c.doc_id
"""
