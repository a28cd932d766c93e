"""Benchmark decontamination by the q-gram lemma: shared character q-grams are counted in overlapping diagonal bands,
regions that meet the bound of the edit budget are retained, and a banded alignment verifies them."""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filesystem, gram_codes, mix, scratch, sliced, staged, unique

#: Characters in a q-gram and in a segment of an item, characters for each edit of the budget, diagonals from one band to the next.
Q, SEGMENT, EACH_EDIT, STEP = 12, 96, 16, 16
#: Characters of items in one block; a benchmark of more is searched for in several passes.
BLOCK_CHARS = 4_000_000
FILTER_BITS = 22
#: Characters of texts that wait for the next block, and places of items that one stretch of a text may share q-grams with.
HELD_CHARS, MOST_PLACES = 32_000_000, 4_000_000
#: Segments of an item that are aligned at once.
TOGETHER = 256
NOT_WORD = re.compile(r"[\W_]+")


def normal(text: str | None) -> str:
    """Lower case, with one space for each run of characters that are neither letters nor digits."""
    return NOT_WORD.sub(" ", text.lower()).strip() if text else ""


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def codes_of(text: str) -> np.ndarray:
    return mix(points(text).astype(np.uint64) + np.uint64(1))


def budget(m: int) -> int:
    """Edits that a segment of m characters may differ by; the lemma then still asks for two shared q-grams where it can."""
    return max(0, min(m // EACH_EDIT, (m - Q - 1) // Q))


@dataclass
class Index:
    """A block of items. An item up to SEGMENT characters is one segment, of a longer one each SEGMENT characters in a row are."""

    name: list[int] = field(default_factory=list)
    whole: list[str] = field(default_factory=list)
    short: list[tuple[int, str]] = field(default_factory=list)

    @classmethod
    def of(cls, items: Iterable[tuple[int, str]]) -> Index:
        out = cls()
        for name, raw in items:
            t = normal(raw)
            if len(t) >= Q:
                out.name.append(name)
                out.whole.append(t)
            elif t:
                out.short.append((name, f" {t} "))
        out.finish()
        return out

    def finish(self) -> None:
        self.length = np.array([len(t) for t in self.whole], np.int64)
        self.size = np.minimum(self.length, SEGMENT)
        self.budget = np.array([budget(m) for m in self.size.tolist()], np.int64)
        #: The lemma: a region within e edits shares m - Q + 1 - Q * e q-grams at least.
        self.least = np.maximum(1, self.size - Q + 1 - Q * self.budget)
        grams = [gram_codes(codes_of(t), Q) for t in self.whole]
        flat = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        own = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        off = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.empty(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.names, first = np.unique(flat[order], return_index=True)
        self.first = np.append(first, len(flat))
        self.own, self.off = own[order], off[order]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(self.names >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        self.span = int(self.budget.max(initial=0))
        #: Added to diagonals, so that none is negative.
        self.shift = -(-int(self.length.max(initial=0)) // STEP) * STEP

    # The segments one by one, as a brute force compares them; the search doesn't list them.
    @cached_property
    def item(self) -> list[int]:
        return [x for x, n, m in zip(self.name, self.length.tolist(), self.size.tolist(), strict=True) for _ in range(n - m + 1)]

    @cached_property
    def text(self) -> list[str]:
        return [t[a : a + m] for t, m in zip(self.whole, self.size.tolist(), strict=True) for a in range(len(t) - m + 1)]

    @cached_property
    def edits(self) -> np.ndarray:
        return np.repeat(self.budget, self.length - self.size + 1)

    def shared(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of a text's q-grams that items have too, and which of the items' distinct q-grams they are."""
        if not len(self.names):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.flatnonzero(self.filter[(grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.names, grams[at]), len(self.names) - 1)
        ok = self.names[place] == grams[at]
        return at[ok], place[ok]

    def regions(self, at: np.ndarray, place: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(place of an item, first diagonal, starts of segments) of the bands in which these segments' counts of shared q-grams, as `shared` gives
        them, meet their bound."""
        n = self.first[place + 1] - self.first[place]
        rows = np.repeat(self.first[place] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        own, off = self.own[rows], self.off[rows]
        diag = np.repeat(at, n) - off + self.shift
        # Bands start every STEP diagonals and reach `span` beyond the next start, so each alignment lies in one as a whole.
        both = (diag % STEP <= self.span) & (diag >= STEP)
        key = np.concatenate([own << 40 | diag // STEP, (own << 40 | (diag // STEP - 1))[both]])
        found, group, count = np.unique(key, return_inverse=True, return_counts=True)
        enough = count >= self.least[found >> 40]
        if not enough.any():
            return
        kept = enough[group]
        group, off = group[kept], np.concatenate([off, off[both]])[kept]
        order = np.lexsort((off, group))
        group, off = group[order], off[order]
        edge = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(group))
        for x, y in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            k = int(found[group[x]])
            e = k >> 40
            m, least, mine = int(self.size[e]), int(self.least[e]), off[x:y]
            # From each q-gram to the one that completes the bound: the segments that hold both.
            lo = np.maximum(mine[least - 1 :] - (m - Q), 0)
            hi = np.minimum(mine[: len(mine) - least + 1], int(self.length[e]) - m)
            some = lo <= hi
            if some.any():
                step = np.zeros(int(self.length[e]) - m + 2, np.int64)
                np.add.at(step, lo[some], 1)
                np.add.at(step, hi[some] + 1, -1)
                yield e, (k & ((1 << 40) - 1)) * STEP - self.shift, np.flatnonzero(np.cumsum(step[:-1]))

    def stretches(self, at: np.ndarray, place: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
        """Ranges of q-grams of a text of `size` that together hold each part that may align, each in one of them as a whole, and share
        MOST_PLACES places with items at most, or are as short as they get."""
        longest = int((self.size + self.budget).max(initial=Q))
        upto = np.concatenate([[0], np.cumsum(self.first[place + 1] - self.first[place])])
        waiting = [(0, size)]
        while waiting:
            x, y = waiting.pop()
            lo, hi = np.searchsorted(at, [x, y + longest])
            if lo == hi:
                continue
            if upto[hi] - upto[lo] > MOST_PLACES and y - x > longest:
                waiting += [(x, (x + y) // 2), ((x + y) // 2, y)]
            else:
                yield x, min(y + longest, size)

    def leaks(self, text: str) -> list[int]:
        """The items of which the (normal) text holds a segment within its budget."""
        out = {name for name, t in self.short if t in f" {text} "} if self.short else set()
        if len(text) >= Q:
            whole = points(text)
            grams = gram_codes(mix(whole.astype(np.uint64) + np.uint64(1)), Q)
            at, place = self.shared(grams)
            for x, y in self.stretches(at, place, len(grams)):
                lo, hi = np.searchsorted(at, [x, y])
                chars = whole[x : y + Q - 1]
                for e, diag, starts in self.regions(at[lo:hi] - x, place[lo:hi]):
                    if self.name[e] not in out and aligned(points(self.whole[e]), starts, int(self.size[e]), chars, diag, STEP + self.span, int(self.budget[e])):
                        out.add(self.name[e])
        return sorted(out)


def aligned(item: np.ndarray, starts: np.ndarray, size: int, chars: np.ndarray, diag: int, width: int, edits: int) -> bool:
    """Whether a segment of `size` characters of item, from one of `starts`, aligns as a whole with a part of chars within `edits` edits, on
    diagonals of the item from diag to diag + width, and `edits` more at either side."""
    lo, n = diag - edits, width + 2 * edits + 1
    far = edits + 1
    steps = np.arange(n)
    # The one in the middle first: of a whole copy it is enough. Then the others, TOGETHER at a time.
    middle = len(starts) // 2
    rest = np.delete(starts, middle)
    for some in (starts[middle : middle + 1], *(rest[k : k + TOGETHER] for k in range(0, len(rest), TOGETHER))):
        base, over = int(some[0]), int(some[-1]) - int(some[0]) + size + n
        # The characters that the item's character base + i meets are padded[i : i + n].
        padded = np.full(over, np.uint32(0xFFFFFFFF))
        first = lo + base
        a, b = max(first, 0), min(first + over, len(chars))
        if b > a:
            padded[a - first : b - first] = chars[a:b]
        meets = np.lib.stride_tricks.sliding_window_view(padded, n)
        row = some - base
        pos = (first + row)[:, None] + steps
        # cell[s, k]: edits of the best alignment of segment s so far that ends before position pos[s, k] + i of chars
        cell = np.where((pos >= 0) & (pos <= len(chars)), 0, far)
        for i in range(size):
            take = cell + (meets[row + i] != item[base + row + i][:, None])
            take[:, :-1] = np.minimum(take[:, :-1], cell[:, 1:] + 1)
            inside = (pos + i + 1 >= 0) & (pos + i + 1 <= len(chars))
            now = np.where(inside, take, far)
            now = np.minimum(np.minimum.accumulate(now - steps, axis=1) + steps, far)
            cell = np.where(inside, now, far)
            alive = cell.min(axis=1) <= edits
            if not alive.all():
                row, pos, cell = row[alive], pos[alive], cell[alive]
                if not len(row):
                    break
        if len(row):
            return True
    return False


def write_indexes(benchmark: DataFrame, path: str) -> list[str]:
    """Indexes items in blocks of about BLOCK_CHARS, each by a task, and writes an index to a file in path. Returns the files' names."""
    items = benchmark.where("text IS NOT NULL").select(F.coalesce(F.col("item_id").cast("long"), F.lit(-1).cast("long")).alias("item_id"), "text")
    n_chars = items.agg(F.coalesce(F.sum(F.char_length("text").cast("long")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-n_chars // BLOCK_CHARS))

    def index(block: pa.Table) -> pa.Table:
        name = f"{unique()}.index"
        fs, where = filesystem(path)
        fs.create_dir(where, recursive=True)
        made = Index.of(zip(block["item_id"].to_pylist(), block["text"].to_pylist(), strict=True))
        with fs.open_output_stream(f"{where}/{name}") as f:
            f.write(pickle.dumps(made, protocol=5))
        return pa.table({"name": [name]})

    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))).repartition(min(n_blocks, 10_000), "block")
    return sorted(r[0] for r in staged(dealt.groupBy("block").applyInArrow(index, "name string"), f"{path}/names").collect())  # a name for each block


_loaded: dict[str, Index] = {}


def load_index(path: str, name: str) -> Index:
    """An index; a worker process keeps the latest one."""
    if name not in _loaded:
        _loaded.clear()
        fs, where = filesystem(path)
        with fs.open_input_file(f"{where}/{name}") as f:
            _loaded[name] = pickle.loads(f.read())
    return _loaded[name]


def flag(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs with item_ids, the sorted ids of the items that each text holds, after its columns; a column of that name gives way to it.

    One pass. If the benchmark makes several blocks, texts wait until HELD_CHARS of them are there, and go through block after block."""
    path = scratch(docs.sparkSession, "benchmark")
    names = write_indexes(benchmark, path)
    docs = docs.select(*[c for c in docs.columns if c.lower() != "item_ids"])
    at = docs.columns.index("text")
    most = HELD_CHARS if len(names) > 1 else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.RecordBatch, list[str], list[set[int]]]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for name in names:
                index = load_index(path, name)
                for _, texts, found in held:
                    for t, own in zip(texts, found, strict=True):
                        own.update(index.leaks(t))
            for b, _, found in held:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(map(sorted, found)), pa.list_(pa.int64()))], [*b.schema.names, "item_ids"])
            held.clear()

        for b in sliced(batches):
            texts = [normal(t) for t in b.column(at).to_pylist()]
            held.append((b, texts, [set() for _ in texts]))
            size += sum(map(len, texts))
            if size >= most:
                yield from flush()
                size = 0
        yield from flush()

    schema = docs.withColumn("item_ids", F.array().cast("array<long>")).schema
    return docs.mapInArrow(run, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each row of docs (doc_id, text): doc_id, item_ids (sorted), n_items, contaminated. An item of benchmark
    (item_id, text) is in a document whose text holds it, or of a longer item any SEGMENT characters in a row, within one edit for
    each EACH_EDIT characters, after `normal` on both sides. Items of under Q characters must stand as whole words.

    A null or empty text holds no item; a null or empty item is in no text; an item without an id is -1. Items of one id are one item. Repeated
    rows are judged one by one, a null doc_id stays null. No items: nothing is contaminated. Extra columns are ignored, whatever their names.

    The benchmark is a query set: blocks of it, of bounded size, are indexed by tasks and written to shared files. Documents stay where they are, and a
    task holds one block's index at a time. Of a text it holds a stretch at a time, as long as its q-grams allow."""
    out = flag(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark)
    return out.select("doc_id", "item_ids", F.size("item_ids").cast("long").alias("n_items"), (F.size("item_ids") > 0).alias("contaminated"))
