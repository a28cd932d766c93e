"""Substring dedup by repeated-phrase automata: recurring passages are confirmed by counting windows, cut where their surroundings
differ, compiled into an Aho-Corasick automaton for each shard of documents, and all documents stream through these, which
alone decide what goes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordCodes, byte_words, gram_codes, scratch, staged, word_codes, word_numbers
from .parts import MOST_TASKS, code_lists, dealt, pack, read_part

#: Words in a window, and in the phrase that stands for it: the one of least hash among the window's phrases.
WINDOW, PHRASE = 35, 8
#: Passages with one anchor that go to every shard with that anchor; beyond these, a passage goes where its first window is.
FEW = 4
#: Bits of a place within a part.
PLACE = 31
HALF = np.uint64(32)


def high(c: str) -> Column:
    return F.shiftrightunsigned(c, 32)


def low(c: str) -> Column:
    return F.col(c).bitwiseAND(0xFFFFFFFF)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    if len(x) < width:
        return x[:0]
    out, have = x, 1
    while 2 * have <= width:
        out = np.minimum(out[: len(out) - have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(codes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window its anchor, and the phrase of each position. Equal windows have equal anchors."""
    phrase = min(PHRASE, window)
    grams = gram_codes(codes, phrase)
    return sliding_min(grams, window - phrase + 1), grams


def suspects(codes: np.ndarray, window: int) -> np.ndarray:
    """A text's distinct anchors; those whose phrase stands in it twice or more come twice."""
    found, grams = anchors(codes, window)
    if not len(found):
        return found
    found = np.unique(found)
    names, n = np.unique(grams, return_counts=True)
    twice = found[n[np.searchsorted(names, found)] > 1] if len(names) < len(grams) else found[:0]
    return np.concatenate([found, twice])


def once_or_twice(codes: np.ndarray) -> np.ndarray:
    """The distinct codes, and once more those that come twice or more."""
    names, n = np.unique(codes, return_counts=True)
    return np.concatenate([names, names[n > 1]])


def member(x: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Which of x stand in the sorted names; the cost follows x."""
    if not len(names):
        return np.zeros(len(x), bool)
    return names[np.minimum(np.searchsorted(names, x), len(names) - 1)] == x


class PhraseAutomaton:
    """An automaton over the numbers of words, which are those of a part's distinct words, for whole phrases; phrases with other words, which can't
    occur in the part, are left out."""

    def __init__(self, names: pa.Array, phrases: pa.Array | pa.ChunkedArray):
        self.known, self.shortest = np.zeros(len(names), bool), 0
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        own, numbers, first = word_numbers(phrases)
        numbers = pc.index_in(own, value_set=names).fill_null(-1).to_numpy()[numbers]
        there = np.concatenate([[0], np.cumsum(numbers < 0)])[first]
        there = np.flatnonzero((there[1:] == there[:-1]) & (first[1:] > first[:-1]))
        if len(there):
            starts, ends = first[there], first[there + 1]
            self.shortest = int((ends - starts).min())
            flat = numbers.tolist()
            for x, y in zip(starts.tolist(), ends.tolist(), strict=True):
                self.automaton.add_word(tuple(flat[x:y]), y - x)
            inside = np.zeros(len(numbers) + 1, np.int64)
            np.add.at(inside, starts, 1)
            np.add.at(inside, ends, -1)
            self.known[numbers[np.cumsum(inside[:-1]) > 0]] = True
            self.automaton.make_automaton()

    def covered(self, numbers: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Which words of texts, given as word_numbers does, lie in an occurrence of a phrase.

        A word that no phrase has, and the end of a text, take the automaton back to its root, so the stream is cut there, and pieces shorter than
        any phrase are passed over."""
        edge = np.zeros(len(numbers) + 1, np.int64)
        if not self.shortest or not len(numbers):
            return edge[:-1] > 0
        known = self.known[numbers]
        begin = known.copy()
        begin[1:] &= ~known[:-1]
        heads = first[:-1][first[:-1] < len(numbers)]
        begin[heads] = known[heads]
        last = known.copy()
        last[:-1] &= ~known[1:] | begin[1:]
        starts, ends = np.flatnonzero(begin), np.flatnonzero(last) + 1
        long = ends - starts >= self.shortest
        for x, y in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            for end, n in self.automaton.iter(tuple(numbers[x:y].tolist())):
                edge[x + end - n + 1] += 1
                edge[x + end + 1] -= 1
        return np.cumsum(edge[:-1]) > 0


def describer(window: int):
    """Word counts and anchors of texts."""

    def describe(texts: list[str | None]) -> tuple[list[int], list[np.ndarray]]:
        names, numbers, first = word_numbers(pa.array(texts, pa.large_string()))
        codes, at = word_codes(names)[numbers], first.tolist()
        return np.diff(first).tolist(), [suspects(codes[x:y], window) if y - x >= window else np.empty(0, np.uint64) for x, y in zip(at, at[1:], strict=False)]

    return describe


def suspect_windows(part: pa.Table, p: int, hits: np.ndarray, window: int) -> list[np.ndarray]:
    """A row of four numbers for each distinct window of a part whose anchor is among the sorted hits: its code, 32 bits of its anchor over the
    number of its places, its first place in all parts, and 32 bits each of the words before and after it. These are 0 at a text's edge and where the
    part has several."""
    own, first = code_lists(part["codes"])
    some = np.concatenate([[0], np.cumsum(member(own, hits))])
    some = some[first[1:]] > some[first[:-1]]
    n = part["n"].to_numpy()
    starts = np.cumsum(n) - n
    names, numbers, edges = word_numbers(part["text"].filter(pa.array(some)))
    codes, edges, out = word_codes(names)[numbers], edges.tolist(), []
    for k, i in enumerate(np.flatnonzero(some).tolist()):
        c = codes[edges[k] : edges[k + 1]]
        anchor, _ = anchors(c, window)
        at = np.flatnonzero(member(anchor, hits))
        if len(at):
            around = np.concatenate([[0], c, [0]]).astype(np.uint64) >> np.uint64(32)
            out.append((anchor[at], gram_codes(c, window)[at], starts[i] + at, around[at], around[at + window + 1]))
    if not out:
        return [np.empty(0, np.int64)] * 4
    a, w, place, before, after = map(np.concatenate, zip(*out, strict=True))
    order = np.lexsort((w, a))  # keeps equal windows in the order of their places
    a, w, place, before, after = (x[order] for x in (a, w, place, before, after))
    edge = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (w[1:] != w[:-1])]))
    one = lambda x: np.where(np.minimum.reduceat(x, edge) == np.maximum.reduceat(x, edge), x[edge], 0)
    number = np.minimum(np.diff(np.append(edge, len(a))), 2).astype(np.uint64)
    rows = (w[edge], a[edge] >> HALF << HALF | number, (np.int64(p) << PLACE) + place[edge], one(before) << HALF | one(after))
    return [x.astype(np.uint64, copy=False).view(np.int64) for x in rows]


def passages(part: pa.Table, places: np.ndarray, before: np.ndarray, after: np.ndarray, window: int) -> list[tuple[int, int, str]]:
    """Anchor and code of the first window, and the words, of the passages of a part that its recurring windows make: those that start at
    neighbouring places of one text are one passage up to where what stands before, or after, isn't always the same."""
    order = np.argsort(places)
    places, before, after = places[order], before[order], after[order]
    n = part["n"].to_numpy()
    ends = np.cumsum(n)
    doc = np.searchsorted(ends, places, side="right")
    cut = np.concatenate([[True], (np.diff(places) != 1) | (np.diff(doc) != 0) | after[:-1] | before[1:]])
    firsts = np.flatnonzero(cut)
    lasts = np.append(firsts[1:], len(places)) - 1
    codes, now, words, c, out = WordCodes(), -1, [], None, []
    for d, x, y in zip(doc[firsts].tolist(), places[firsts].tolist(), places[lasts].tolist(), strict=True):
        if d != now:
            now, words = d, byte_words(part["text"][d].as_py())
        start = x - int(ends[d] - n[d])
        own = words[start : start + y - x + window]
        c = codes(own[:window])
        out.append((int(anchors(c, window)[0].view(np.int64)[0]), int(gram_codes(c, window).view(np.int64)[0]), b" ".join(own).decode("utf-8", "surrogatepass")))
    return out


def cleaned(ids: pa.Array, texts: pa.Array, phrases: pa.Array, with_text: bool) -> pa.Table:
    """What is left of a part's texts when the automaton of these phrases has gone over all of them."""
    names, numbers, first = word_numbers(texts)
    left = ~PhraseAutomaton(names, phrases).covered(numbers, first)
    ends = np.concatenate([[0], np.cumsum(left)])[first]
    kept = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), names.take(pa.array(numbers[left]))), pa.scalar(" ", pa.large_string()))
    sha = pa.array([hashlib.sha256(t).hexdigest() for t in kept.cast(pa.large_binary()).to_pylist()], pa.string())
    cols = [ids, pa.array(np.diff(first), pa.int64()), pa.array(np.diff(first) - np.diff(ends), pa.int64()), sha, kept.cast(pa.string()) if with_text else pa.nulls(len(sha), pa.string())]
    return pa.table(cols, names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])


def confirmed(docs: DataFrame, path: str, window: int = WINDOW) -> tuple[DataFrame, DataFrame, int]:
    """The parts (p, file) of docs (doc_id, text) and their number, and the passages (p, words) that each part may hold."""
    parts = pack(docs, path, lambda: describer(window), once_or_twice)
    n_parts = parts.count()
    files = parts.select("p", "file")
    occ = parts.select("p", F.explode("codes").alias("a"))
    again = staged(occ.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a"), f"{path}/again")
    # Distinct in a part, so a hot anchor has a row for each part.
    hits = staged(occ.join(again.hint("merge"), "a").distinct(), f"{path}/hits")

    def windows(wanted: DataFrame) -> DataFrame:
        """(w, an, place, around) of the windows whose anchors are wanted (p, a), as suspect_windows gives them."""
        lists = wanted.groupBy("p").agg(F.collect_list("a").alias("hits"))  # bounded by the anchors of a part

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for p, file, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                    found = suspect_windows(read_part(path, file, ["text", "n", "codes"]), p, np.sort(own.values.to_numpy().view(np.uint64)), window)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["w", "an", "place", "around"])

        listed = files.join(lists.hint("merge"), "p").select("p", "file", "hits")
        return dealt(listed, n_parts).mapInArrow(run, "w long, an long, place long, around long")

    # Rows are packed for their shuffle. Code and anchor make 96 bits; windows with one anchor are few enough to be told apart by the code alone.
    rows = windows(hits).repartition(max(1, min(n_parts, MOST_TASKS)), "w").withColumns({"a": high("an"), "n": low("an"), "before": high("around"), "after": low("around")})
    many = lambda c: ((F.min(c) != F.max(c)) | (F.min(c) == 0)).alias(c)
    counts = rows.groupBy("w", "a").agg(F.sum("n").alias("n"), F.min("place").alias("place"), many("before"), many("after")).where("n > 1")
    split = counts.select(F.shiftright("place", PLACE).alias("p"), F.col("place").bitwiseAND((1 << PLACE) - 1).alias("place"), "before", "after")
    recurring = staged(split, f"{path}/recurring")

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows:
            places, before, after = (left[c].to_numpy() for c in ("place", "before", "after"))
            rows = passages(read_part(path, right["file"][0].as_py(), ["text", "n"]), places, before, after, window)
        cols = list(zip(*rows, strict=True)) or [[]] * 3
        return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], names=["a", "w", "words"])

    found = staged(dealt(recurring, n_parts).groupBy("p").cogroup(dealt(files, n_parts).groupBy("p")).applyInArrow(cut, "a long, w long, words string"), f"{path}/passages")
    busy = staged(found.groupBy("a").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > FEW).select("a"), f"{path}/busy")
    routed = found.join(busy.hint("merge"), "a", "left_anti").hint("merge").join(hits, "a").select("p", "words")
    if busy.limit(1).count():
        # Anchors with many passages: these go only to the parts that have their first windows.
        own = staged(windows(hits.join(busy.hint("merge"), "a", "left_semi")).select("w", high("an").alias("h"), F.shiftright("place", PLACE).alias("p")), f"{path}/busy-windows")
        many_of = found.join(busy.hint("merge"), "a", "left_semi").select("w", high("a").alias("h"), "words")
        routed = routed.unionByName(own.hint("merge").join(many_of, ["w", "h"]).select("p", "words"))
    return files, staged(routed, f"{path}/routed"), n_parts


def located(files: DataFrame, routed: DataFrame, path: str, n_parts: int, with_text: bool = False) -> DataFrame:
    """Compiles the passages of each part into an automaton and streams all documents of the part through it."""

    def clean(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return cleaned(pa.array([], pa.int64()), *[pa.array([], pa.string())] * 2, with_text)
        part = read_part(path, left["file"][0].as_py(), ["doc_id", "text"])
        return cleaned(part["doc_id"], part["text"], right["words"], with_text)

    kinds = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    out = dealt(files, n_parts).groupBy("p").cogroup(dealt(routed, n_parts).groupBy("p")).applyInArrow(clean, kinds)
    return out if with_text else out.drop("kept_text")


def remove_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """One row for each row of docs (doc_id, text): doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one
    space) and, with_text, kept_text. A word goes if a window of `window` consecutive words that covers it starts anywhere else
    too, in the same document or another; all windows are judged on the input.

    A null or empty text has no words; a text of fewer than `window` words loses none. Repeated rows, and rows of one doc_id,
    are documents of their own, so a repeated row of `window` words or more loses them. A null doc_id stays null. No documents
    give no rows. Extra columns are ignored, whatever their names.

    Each window stands for one phrase in it, its anchor, so equal windows share it: about 7 of 100 positions are anchors. Anchors are
    counted, and only windows with one that recurs are counted themselves, once for each part that has them, with the word before and
    after. Recurring windows make passages at their first occurrences: neighbours are one passage unless what stands before or after
    one of them differs somewhere. So wherever one window of a passage occurs, the whole passage does, and each window is in one
    passage only. A part gets the passages whose anchors it has, compiles them into its automaton, and all its documents stream through it;
    the automaton compares words, and nothing else decides what goes. Texts stay in their part files: what is shuffled are anchors,
    windows and passages. A passage that many documents share costs a row for each part and no pairs."""
    at = scratch(docs.sparkSession, "repeats")
    files, routed, n_parts = confirmed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), at, window)
    return located(files, routed, at, n_parts, with_text)


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(ws[i : i + 34], ' ')) AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY g) AS c FROM win) WHERE c > 1),
mark AS (SELECT doc_id, i AS pos, 1 AS s FROM rep UNION ALL SELECT doc_id, i + 35, -1 FROM rep),
steps AS (SELECT doc_id, pos, sum(s) AS s FROM mark GROUP BY doc_id, pos),
x AS (SELECT doc_id, word, i, ws_n FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i, len(ws) AS ws_n FROM w)),
y AS (SELECT x.doc_id, word, i, coalesce(sum(s) OVER (PARTITION BY x.doc_id ORDER BY i), 0) > 0 AS gone FROM x LEFT JOIN steps ON steps.doc_id = x.doc_id AND pos = i),
z AS (SELECT doc_id, sum(gone::INT)::BIGINT AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS t FROM y GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN z USING (doc_id)
"""
