"""Language ID by partial matching: for each language a tree of byte contexts of orders 0 to 3, whose escape probabilities
give exact code lengths under frozen statistics; the language with the shortest code wins."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import sliced

ORDER = 3
#: Bytes of text, in expectation, that a language's statistics are taken from; languages that are learned, those with most text.
TRAIN_BYTES, MAX_LANGS = 4_000_000, 1_000
PIECE = 1 << 20
#: Grams times languages whose costs are held at once.
CELLS = 1 << 20
#: Bits of a byte that isn't coded at all. A text that its language codes no better is hardly of that language.
RAW_BITS = 8.0
#: Characters of a piece of a text at most, as pieces are drawn to learn from.
DRAWN = 1 << 16


def fold(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass")


def grams4(data: np.ndarray) -> np.ndarray:
    """For each byte, it with the three before it, as one number; data starts with three zero bytes of padding."""
    x = data.astype(np.uint32)
    return x[:-3] << np.uint32(24) | x[1:-2] << np.uint32(16) | x[2:-1] << np.uint32(8) | x[3:]


class Places:
    """The places of keys in a fixed array, by open addressing over whole arrays of keys."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.append(keys.astype(np.uint32), np.uint32(0))
        self.shift = np.uint32(32 - max(4, int(np.ceil(np.log2(max(2, len(keys))))) + 1))
        self.slots = np.full(1 << (32 - int(self.shift)), -1, np.int32)
        left, at = np.arange(len(keys), dtype=np.int32), self._slot(self.keys[:-1])
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]
            lost = self.slots[at] != left
            left, at = left[lost], (at[lost] + 1) & (len(self.slots) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint32(0x9E3779B1)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        at = self._slot(keys)
        out = self.slots[at]
        wrong = np.flatnonzero((self.keys[out] != keys) & (out >= 0))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & (len(self.slots) - 1)
            out[wrong] = self.slots[at[wrong]]
            w = out[wrong]
            wrong = wrong[(self.keys[w] != keys[wrong]) & (w >= 0)]
        return out


class Costs:
    """Code lengths by key and language, a row for each key and language that has it: what it holds follows the languages' own grams."""

    def __init__(self, codes: np.ndarray, n_langs: int, costs: np.ndarray):
        """codes: key * n_langs + language, ascending."""
        keys, lang = np.divmod(codes, n_langs)
        names, first = np.unique(keys, return_index=True)
        self.places = Places(names)
        self.first, self.lang, self.cost = np.append(first, len(codes)), lang.astype(np.int32), costs.astype(np.float32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, language, cost) of all languages that have the key of a row."""
        place = self.places.find(keys)
        row = np.flatnonzero(place >= 0)
        place = place[row]
        n = self.first[place + 1] - self.first[place]
        at = np.repeat(self.first[place] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return np.repeat(row, n), self.lang[at], self.cost[at]


@dataclass
class Model:
    """langs; for each order the grams (context and byte) with the code length in each language that has them, and the contexts with
    the code length of their escapes; and the escape to a byte that a language has never seen."""

    langs: list[str]
    grams: list[Costs]
    contexts: list[Costs | None]
    last: np.ndarray

    def costs(self, keys: np.ndarray) -> np.ndarray:
        """The code length of the last byte of each distinct gram of four bytes, in each language."""
        out, left = np.zeros((len(keys), len(self.langs)), np.float32), np.ones((len(keys), len(self.langs)), bool)
        rows = np.arange(len(keys))
        for order in range(ORDER, -1, -1):
            own = keys[rows] & np.uint32((1 << 8 * (order + 1)) - 1)
            r, lang, cost = self.grams[order].find(own)
            r = rows[r]
            ok = left[r, lang]
            out[r[ok], lang[ok]] += cost[ok]
            left[r, lang] = False
            still = left[rows].any(axis=1)
            rows, own = rows[still], own[still]
            if order:
                r, lang, cost = self.contexts[order].find(own >> np.uint32(8))
                r = rows[r]
                ok = left[r, lang]
                out[r[ok], lang[ok]] += cost[ok]
        return out + np.where(left, self.last, np.float32(0))

    def bits(self, data: bytes, ends: np.ndarray) -> np.ndarray:
        """The code length of each text in each language. data holds the texts, each after ORDER zero bytes, up to each of `ends`."""
        keys = grams4(np.frombuffer(data, np.uint8))
        first = np.concatenate([[0], ends[:-1]])
        real = np.ones(len(keys), bool)
        for k in range(ORDER):
            at = first[1:] + k - ORDER  # grams that would run over the padding of the next text
            real[at[at >= 0]] = False
        total, edge = np.zeros((len(ends), len(self.langs))), ends - ORDER
        where = np.flatnonzero(real)
        step = max(1 << 10, CELLS // len(self.langs))
        for x in range(0, len(where), step):
            some = where[x : x + step]
            names, at = np.unique(keys[some], return_inverse=True)
            owner = np.searchsorted(edge, some, side="right")
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            total[owner[starts]] += np.add.reduceat(self.costs(names)[at], starts, axis=0, dtype=np.float64)
        return total


def _model(langs: list[str], who: np.ndarray, key4: np.ndarray, n4: np.ndarray) -> Model:
    grams, contexts, n, last = [], [], len(langs), None
    for order in range(ORDER + 1):
        codes, at = np.unique((key4 & ((1 << 8 * (order + 1)) - 1)) * n + who, return_inverse=True)
        count = np.bincount(at, weights=n4)
        above, ctx = np.unique((codes // n >> 8) * n + codes % n, return_inverse=True)
        total, kinds = np.bincount(ctx, weights=count), np.bincount(ctx)
        grams.append(Costs(codes, n, np.log2((total + kinds)[ctx] / count)))
        escape = np.log2((total + kinds) / kinds)
        contexts.append(Costs(above, n, escape) if order else None)
        if not order:
            last = (escape + 8.0).astype(np.float32)  # every language has some byte, so all have the empty context
    return Model(langs, grams, contexts, last)


def build(rows: list[tuple[str, int, int]]) -> Model:
    """A model from (language, four bytes as a number, count). Lower orders are sums over the bytes in front."""
    langs = sorted({r[0] for r in rows}, key=lambda s: s.encode("utf-32-be"))
    number = {x: i for i, x in enumerate(langs)}
    return _model(langs, np.array([number[r[0]] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.float64))


def train(labelled: DataFrame, train_bytes: int = TRAIN_BYTES) -> Model | None:
    """A model from labelled (doc_id, text, lang) rows; those with a null text or lang are left out. None if there are no rows.

    Of each language about train_bytes bytes are learned from: texts, long ones in pieces of DRAWN characters at most, drawn by hash, and
    always the one of the smallest hash. Of more than MAX_LANGS languages those with the most bytes are learned, of equals those that come
    first. The driver gets a row for each language and distinct gram of this sample, and the model has as many, so both are bounded by it."""
    texts = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "lang", "text", F.greatest(F.lit(1), F.ceil(F.char_length("text") / DRAWN)).cast("int").alias("of"))
    pieces = texts.select("lang", "text", "of", F.xxhash64("doc_id", "text").alias("id"), F.explode(F.sequence(F.lit(0), F.col("of") - 1)).alias("k"))
    # A text of one piece has the hash of the whole.
    rows = pieces.select("lang", "text", "of", "k", F.pmod(F.when(F.col("k") == 0, F.col("id")).otherwise(F.xxhash64("id", "k")), F.lit(1 << 30)).alias("h"))
    n_bytes = F.octet_length("text").cast("long")
    sizes = rows.groupBy("lang").agg(F.sum(F.when(F.col("k") == 0, n_bytes)).alias("n"), F.min(F.when(n_bytes > 0, F.col("h"))).alias("least")).orderBy(F.desc("n"), "lang").limit(MAX_LANGS).collect()
    if not sizes:
        return None
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], max(int((1 << 30) * min(1.0, train_bytes / max(1, r["n"]))), (r["least"] or 0) + 1))])
    # Pieces of one text are of equal length, but for one character.
    first = lambda k: F.floor(k * F.char_length("text").cast("long") / F.col("of")).cast("int")
    piece = F.when(F.col("of") == 1, F.col("text")).otherwise(F.substring("text", first(F.col("k")) + 1, first(F.col("k") + 1) - first(F.col("k"))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            by: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                found = [grams4(np.frombuffer(b"\0" * ORDER + fold(t), np.uint8)) for t in texts if t]
                if found:
                    names, n = np.unique(np.concatenate(found), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(names), pa.string()), pa.array(names.astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    counts = rows.where(F.col("h") < F.element_at(share, F.col("lang"))).select("lang", piece.alias("text")).mapInArrow(count, "lang string, gram long, n long")
    table = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    if not table.num_rows:
        return None
    names = table["lang"].combine_chunks().dictionary_encode()
    names = names.combine_chunks() if isinstance(names, pa.ChunkedArray) else names
    known = names.dictionary.to_pylist()
    langs = sorted(known, key=lambda x: x.encode("utf-32-be"))
    place = np.array([langs.index(x) for x in known], np.int64)
    return _model(langs, place[names.indices.to_numpy()], table["gram"].to_numpy().astype(np.int64), table["n"].to_numpy().astype(np.float64))


def predictor(model: Model | None):
    """A function from texts to (language, score, bits a byte) lists."""

    def predict(texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        langs, scores, rates = ["und"] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
        group: list[tuple[int, bytes]] = []
        held = 0

        def flush() -> None:
            nonlocal held
            if not group:
                return
            data = b"".join(b"\0" * ORDER + d for _, d in group)
            ends = np.cumsum([len(d) + ORDER for _, d in group])
            bits = model.bits(data, ends)
            best = bits.argmin(axis=1)
            low = bits[np.arange(len(best)), best]
            rate = low / np.array([len(d) for _, d in group])
            score = 1.0 / np.exp2(low[:, None] - bits).sum(axis=1) / (1.0 + np.exp2(2 * np.minimum(rate - RAW_BITS, 100)))
            for (i, _), b, s, r in zip(group, best.tolist(), score.tolist(), rate.tolist(), strict=True):
                langs[i], scores[i], rates[i] = model.langs[b], min(1.0, s), r
            group.clear()
            held = 0

        for i, text in enumerate(texts):
            if model is not None and text and any(map(str.isalpha, text)):
                data = fold(text)
                group.append((i, data))
                held += len(data)
                if held > PIECE:
                    flush()
        flush()
        return langs, scores, rates

    return predict


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs with lang_pred, score and bits_per_byte after its columns, in one pass.

    score is the language's share of the probability that all languages give the text, times 1 / (1 + 4 ** (bits_per_byte - RAW_BITS)): a text
    whose best code is longer than its bytes is of no language that was learned, and scores under a half however the languages compare.

    A text that is null or has no letter, and any text if there is no model, is `und` with score 0. Equal code lengths go
    to the language that comes first by code point. Only text is read; a column of docs with one of the three names gives way to it."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)  # bounded by the training sample
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits_per_byte", T.DoubleType())]
    docs = docs.select(*[c for c in docs.columns if c.lower() not in {f.name for f in added}])
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = predictor(sent.value)
        for batch in sliced(batches):
            langs, scores, rates = predict(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rates, pa.float64())], [*batch.schema.names, "lang_pred", "score", "bits_per_byte"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))


def held_out(doc_id="doc_id"):
    """The test fold: a document whose id's CRC-32 is 1 mod 3. A null id counts as an empty string."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def language_id(docs: DataFrame, train_bytes: int = TRAIN_BYTES) -> DataFrame:
    """One row for each row of docs (doc_id, text, lang): doc_id, held_out, lang_pred, score, bits_per_byte. Learns from the
    labelled rows that aren't held out. Repeated rows are judged one by one; other columns are ignored."""
    model = train(docs.where(~held_out()).select("doc_id", "text", "lang"), train_bytes)
    return identify(docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text"), model).drop("text")
