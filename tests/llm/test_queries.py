import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from corvane.llm import decontam, queries

Q, SQL = queries.queries(), queries.oracle_sql()
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(name, same_as_sql):
    same_as_sql(Q[name], SQL[name])


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source").orderBy("doc_id").collect()


def tokenizer():
    from tokenizers import Tokenizer

    from corvane.llm.encoding import default_path

    t = Tokenizer.from_file(default_path())
    t.encode_special_tokens = True
    return t


def test_token_store_equals_direct_encoding(spark, sf_dir):
    t, start, want = tokenizer(), 0, []
    for r in documents(spark, sf_dir):
        ids = [*t.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        want.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r[c] for c in ("doc_id", "start", "n_tokens", "ids_crc32")) for r in Q["op8_token_store"](spark, sf_dir).collect()) == want


def test_token_counts_equal_direct_encoding(spark, sf_dir):
    t = tokenizer()
    want = [(r["doc_id"], len(t.encode(r["text"] or "", add_special_tokens=False).ids)) for r in documents(spark, sf_dir)]
    assert sorted(map(tuple, Q["op3_token_counts"](spark, sf_dir).collect())) == want


def test_language_id_held_out_accuracy(spark, sf_dir):
    truth = {r["doc_id"]: r["lang"] for r in documents(spark, sf_dir)}
    held = [r for r in Q["op5_language_id"](spark, sf_dir).collect() if r["held_out"]]
    assert held and sum(truth[r["doc_id"]] == r["lang_pred"] for r in held) / len(held) > 0.98
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in held)


def best_edits(segment, text):
    """Sellers: the least edits of the whole segment against any part of text."""
    row = np.zeros(len(text) + 1, int)
    chars = np.array(list(text))
    for i, c in enumerate(segment):
        now = np.empty_like(row)
        now[0] = i + 1
        np.minimum(row[:-1] + (chars != c), row[1:] + 1, out=now[1:])
        now = np.minimum.accumulate(now - np.arange(len(now))) + np.arange(len(now))
        row = now
    return row.min()


def best_edits_of_all(segments, text):
    """best_edits of segments of one length, all at once."""
    chars, rows = np.array(list(text)), np.array([list(s) for s in segments])
    row, steps = np.zeros((len(rows), len(text) + 1), np.int16), np.arange(len(text) + 1, dtype=np.int16)
    for i in range(rows.shape[1]):
        now = np.empty_like(row)
        now[:, 0] = i + 1
        np.minimum(row[:, :-1] + (chars[None, :] != rows[:, i, None]), row[:, 1:] + np.int16(1), out=now[:, 1:])
        row = np.minimum.accumulate(now - steps, axis=1) + steps
    return row.min(axis=1)


def test_decontamination_equals_brute_force(spark, sf_dir):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()][:6]
    index = decontam.Index.of(items)
    docs = [decontam.normal(r["text"])[:1500] for r in documents(spark, sf_dir)[:60]]
    docs += [docs[0] + " " + decontam.normal(items[0][1]) + " end", decontam.normal(items[1][1])[10:140].replace("an", "am", 2)]
    for text in docs:
        want = set()
        for size in {len(s) for s in index.text} if text else ():
            own = [s for s in range(len(index.text)) if len(index.text[s]) == size]
            want |= {index.item[s] for s, edits in zip(own, best_edits_of_all([index.text[s] for s in own], text), strict=True) if edits <= index.edits[s]}
        assert set(index.leaks(text)) == want
    assert index.leaks(docs[-1]) == [items[1][0]] and items[0][0] in index.leaks(docs[-2])


@pytest.mark.parametrize("seed", range(3))
def test_decontamination_finds_parts_from_every_offset(seed):
    rnd = random.Random(seed)
    words = lambda n: " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(n))
    item = words(90)[:300].strip()
    index, size = decontam.Index.of([(1, words(60)), (4, item)]), decontam.SEGMENT
    for a in range(len(item) - size + 1):
        part = decontam.normal(item[a : a + size])
        if len(part) == size:  # a space at an end is the text's own
            assert index.leaks(decontam.normal(f"{words(5)} {part} {words(5)}")) == [4]
    for _ in range(60):
        n = rnd.randint(80, 140)
        a = rnd.randint(0, len(item) - n)
        part = list(item[a : a + n])
        for at in rnd.sample(range(n), rnd.randint(0, 11)):
            part[at] = rnd.choice(["", "z", "zq", part[at] + "z"])
        text = decontam.normal(f"{words(rnd.randint(0, 5))}{''.join(part)}{words(rnd.randint(0, 5))}")
        want = any(best_edits(item[b : b + size], text) <= decontam.budget(size) for b in range(len(item) - size + 1))
        assert index.leaks(text) == [4] * want


def brute_components(rows):
    sets = {}
    for i, text in rows:
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in WORD.findall(text or "")]
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def brute_mix(rows, epochs=1.5, cap=2.0):
    size = Counter()
    for r in rows:
        size[r["source"]] += len(WORD.findall(r["text"] or ""))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, open_, goal = epochs * sum(size.values()), set(names), {}
    while open_:
        left, w = total - sum(goal.values()), sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / w > cap * size[s]}
        goal |= {s: cap * size[s] for s in over} if over else {s: left * weight[s] / w for s in open_}
        open_ = open_ - over if over else set()
    taken = defaultdict(int)
    for r in rows:
        s, h = r["source"], hashlib.md5(str(r["doc_id"]).encode()).hexdigest()[:15]
        taken[s, h] += len(WORD.findall(r["text"] or ""))
    copies = {}
    for s in names:
        full = int(goal[s] // size[s]) if size[s] else 0
        room, got = goal[s] - full * size[s], 0
        for h in sorted(h for x, h in taken if x == s):
            got += taken[s, h]
            copies[s, h] = full + (got <= room)
    return copies


def test_pipeline_equals_plain_version(spark, sf_dir):
    import corpus_pipeline

    got = sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect()))
    rows = documents(spark, sf_dir)
    lang = {r["doc_id"]: r for r in Q["op5_language_id"](spark, sf_dir).collect()}
    rows = [r for r in rows if lang[r["doc_id"]]["lang_pred"] != "und" and lang[r["doc_id"]]["score"] >= corpus_pipeline.LEAST_SCORE]
    comp = brute_components([(r["doc_id"], r["text"]) for r in rows])
    rows = [r for r in rows if comp[r["doc_id"]] == r["doc_id"]]
    items = [decontam.normal(r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = [r for r in rows if not any(t in decontam.normal(r["text"]) for t in items)]
    copies = brute_mix(rows)
    t, start, want = tokenizer(), 0, []
    for r in rows:
        ids = [*t.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        for _ in range(copies[r["source"], hashlib.md5(str(r["doc_id"]).encode()).hexdigest()[:15]]):
            want.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
    assert got == want
