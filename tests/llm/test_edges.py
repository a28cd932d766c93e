"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from corvane.llm import common, decontam, encoding, graph, langid, line_dedup, mixing, near_dedup, parts, quality, substring, token_count, token_store, url_rules

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, p int, rid long, key string, n_words long"
LONG = " ".join(f"w{i % 5000}" for i in range(60_000))
COPY = " ".join(f"c{i}" for i in range(50))
ROWS = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t\n ", "en", "a", 5), (4, "One. Two!", "en", None, 9), (5, LONG, "en", "b", len(LONG)),
    (6, COPY, "en", "b", 1), (7, COPY + " tail", None, "b", 1), (7, COPY + " tail", None, "b", 1), (None, "a text without a number, short", "en", "c", 1),
    (None, None, None, None, None), (8, "The same line\nthe SAME line \nother", "de", "c", 1), (9, "日本語 テキスト\u0085\u00a0x\ud7ff", "ja", "c", 3), (10, "12 34 56", "en", "d", 8), (11, "x " * 200, "en", "d", 400),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "z", 5, 6, "k", 7) for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_quality(docs, none):
    rows = quality.quality_rules(docs, with_text=True).collect()
    assert len(rows) == len(ROWS)
    r = {x["doc_id"]: x for x in rows}
    assert (r[1]["n_words"], r[1]["base_failed"], r[1]["kept"]) == (0, True, False)
    assert r[5]["n_words"] == 60_000 and r[5]["base_failed"]
    assert r[8]["n_dup_lines"] == 0 and r[11]["n_repeat_words"] == 200
    assert quality.quality_rules(none).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_repeated_words_by_brute_force(seed):
    rnd = random.Random(seed)
    words = [rnd.choice("abc") for _ in range(rnd.randrange(0, 60))]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    want = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
    assert quality.repeated_words(words, 5) == len(want)


@pytest.mark.parametrize(("line", "fault"), [("Home | News | About | Contact", "navigation"), ("Menu", "navigation"), ("A plain sentence, of some words.", None), ("w### x$$$ y%%% z", "punctuation"), ("Alle Rechte vorbehalten, auch die der Übersetzung.", "boilerplate"), ("Voir les Conditions d'utilisation du site ici.", "boilerplate"), ("Lea nuestra política de privacidad antes de seguir.", "boilerplate"), ("Please read our Privacy Policy before you go on.", "boilerplate")])
def test_line_rules(line, fault):
    assert quality.line_fault(line, len(line.split()), quality.LineRules()) == fault


def test_near_duplicates(docs, none):
    rows = near_dedup.near_duplicates(docs).collect()
    assert len(rows) == len(ROWS)
    r = {x["doc_id"]: x for x in rows}
    assert (r[1]["n_shingles"], r[1]["component_id"], r[1]["kept"]) == (0, 1, True)
    assert r[7]["component_id"] == 6 and not r[7]["kept"] and r[6]["kept"]
    assert r[None]["component_id"] is None and r[None]["kept"]
    assert near_dedup.near_duplicates(none).count() == 0


def test_near_duplicates_in_one_hot_group(spark):
    """A large group of near copies of several kinds, whose buckets hold different components, against brute force."""
    rnd = random.Random(3)
    base = [[f"g{g}w{i}" for i in range(60)] for g in range(3)]
    base[1][:35] = base[0][:35]
    rows = []
    for i in range(260):
        w = list(base[i % 3])
        for _ in range(rnd.choice([0, 1, 1, 2, 2])):
            w[rnd.randrange(60)] = f"e{rnd.randrange(40)}"
        rows.append((i, " ".join(w)))
    from .test_queries import brute_components

    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(rows)


def test_chain_of_links(spark):
    """Each text is similar to the next only, so that one component has many steps."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[6 * i : 6 * i + 60])) for i in range(40)]
    from .test_queries import brute_components

    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(rows)


@pytest.mark.parametrize("sim", [0.3, 0.6, 0.75, 0.9, 1.0])
def test_likelihood_keeps_what_is_similar(sim):
    rng, kept = np.random.default_rng(5), 0
    for _ in range(40):
        both, each = int(1000 * sim), int(1000 * (1 - sim) / 2)
        x = rng.integers(0, 2**63, both + 2 * each, dtype=np.uint64)
        a, b = x[: both + each], np.concatenate([x[:both], x[both + each :]])
        ra, rb = near_dedup.registers(a), near_dedup.registers(b)
        kept += near_dedup.likely(np.array([len(a) * 1.0]), np.array([len(b) * 1.0]), ra[None], rb[None])[0]
        merged = near_dedup.registers(np.concatenate([a, b]))
        assert (np.maximum(ra, rb) == merged).all()
    assert kept == 40 if sim >= 0.75 else kept <= (0 if sim < 0.5 else 36)


def test_components_of_paths_stars_and_rings(spark, tmp_path):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(200, 200 + i) for i in range(1, 50)] + [(300 + i, 300 + (i + 1) % 20) for i in range(20)] + [(7, 7)]
    rnd.shuffle(edges)
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "u long, v long"), str(tmp_path)).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 200 for i in range(200, 250)} | {i: 300 for i in range(300, 320)}
    assert graph.components(spark.createDataFrame([], "u long, v long"), str(tmp_path / "none")).count() == 0


def test_flat_files(spark, docs, none, tmp_path):
    rows = token_count.document_tokens(docs).collect()
    assert len(rows) == len(ROWS)
    assert {r["doc_id"]: r["n_tokens"] for r in rows}[1] == 0
    assert token_count.document_tokens(none).count() == 0


@pytest.mark.parametrize("block", [1, 2, 3, 7, 100])
def test_separators_across_blocks(spark, tmp_path, block):
    files = {"a": [5, 9, 9, 4, 4, 4, 4, 4, 4, 9], "b": [], "c": [1, 2, 3], "d": [9, 1, 9, 7]}
    want = [("a", 0, 0, 1, True), ("a", 1, 2, 0, True), ("a", 2, 3, 6, True), ("c", 0, 0, 3, False), ("d", 0, 0, 0, True), ("d", 1, 1, 1, True), ("d", 2, 3, 1, False)]
    for name, ids in files.items():
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes())
    got = token_count.count_tokens(spark, str(tmp_path), sorted(files), 9, 2, block).collect()
    assert sorted(tuple(r[c] for c in ("file", "ord", "start", "n_tokens", "closed")) for r in got) == want


def test_pipeline_links_rows_without_or_with_repeated_ids(spark):
    import corpus_pipeline

    one, two, three = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [
        (None, one, "en", "s", 1), (None, one, "en", "s", 1), (None, two, "en", "s", 1), (5, two + " more", "en", "s", 1), (4, two, "en", "s", 1), (4, three, "en", "s", 1),
        (6, three, "en", "s", 1), (4, three, "en", "s", 1), (None, None, "en", "s", 0), (None, None, "en", "s", 0), (7, " ", "en", "s", 0), (7, " ", "en", "s", 0), (8, " ", "en", "s", 0), (9, "short", "en", "s", 1),
    ]
    want = sorted(map(str, [(None, one), (4, two), (4, three), (None, None), (7, " "), (8, " "), (9, "short")]))
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    for n, given in ((1, rows), (3, rows[::-1])):
        got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(given, kinds).repartition(n), None).collect()
        assert sorted(str((r["doc_id"], r["text"])) for r in got) == want
    assert corpus_pipeline.near_duplicates(spark, spark.createDataFrame([], kinds), None).count() == 0


@pytest.mark.parametrize("edits", [0, 1, 6, 14])
def test_decontamination_within_the_budget(edits):
    rnd = random.Random(edits)
    item = " ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(13))[:90]
    index = decontam.Index.of([(3, item)])
    text = list(item)
    for k in range(edits):
        at = 3 + k * 6
        text[at] = rnd.choice(["", "zq", "z"])
    found = index.leaks(f"before it {''.join(text)} and after")
    assert found == ([3] if edits <= index.edits[0] else [])


def test_decontamination_edges(spark, docs, none):
    bench = spark.createDataFrame([(1, COPY), (2, None), (3, ""), (4, "two"), (None, "日本語 テキスト")], "item_id long, text string")
    rows = decontam.decontaminate(docs, bench).collect()
    assert len(rows) == len(ROWS)
    r = {x["doc_id"]: x["item_ids"] for x in rows}
    assert r[6] == [1] and r[7] == [1] and r[4] == [4] and r[9] == [-1] and r[1] == []
    assert decontam.decontaminate(none, bench).count() == 0
    assert not any(x["contaminated"] for x in decontam.decontaminate(docs, bench.limit(0)).collect())


def test_decontamination_in_blocks(spark, docs, monkeypatch):
    bench = spark.createDataFrame([(1, COPY), (4, "two"), (5, LONG[:200])], "item_id long, text string")
    want = sorted(map(str, decontam.decontaminate(docs, bench).collect()))
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 1)
    assert sorted(map(str, decontam.decontaminate(docs, bench).collect())) == want


def test_language_id(docs, none):
    rows = langid.language_id(docs).collect()
    assert len(rows) == len(ROWS)
    r = {x["doc_id"]: x for x in rows}
    assert r[1]["lang_pred"] == r[2]["lang_pred"] == r[10]["lang_pred"] == "und" and r[10]["score"] == 0
    assert r[4]["lang_pred"] != "und" and 0 < r[4]["score"] <= 1
    assert langid.language_id(none).count() == 0
    assert {x["lang_pred"] for x in langid.language_id(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_language_of_few_long_texts_is_learned(spark):
    for seed in range(4):
        rnd = random.Random(seed)
        rows = [(seed * 10 + k, "".join(rnd.choice("abcde ") for _ in range(langid.DRAWN * 3 + k)), "long") for k in range(3)]
        rows += [(seed * 10 + 5, "xyz zyx", "short"), (seed * 10 + 6, "", "short")]
        labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        # A model that may see one part in a thousand still knows each language.
        assert langid.train(labelled, 600).langs == ["long", "short"]


def plain_bits(counts, data):
    """Code lengths by walking the contexts one by one."""
    total = 0.0
    padded = b"\0\0\0" + data
    for i in range(3, len(padded)):
        for order in (3, 2, 1, 0):
            ctx = padded[i - order : i]
            follow = counts[order].get(ctx)
            if not follow:
                continue
            n, d = sum(follow.values()), len(follow)
            if padded[i] in follow:
                total += np.log2((n + d) / follow[padded[i]])
                break
            total += np.log2((n + d) / d)
        else:
            total += 8.0
    return total


def test_code_lengths_by_walking_the_trees():
    texts = {"aa": [b"the cat sat on the mat", b"the theory"], "bb": [b"der hund und die katze", b"die"]}
    rows, trees = [], {}
    for lang, ts in texts.items():
        trees[lang] = [{}, {}, {}, {}]
        for t in ts:
            p = b"\0\0\0" + t
            for i in range(3, len(p)):
                rows.append((lang, int.from_bytes(p[i - 3 : i + 1], "big"), 1))
                for order in range(4):
                    f = trees[lang][order].setdefault(p[i - order : i], {})
                    f[p[i]] = f.get(p[i], 0) + 1
    merged = {}
    for lang, g, n in rows:
        merged[lang, g] = merged.get((lang, g), 0) + n
    model = langid.build([(a, b, n) for (a, b), n in merged.items()])
    probe = [b"the dog", b"xyz", b"die katze sat", b"\xff\x00q"]
    data = b"".join(b"\0\0\0" + d for d in probe)
    got = model.bits(data, np.cumsum([len(d) + 3 for d in probe]))
    for k, d in enumerate(probe):
        assert np.allclose(got[k], [plain_bits(trees[x], d) for x in model.langs], atol=1e-3)


def test_mixing(docs, none):
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == len(ROWS)
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    assert sorted(map(str, mixing.mix_sources(docs).collect())) == sorted(map(str, rows))
    assert mixing.mix_sources(none).count() == 0
    assert mixing.mixed(docs).columns == docs.columns
    assert mixing.mixed(docs).count() == sum(r["copies"] for r in rows)


@pytest.mark.parametrize("sizes", [[10, 10, 10], [0, 0, 5], [100, 1, 1, 1], [7], [3, 900, 2, 5, 1]])
def test_water_fill(sizes):
    got = mixing.water_fill(sizes, [(3, 1, 2)[i % 3] for i in range(len(sizes))], 1.5 * sum(sizes), 2.0)
    assert abs(sum(got) - 1.5 * sum(sizes)) < 1e-9 and all(g <= 2 * s + 1e-9 for g, s in zip(got, sizes, strict=True))


def test_substring(docs, none):
    rows = substring.remove_repeats(docs, with_text=True).collect()
    assert len(rows) == len(ROWS)
    r = {x["doc_id"]: x for x in rows}
    assert (r[1]["n_words"], r[1]["kept_sha256"]) == (0, sha(""))
    assert r[6]["n_removed"] == 50 and r[7]["n_removed"] == 51 and r[6]["kept_text"] == ""
    assert r[11]["n_removed"] == 200 and r[5]["n_removed"] == 60_000
    assert r[4]["kept_text"] == "One. Two!"
    assert substring.remove_repeats(none).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_substring_by_brute_force(spark, seed):
    rnd = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for _ in range(40):
        w = [rnd.choice("abcdefgh") + str(rnd.randrange(50)) for _ in range(rnd.randrange(0, 90))]
        if rnd.random() < 0.6:
            a = rnd.randrange(0, 30)
            w[len(w) // 2 : len(w) // 2] = passage[a : a + rnd.choice([33, 34, 35, 36, 50])]
        if rnd.random() < 0.2:
            w += ["x"] * rnd.randrange(30, 45)
        texts.append(w)
    seen = {}
    for d, w in enumerate(texts):
        for i in range(len(w) - 34):
            seen.setdefault(tuple(w[i : i + 35]), []).append((d, i))
    gone = [set() for _ in texts]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone[d].update(range(i, i + 35))
    got = by_id(substring.remove_repeats(spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(texts)], "doc_id long, text string")))
    for d, w in enumerate(texts):
        assert got[d]["n_removed"] == len(gone[d])
        assert got[d]["kept_sha256"] == sha(" ".join(x for i, x in enumerate(w) if i not in gone[d]))


def test_automaton_alone_decides(spark, tmp_path):
    """Without its phrases nothing goes, and with them only what holds them word by word, also in texts that nothing pointed to."""
    passage = [f"p{i}" for i in range(80)]
    rows = [(1, " ".join(["a", *passage, "b"])), (2, " ".join(["c", *passage[10:60], "d"])), (3, " ".join(passage[:34]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    files, routed, n = substring.confirmed(docs, str(tmp_path))
    assert sorted(len(r["words"].split(" ")) for r in routed.collect()) == [50]  # what both have, from end to end
    gone = lambda phrases: {r["doc_id"]: r["n_removed"] for r in substring.located(files, phrases, str(tmp_path), n).collect()}
    assert gone(routed) == {1: 50, 2: 50, 3: 0}
    assert gone(routed.limit(0)) == {1: 0, 2: 0, 3: 0}
    assert gone(routed.withColumn("words", F.lit(" ".join(passage[:34])))) == {1: 34, 2: 0, 3: 34}


@pytest.mark.parametrize("seed", range(2))
def test_substring_with_many_passages_of_one_anchor(spark, monkeypatch, seed):
    """A phrase before which, and after which, many things stand: its passages go only where they are."""
    rnd = random.Random(seed)
    start = [f"s{i}" for i in range(30)]
    texts = []
    for k in range(30):
        tail = [f"t{k}x{i}" for i in range(20)]
        for _ in range(rnd.randrange(1, 4)):
            texts.append([f"u{len(texts)}", *start, *tail[: rnd.randrange(3, 20)], f"v{len(texts)}"])
    seen = {}
    for d, w in enumerate(texts):
        for i in range(len(w) - 34):
            seen.setdefault(tuple(w[i : i + 35]), []).append((d, i))
    gone = {d: set() for d in range(len(texts))}
    for places in seen.values():
        for d, i in places * (len(places) > 1):
            gone[d].update(range(i, i + 35))
    rows = spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(texts)], "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["n_removed"] for r in substring.remove_repeats(rows).collect()}
    assert got == {d: len(g) for d, g in gone.items()} and any(got.values())


def test_sliding_minimum():
    x = np.random.default_rng(1).integers(0, 50, 200).astype(np.uint64)
    for width in (1, 2, 3, 28, 200, 201):
        assert substring.sliding_min(x, width).tolist() == [x[i : i + width].min() for i in range(len(x) - width + 1)]


def test_store_round_trip(spark, docs, none, tmp_path):
    path = str(tmp_path / "store")
    token_store.write_store(docs, path)
    enc = encoding.encoder(encoding.default_path())
    want = sorted([*np.frombuffer(enc.encode([r[1] or ""])[0], enc.dtype).tolist(), 0] for r in ROWS)
    assert sorted(r["ids"] for r in token_store.read_ids(spark, path).collect()) == want
    digests = token_store.store_digests(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in digests] == sorted((r[0] for r in ROWS), key=lambda i: (i is not None, i))
    assert token_store.encode_documents(none).count() == 0


def test_store_finds_damage(spark, docs, tmp_path):
    path = str(tmp_path / "store")
    token_store.write_store(docs, path)
    chunks = spark.read.parquet(f"{path}/chunks")
    broken = chunks.withColumn("ids", F.when(F.octet_length("ids") == F.lit(2), F.unhex(F.lit("0100"))).otherwise(F.col("ids")))
    broken.write.parquet(str(tmp_path / "broken"))
    common.delete(spark, f"{path}/chunks")
    spark.read.parquet(str(tmp_path / "broken")).write.parquet(f"{path}/chunks")
    with pytest.raises(Exception, match="address"):
        token_store.store_digests(spark, path).collect()


def test_store_finds_changed_recipes(spark, docs, tmp_path):
    path = str(tmp_path / "store")
    token_store.write_store(docs, path)
    recipes = spark.read.parquet(f"{path}/recipes").cache()
    rows, kinds = recipes.orderBy("seg", "local_start").collect(), recipes.schema
    common.delete(spark, f"{path}/recipes")

    def read(changed, reader=token_store.store_digests):
        spark.createDataFrame(changed, kinds).coalesce(1).write.mode("overwrite").parquet(f"{path}/recipes")
        return reader(spark, path).count()

    assert read(rows) == read(rows[::-1]) == len(ROWS)
    at = next(k for k in range(len(rows) - 1) if rows[k]["seg"] == rows[k + 1]["seg"] and rows[k]["root"] != rows[k + 1]["root"])
    lost, doubled, alone = rows[:at] + rows[at + 1 :], [*rows, rows[at]], [r for r in rows if r["seg"] != rows[at]["seg"]]
    x, y = rows[at].asDict(), rows[at + 1].asDict()
    swapped = [*rows[:at], Row(**{**y, "local_start": x["local_start"]}), Row(**{**x, "local_start": x["local_start"] + y["n_tokens"]}), *rows[at + 2 :]]
    moved = [*rows[:-1], Row(**{**rows[-1].asDict(), "local_start": rows[-1]["local_start"] + 1})]
    for changed in (lost, doubled, alone, swapped, moved):
        for reader in (token_store.store_digests, token_store.read_ids):
            with pytest.raises(ValueError, match="segment"):
                read(changed, reader)
    read(rows)
    manifest, own = (f(spark.read.parquet(f"{path}/manifest")) for f in (lambda x: x.collect(), lambda x: x.schema))
    common.delete(spark, f"{path}/manifest")
    # A segment that is gone altogether, from the recipes and the manifest.
    last = max(r["seg"] for r in manifest)
    spark.createDataFrame([r for r in manifest if r["seg"] != last], own).coalesce(1).write.parquet(f"{path}/manifest")
    for reader in (token_store.store_digests, token_store.read_ids):
        with pytest.raises(ValueError, match="segment"):
            read([r for r in rows if r["seg"] != last], reader)


def test_store_trees_of_several_levels(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_store, "GROUP", 3)
    path = str(tmp_path / "store")
    token_store.write_store(spark.range(60).selectExpr("id AS doc_id", "concat('text ', id) AS text").coalesce(1), path)
    assert [r["doc_id"] for r in token_store.store_digests(spark, path).orderBy("start").collect()] == list(range(60))
    chunks = spark.read.parquet(f"{path}/chunks")
    kept = chunks.orderBy("hash").limit(chunks.count() - 1).collect()
    common.delete(spark, f"{path}/chunks")
    spark.createDataFrame(kept, chunks.schema).write.parquet(f"{path}/chunks")
    for reader in (token_store.store_digests, token_store.read_ids):
        with pytest.raises(Exception, match="lacks a chunk"):
            reader(spark, path).collect()


@pytest.mark.parametrize("seed", range(4))
def test_crcs_join_and_cuts_shift(seed):
    import zlib

    rnd = np.random.default_rng(seed)
    a, b = rnd.bytes(rnd.integers(0, 500)), rnd.bytes(rnd.integers(0, 5000))
    assert token_store.crc_join(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    ids = rnd.integers(0, 50_000, 20_000).astype(np.uint16)
    one, two = token_store.cuts(ids), token_store.cuts(np.concatenate([[7, 7, 7], ids]).astype(np.uint16))
    assert len({x + 3 for x in one} & set(two)) > 0.9 * len(one) and one[-1] == len(ids)


def test_encoder_on_odd_white_space():
    enc, plain = encoding.Encoder(encoding.default_path()), encoding.Encoder(encoding.default_path())
    plain.by_word = False
    rnd = random.Random(2)
    bits = ["a", "é", "Z", "9", "'s", ".", ",", " ", "\n", "  ", "\t", "\u00a0", "²", "don't", "<|endoftext|>", "日本", "\x00", "\x1c", " '", "Ġ", "Ċ"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randrange(14))) for _ in range(3000)]
    assert enc.encode(texts) == plain.encode(texts)


def test_encoder_looks_up_each_word_once_without_its_marks(monkeypatch):
    enc, plain = encoding.Encoder(encoding.default_path(), 3), encoding.Encoder(encoding.default_path())
    plain.by_word = False
    asked = []
    monkeypatch.setattr(enc, "_found", lambda names, found=enc._found: asked.append(sorted(names)) or found(names))
    texts = ["one two, two. two\ntwo; two,,", "", "two! one", "\n", "one  two", " two", "é, × ×, don't' ))"]
    assert enc.encode(texts) == plain.encode(texts)
    assert asked == [sorted(["\none", "two", "\ntwo", "\n", "one", "\né", "×", "×,", "don't", "))"])]
    monkeypatch.setattr(encoding, "GROUP_BYTES", 5)
    column = pa.array(["x", None, *texts, None]).slice(1)
    assert [x for ids in enc.encoded(column) for x in ids.to_pylist()] == plain.encode(["", *texts, ""])


def test_urls(spark):
    rows = [
        (1, "http://a.Example.NET/en/x?q", "a.example.net", "/en/x", "example.net/en/", "allow"), (2, "http://example.net", "example.net", "", None, "allow"), (3, "http://NET/", "net", "/", "net/", "block"),
        (4, None, "", "", None, "allow"), (5, "no scheme", "", "", None, "allow"), (6, "x://planet/", "planet", "/", None, "allow"), (7, "http://example.com/de/#f", "example.com", "/de/", "example.com/de/", "block"),
        (None, "http://a.org/fr/", "a.org", "/fr/", "org/fr/", "allow"), (8, "http://example.net.evil.com/de/", "example.net.evil.com", "/de/", None, "allow"), (9, "http:///de/", "", "/de/", None, "allow"),
    ]
    pages = spark.createDataFrame([(r[0], r[1], "h", "k", 3) for r in rows] * 300, "page_id long, url string, html string, key string, part int")
    got = url_rules.filter_urls(pages, url_rules.RULES).collect()
    assert sorted(map(str, map(tuple, got))) == sorted([str((r[0], *r[2:])) for r in rows] * 300)
    assert url_rules.filter_urls(pages.limit(0), url_rules.RULES).count() == 0
    assert {r["verdict"] for r in url_rules.filter_urls(pages, [], "block").collect()} == {"block"}


def test_words_of_a_column():
    rnd = random.Random(4)
    bits = ["a", "b", "é", "\u00a0", "\u3000", "\x1c", "\x85", "\x00", *" \t\n\v\f\r"]
    texts = [None, "", *("".join(rnd.choice(bits) for _ in range(rnd.randrange(9))) for _ in range(500))]
    for column in (pa.array(texts), pa.chunked_array([texts[:7], texts[7:]], pa.large_string()), pa.array(texts).slice(300)):
        names, numbers, first = common.word_numbers(column)
        want = [common.byte_words(t) for t in column.to_pylist()]
        words = [w.encode() for w in names.take(pa.array(numbers)).to_pylist()]
        assert [words[a:b] for a, b in zip(first, first[1:], strict=False)] == want and len(set(names.to_pylist())) == len(names)
        assert common.word_codes(names)[numbers].tolist() == common.WordCodes()(sum(want, [])).tolist()
    assert [len(x) for x in common.word_numbers(pa.array([], pa.string()))] == [0, 0, 1]


def test_automaton_passes_over_pieces_that_hold_no_phrase():
    """Pieces between words that no phrase has, and texts, are shorter than any phrase or go through the automaton whole."""
    rnd = random.Random(5)
    for _ in range(30):
        texts = ["".join(rnd.choice("abcdx") + " " for _ in range(rnd.randrange(30))) for _ in range(20)]
        phrases = ["".join(rnd.choice("abcdy") + " " for _ in range(rnd.randrange(3, 6))) for _ in range(12)]
        names, numbers, first = common.word_numbers(pa.array(texts))
        auto = substring.PhraseAutomaton(names, pa.array(phrases))
        inner, seen = auto.automaton, []
        auto.automaton = type("A", (), {"iter": lambda self, x: seen.append(len(x)) or inner.iter(x)})()
        want = []
        for words, ps in ((t.split(), [p.split() for p in phrases]) for t in texts):
            hit = [any(words[i : i + len(p)] == p and i <= k < i + len(p) for p in ps for i in range(len(words))) for k in range(len(words))]
            want += hit
        assert auto.covered(numbers, first).tolist() == want
        assert all(n >= 3 for n in seen) and sum(seen) < len(numbers)
    assert not substring.PhraseAutomaton(names, pa.array([], pa.string())).covered(numbers, first).any()


@pytest.mark.parametrize("seed", range(3))
def test_urls_by_brute_force(spark, seed):
    rnd = random.Random(seed)
    host = lambda: ".".join(rnd.choice(["a", "ab", "b", "", "com", "é"]) for _ in range(rnd.randrange(1, 5)))
    path = lambda: "".join(rnd.choice(["/", "/x", "/xy", "y"]) for _ in range(rnd.randrange(0, 3)))
    rules = list({(r.host, r.path): r for r in (url_rules.Rule(rnd.choice(["allow", "block"]), host(), path()) for _ in range(30))}.values())
    urls = [(i, f"http://{host()}/{path()}") for i in range(1500)]
    for r in url_rules.filter_urls(spark.createDataFrame(urls, "page_id long, url string"), rules).collect():
        fits = [x for x in rules if (r["host"] == x.host or r["host"].endswith("." + x.host)) and r["path"].startswith(x.path)]
        best = max(fits, key=lambda x: (len(x.name), len(x.host), x.verdict == "block"), default=None)
        assert r["rule"] == (best and best.name) and r["verdict"] == (best.verdict if best else "allow")


def test_lines(docs, none):
    rows = line_dedup.dedup_lines(docs, min_docs=2, keep_first=True).collect()
    assert len(rows) == len(ROWS)
    r = {x["doc_id"]: x for x in rows}
    assert (r[1]["n_lines"], r[1]["n_dropped"], r[1]["kept_text"]) == (1, 0, "")
    assert r[8]["n_dropped"] == 0 and r[3]["n_lines"] == 3
    assert line_dedup.dedup_lines(none).count() == 0


@pytest.mark.parametrize("first", [True, False])
@pytest.mark.parametrize("bits", [1 << 20, 8])
def test_lines_by_brute_force(spark, monkeypatch, first, bits):
    """Also with filters so small that they suspect every line."""
    if bits == 8:
        monkeypatch.setattr(line_dedup, "filter_plan", lambda n: (1, 8))
    rnd = random.Random(4)
    texts = {i: "\n".join(rnd.choice(["Same", " same\t", "b", "", "C c", f"u{i}", "d"]) for _ in range(rnd.randrange(1, 8))) for i in range(30)}
    where = {}
    for i, t in texts.items():
        for n, line in enumerate(t.split("\n")):
            if line_dedup.line_key(line):
                where.setdefault(line_dedup.line_key(line), []).append((i, n))
    gone = {p for places in where.values() if len({i for i, _ in places}) >= 3 for p in places if not (first and p == min(places))}
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = by_id(line_dedup.dedup_lines(rows, min_docs=3, keep_first=first))
    for i, t in texts.items():
        assert got[i]["kept_text"] == "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone)
        assert got[i]["kept_sha256"] == sha(got[i]["kept_text"])


def test_few_lines_are_suspected_at_every_size(spark, monkeypatch, tmp_path):
    """With filters of 512 bytes, many ranges of hashes keep the share of wrong suspects as small as one range does."""
    texts = [(i, "\n".join([f"line {i} {j}" for j in range(100)] + ["shared"] * (i % 10 == 0))) for i in range(200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    for k, bits in enumerate((1 << 12, 1 << 26)):
        monkeypatch.setattr(line_dedup, "SHARD_BITS", bits)
        at = str(tmp_path / str(k))
        parts_ = parts.pack(docs, at, lambda: line_dedup.describer(1), lambda c: c[:0])
        n_parts, n_hashes = parts_.count(), parts_.agg(F.sum("n_codes")).first()[0]
        assert n_hashes == 20_020 and line_dedup.filter_plan(n_hashes)[0] == (59 if bits == 1 << 12 else line_dedup.LEAST_SHARDS)
        hits = line_dedup.suspected(parts_, at, n_parts, n_hashes).collect()
        assert np.int64(np.uint64(line_dedup.key_hash("shared"))) in {r["h"] for r in hits}
        assert len(hits) < 0.02 * n_hashes


def test_lines_of_repeated_ids_are_of_one_document(spark):
    rows = [(1, "a\nb"), (1, "b\na\nc"), (2, "a"), (None, "c\nq"), (None, "q\nc")]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), min_docs=2, keep_first=False).collect()
    # a is in documents 1 and 2, c in 1 and the one without an id; b and q in one document each
    assert sorted((r["doc_id"] or 0, r["kept_text"]) for r in got) == [(0, "q"), (0, "q"), (1, "b"), (1, "b"), (2, "")]


def test_language_query_equals_walking_the_trees(spark):
    """The whole operator against trees walked byte by byte: who is learned from, all code lengths, the choice and the score."""
    import zlib

    rnd = random.Random(11)
    stems = {"aa": ["the", "cat", "mat", "sat", "on"], "bb": ["der", "hund", "und", "die", "katze"], "cc": ["le", "chien", "à", "été", "où"]}
    rows = [(i, " ".join(rnd.choice(stems[x]) for _ in range(rnd.randrange(1, 12))), x) for i, x in enumerate(["aa", "aa", "bb", "bb", "cc", "cc"] * 8)]
    rows += [(100, None, "aa"), (101, "12 34", "bb"), (102, "The DER le", None), (103, "zzz qqq", "cc"), (None, "katze und hund", "bb"), (7, "chien où", "cc")]
    held = [zlib.crc32(str("" if i is None else i).encode()) % 3 == 1 for i, _, _ in rows]
    trees = {}
    for (_, text, lang), h in zip(rows, held, strict=True):
        if text and lang and not h:
            p = b"\0\0\0" + text.lower().encode()
            for i in range(3, len(p)):
                for order in range(4):
                    f = trees.setdefault(lang, [{}, {}, {}, {}])[order].setdefault(p[i - order : i], {})
                    f[p[i]] = f.get(p[i], 0) + 1
    want = []
    for (i, text, _), h in zip(rows, held, strict=True):
        if not text or not any(map(str.isalpha, text)):
            want.append((i, h, "und", 0.0))
            continue
        data = text.lower().encode()
        bits = {x: plain_bits(trees[x], data) for x in sorted(trees)}
        best = min(bits, key=lambda x: (bits[x], x))
        share = 1 / sum(2 ** (bits[best] - b) for b in bits.values())
        want.append((i, h, best, share / (1 + 4 ** (bits[best] / len(data) - 8))))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = [(r["doc_id"], r["held_out"], r["lang_pred"], r["score"]) for r in langid.language_id(docs).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[3])
    assert [r[:3] for r in sorted(got, key=key)] == [r[:3] for r in sorted(want, key=key)]
    assert np.allclose([r[3] for r in sorted(got, key=key)], [r[3] for r in sorted(want, key=key)], atol=1e-3)


def test_texts_of_no_learned_language_score_low(spark, sf_dir):
    model = langid.train(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang"))
    langs, scores, _ = langid.predictor(model)(["Talvella järvi jäätyy ja lapset luistelevat jäällä koko päivän.", "asdkjfh qwepoiu zxmcnb lkjhqwe zzxqj", "東京は日本の首都です"])
    assert all(x in model.langs for x in langs) and max(scores) < 0.5


def test_more_languages_than_are_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGS", 2)
    rows = [(i, f"{'ab cd ef'[i % 3 * 3 : i % 3 * 3 + 2]} " * (5 + 10 * (i % 3)), "xyz"[i % 3]) for i in range(30)]
    assert langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string")).langs == ["y", "z"]


def test_decontamination_query_equals_brute_force(spark, monkeypatch):
    """The whole operator against Sellers' algorithm over whole texts, with several blocks, and with stretches as short as they get."""
    from .test_queries import best_edits

    rnd = random.Random(5)
    words = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7))) for _ in range(n))
    items = [(1, words(12)), (2, words(40)), (3, words(9)), (3, words(15)), (4, "short one"), (None, words(11)), (5, "aaaa " * 30), (6, None)]
    docs = []
    for i in range(40):
        text = words(rnd.randrange(0, 60))
        if i % 2:
            name, item = rnd.choice([x for x in items if x[1]])
            a = rnd.randrange(0, max(1, len(item) - 100))
            part = list(item[a : a + rnd.choice([90, 100, 130, 400])])
            for at in rnd.sample(range(len(part)), min(len(part), rnd.randrange(0, 9))):
                part[at] = rnd.choice(["", "z", part[at] + "q"])
            text = f"{text} {''.join(part)}. {words(rnd.randrange(0, 200))}"
        docs.append((i, text))
    docs.append((40, "aaaa " * 400))
    want = {}
    for i, text in docs:
        t, found = decontam.normal(text), set()
        for name, item in items:
            one = decontam.normal(item)
            if len(one) < decontam.Q:
                hit = bool(one) and f" {one} " in f" {t} "
            else:
                m = min(len(one), decontam.SEGMENT)
                hit = any(best_edits(one[a : a + m], t) <= decontam.budget(m) for a in range(len(one) - m + 1)) if t else False
            if hit:
                found.add(-1 if name is None else name)
        want[i] = sorted(found)
    rows, bench = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    assert sum(map(bool, want.values())) > 10
    assert {r["doc_id"]: r["item_ids"] for r in decontam.decontaminate(rows, bench).collect()} == want
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 200)
    monkeypatch.setattr(decontam, "HELD_CHARS", 3000)
    assert {r["doc_id"]: r["item_ids"] for r in decontam.decontaminate(rows, bench).collect()} == want
    monkeypatch.setattr(decontam, "MOST_PLACES", 8)
    index = decontam.Index.of([(-1 if n is None else n, t) for n, t in items])
    assert {i: index.leaks(decontam.normal(t)) for i, t in docs} == want


def test_clashing_names_are_handled(spark):
    """Columns that bear the names of what the operators add or use on their way."""
    names = "target src source_size full threshold copies score lang_pred bits_per_byte item_ids h p a n place part host path verdict rule bounds row"
    cols = [F.lit("x").alias(c) for c in names.split()]
    docs = spark.createDataFrame([(1, COPY, "en", "s"), (2, COPY + " more", "de", None)], "doc_id long, text string, lang string, source string").select("*", *cols)
    assert mixing.mixed(docs).columns == docs.columns and mixing.mix_sources(docs).count() == 2
    out = langid.identify(docs, langid.train(docs))
    assert out.columns.count("score") == 1 and out.first()["score"] != "x" and out.count() == 2
    flagged = decontam.flag(docs, spark.createDataFrame([(1, COPY)], "item_id long, text string"))
    assert flagged.columns.count("item_ids") == 1 and [r["item_ids"] for r in flagged.collect()] == [[1], [1]]
    for run in (quality.quality_rules, near_dedup.near_duplicates, token_count.document_tokens, langid.language_id, substring.remove_repeats, token_store.encode_documents, line_dedup.dedup_lines):
        assert run(docs).count() == 2
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("http://a.net/x").alias("url"), *cols)
    assert {r["verdict"] for r in url_rules.filter_urls(pages, url_rules.RULES).collect()} == {"block"}


def test_mixing_with_a_giant_document_and_repeated_ids(spark):
    rows = [(1, "w " * 50_000, "a"), (2, "w " * 10, "a"), (2, "w " * 20, "b"), (2, "w " * 20, "b"), (3, "w " * 30, "b"), (None, "q", None), (4, None, "c"), (5, "", "c")]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)).collect()
    assert len(got) == len(rows) and all(r["taken"] <= 2 * r["size"] for r in got)
    # Rows of one id share a hash, so those of one source are taken alike; and no source is taken beyond its target.
    assert len({r["copies"] for r in got if r["doc_id"] == 2 and r["size"] == 20}) == 1
    by = {}
    for r in got:
        by.setdefault(r["source_size"], [r["target"], 0])[1] += r["taken"]
    assert all(taken <= target + 1e-9 for target, taken in by.values())


def test_pipeline_stages_on_odd_rows(spark, sf_dir):
    """Null and empty texts, null ids, repeated rows and columns that documents doesn't have, through each stage, and no rows at all."""
    import corpus_pipeline

    base = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(r[0], r[1], r[2], r[3], r[4]) for r in ROWS]
    odd = spark.createDataFrame(rows, base).withColumns({c: F.lit(1) for c in ("score", "target", "item_ids", "row", "c")}).repartition(3)
    counts = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, sf_dir)
        assert name == "token_output" or out.columns == list(corpus_pipeline.COLUMNS)
        counts[name] = out.count()
        assert stage(spark, odd.limit(0), sf_dir).count() == 0
    # Without a letter: 1, 2, 3 and 10 and the row without anything; more go, as little is learned. One of each group of equal or similar texts stays.
    assert 0 < counts["language"] <= len(ROWS) - 5 and counts["token_output"] == len(ROWS)
    assert counts["near_duplicates"] == len(ROWS) - 2 and counts["decontamination"] == len(ROWS)


def test_folders_of_other_calls_stay(spark):
    mine, theirs = common.scratch(spark, "mine"), None
    with common.owned("pipeline"):
        theirs = common.scratch(spark, "theirs")
    one = [common.staged(spark.range(3), f"{x}/t") for x in (mine, theirs)]
    common.release(spark, "pipeline")
    assert one[0].count() == 3
    with pytest.raises(Exception, match="(?i)does not exist|not_exist"):
        spark.read.parquet(f"{theirs}/t").count()
