import json

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from corvane.catalogue import generated
from corvane.functions import signal
from corvane.plans import models
from corvane.sources import audio, tables
from corvane.streaming.ingest import ingest

NAMES = [f"species_{i}" for i in range(200)]


def wav(folder, name, seconds):
    t = np.arange(int(32_000 * seconds)) / 32_000
    (folder / name).write_bytes(signal.encode_wav(np.sin(2 * np.pi * 700 * t) * 0.5))


def test_listing_takes_both_cases_only(spark, tmp_path):
    for name in ("a.wav", "b.WAV", "c.Wav", "d.txt"):
        (tmp_path / name).write_bytes(b"x")
    assert sorted(r["path"][-5:] for r in tables.listing(spark, str(tmp_path)).collect()) == ["a.wav", "b.WAV"]
    assert tables.listing(spark, str(tmp_path), limit=1).count() == 1
    assert tables.either_case("*.wav") == "{*.wav,*.WAV}"


def test_decoding_keeps_short_tails_and_reports_faults(spark):
    got = {(r["file_path"][-19:-4], r["chunk_idx"]): (r["n"], r["end_time"]) for r in audio.chunks(generated(spark)).selectExpr("*", "size(samples) AS n").collect()}
    assert got["20250101_053015", 2] == (64_000, 12.0)
    assert got["20250102_053015", 0] == (160_000, 5.0)
    assert not any(k[0] == "20250103_053015" for k in got)
    assert audio.faults(generated(spark)).count() == 1


def test_model_is_deterministic(spark):
    run = lambda: sorted(models.infer(generated(spark), models.StandIn, NAMES, key="t").selectExpr("file", "topk").where("file IS NOT NULL").collect())
    assert run() == run()
    scores = [t["score"] for t in run()[0]["topk"]]
    assert scores == sorted(scores, reverse=True)


def test_ingest_takes_each_file_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    wav(tmp_path / "in", "20250101_000000.WAV", 6)
    (tmp_path / "in" / "20250102_000000.wav").write_bytes(b"broken")
    go = lambda: ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), models.StandIn, NAMES, files_each=1)
    assert go() == 2
    assert go() == 0
    wav(tmp_path / "in", "20250103_000000.wav", 1)
    assert go() == 1
    assert spark.read.parquet(str(tmp_path / "out/embeddings")).count() == 3
    assert spark.read.parquet(str(tmp_path / "out/faults")).count() == 1


def test_legacy_embeddings(spark, tmp_path):
    for part in (0, 11):
        (tmp_path / str(part)).mkdir()
        t = pa.table({"file": ["a"], "file_path": ["/a"], "chunk_idx": [0], "start_time": [0.0], "end_time": [5.0]} | {f"emb_{i}": pa.array([float(i + part)], pa.float32()) for i in range(12)})
        pq.write_table(t, tmp_path / str(part) / "part-0.parquet")
        pq.write_table(t, tmp_path / str(part) / "part-1.parquet")
    got = tables.legacy_embeddings(spark, str(tmp_path)).where("checkpoint_id = 11").first()
    assert got["embedding"] == [float(i + 11) for i in range(12)]
    assert tables.legacy_embeddings(spark, str(tmp_path), files_each=1).count() == 2


def test_predictions_read_null_names(spark, tmp_path):
    head = "file,file_path,chunk_idx,start_time,end_time,checkpoint_id,top1,top2,score1,score2"
    (tmp_path / "checkpoint_0000.csv").write_text(head + '\na_0,/a,0,0.0,5.0,0,"x, y",NA,1.5,0.5\n')
    from corvane import schemas

    assert "top2 string" in schemas.wide_predictions(2)
    r = tables.predictions(spark, str(tmp_path / "checkpoint_*.csv"), k=2).first()
    assert (r["top1"], r["top2"], r["score1"]) == ("x, y", None, 1.5)


def test_json_sources(spark, tmp_path):
    (tmp_path / "classes.json").write_text(json.dumps(["a", "b"]))
    assert [tuple(r) for r in tables.class_names(spark, str(tmp_path / "classes.json")).collect()] == [(0, "a"), (1, "b")]
    (tmp_path / "c.json").write_text(json.dumps({"processed_files": ["x", "y", "x"], "checkpoint_id": 3}))
    assert tables.checkpoint(spark, str(tmp_path / "c.json")).count() == 2


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    rows = lambda c, v: spark.createDataFrame([("f", [v], c)], "file string, embedding array<float>, checkpoint_id int")
    for c, v in ((0, 1.0), (1, 2.0), (0, 3.0)):
        tables.write_embeddings(rows(c, v), str(tmp_path / "e"))
    got = spark.read.parquet(str(tmp_path / "e")).orderBy("checkpoint_id").collect()
    assert [r["embedding"] for r in got] == [[3.0], [2.0]]
    assert tables.output_size(spark, str(tmp_path / "e"), "*.parquet").first()["files"] == 2


def test_half_precision_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("f", [0.1, 1.0, 70000.0], 0)], "file string, embedding array<float>, checkpoint_id int")
    tables.write_embeddings(df, str(tmp_path / "h"), half_precision=True)
    assert spark.read.parquet(str(tmp_path / "h")).first()["embedding"] == [float(np.float32(np.float16(v))) for v in (0.1, 1.0, 70000.0)]


def test_every_truncation_and_many_changes_are_faults_or_samples():
    """No beginning of a file, and no change of a header's bytes, raises anything but BadAudio."""
    good = signal.encode_wav(np.sin(np.arange(400) / 9))
    wide = good[:16] + b"\x28\0\0\0\xfe\xff" + good[22:36] + b"\x16\0" + b"\x10\0\0\0\0\0\1\0" + b"\0" * 14 + good[36:]
    r = np.random.default_rng(3)
    cases = [g[:n] for g in (good, wide) for n in range(len(g))]
    for _ in range(3000):
        b = bytearray(good[: r.integers(12, 200)])
        for at in r.integers(4, min(len(b), 48), r.integers(1, 4)):
            b[at] = r.integers(0, 256)
        cases.append(bytes(b))
    bad = 0
    for data in cases:
        for read in (signal.wav_header, signal.decode_wav):
            try:
                read(data)
            except signal.BadAudio:
                bad += 1
    assert bad > 500 and len(signal.decode_wav(good)[0]) == 400


def test_header_of_a_long_file_needs_its_beginning_only(spark):
    from corvane.catalogue import damaged

    rows = {r["path"][9:-4]: r for r in audio.headers(damaged(spark)).collect()}
    assert rows["0_good"]["duration"] == 0.1 and rows["4_no_channels"]["rate"] is None and rows["8_empty"]["bits"] is None
    body = signal.encode_wav(np.zeros(100_000))
    far = body[:12] + b"LIST" + (6000).to_bytes(4, "little") + bytes(6000) + body[12:]
    files = spark.createDataFrame([("a", bytearray(body)), ("b", bytearray(far))], "path string, content binary")
    assert {r["duration"] for r in audio.headers(files).collect()} == {3.125}


def test_session_settings_stay(spark, tmp_path):
    before = dict(spark.sparkContext._conf.getAll()) | {k: spark.conf.get(k) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch",)}
    (tmp_path / "in").mkdir()
    wav(tmp_path / "in", "20250101_000000.WAV", 1)
    audio.recordings(spark, str(tmp_path / "in")).count()
    ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), models.StandIn, NAMES)
    assert before == dict(spark.sparkContext._conf.getAll()) | {k: spark.conf.get(k) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch",)}


def test_deployments_of_a_site(spark, tmp_path):
    head = "file,file_path,chunk_idx,start_time,end_time,checkpoint_id,top1,score1\n"
    for site in ("A4", "A4-2", "A40", "A4-10", "B1"):
        folder = tmp_path / site / tables.PARTITIONED
        folder.mkdir(parents=True)
        (folder / "checkpoint_0000.csv").write_text(head + f"{site}_0,/x/{site}/a.wav,0,0.0,5.0,0,owl,1.5\n")
    (tmp_path / "A4-3").mkdir()
    names = lambda **k: [f.split("/")[-2] for f in tables.related_folders(spark, str(tmp_path / "A4-2" / tables.PARTITIONED), **k)]
    assert names() == ["A4", "A4-10", "A4-2"]
    assert names(legacy=True) == ["A4", "A4-10", "A4-2", "A40"]
    assert tables.related_folders(spark, str(tmp_path / "B1")) == [str(tmp_path / "B1")]
    got = tables.site_predictions(spark, str(tmp_path / "A4" / tables.PARTITIONED), k=1).collect()
    assert sorted((r["site"], r["file"]) for r in got) == [("A4", "A4_0"), ("A4-10", "A4-10_0"), ("A4-2", "A4-2_0")]


def test_exports_of_what_was_taken_in(spark, tmp_path):
    (tmp_path / "in").mkdir()
    wav(tmp_path / "in", "20250101_000000.WAV", 6)
    ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), models.Fixed, ["owl", "wren", "jay"], k=2)
    tables.export_predictions(spark, str(tmp_path / "out"), str(tmp_path / "csv"), k=5)
    rows = tables.predictions(spark, str(tmp_path / "csv/checkpoint=checkpoint_0000"), k=5).collect()
    assert sorted((r["chunk_idx"], r["checkpoint_id"], r["top1"], r["top2"], r["top3"], r["score2"], r["score3"]) for r in rows) == [(0, 0, "owl", "wren", None, 1.0, None), (1, 0, "owl", "wren", None, 1.0, None)]
    tables.export_embeddings(spark, str(tmp_path / "out"), str(tmp_path / "wide"), 4)
    assert {"emb_0", "emb_3", "checkpoint_id"} <= set(spark.read.parquet(str(tmp_path / "wide")).columns)
    from corvane import cli

    cli.main(["timeseries", "--ingested", "--input", str(tmp_path / "out"), "--output", str(tmp_path / "series")])
    assert sorted((r["species"], r["n"]) for r in spark.read.parquet(str(tmp_path / "series")).collect()) == [("owl", 2), ("wren", 2)]
    cli.main(["export", "--input", str(tmp_path / "out"), "--output", str(tmp_path / "all"), "--embedding-size", "4"])
    assert (tmp_path / "all/predictions_partitioned").is_dir() and (tmp_path / "all/embeddings_partitioned").is_dir()


def test_half_precision_keeps_nulls(spark):
    df = spark.createDataFrame([(0, [0.1, 2.0]), (1, None), (2, [])], "i int, e array<float>")
    got = {r["i"]: r["h"] for r in df.select("i", tables.half("e").alias("h")).collect()}
    assert got == {0: [float(np.float32(np.float16(0.1))), 2.0], 1: None, 2: []}
