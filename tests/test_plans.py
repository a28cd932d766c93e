import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane import cli
from corvane.plans import benchmark, maps


def rows(spark, n=60):
    r = np.random.default_rng(0)
    data = [(f"20250101_{i % 24:02d}0000_{i}", f"/s/20250101_{i % 24:02d}0000.WAV", i, 0.0, 5.0, [float(v) for v in r.normal(size=6)]) for i in range(n)]
    return spark.createDataFrame(data, "file string, file_path string, chunk_idx int, start_time double, end_time double, embedding array<float>")


def test_class_map_keeps_unmatched_rows(spark):
    e = rows(spark)
    p = e.where("chunk_idx < 50").select("file_path", "chunk_idx", F.concat(F.lit("c"), F.col("chunk_idx") % 3).alias("top1"))
    got = maps.class_map(e, p, n=2).collect()
    assert len(got) == 60 and {r["class_index"] for r in got if r["predicted_class"] is None} == {0}
    assert {r["predicted_class"]: r["class_index"] for r in got if r["predicted_class"]} == {"c0": 1, "c1": 2, "c2": 0}


def test_time_map_and_its_windows(spark):
    m = maps.time_map(rows(spark), least=500)
    assert m.count() == 60 and m.first()["day_of_year"] == 1
    assert maps.time_of_day_windows(m.where("time_seconds < 7200")).count() in (1, 2)


def test_labels_lie_off_the_points(spark):
    m = maps.class_map(rows(spark), rows(spark).select("file_path", "chunk_idx", (F.col("chunk_idx") % 2).cast("string").alias("top1")), n=2)
    assert all(np.isfinite([r["label_x"], r["label_y"]]).all() for r in maps.label_places(m).collect())
    assert maps.label_places(m.limit(0)).count() == 0


def test_chunk_labels_skip_bad_names(spark):
    p = spark.createDataFrame([("a_0", "/s/a.wav", 0, "x", "nan", "z", 3.0, 2.0, 1.0), ("b_0", "/s/b.wav", 0, "q", "q", "q", 3.0, 2.0, 1.0)], "file string, file_path string, chunk_idx int, top1 string, top2 string, top3 string, score1 double, score2 double, score3 double")
    got = maps.chunk_labels(p, "a").collect()
    assert [(x["species"], x["confidence"]) for x in got[0]["labels"]] == [("x", 100.0), ("z", 0.0)] and len(got) == 1


def test_colours_of_the_day():
    c = maps.day_colours([("morning", 5.0, 8.0), ("evening", 22.0, 1.0)])
    assert c.shape == (288, 4)
    assert c[12 * 6, 3] == 1 and c[int(12 * 23.5), 3] == 1 and c[6, 3] == 1 and c[12 * 12, 3] == maps.GAP_ALPHA


def test_bilinear():
    g = np.array([[0.0, 1.0], [2.0, 3.0]])
    assert maps.bilinear(g, np.array([0.5, 5.0, -1.0]), np.array([0.5, 5.0, 0.0])).tolist() == [1.5, 3.0, 0.0]


def test_sweep_and_report(spark, tmp_path):
    def run(config):
        if config["workers"] == 3:
            raise ValueError
        return config["workers"] * 10

    runs = benchmark.sweep(spark, run, [{"workers": w} for w in (1, 2, 3)], iterations=2)
    assert runs.count() == 6 and benchmark.report(runs).count() == 2
    benchmark.write_report(runs, str(tmp_path / "r"))
    doc = json.loads(spark.read.text(str(tmp_path / "r")).first()[0])
    assert [r["rank"] for r in doc["results"]] == [1, 2]


def test_cli(spark, tmp_path, capsys):
    (tmp_path / "log.txt").write_text("[01:00:00] Starting: a\n│ Total Files │ 5\n[02:00:00] DONE: a\n")
    cli.main(["parse-log", "--input", str(tmp_path / "log.txt"), "--output", str(tmp_path / "jobs")])
    assert json.loads(capsys.readouterr().out)["jobs"] == 1
    with pytest.raises(SystemExit):
        cli.main(["unknown"])


def test_report_round_trip(spark, tmp_path):
    from corvane.sources import tables

    runs = benchmark.sweep(spark, lambda c: c["workers"] * 10, [{"workers": w, "batch_size": 4, "loader_threads": 1, "use_float16": False} for w in (1, 2)], iterations=2)
    benchmark.write_report(runs, str(tmp_path / "r"), model_path="m.onnx", timeout=60)
    read = tables.benchmark_report(spark, str(tmp_path / "r"))
    r = read.first()
    assert r["benchmark_metadata"]["successful_configurations"] == 2 and r["test_parameters"]["workers_tested"] == [1, 2] and r["test_parameters"]["timeout_seconds"] == 60
    best = benchmark.analysis(read).orderBy("rank").collect()
    assert [b["rank"] for b in best] == [1, 2] and all(abs(b["speedup_factor"] - 60 * b["mean_throughput"]) < 1e-6 * b["speedup_factor"] for b in best)
    assert all(x["throughput_stats"]["count"] == 2 and x["files_processed"] == 20 * x["config"]["workers"] for x in r["results"])


def test_sweep_stops_what_takes_too_long_and_reads_the_machine(spark):
    from corvane.plans.benchmark import Monitor

    def slow(config):
        import time

        def wait(batches):
            time.sleep(60)
            yield from batches

        return spark.range(1).mapInArrow(wait, "id long").count()

    assert [r["returncode"] for r in benchmark.sweep(spark, slow, [{"workers": 1}], iterations=1, timeout=3).collect()] == [-1]
    with Monitor(0.05) as seen:
        sum(i * i for i in range(4_000_000))
    assert seen.mb and max(seen.mb) > 10 and max(seen.cpu) > 0


def test_best_by_text_and_number_keys(spark):
    from corvane.operators import stats

    rows = spark.createDataFrame([("g", "b", 2.0), ("g", "a", 2.0), ("g", "c", 1.0), ("h", "z", None)], "g string, k string, v double")
    assert {r["g"]: r["best_k"] for r in stats.best_by(rows, ["g"], "v", "k").collect()}["g"] == "a"


def test_label_goes_where_its_own_class_is_thin(spark):
    pts = [(1, 10.0 + i % 7 * 0.1, 5.0 + i % 5 * 0.1) for i in range(200)] + [(2, 0.0, 5.0), (0, 0.0, 0.0), (0, 10.0, 10.0), (2, 0.0, 5.0)]
    m = spark.createDataFrame(pts, "class_index int, umap_x double, umap_y double")
    got = {r["class"]: r for r in maps.label_places(m).collect()}
    assert set(got) == {1, 2}
    # Both rays leave the plot at once, so the labels stand a little further out.
    reach = 10.6
    assert abs(got[1]["label_x"] - got[1]["cx"]) > 0.3 * reach and abs(got[2]["cx"] - got[2]["label_x"]) > 0.3 * reach


def test_mornings_go_before_evenings():
    c = maps.day_colours([("evening", 6.0, 9.0), ("morning", 5.0, 8.0)])
    assert c[int(287 * 7 / 24), :3].tolist() != c[int(287 * 8.5 / 24), :3].tolist() and c[0].tolist() == [maps.GAP] * 3 + [maps.GAP_ALPHA]
    assert c[287, 3] == maps.GAP_ALPHA
