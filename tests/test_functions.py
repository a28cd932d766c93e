import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.functions import arrays as A
from corvane.functions import paths as P
from corvane.functions import signal as S
from corvane.functions import times as M
from corvane.operators import detections as D
from corvane.operators import embeddings as E
from corvane.operators import joblog, joins, raster, stats
from corvane.plans import models, timeseries


def one(spark, value, kind, *exprs):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return list(df.select(*[e(F.col("x")) for e in exprs]).first())


@pytest.mark.parametrize(
    ("path", "stem", "ts"),
    [
        ("/a/20250101_053015.WAV", "20250101_053015", datetime.datetime(2025, 1, 1, 5, 30, 15)),
        ("/a/20230101_053015.wav", "20230101_053015", None),
        ("/a/2025011_000000.wav", "2025011_000000", None),
        ("/a/20250101_053015.x.wav", "20250101_053015.x", None),
        ("/a/.hidden", ".hidden", None),
        ("/20250101_053015/none", "none", None),
    ],
)
def test_stem_and_time(spark, path, stem, ts):
    assert one(spark, path, "string", P.stem, P.file_timestamp) == [stem, ts]


def test_path_time_is_found_anywhere(spark):
    assert one(spark, "/20250101_053015 copy/x.wav", "string", P.path_timestamp) == [datetime.datetime(2025, 1, 1, 5, 30, 15)]
    assert one(spark, "/none/x.wav", "string", P.path_timestamp) == [None]


def test_keys(spark):
    assert one(spark, "rec_5_12", "string", P.trailing_int, P.key_stem) == [12, "rec_5"]
    assert one(spark, "rec", "string", P.trailing_int, P.key_stem) == [0, "rec"]


@pytest.mark.parametrize(("s", "want"), [("short", "short"), ("Parus major and others here", "Parus major and..."), ("Abcdefghijklmnopqrstuvwxyz", "Abcdefghijklmnopqrs..."), ("Ab cdefghijklmnopqrstuvwxyz", "Ab cdefghijklmnopqr...")])
def test_truncate(spark, s, want):
    assert one(spark, s, "string", A.smart_truncate) == [want]


def test_topk_order(spark):
    got = one(spark, [1.0, float("nan"), 3.0, 3.0, -1.0], "array<double>", lambda x: A.topk(x, 3))[0]
    assert [r["i"] for r in got] == [1, 3, 2]
    assert len(one(spark, [1.0], "array<double>", lambda x: A.topk(x, 3))[0]) == 1
    logits = np.array([[1.0, np.nan, 3.0, 3.0, -1.0]])
    assert models.best(logits, 3).tolist() == [[1, 3, 2]]


@pytest.mark.parametrize("seed", range(5))
def test_best_equals_sorting(seed):
    x = np.random.default_rng(seed).integers(0, 5, (20, 50)).astype(float)
    want = [sorted(range(50), key=lambda i: (-r[i], -i))[:10] for r in x]
    assert models.best(x, 10).tolist() == want


def test_relative(spark):
    r = lambda v: one(spark, v, "array<double>", A.relative)[0]
    assert r([2.0, 2.0]) == [50.0, 50.0]
    assert r([4.0, 3.0, 2.0]) == [100.0, 50.0, 0.0]
    assert r([float("nan")]) == []
    assert all(math.isnan(v) for v in r([1.0, float("nan")]))


def test_frames_and_peaks(spark):
    assert one(spark, [], "array<double>", lambda x: A.frame_numbers(F.size(x), 5))[0] == []
    assert one(spark, [1.0] * 12, "array<double>", lambda x: A.frame_numbers(F.size(x), 5))[0] == [0, 1, 2]
    assert one(spark, [0.5, -2.0], "array<double>", A.peak_normal)[0] == [0.0625, -0.25]
    assert one(spark, [0.0, 1e-12], "array<double>", A.peak_normal)[0] == [0.0, 1e-12]


def test_windows_around_midnight(spark):
    assert one(spark, 23.5, "double", lambda h: M.in_window(h, 22.0, 2.0), lambda h: M.in_window(h, 2.0, 22.0)) == [True, False]


@pytest.mark.parametrize(("rate", "channels", "seconds"), [(32_000, 1, 5.0), (32_000, 2, 12.0), (44_100, 1, 1.0), (16_000, 2, 0.0)])
def test_wav_round_trip(rate, channels, seconds):
    t = np.arange(int(rate * seconds)) / rate
    x = np.stack([0.4 * np.sin(2 * np.pi * 440 * t)] * channels, axis=1)
    back, r = S.decode_wav(S.encode_wav(x, rate))
    assert r == rate and back.shape == x.shape
    assert np.abs(back - x).max(initial=0) < 1e-4
    y = S.load(S.encode_wav(x, rate))
    assert len(y) == -(-len(x) * 32_000 // rate)
    if seconds:
        want = 0.4 * np.sin(2 * np.pi * 440 * np.arange(len(y)) / 32_000)
        assert np.abs(y - want)[500:-500].max() < 0.01


@pytest.mark.parametrize("data", [b"", b"RIFF", b"not a recording at all", b"RIFF\0\0\0\0WAVEfmt "])
def test_bad_audio(data):
    with pytest.raises(S.BadAudio):
        S.load(data)


def test_framing_restores_the_signal():
    x = np.random.default_rng(0).normal(size=400_001).astype(np.float32)
    assert np.array_equal(np.concatenate(S.frames(x)), x)
    p = S.prepared(S.frames(x)[-1])
    assert len(p) == S.CHUNK and abs(np.abs(p).max() - 0.25) < 1e-6
    assert not S.prepared(np.zeros(10, np.float32)).any()


def test_spectrum_has_its_peak_at_the_tone():
    t = np.arange(32_000) / 32_000
    db = S.stft_db(np.sin(2 * np.pi * 2000 * t))
    assert abs(db[:, 20].argmax() * 32_000 / 2048 - 2000) < 16
    assert db.max() == 0 and db.min() >= -80


def test_thresholds(spark):
    rows = [("a", 0.0), ("a", -0.1), ("", 1.0), ("nan", 1.0), (None, 1.0), ("b", float("nan")), ("b", 2.0)]
    df = spark.createDataFrame(rows, "species string, score double")
    assert sorted(tuple(r) for r in D.detections(df).collect()) == [("a", 0.0), ("b", 2.0)]


def test_unpivot_without_some_columns(spark):
    df = spark.createDataFrame([("x", "a", 1.0, "b", 2.0)], "k string, top1 string, score1 double, top2 string, score2 double")
    assert [tuple(r) for r in D.unpivot_topk(df, ["k"]).orderBy("rank").collect()] == [("x", 1, "a", 1.0), ("x", 2, "b", 2.0)]
    with pytest.raises(ValueError, match="no topN"):
        D.unpivot_topk(df.select("k"), ["k"])


def test_series_of_one_day_and_of_none(spark):
    df = spark.createDataFrame([(datetime.date(2025, 1, 1), "a")], "date date, species string")
    assert [tuple(r) for r in timeseries.detection_timeseries(df).collect()] == [(datetime.date(2025, 1, 1), "a", 1, 1.0)]
    assert timeseries.detection_timeseries(df.limit(0)).count() == 0


def test_series_from_predictions(spark):
    rows = [("20250101_000000_0", "/s/20250101_000000.WAV", "a", 1.0, "b", -1.0), ("20250103_000000_1", None, "a", 2.0, "b", 3.0), ("x_1", "/s/x.wav", "a", 9.0, "b", 9.0)]
    df = spark.createDataFrame(rows, "file string, file_path string, top1 string, score1 double, top2 string, score2 double")
    got = {(r["date"].day, r["species"]): r["n"] for r in timeseries.from_predictions(df).collect()}
    assert got == {(1, "a"): 1, (2, "a"): 0, (3, "a"): 1, (1, "b"): 0, (2, "b"): 0, (3, "b"): 1}


@pytest.mark.parametrize(("bins", "want"), [([5], [("single", 5 / 6, 1.0)]), ([0, 1, 143], [("single", 143 / 6, 2 / 6)]), ([], []), (list(range(144)), [("single", 0.0, 24.0)])])
def test_recording_windows(spark, bins, want):
    df = spark.createDataFrame([(b, 10) for b in bins], "bin int, n long")
    got = raster.recording_windows(raster.circular_runs(raster.runs(raster.occupied(df)))).collect()
    assert [(r[0], round(r[1], 5), round(r[2], 5)) for r in got] == [(k, round(a, 5), round(b, 5)) for k, a, b in want]


@pytest.mark.parametrize("n", [1, 2, 19, 20, 41])
def test_percentiles_by_place(spark, n):
    xs = sorted(float(x) for x in np.random.default_rng(n).integers(0, 10, n))
    r = stats.sample_stats(spark.createDataFrame([("g", x) for x in xs], "g string, x double"), ["g"], "x").first()
    if n == 1:
        assert r["percentile_25"] is None and r["stdev"] is None
    else:
        assert [r["percentile_25"], r["percentile_75"], r["percentile_95"]] == [xs[int(n * 0.25)], xs[int(n * 0.75)], xs[int(n * 0.95)] if n >= 20 else xs[-1]]


def test_days_at_the_bound(spark):
    day = lambda d, n: [(datetime.datetime(2025, 1, d),)] * n
    df = spark.createDataFrame(day(1, 500) + day(2, 501) + day(3, 1), "ts timestamp_ntz")
    assert E.sufficient_days(df, "ts").count() == 502
    assert E.sufficient_days(df, "ts", 600).count() == 1002


def test_join_keeps_unmatched_and_fans_out(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "p"), (1, "q")], "k int, v string")
    assert sorted(map(tuple, joins.left_with_suffix(a, b, ["k"]).collect()), key=str) == [(1, "x", "p"), (1, "x", "q"), (2, "y", None)]
    assert sorted(map(tuple, joins.left_with_suffix(a, b, ["k"], one_each=True).collect()), key=str) == [(1, "x", "p"), (2, "y", None)]


LOG = "[01:00:00] Starting: A.4\n│ Total Files │ 1,234\n[02:00:00] DONE: A.4\n[03:00:00] Starting: A.4\n│ Total Files │ 5\n[04:00:00] FAILED: A.4\n"


def test_log_with_a_failed_job_and_a_repeated_site(spark):
    got = joblog.parse(spark.createDataFrame([(LOG,)], "value string")).orderBy("ordinal").collect()
    assert [(r["name"], r["start_time"], r["end_time"], r["total_files"]) for r in got] == [("A.4", "01:00:00", "02:00:00", "1234"), ("A.4", "03:00:00", None, "5")]
    assert joblog.parse(spark.createDataFrame([("no jobs",)], "value string")).count() == 0


def test_bins_close_the_last_one(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (2.0,)], "x double")
    assert [r[0] for r in df.select(raster.bin_of(F.col("x"), 0.0, 1.0, 2)).collect()] == [0, 1, 1, None]
