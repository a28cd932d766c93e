"""A query for each operator over the driver's tables, and the same in SQL.

Stand-ins: events are detections (event_type a species, value a score, ts the recording's time, user_id a site), embeddings are
logits, waveforms and embeddings, lineitem are chunk rows with repeated keys, orders are files and jobs."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.functions import arrays as A
from corvane.functions import paths as P
from corvane.functions import times as M
from corvane.operators import detections as D
from corvane.operators import embeddings as E
from corvane.operators import joblog, joins, raster, stats, topk
from corvane.plans import timeseries

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(c, name: str):
    return F.round(c, 6).alias(name)


def detected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as detections."""
    e = table(spark, sf_dir, "events").select(F.to_date("ts").alias("date"), F.col("event_type").alias("species"), F.col("value").alias("score"))
    return D.detections(e, 10.0)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", A.doubles(F.col("embedding")).alias("x"), "label")


def sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts of high scores, with days missing."""
    e = table(spark, sf_dir, "events").select(F.to_date("ts").alias("date"), F.col("event_type").alias("species"), F.col("value").alias("score"))
    return D.daily_counts(D.detections(e, 150.0))


DETECTED = "d AS (SELECT CAST(ts AS DATE) AS date, event_type AS species, value AS score FROM events WHERE value >= 10.0 AND NOT isnan(value) AND event_type IS NOT NULL AND event_type NOT IN ('', 'nan'))"
DAILY = f"WITH {DETECTED}, daily AS (SELECT date, species, count(*)::BIGINT AS n FROM d GROUP BY 1, 2)"
SPARSE = DAILY.replace("10.0", "150.0")
TOP3 = "top AS (SELECT species, sum(n)::BIGINT AS total FROM daily GROUP BY 1 ORDER BY total DESC, species LIMIT 3)"
GRID = (
    "days AS (SELECT unnest(generate_series(min(date)::TIMESTAMP, max(date)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS date FROM own), "
    "full_ AS (SELECT days.date, s.species, coalesce(own.n, 0)::BIGINT AS n FROM days CROSS JOIN (SELECT DISTINCT species FROM own) s LEFT JOIN own ON own.date = days.date AND own.species = s.species)"
)


def rolling_sql(width: int) -> str:
    back = width // 2
    return f"{SPARSE}, own AS (SELECT * FROM daily), {GRID} SELECT date, species, n, round(avg(n::DOUBLE) OVER (PARTITION BY species ORDER BY date ROWS BETWEEN {back} PRECEDING AND {width - 1 - back} FOLLOWING), 6) AS smooth FROM full_"


@query(f"{DAILY}, {TOP3}, own AS (SELECT daily.* FROM daily SEMI JOIN top USING (species)), {GRID} SELECT date, species, n, round(avg(n::DOUBLE) OVER (PARTITION BY species ORDER BY date ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING), 6) AS smooth FROM full_")
def detection_timeseries(spark, sf_dir):
    return timeseries.detection_timeseries(detected(spark, sf_dir), n=3, width=4).withColumn("smooth", F.round("smooth", 6))


@query(f"{DAILY} SELECT date, species, n FROM daily")
def daily_counts(spark, sf_dir):
    return D.daily_counts(detected(spark, sf_dir))


@query(f"{DAILY} SELECT coalesce(sum(n), 0)::BIGINT AS detections, count(DISTINCT species) AS species, count(DISTINCT date) AS days FROM daily")
def detection_totals(spark, sf_dir):
    return D.totals(D.daily_counts(detected(spark, sf_dir)))


@query(f"{DAILY}, {TOP3} SELECT species, total FROM top")
def species_top_n(spark, sf_dir):
    return D.top_species(D.daily_counts(detected(spark, sf_dir)), 3)


@query(f"{DAILY}, {TOP3} SELECT date, species, n FROM daily SEMI JOIN top USING (species)")
def top_species_semi(spark, sf_dir):
    return D.of_top_species(D.daily_counts(detected(spark, sf_dir)), 3).select("date", "species", "n")


@query(f"{SPARSE}, own AS (SELECT * FROM daily), {GRID} SELECT date, species, n FROM full_")
def calendar_zero_fill(spark, sf_dir):
    return D.calendar(sparse(spark, sf_dir))


@query(rolling_sql(4))
def rolling_mean_even(spark, sf_dir):
    return D.rolling_mean(D.calendar(sparse(spark, sf_dir)), 4).withColumn("smooth", F.round("smooth", 6))


@query(rolling_sql(5))
def rolling_mean_odd(spark, sf_dir):
    return D.rolling_mean(D.calendar(sparse(spark, sf_dir)), 5).withColumn("smooth", F.round("smooth", 6))


V = "v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings)"
LONG = f"WITH {V}, e AS (SELECT vec_id, unnest(x) AS score, unnest(range(len(x)))::INT AS idx FROM v), r AS (SELECT vec_id, (row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, idx DESC))::INT AS rank, idx, score FROM e), k AS (SELECT * FROM r WHERE rank <= 10)"
WIDE10 = ", ".join(f"max(CASE WHEN rank = {i} THEN 'species_' || idx END) AS top{i}" for i in range(1, 11)) + ", " + ", ".join(f"max(CASE WHEN rank = {i} THEN score END) AS score{i}" for i in range(1, 11))
NAMES = [f"species_{i}" for i in range(64)]


@query(f"{LONG} SELECT vec_id, rank, idx, score FROM k")
def topk_long(spark, sf_dir):
    return topk.topk_long(vectors(spark, sf_dir), "x", ["vec_id"], 10)


@query(f"{LONG} SELECT vec_id, {WIDE10} FROM k GROUP BY vec_id")
def topk_wide(spark, sf_dir):
    return topk.topk_wide(vectors(spark, sf_dir), "x", ["vec_id"], NAMES, 10)


@query(f"{LONG} SELECT vec_id, rank, 'species_' || idx AS species, score FROM k WHERE rank <= 5")
def topk_unpivot(spark, sf_dir):
    return D.unpivot_topk(topk.topk_wide(vectors(spark, sf_dir), "x", ["vec_id"], NAMES, 5), ["vec_id"], 5)


@query(f"{LONG} SELECT vec_id, rank, idx, 'species_' || idx AS species FROM k WHERE rank <= 3")
def class_lookup(spark, sf_dir):
    names = spark.createDataFrame(list(enumerate(NAMES)), "idx int, species string")
    return topk.label(topk.topk_long(vectors(spark, sf_dir), "x", ["vec_id"], 3), names).select("vec_id", "rank", "idx", "species")


@query(f"WITH {V} SELECT vec_id, " + ", ".join(f"x[{i + 1}] AS emb_{i}" for i in range(64)) + " FROM v")
def array_to_wide(spark, sf_dir):
    return vectors(spark, sf_dir).select("vec_id", *A.to_wide(F.col("x"), 64))


@query(f"WITH {V} SELECT vec_id, (unnest(range(len(x))))::INT AS i, unnest(x) AS value FROM v")
def wide_to_array(spark, sf_dir):
    wide = vectors(spark, sf_dir).select("vec_id", *A.to_wide(F.col("x"), 64))
    return wide.select("vec_id", F.posexplode(F.array(*A.wide_names(wide.columns))).alias("i", "value"))


FRAMES = f"WITH {V}, f AS (SELECT vec_id, x, unnest(range(ceil(len(x) / 10.0)::INT))::INT AS chunk_idx FROM v)"


def framed(spark, sf_dir):
    f = vectors(spark, sf_dir).select("vec_id", "x", F.explode(A.frame_numbers(F.size("x"), 10)).alias("chunk_idx"))
    return f.withColumn("samples", A.frame(F.col("x"), F.col("chunk_idx"), 10))


@query(f"{FRAMES} SELECT vec_id, chunk_idx, len(x[chunk_idx * 10 + 1 : chunk_idx * 10 + 10])::INT AS n, list_sum(x[chunk_idx * 10 + 1 : chunk_idx * 10 + 1]) AS first FROM f")
def frame_chunks(spark, sf_dir):
    return framed(spark, sf_dir).select("vec_id", "chunk_idx", F.size("samples").alias("n"), F.get("samples", F.lit(0)).alias("first"))


@query(f"{FRAMES} SELECT vec_id, chunk_idx, (chunk_idx * 5.0)::DOUBLE AS start_time, least((chunk_idx + 1) * 5.0::DOUBLE, len(x) / 2.0::DOUBLE) AS end_time FROM f")
def chunk_times(spark, sf_dir):
    i = F.col("chunk_idx")
    return framed(spark, sf_dir).select("vec_id", "chunk_idx", A.start_time(i, 5.0).alias("start_time"), A.end_time(i, F.size("x"), 5.0, 2.0).alias("end_time"))


@query(f"{FRAMES}, g AS (SELECT vec_id, chunk_idx, x[chunk_idx * 10 + 1 : chunk_idx * 10 + 10] AS s FROM f) SELECT vec_id, chunk_idx, i::INT AS i, coalesce(s[i + 1], 0.0) AS value FROM g, range(10) t(i)")
def pad_frames(spark, sf_dir):
    return framed(spark, sf_dir).select("vec_id", "chunk_idx", F.posexplode(A.pad_right(F.col("samples"), 10)).alias("i", "value"))


def peak_sql(quiet: str) -> str:
    return f"WITH {V}, z AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN list_transform(x, lambda a: a * 1e-12) ELSE x END AS x FROM v), p AS (SELECT vec_id, x, list_max(list_transform(x, lambda a: abs(a))) AS top FROM z), u AS (SELECT vec_id, top, unnest(x) AS a, unnest(range(len(x)))::INT AS i FROM p) SELECT vec_id, i, round(CASE WHEN top > 1e-10 THEN a / top * 0.25 ELSE {quiet} END * CASE WHEN vec_id % 7 = 0 THEN 1e12 ELSE 1.0 END, 9) + 0.0 AS value FROM u"


def quiet_some(spark, sf_dir):
    v = vectors(spark, sf_dir)
    return v.withColumn("x", F.when(F.col("vec_id") % 7 == 0, F.transform("x", lambda a: a * 1e-12)).otherwise(F.col("x")))


@query(peak_sql("a"))
def peak_normalize(spark, sf_dir):
    return quiet_some(spark, sf_dir).select("vec_id", F.posexplode(A.peak_normal(F.col("x"))).alias("i", "v")).select("vec_id", "i", (F.round(F.col("v") * F.when(F.col("vec_id") % 7 == 0, 1e12).otherwise(1.0), 9) + 0.0).alias("value"))


@query(peak_sql("a * 0.25"))
def peak_normalize_always_scale(spark, sf_dir):
    return quiet_some(spark, sf_dir).select("vec_id", F.posexplode(A.peak_normal(F.col("x"), always=True)).alias("i", "v")).select("vec_id", "i", (F.round(F.col("v") * F.when(F.col("vec_id") % 7 == 0, 1e12).otherwise(1.0), 9) + 0.0).alias("value"))


@query(f"WITH {V}, i AS (SELECT vec_id, x, unnest(range(len(x) // 2))::INT AS i FROM v) SELECT vec_id, i, round((x[2 * i + 1] + x[2 * i + 2]) / 2, 9) AS value FROM i")
def mono_downmix(spark, sf_dir):
    return vectors(spark, sf_dir).select("vec_id", F.posexplode(A.mono_interleaved(F.col("x"), 2)).alias("i", "v")).select("vec_id", "i", F.round("v", 9).alias("value"))


def scored(spark, sf_dir):
    """Five scores each: all equal for some, a NaN or none finite for others."""
    x = F.slice("x", 1, 5)
    nan = F.lit(float("nan"))
    m = F.col("vec_id") % 11
    own = F.when(m == 0, F.transform(x, lambda v: F.lit(0.5))).when(m == 1, F.transform(x, lambda v, i: F.when(i == 2, nan).otherwise(v))).when(m == 2, F.transform(x, lambda v: nan)).otherwise(x)
    return vectors(spark, sf_dir).select("vec_id", own.alias("scores"))


SCORED = f"WITH {V}, s AS (SELECT vec_id, i::INT AS i, CASE WHEN vec_id % 11 = 0 THEN 0.5 WHEN vec_id % 11 = 1 AND i = 2 THEN 'nan'::DOUBLE WHEN vec_id % 11 = 2 THEN 'nan'::DOUBLE ELSE x[i + 1] END AS s FROM v, range(5) t(i)), g AS (SELECT vec_id, min(s) FILTER (WHERE isfinite(s)) AS lo, max(s) FILTER (WHERE isfinite(s)) AS hi, count(*) FILTER (WHERE isfinite(s)) AS k FROM s GROUP BY 1), c AS (SELECT s.vec_id, i, CASE WHEN k < 5 THEN 'nan'::DOUBLE WHEN hi > lo THEN (s - lo) / (hi - lo) * 100 ELSE 50.0 END AS confidence FROM s JOIN g USING (vec_id) WHERE k > 0)"


@query(f"{SCORED} SELECT vec_id, i, CASE WHEN isnan(confidence) THEN -1 ELSE round(confidence, 6) END AS confidence, CASE WHEN confidence >= 75 THEN 'very high' WHEN confidence >= 50 THEN 'high' WHEN confidence >= 25 THEN 'medium' ELSE 'low' END AS level FROM c")
def relative_confidence(spark, sf_dir):
    c = scored(spark, sf_dir).select("vec_id", F.posexplode(A.relative(F.col("scores"))).alias("i", "c"))
    return c.select("vec_id", "i", F.when(F.isnan("c"), -1.0).otherwise(F.round("c", 6)).alias("confidence"), A.confidence_level(F.col("c")).alias("level"))


@query(f"{SCORED}, n AS (SELECT vec_id, i, CASE (vec_id + i) % 6 WHEN 0 THEN '' WHEN 1 THEN 'nan' WHEN 2 THEN NULL ELSE 'species_' || i END AS species, confidence FROM c), o AS (SELECT *, (row_number() OVER (PARTITION BY vec_id ORDER BY i))::INT AS rank FROM n WHERE species IS NOT NULL AND species NOT IN ('', 'nan') AND isfinite(confidence)) SELECT vec_id, rank, species, round(confidence, 6) AS confidence FROM o WHERE rank <= 3")
def top3_valid(spark, sf_dir):
    name = lambda i, v: F.when((v + i) % 6 == 0, "").when((v + i) % 6 == 1, "nan").when((v + i) % 6 == 2, F.lit(None)).otherwise(F.concat(F.lit("species_"), i.cast("string")))
    p = scored(spark, sf_dir).select("vec_id", F.transform(A.relative(F.col("scores")), lambda c, i: F.struct(name(i, F.col("vec_id")).alias("species"), c.alias("confidence"))).alias("p"))
    best = p.select("vec_id", F.posexplode(A.first_valid(F.col("p"), 3)).alias("i", "b"))
    return best.select("vec_id", (F.col("i") + 1).alias("rank"), F.col("b.species").alias("species"), r6(F.col("b.confidence"), "confidence"))


@query("WITH h AS (SELECT p_partkey, p_name, left(p_name, 9) AS h FROM part), l AS (SELECT *, CASE WHEN instr(h, ' ') > 0 THEN length(h) - instr(reverse(h), ' ') ELSE -1 END AS last FROM h) SELECT p_partkey, CASE WHEN length(p_name) <= 10 THEN p_name WHEN last > 5 THEN left(h, last::INT) || '...' ELSE h || '...' END AS label FROM l")
def smart_truncate(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", A.smart_truncate(F.col("p_name"), limit=10, cut=9, back=0.5).alias("label"))


@query("WITH u AS (SELECT page_id, split_part(url, '/', -1) AS basename FROM pages) SELECT page_id, basename, regexp_replace(basename, '(.)\\.[^.]+$', '\\1') AS stem, regexp_replace(basename || '.WAV', '(?i)\\.wav$', '') AS audio_stem FROM u")
def basename_stem(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", P.basename(url).alias("basename"), P.stem(url).alias("stem"), P.without_wav(F.concat(P.basename(url), F.lit(".WAV"))).alias("audio_stem"))


CHUNK_PATH = "'/site/rec_' || l_orderkey || '.wav'"


def chunk_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", F.concat(F.lit("/site/rec_"), F.col("l_orderkey").cast("string"), F.lit(".wav")).alias("file_path"), F.col("l_linenumber").alias("chunk_idx"))


@query("SELECT l_orderkey, 'rec_' || l_orderkey || '_' || l_linenumber AS file, 'rec_' || l_orderkey AS stem, l_linenumber::INT AS idx, count(*) AS n FROM lineitem GROUP BY 1, 2, 3, 4")
def chunk_key(spark, sf_dir):
    k = chunk_rows(spark, sf_dir).withColumn("file", P.chunk_key(F.col("file_path"), F.col("chunk_idx")))
    return k.select("l_orderkey", "file", P.key_stem(F.col("file")).alias("stem"), P.trailing_int(F.col("file")).alias("idx")).groupBy("l_orderkey", "file", "stem", "idx").agg(F.count(F.lit(1)).alias("n"))


def named_events(spark, sf_dir):
    """Recordings named by time, some of them badly."""
    stamp = F.date_format("ts", "yyyyMMdd_HHmmss")
    m = F.col("event_id") % 9
    name = F.when(m == 0, F.substring(stamp, 2, 20)).when(m == 1, F.concat(F.lit("2023"), F.substring(stamp, 5, 20))).when(m == 2, F.concat(F.substring(stamp, 1, 8), F.lit("_996161"))).otherwise(stamp)
    return table(spark, sf_dir, "events").select("event_id", name.alias("name"))


NAMED = "WITH n AS (SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS s FROM events), f AS (SELECT event_id, CASE event_id % 9 WHEN 0 THEN substr(s, 2) WHEN 1 THEN '2023' || substr(s, 5) WHEN 2 THEN substr(s, 1, 8) || '_996161' ELSE s END AS name FROM n)"
PARSED = "CASE WHEN regexp_full_match({0}, '\\d{{8}}_\\d{{6}}') THEN try_strptime({0}, '%Y%m%d_%H%M%S') END"


@query(f"{NAMED}, t AS (SELECT event_id, {PARSED.format('name')} AS t FROM f) SELECT event_id, CASE WHEN year(t) >= 2024 THEN t END AS recorded FROM t")
def filename_timestamp(spark, sf_dir):
    path = F.concat(F.lit("/data/A4/"), F.col("name"), F.lit(".WAV"))
    return named_events(spark, sf_dir).select("event_id", P.file_timestamp(path).alias("recorded"))


@query(f"{NAMED}, g AS (SELECT event_id, regexp_extract(name || '/part.wav', '(\\d{{8}}_\\d{{6}})', 1) AS g FROM f) SELECT event_id, {PARSED.format('g')} AS recorded FROM g")
def path_timestamp(spark, sf_dir):
    path = F.concat(F.lit("/data copy/"), F.col("name"), F.lit(" copy/part.wav"))
    return named_events(spark, sf_dir).select("event_id", P.path_timestamp(path).alias("recorded"))


SECONDS = "(hour(ts) * 3600 + minute(ts) * 60 + second(ts))"


@query(f"SELECT event_id, {SECONDS}::INT AS seconds, dayofyear(ts)::INT AS day, round({SECONDS} / 3600.0::DOUBLE % 24, 9) AS hour, round({SECONDS} / 3600.0::DOUBLE % 24 / 24, 9) AS fraction FROM events")
def time_features(spark, sf_dir):
    s = M.second_of_day(F.col("ts"))
    return table(spark, sf_dir, "events").select("event_id", s.cast("int").alias("seconds"), F.dayofyear("ts").alias("day"), F.round(M.hour_of_day(s), 9).alias("hour"), F.round(M.hour_fraction(s), 9).alias("fraction"))


HIST = f"h AS (SELECT ({SECONDS} // 600)::INT AS bin, count(*) AS n FROM e GROUP BY 1)"


@query(f"WITH e AS (SELECT * FROM events), {HIST} SELECT bin, n FROM h")
def tod_histogram(spark, sf_dir):
    return raster.time_of_day_bins(table(spark, sf_dir, "events"), M.second_of_day(F.col("ts")))


def night_events(spark, sf_dir):
    return table(spark, sf_dir, "events").where("hour(ts) IN (0, 1, 5, 6, 7, 18, 19, 22, 23)")


RUNS = f"WITH e AS (SELECT * FROM events WHERE hour(ts) IN (0, 1, 5, 6, 7, 18, 19, 22, 23)), {HIST}, o AS (SELECT bin FROM h WHERE n >= (SELECT greatest(1, floor(max(n) * 0.005)) FROM h)), g AS (SELECT bin, bin - row_number() OVER (ORDER BY bin) AS g FROM o), r AS (SELECT min(bin) AS first_bin, max(bin) AS last_bin FROM g GROUP BY g)"


def night_runs(spark, sf_dir):
    return raster.runs(raster.occupied(raster.time_of_day_bins(night_events(spark, sf_dir), M.second_of_day(F.col("ts")))))


@query(f"{RUNS} SELECT first_bin, last_bin FROM r")
def occupied_runs(spark, sf_dir):
    return night_runs(spark, sf_dir)


CIRCULAR = "w AS (SELECT max(CASE WHEN last_bin = 143 THEN first_bin END) AS tail, max(CASE WHEN first_bin = 0 THEN last_bin END) AS head, count(*) AS k FROM r), c AS (SELECT first_bin, CASE WHEN tail IS NOT NULL AND head IS NOT NULL AND k > 1 AND last_bin = 143 THEN head ELSE last_bin END AS last_bin FROM r, w WHERE NOT (tail IS NOT NULL AND head IS NOT NULL AND k > 1 AND first_bin = 0))"


@query(f"{RUNS}, {CIRCULAR} SELECT first_bin, last_bin FROM c")
def circular_runs(spark, sf_dir):
    return raster.circular_runs(night_runs(spark, sf_dir))


def windows_sql(length: str, centre: str) -> str:
    return f"{RUNS}, {CIRCULAR}, l AS (SELECT *, {length} AS len FROM c), m AS (SELECT *, {centre} AS mid FROM l), b AS (SELECT *, count(*) OVER () AS k FROM (SELECT * FROM m ORDER BY len DESC, first_bin LIMIT 2)) SELECT CASE WHEN k = 1 THEN 'single' WHEN row_number() OVER (ORDER BY mid, first_bin) = 1 THEN 'morning' ELSE 'evening' END AS kind, round(first_bin / 6.0::DOUBLE, 6) AS start_hour, round((last_bin + 1) / 6.0::DOUBLE, 6) AS end_hour FROM b"


@query(windows_sql("CASE WHEN last_bin + 1 - first_bin <= 0 THEN last_bin + 145 - first_bin ELSE last_bin + 1 - first_bin END", "(first_bin + len / 2.0) / 6.0 % 24"))
def recording_windows(spark, sf_dir):
    return raster.recording_windows(raster.circular_runs(night_runs(spark, sf_dir)))


@query(windows_sql("last_bin + 1 - first_bin", "(first_bin + len / 2.0) / 6.0"))
def recording_windows_legacy(spark, sf_dir):
    return raster.recording_windows(raster.circular_runs(night_runs(spark, sf_dir)), legacy=True)


@query(f"WITH h AS (SELECT event_id, {SECONDS} / 3600.0::DOUBLE AS h FROM events) SELECT event_id, h >= 5.0 AND h <= 8.5 AS morning, h >= 22.0 OR h <= 1.5 AS night FROM h")
def window_membership(spark, sf_dir):
    h = M.hour_of_day(M.second_of_day(F.col("ts")))
    return table(spark, sf_dir, "events").select("event_id", M.in_window(h, 5.0, 8.5).alias("morning"), M.in_window(h, 22.0, 1.5).alias("night"))


@query("WITH d AS (SELECT event_id, dayofyear(ts)::INT AS day FROM events WHERE dayofyear(ts) <> 3 OR value > 50), f AS (SELECT min(day) AS first_day FROM (SELECT day, count(*) AS c FROM d GROUP BY 1 HAVING c > (SELECT 0.03 * count(*) FROM events))) SELECT event_id, day FROM d, f WHERE day >= coalesce(first_day, day)")
def day_sufficiency(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    least = 0.03 * e.count()
    return E.sufficient_days(e.where("dayofyear(ts) <> 3 OR value > 50"), "ts", least).select("event_id", "day")


@query("WITH d AS (SELECT event_id, dayofyear(ts) AS day FROM events) SELECT event_id, round((day - (SELECT min(day) FROM d)) / greatest((SELECT max(day) - min(day) FROM d), 1)::DOUBLE, 6) AS scaled FROM d")
def day_minmax(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.dayofyear("ts").alias("day"))
    return E.minmax_scaled(e, "day", "s").select("event_id", r6("s", "scaled"))


@query("WITH l AS (SELECT 'v' || vec_id AS file_path, (vec_id % 4)::INT AS chunk_idx, vec_id::DOUBLE AS start_time FROM embeddings), r AS (SELECT 'v' || vec_id AS file_path, (vec_id % 4)::INT AS chunk_idx, vec_id * 2.0::DOUBLE AS start_time, 'species_' || label AS top1 FROM embeddings WHERE label >= 3) SELECT file_path, chunk_idx, l.start_time, r.start_time AS start_time_pred, top1 FROM l LEFT JOIN r USING (file_path, chunk_idx)")
def emb_pred_left_join(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    key = [F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("file_path"), (F.col("vec_id") % 4).cast("int").alias("chunk_idx")]
    left = e.select(*key, F.col("vec_id").cast("double").alias("start_time"))
    right = e.where("label >= 3").select(*key, (F.col("vec_id") * 2.0).alias("start_time"), F.concat(F.lit("species_"), F.col("label").cast("string")).alias("top1"))
    return joins.left_with_suffix(left, right, ["file_path", "chunk_idx"])


FAN = "WITH o AS (SELECT o_orderkey AS k, o_custkey FROM orders), l AS (SELECT l_orderkey AS k, l_partkey, l_linenumber FROM lineitem)"


def fan_sides(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), "o_custkey"), table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), "l_partkey", "l_linenumber")


@query(f"{FAN} SELECT k, o_custkey, l_partkey, l_linenumber FROM o LEFT JOIN l USING (k)")
def join_fanout(spark, sf_dir):
    return joins.left_with_suffix(*fan_sides(spark, sf_dir), ["k"])


@query(f"{FAN}, m AS (SELECT k, l_partkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY l_partkey, l_linenumber) AS rn FROM l) WHERE rn = 1) SELECT k, o_custkey, l_partkey, l_linenumber FROM o LEFT JOIN m USING (k)")
def join_dedup(spark, sf_dir):
    return joins.left_with_suffix(*fan_sides(spark, sf_dir), ["k"], one_each=True)


@query("SELECT o_orderkey AS file_path FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def resume_anti_join(spark, sf_dir):
    files = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("file_path"))
    return joins.not_processed(files, table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("file_path")))


@query("SELECT DISTINCT l_orderkey AS file_path FROM lineitem")
def processed_files(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("file_path")).distinct()


@query("WITH x AS (SELECT o_orderkey AS file_path, (o_custkey % 6 + 1)::BIGINT AS expected FROM orders), d AS (SELECT l_orderkey AS file_path, count(*) AS done FROM lineitem GROUP BY 1) SELECT file_path, expected, coalesce(done, 0) AS done, coalesce(done, 0) >= expected AS complete FROM x LEFT JOIN d USING (file_path)")
def file_completion(spark, sf_dir):
    expected = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("file_path"), (F.col("o_custkey") % 6 + 1).alias("expected"))
    return joins.completion(expected, table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("file_path")))


CLASSED = "WITH c AS (SELECT label::INT AS class, count(*) AS total FROM embeddings WHERE label IS NOT NULL GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY total DESC, class) AS rn FROM c), i AS (SELECT class, total, CASE WHEN rn <= 4 THEN rn ELSE 0 END::INT AS class_index FROM r)"


@query(f"{CLASSED} SELECT class, total, class_index FROM i")
def class_index(spark, sf_dir):
    return E.class_index(table(spark, sf_dir, "embeddings").select(F.col("label").cast("int").alias("label")), "label", 4)


@query(f"{CLASSED} SELECT vec_id, class_index FROM embeddings JOIN i ON label = class")
def class_index_rows(spark, sf_dir):
    return E.with_class_index(table(spark, sf_dir, "embeddings"), "label", 4).select("vec_id", "class_index")


def points(spark, sf_dir):
    return vectors(spark, sf_dir).select("vec_id", F.col("label").cast("int").alias("label"), F.get("x", F.lit(0)).alias("x"), F.get("x", F.lit(1)).alias("y"), F.get("x", F.lit(2)).alias("z"))


PTS = f"WITH {V}, p AS (SELECT vec_id, label::INT AS label, v.x[1] AS x, v.x[2] AS y, v.x[3] AS z FROM v)"
CENT = f"{PTS}, c AS (SELECT label, median(x) AS cx, median(y) AS cy FROM p GROUP BY 1)"


@query(f"{CENT} SELECT label, round(cx, 6) AS cx, round(cy, 6) AS cy FROM c")
def median_centroid(spark, sf_dir):
    return E.median_centroids(points(spark, sf_dir), "label").select("label", r6("cx", "cx"), r6("cy", "cy"))


@query(f"{CENT} SELECT label, (row_number() OVER (ORDER BY atan2(cy, cx), label))::INT AS angle_rank FROM c")
def angle_order(spark, sf_dir):
    return E.angle_order(E.median_centroids(points(spark, sf_dir), "label"), 0.0, 0.0).select("label", "angle_rank")


def cell(v: str, lo: str, hi: str, n: int) -> str:
    return f"least(floor(({v} - {lo}) / ({hi} - {lo}) * {n}), {n - 1})::INT"


BOX = f"{PTS}, b AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM p)"


@query(f"{BOX} SELECT {cell('x', 'x0', 'x1', 20)} AS px, {cell('y', 'y0', 'y1', 20)} AS py, count(*) AS n, round(avg(z), 6) AS mean FROM p, b GROUP BY 1, 2")
def raster_mean(spark, sf_dir):
    return raster.raster(points(spark, sf_dir), 20, 20, value="z").withColumn("mean", F.round("mean", 6))


@query(f"{BOX} SELECT {cell('x', 'x0', 'x1', 50)} AS px, {cell('y', 'y0', 'y1', 50)} AS py, count(*) AS n FROM p, b GROUP BY 1, 2")
def raster_count(spark, sf_dir):
    return raster.raster(points(spark, sf_dir), 50, 50)


@query(f"{BOX} SELECT label, {cell('x', 'x0', 'x1', 15)} AS px, {cell('y', 'y0', 'y1', 15)} AS py, count(*) AS n FROM p, b GROUP BY 1, 2, 3")
def class_hist2d(spark, sf_dir):
    return raster.raster(points(spark, sf_dir), 15, 15, by=("label",))


@query(f"{BOX} SELECT round(x0, 6) AS x0, round(x1, 6) AS x1, round(y0, 6) AS y0, round(y1, 6) AS y1 FROM b")
def point_extent(spark, sf_dir):
    return raster.extent(points(spark, sf_dir)).select(*[r6(c, c) for c in ("x0", "x1", "y0", "y1")])


STATS = (
    "WITH g AS (SELECT event_type, count(*) AS count, avg(value) AS mean, median(value) AS median, min(value) AS min, max(value) AS max, stddev_samp(value) AS stdev, var_samp(value) AS variance, list_sort(list(value)) AS l FROM events WHERE value IS NOT NULL GROUP BY 1) "
    "SELECT event_type, count, round(mean, 6) AS mean, round(median, 6) AS median, min, max, round(max - min, 6) AS range, round(stdev, 6) AS stdev, round(variance, 4) AS variance, "
    "CASE WHEN count > 1 THEN round(CASE WHEN mean > 0 THEN stdev / mean * 100 ELSE 0 END, 6) END AS coefficient_of_variation, "
    "CASE WHEN count > 1 THEN l[floor(count * 0.25::DOUBLE)::INT + 1] END AS percentile_25, CASE WHEN count > 1 THEN l[floor(count * 0.75::DOUBLE)::INT + 1] END AS percentile_75, "
    "CASE WHEN count > 1 THEN CASE WHEN count >= 20 THEN l[floor(count * 0.95::DOUBLE)::INT + 1] ELSE max END END AS percentile_95 FROM g"
)


@query(STATS)
def sample_stats(spark, sf_dir):
    s = stats.sample_stats(table(spark, sf_dir, "events"), ["event_type"], "value")
    return s.withColumns({c: F.round(c, 6) for c in ("mean", "median", "range", "stdev", "coefficient_of_variation")} | {"variance": F.round("variance", 4)})


def monitor_sql(c: str, v: str) -> str:
    return f"round(coalesce(avg({v}), 0), 6) AS {c}_mean, round(coalesce(median({v}), 0), 6) AS {c}_median, coalesce(max({v}), 0) AS {c}_max, coalesce(min({v}), 0) AS {c}_min, round(coalesce(stddev_samp({v}), 0), 6) AS {c}_stdev"


@query(f"WITH r AS (SELECT user_id % 5 AS run, CASE WHEN value - 20 > 0 THEN value - 20 END AS cpu, value AS memory FROM events) SELECT run, {monitor_sql('cpu', 'cpu')}, {monitor_sql('memory', 'memory')} FROM r GROUP BY run")
def monitor_stats(spark, sf_dir):
    r = stats.cpu_readings(table(spark, sf_dir, "events").select((F.col("user_id") % 5).alias("run"), (F.col("value") - 20).alias("cpu"), F.col("value").alias("memory")))
    out = r.groupBy("run").agg(*stats.monitor_stats("cpu"), *stats.monitor_stats("memory"))
    return out.withColumns({f"{a}_{b}": F.round(f"{a}_{b}", 6) for a in ("cpu", "memory") for b in ("mean", "median", "stdev")})


CONFIGS = "WITH c AS (SELECT o_custkey % 12 AS workers, avg(o_totalprice) / 1000 AS mean_time FROM orders GROUP BY 1), b AS (SELECT max(mean_time) AS baseline_time FROM c), s AS (SELECT workers, mean_time, baseline_time, baseline_time / mean_time AS speedup, (baseline_time - mean_time) / baseline_time * 100 AS percent_faster, baseline_time - mean_time AS time_saved FROM c, b)"


def configs(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 12).alias("workers")).agg((F.avg("o_totalprice") / 1000).alias("mean_time"))


@query(f"{CONFIGS} SELECT workers, round(speedup, 6) AS speedup, round(percent_faster, 6) AS percent_faster, round(time_saved, 6) AS time_saved, (row_number() OVER (ORDER BY speedup DESC, workers))::INT AS rank FROM s")
def speedup_vs_slowest(spark, sf_dir):
    s = stats.speedups(configs(spark, sf_dir), "workers", "mean_time")
    return s.select("workers", r6("speedup", "speedup"), r6("percent_faster", "percent_faster"), r6("time_saved", "time_saved"), "rank")


@query(f"{CONFIGS} SELECT round(max(speedup), 6) AS max_speedup, round(min(speedup), 6) AS min_speedup, round(avg(speedup), 6) AS avg_speedup, round(max(speedup) - min(speedup), 6) AS speedup_range, count(*) AS configs FROM s")
def speedup_summary(spark, sf_dir):
    s = stats.speedup_summary(stats.speedups(configs(spark, sf_dir), "workers", "mean_time"))
    return s.select(*[r6(c, c) for c in ("max_speedup", "min_speedup", "avg_speedup", "speedup_range")], "configs")


@query(f"{CONFIGS}, r AS (SELECT DISTINCT o_custkey % 15 AS workers FROM orders) SELECT r.workers, round(speedup, 6) AS speedup FROM r LEFT JOIN s USING (workers)")
def config_lookup(spark, sf_dir):
    reports = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 15).alias("workers")).distinct()
    s = stats.speedups(configs(spark, sf_dir), "workers", "mean_time").select("workers", "speedup")
    return stats.with_matching_config(reports, s, ("workers",)).select("workers", r6("speedup", "speedup"))


RATE = "WITH j AS (SELECT user_id % 20 AS job, count(*) AS files, sum(value) AS elapsed FROM events GROUP BY 1), f AS (SELECT job, files, CASE WHEN elapsed > 0 THEN files * 60.0::DOUBLE / elapsed END AS factor FROM j)"


@query(f"{RATE} SELECT job, files, round(factor, 6) AS factor, (row_number() OVER (ORDER BY factor DESC, job))::INT AS rank FROM f")
def realtime_rank(spark, sf_dir):
    from pyspark.sql import Window

    j = table(spark, sf_dir, "events").groupBy((F.col("user_id") % 20).alias("job")).agg(F.count(F.lit(1)).alias("files"), F.sum("value").alias("elapsed"))
    f = j.withColumn("factor", M.realtime_factor(F.col("files"), F.col("elapsed")))
    return f.select("job", "files", r6("factor", "factor"), F.row_number().over(Window.orderBy(F.desc("factor"), "job")).alias("rank"))


@query("WITH m AS (SELECT o_orderpriority, o_custkey % 8 AS workers, round(avg(o_totalprice), 2) AS throughput FROM orders GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY throughput DESC, workers) AS rn FROM m) SELECT o_orderpriority, workers AS best_workers, throughput AS best_throughput FROM r WHERE rn = 1")
def best_config(spark, sf_dir):
    m = table(spark, sf_dir, "orders").groupBy("o_orderpriority", (F.col("o_custkey") % 8).alias("workers")).agg(F.round(F.avg("o_totalprice"), 2).alias("throughput"))
    return stats.best_by(m, ["o_orderpriority"], "throughput", "workers")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'")
def successful_runs(spark, sf_dir):
    return stats.successful(table(spark, sf_dir, "orders").withColumn("returncode", F.when(F.col("o_orderstatus") == "F", 0).otherwise(1))).select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey, round((o_custkey % 8 + 1) * 3 / 120::DOUBLE * 100, 6) AS cpu_pct, greatest(1, floor(floor((o_custkey % 8 + 1) * 1024 / (160000 * 4 / 1048576.0::DOUBLE * 1.5 * 12)) * 0.8::DOUBLE))::BIGINT AS files_per_group FROM orders")
def resource_sizing(spark, sf_dir):
    w = F.col("o_custkey") % 8 + 1
    return table(spark, sf_dir, "orders").select("o_orderkey", r6(M.cpu_efficiency(w, F.lit(3), F.lit(120)), "cpu_pct"), M.group_size(w * 1024, F.lit(12)).cast("long").alias("files_per_group"))


def logs(spark, sf_dir) -> DataFrame:
    """A log for each customer, with a job for each order, in the launcher's format."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("log"))
    k = F.col("o_orderkey")
    t = F.concat(
        F.format_string("[%02d:00:00] Starting: site-%d\n│ Total Files         │ %,d files\n│ Batch Size          │ %d\n│ RAM Budget          │ %.1f GB\n", (k % 24).cast("int"), k, k * 7, (k % 4 + 1).cast("int"), (k % 9).cast("double")),
        F.format_string("║ Files Processed     │ %,d ║\n║ Total Running Time  │ %.1fs ║\n║ Throughput          │ %.2f files/sec ║\n", k * 7, (k % 1000).cast("double"), (k % 50).cast("double") + 0.25),
        F.when(k % 3 == 0, F.format_string("[%02d:30:00] FAILED: site-%d\n", (k % 24).cast("int"), k)).otherwise(F.format_string("Predictions size: %.1f MB\n[%02d:45:00] DONE: site-%d\n", (k % 77).cast("double"), (k % 24).cast("int"), k)),
    )
    return o.select("log", "o_orderkey", t.alias("t")).groupBy("log").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("o_orderkey", "t"))), lambda x: x["t"]), "").alias("value"))


JOBS = "WITH j AS (SELECT o_custkey::INT AS log, o_orderkey AS k, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1)::INT AS pos FROM orders)"


@query(f"{JOBS} SELECT log, 'site-' || k AS name, printf('%02d:00:00', k % 24) AS start_time, CASE WHEN k % 3 <> 0 THEN printf('%02d:45:00', k % 24) END AS end_time, (k * 7)::VARCHAR AS total_files, (k * 7)::VARCHAR AS files_processed, printf('%.1f', (k % 1000)::DOUBLE) AS running_time_s, printf('%.2f', (k % 50)::DOUBLE + 0.25) AS throughput_files_sec, (k % 4 + 1)::VARCHAR AS batch_size, printf('%.1f', (k % 9)::DOUBLE) AS ram_budget_gb, CASE WHEN k % 3 <> 0 THEN printf('%.1f', (k % 77)::DOUBLE) END AS predictions_mb FROM j")
def job_log_parse(spark, sf_dir):
    return joblog.parse(logs(spark, sf_dir), keys=("log",)).select(F.col("log").cast("int").alias("log"), "name", "start_time", "end_time", "total_files", "files_processed", "running_time_s", "throughput_files_sec", "batch_size", "ram_budget_gb", "predictions_mb")


@query(f"{JOBS}, f AS (SELECT log, min_by(k, pos) AS f FROM j GROUP BY 1) SELECT log, count(*) AS jobs, sum(k * 7)::BIGINT AS files, round(sum((k % 1000)::DOUBLE), 6) AS seconds, round(avg((k % 50)::DOUBLE + 0.25), 6) AS mean_throughput, min((k % 50)::DOUBLE + 0.25) AS min_throughput, max((k % 50)::DOUBLE + 0.25) AS max_throughput, round(sum((k % 77)::DOUBLE) FILTER (WHERE k % 3 <> 0) / 1024, 6) AS predictions_gb, (any_value(f) % 4 + 1)::VARCHAR AS batch_size FROM j JOIN f USING (log) GROUP BY log")
def job_log_summary(spark, sf_dir):
    s = joblog.summary(joblog.parse(logs(spark, sf_dir), keys=("log",)), ("log",))
    return s.select(F.col("log").cast("int").alias("log"), "jobs", "files", r6("seconds", "seconds"), r6("mean_throughput", "mean_throughput"), "min_throughput", "max_throughput", r6("predictions_gb", "predictions_gb"), "batch_size")


@query(f"{JOBS} SELECT 'site-' || k AS name, CASE WHEN k % 3 <> 0 THEN printf('%02d:45:00', k % 24) ELSE '' END AS end_time, '' AS embedding_format, (k * 7)::VARCHAR AS total_files FROM j")
def job_csv_columns(spark, sf_dir):
    return joblog.exported(joblog.parse(logs(spark, sf_dir), keys=("log",))).select("name", "end_time", "embedding_format", "total_files")


@query("WITH r AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) AS rn FROM lineitem) SELECT l_suppkey, floor((rn - 1) / 64)::BIGINT AS grp, count(*) AS n, min(l_orderkey) AS first FROM r GROUP BY 1, 2")
def batch_groups(spark, sf_dir):
    g = joins.numbered_groups(table(spark, sf_dir, "lineitem"), 64, "l_suppkey", ["l_orderkey", "l_linenumber", "l_partkey"])
    return g.groupBy("l_suppkey", "grp").agg(F.count(F.lit(1)).alias("n"), F.min("l_orderkey").alias("first"))


@query("SELECT user_id, event_id, rn::INT AS rn FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events) WHERE rn <= 3")
def first_k_per_partition(spark, sf_dir):
    return joins.first_files(table(spark, sf_dir, "events").select("user_id", "event_id"), 3, "user_id", "event_id")


SITES = "WITH e AS (SELECT event_id, CASE user_id % 4 WHEN 0 THEN 'A4' WHEN 1 THEN 'A4-2' WHEN 2 THEN 'A40' ELSE 'B1' END AS site FROM events)"


def by_site(spark, sf_dir):
    m = F.col("user_id") % 4
    return table(spark, sf_dir, "events").select("event_id", F.when(m == 0, "A4").when(m == 1, "A4-2").when(m == 2, "A40").otherwise("B1").alias("site"))


@query(f"{SITES} SELECT site, event_id FROM e WHERE site IN ('A4', 'A4-2')")
def union_sites(spark, sf_dir):
    return joins.related_sites(by_site(spark, sf_dir), "A4")


@query(f"{SITES} SELECT site, event_id FROM e WHERE site LIKE 'A4%'")
def union_sites_legacy(spark, sf_dir):
    return joins.related_sites(by_site(spark, sf_dir), "A4", legacy=True)


@query(f"{SITES} SELECT split_part(site, '-', 1) AS base, count(*) AS n FROM e GROUP BY 1")
def base_sites(spark, sf_dir):
    return by_site(spark, sf_dir).groupBy(P.base_site(F.col("site")).alias("base")).agg(F.count(F.lit(1)).alias("n"))


@query(f"{SITES}, a AS (SELECT event_id, site FROM e WHERE site = 'A4' UNION ALL SELECT event_id, site FROM e WHERE site = 'A40') SELECT site, count(*) AS n FROM a GROUP BY 1")
def union_files(spark, sf_dir):
    s = by_site(spark, sf_dir)
    return s.where("site = 'A4'").unionByName(s.where("site = 'A40'"), allowMissingColumns=True).groupBy("site").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey AS file_path FROM orders WHERE o_orderstatus = 'F' UNION SELECT l_orderkey FROM lineitem WHERE l_linenumber = 1")
def processed_union(spark, sf_dir):
    a = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("file_path"))
    return a.union(table(spark, sf_dir, "lineitem").where("l_linenumber = 1").select("l_orderkey")).distinct()


@query("SELECT coalesce(avg(ceil(len(embedding) / 10.0 / 5)), 12) AS mean_chunks, coalesce((SELECT avg(ceil(len(embedding) / 10.0 / 5)) FROM embeddings WHERE label < 0), 12)::DOUBLE AS default_chunks FROM embeddings")
def mean_chunks(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    d = M.mean_chunks(F.size("embedding") / 10.0)
    return e.agg(d.alias("mean_chunks")).crossJoin(e.where("label < 0").agg(d.alias("default_chunks")))


@query(f"WITH {V}, u AS (SELECT round(unnest(x) * 100) / 100 AS a FROM v) SELECT round(quantile_cont(a, 0.05), 6) AS low, round(quantile_cont(a, 0.99), 6) AS high FROM u")
def percentile_range(spark, sf_dir):
    from corvane.sources import audio

    return audio.clip_range(vectors(spark, sf_dir).select(F.col("x").alias("db"))).select(r6("low", "low"), r6("high", "high"))


@query(f"WITH {V}, u AS (SELECT vec_id, unnest(range(len(x)))::INT AS frame FROM v) SELECT vec_id, frame, round(frame * 512 / 32000.0::DOUBLE, 6) AS seconds, greatest(16.0, least(30.0, frame / 3.0::DOUBLE)) AS width FROM u WHERE frame * 32000 / 64.0 <= 12000")
def frame_axis(spark, sf_dir):
    f = vectors(spark, sf_dir).select("vec_id", F.explode(F.sequence(F.lit(0), F.size("x") - 1)).alias("frame")).where(F.col("frame") * 32000 / 64.0 <= 12000)
    return f.select("vec_id", "frame", r6(M.frame_seconds(F.col("frame")), "seconds"), A.bar_width(F.col("frame")).alias("width"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem WHERE ('rec_' || l_orderkey) LIKE 'rec_12%' GROUP BY 1, 2")
def file_match(spark, sf_dir):
    c = chunk_rows(spark, sf_dir).withColumn("file", P.chunk_key(F.col("file_path"), F.col("chunk_idx")))
    hit = c.where(P.file_matches(F.col("file"), F.col("file_path"), "rec_12"))
    return hit.groupBy("l_orderkey", F.col("chunk_idx").alias("l_linenumber")).agg(F.count(F.lit(1)).alias("n"))


@query(f"{PTS} SELECT vec_id, round(3 * abs(z) + pow(abs(x) / (0.3 * 2.0), 1.5), 6) AS score, x BETWEEN -0.1 AND 0.1 AND y BETWEEN -0.1 AND 0.1 AS visible FROM p")
def label_scores(spark, sf_dir):
    x, y, z = F.col("x"), F.col("y"), F.col("z")
    return points(spark, sf_dir).select("vec_id", r6(A.radial_score(F.abs(z), F.abs(x), F.lit(2.0)), "score"), A.in_view(x, y, (-0.1, -0.1), (0.1, 0.1)).alias("visible"))


@query("SELECT p_partkey, replace(replace(p_name, ' ', '_'), '_', ' ') AS name FROM part")
def display_names(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", A.display_name(F.replace("p_name", F.lit(" "), F.lit("_"))).alias("name"))


def generated(spark: SparkSession, seconds: tuple = (12.0, 5.0, 0.0, 3.3, 7.5, 0.0), broken: bool = True) -> DataFrame:
    """Recordings made in memory: tones of several lengths, rates and channels, silence, an empty one and broken bytes."""
    from corvane.functions import signal

    rows = []
    for i, s in enumerate(seconds):
        rate = (32_000, 32_000, 32_000, 44_100, 16_000, 48_000)[i % 6]
        t = np.arange(int(s * rate)) / rate
        x = np.stack([np.sin(2 * np.pi * (400 + 100 * i) * t) * 0.5, np.sin(2 * np.pi * 900 * t) * 0.25], axis=1)
        rows.append((f"/data/A4/2025010{i + 1}_053015.WAV", signal.encode_wav(x if i % 2 else x[:, 0], rate)))
    rows.append(("/data/A4/20250109_000000.wav", signal.encode_wav(np.zeros(32_000), 32_000)))
    if broken:
        rows.append(("/data/A4/20250110_000000.wav", b"not a recording"))
    return spark.createDataFrame([(p, bytearray(b)) for p, b in rows], "path string, content binary").repartition(4, "path")


def damaged(spark: SparkSession) -> DataFrame:
    """Files that can't be decoded, each for another reason, and one that can."""
    from corvane.functions import signal

    good = signal.encode_wav(np.zeros(3200), 32_000)
    bent = {
        "0_good": good, "1_text": b"not a recording", "2_short_format": good[:26], "3_no_samples": good[:36], "4_no_channels": good[:22] + b"\0\0" + good[24:], "5_no_rate": good[:24] + b"\0\0\0\0" + good[28:],
        "6_no_bits": good[:34] + b"\0\0" + good[36:], "7_other_format": good[:20] + b"\7\0" + good[22:], "8_empty": b"", "9_odd_bits": good[:34] + b"\14\0" + good[36:],
    }
    return spark.createDataFrame([(f"/data/A4/{name}.wav", bytearray(b)) for name, b in bent.items()], "path string, content binary").repartition(4, "path")


#: The generated recordings that can be decoded, as SQL: path, seconds, channels, rate.
RECORDED = (
    "rec(path, seconds, channels, rate) AS (VALUES ('/data/A4/20250101_053015.WAV', 12.0, 1, 32000), ('/data/A4/20250102_053015.WAV', 5.0, 2, 32000), ('/data/A4/20250103_053015.WAV', 0.0, 1, 32000), "
    "('/data/A4/20250104_053015.WAV', 3.3, 2, 44100), ('/data/A4/20250105_053015.WAV', 7.5, 1, 16000), ('/data/A4/20250106_053015.WAV', 0.0, 2, 48000), ('/data/A4/20250109_000000.wav', 1.0, 1, 32000))"
)
CHUNKED = f"WITH {RECORDED}, c AS (SELECT path, seconds, unnest(range(ceil(seconds / 5)::INT))::INT AS i FROM rec), ch AS (SELECT path AS file_path, i AS chunk_idx, i * 5.0::DOUBLE AS start_time, least((i + 1) * 5.0, seconds)::DOUBLE AS end_time FROM c)"
STEM = "regexp_extract(file_path, '([^/]+)[.][^.]+$', 1) || '_' || chunk_idx"


@query(f"{CHUNKED} SELECT file_path, chunk_idx, round((end_time - start_time) * 32000)::INT AS n, start_time, end_time FROM ch")
def wav_decode_chunks(spark, sf_dir):
    from corvane.sources import audio

    return audio.chunks(generated(spark)).select("file_path", "chunk_idx", F.size("samples").alias("n"), "start_time", "end_time")


@query(f"WITH {RECORDED} SELECT path, channels::INT AS channels, rate::BIGINT AS rate, 16::INT AS bits, seconds::DOUBLE AS duration FROM rec UNION ALL SELECT '/data/A4/20250110_000000.wav', NULL, NULL, NULL, NULL")
def wav_headers(spark, sf_dir):
    from corvane.sources import audio

    return audio.headers(generated(spark))


@query(
    "SELECT '/data/A4/' || name || '.wav' AS file_path, reason FROM (VALUES ('1_text', 'not a RIFF WAVE file'), ('2_short_format', 'a format chunk that is too short'), ('3_no_samples', 'no format or no samples'), "
    "('4_no_channels', 'no channels, no rate or no bits'), ('5_no_rate', 'no channels, no rate or no bits'), ('6_no_bits', 'no channels, no rate or no bits'), ('7_other_format', 'format 7 with 16 bits'), ('8_empty', 'not a RIFF WAVE file'), "
    "('9_odd_bits', 'format 1 with 12 bits')) AS t(name, reason)"
)
def decode_faults(spark, sf_dir):
    from corvane.sources import audio

    return audio.faults(damaged(spark))


@query(
    "WITH rec(file_path, samples, hz) AS (VALUES ('/data/A4/20250101_053015.WAV', 32000, 400), ('/data/A4/20250102_053015.WAV', 64000, 500), ('/data/A4/20250109_000000.wav', 32000, 0)), "
    "f AS (SELECT *, unnest(range(1 + samples // 512))::INT AS frame FROM rec) SELECT file_path, 0::INT AS chunk_idx, frame, round(frame * 512 / 32000.0::DOUBLE, 6) AS seconds, 769::INT AS bins, "
    "CASE WHEN frame BETWEEN 2 AND samples // 512 - 2 THEN round(hz * 2048 / 32000.0)::BIGINT END AS peak FROM f"
)
def stft_db(spark, sf_dir):
    """The bin of the loudest tone of each frame that lies inside its recording; silence has none but the first."""
    from corvane.sources import audio

    found = audio.spectrogram(audio.chunks(generated(spark, (1.0, 2.0))))
    inside = F.col("frame").between(2, F.max("frame").over(Window.partitionBy("file_path", "chunk_idx")) - 2)
    peak = F.when(inside, F.array_position("db", F.array_max("db")) - 1)
    return found.select("file_path", "chunk_idx", "frame", r6("seconds", "seconds"), F.size("db").alias("bins"), peak.alias("peak"))


@query(f"{CHUNKED} SELECT {STEM} AS file, file_path, chunk_idx, 64::INT AS dims, 10::INT AS k, true AS falling, NULL::VARCHAR AS reason FROM ch UNION ALL SELECT NULL, '/data/A4/20250110_000000.wav', NULL, NULL, NULL, NULL, 'not a RIFF WAVE file'")
def model_map(spark, sf_dir):
    from corvane.plans import models

    rows = models.infer(generated(spark), models.StandIn, [f"species_{i}" for i in range(200)], key="stand-in")
    scores = F.transform("topk", lambda t: t["score"])
    ranks = F.transform("topk", lambda t: t["rank"])
    falling = (scores == F.reverse(F.array_sort(scores))) & (ranks == F.sequence(F.lit(1), F.lit(10)))
    size = lambda c: F.when(F.col(c).isNotNull(), F.size(c))
    return rows.select("file", "file_path", "chunk_idx", size("embedding").alias("dims"), size("topk").alias("k"), falling.alias("falling"), "reason")


@query()
def pca_2d(spark, sf_dir):
    return E.pca(vectors(spark, sf_dir), "x", 2).select("vec_id", r6("pc1", "pc1"), r6("pc2", "pc2"))


def taken_in(spark: SparkSession) -> str:
    """A folder to which two calls have taken in generated recordings; the second found nothing new. Their names are those of the fixed model."""
    from corvane.plans import models
    from corvane.sources.files import shared_folder, write_file
    from corvane.streaming.ingest import ingest

    base = shared_folder(spark, "ingest")
    for r in generated(spark, (6.0, 3.0)).collect():
        write_file(f"{base}/in/{r['path'].rsplit('/', 1)[-1]}", bytes(r["content"]))
    for _ in range(2):
        ingest(spark, f"{base}/in", f"{base}/out", models.Fixed, ["owl", "wren", "jay"], k=2, files_each=2)
    return f"{base}/out"


#: What is taken in: name, chunk, start and end; 20250109 is silence.
TAKEN = "t(stem, chunk_idx, start_time, end_time) AS (VALUES ('20250101_053015', 0, 0.0, 5.0), ('20250101_053015', 1, 5.0, 6.0), ('20250102_053015', 0, 0.0, 3.0), ('20250109_000000', 0, 0.0, 1.0))"


@query(f"WITH {TAKEN} SELECT stem || '_' || chunk_idx AS file, chunk_idx::INT AS chunk_idx, start_time::DOUBLE AS start_time, end_time::DOUBLE AS end_time, 2::INT AS k FROM t")
def incremental_ingest(spark, sf_dir):
    """Two calls over one folder; the second finds nothing new."""
    return spark.read.parquet(f"{taken_in(spark)}/predictions").select("file", "chunk_idx", "start_time", "end_time", F.size("topk").alias("k"))


@query(
    f"WITH {TAKEN}, d AS (SELECT strptime(left(stem, 8), '%Y%m%d')::DATE AS date, CASE WHEN stem LIKE '20250109%' THEN 'jay' ELSE 'owl' END AS first FROM t), own AS (SELECT date, first AS species, count(*) AS n FROM d GROUP BY 1, 2 UNION ALL "
    "SELECT date, 'wren', count(*) FROM d GROUP BY 1), days AS (SELECT unnest(generate_series(DATE '2025-01-01', DATE '2025-01-09', INTERVAL 1 DAY))::DATE AS date), "
    "g AS (SELECT days.date, s.species, coalesce(own.n, 0)::BIGINT AS n FROM days CROSS JOIN (SELECT DISTINCT species FROM own) s LEFT JOIN own ON own.date = days.date AND own.species = s.species) "
    "SELECT date, species, n, round(avg(n::DOUBLE) OVER (PARTITION BY species ORDER BY date ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING), 6) AS smooth FROM g"
)
def ingest_to_timeseries(spark, sf_dir):
    """From recordings to a daily series: decoded, run through a model with fixed answers, kept, dated, counted and smoothed."""
    return timeseries.from_ingested(spark.read.parquet(f"{taken_in(spark)}/predictions"), threshold=0.0, n=3).withColumn("smooth", F.round("smooth", 6))


@query(f"WITH {TAKEN} SELECT stem || '_' || chunk_idx AS file, chunk_idx::INT AS chunk_idx, CASE WHEN stem LIKE '20250109%' THEN 'jay' ELSE 'owl' END AS top1, 'wren' AS top2, 2.0::DOUBLE AS score1, 1.0::DOUBLE AS score2 FROM t")
def ingest_to_csv(spark, sf_dir):
    """The same kept predictions, written as wide CSV files by checkpoint and read again."""
    from corvane.sources import tables

    out = taken_in(spark)
    tables.export_predictions(spark, out, f"{out}/csv", k=2)
    return tables.predictions(spark, f"{out}/csv/*/*.csv", k=2).select("file", "chunk_idx", "top1", "top2", "score1", "score2")


def kept(spark: SparkSession, files: dict[str, bytes]) -> str:
    """A new shared folder with these files."""
    from corvane.sources.files import shared_folder, write_file

    base = shared_folder(spark, "files")
    for name, data in files.items():
        write_file(f"{base}/{name}", data)
    return base


def last_name(c):
    return F.element_at(F.split(c, "/"), -1)


@query("SELECT * FROM (VALUES ('a.wav', 3::BIGINT), ('b.WAV', 5::BIGINT)) AS t(name, length)")
def listing_files(spark, sf_dir):
    """Both cases of a pattern, nothing between them, one folder deep."""
    from corvane.sources import tables

    base = kept(spark, {"a.wav": b"123", "b.WAV": b"12345", "c.Wav": b"1", "d.txt": b"1", "e/f.wav": b"1"})
    return tables.listing(spark, base).select(last_name(F.col("path")).alias("name"), "length")


@query("SELECT 'a.WAV' AS name UNION ALL SELECT 'b.wav'")
def listing_first(spark, sf_dir):
    """The first files by path, of a pattern given in one case."""
    from corvane.sources import tables

    base = kept(spark, {"c.wav": b"1", "b.wav": b"1", "a.WAV": b"1"})
    return tables.listing(spark, base, tables.either_case("*.wav"), limit=2).select(last_name(F.col("path")).alias("name"))


@query("SELECT 2::BIGINT AS files, 11::BIGINT AS bytes")
def output_size(spark, sf_dir):
    from corvane.sources import tables

    return tables.output_size(spark, kept(spark, {"0/p.parquet": b"12345", "1/p.parquet": b"123456", "1/q.csv": b"1"}), "*.parquet")


@query("SELECT * FROM (VALUES ('class', 0::INT, 'owl, barred'), ('class', 1::INT, 'wren'), ('done', NULL, '/a.wav'), ('done', NULL, '/b.wav'), ('model', 1536::INT, 'x')) AS t(kind, idx, name)")
def json_scans(spark, sf_dir):
    """Class names by place, the files of a checkpoint once each, a model's description."""
    from corvane.sources import tables

    base = kept(spark, {"classes.json": b'["owl, barred",\n "wren"]', "c.json": b'{"processed_files": ["/a.wav", "/b.wav", "/a.wav"],\n "checkpoint_id": 2}', "m.json": b'{"version": 2, "system": "x",\n "embedding_size": 1536}'})
    classes = tables.class_names(spark, f"{base}/classes.json").select(F.lit("class").alias("kind"), F.col("idx").cast("int"), F.col("species").alias("name"))
    done = tables.checkpoint(spark, f"{base}/c.json").select(F.lit("done").alias("kind"), F.lit(None).cast("int").alias("idx"), F.col("file_path").alias("name"))
    model = tables.model_metadata(spark, f"{base}/m.json").select(F.lit("model").alias("kind"), F.col("embedding_size").alias("idx"), F.col("system").alias("name"))
    return classes.unionAll(done).unionAll(model)


CSV_HEAD = b"file,file_path,chunk_idx,start_time,end_time,checkpoint_id,top1,top2,score1,score2\n"


@query("SELECT * FROM (VALUES ('a_0', 0::INT, 'owl, barred', NULL, 1.5::DOUBLE, 0.5::DOUBLE), ('a_1', 0::INT, 'wren', 'jay', 2.5::DOUBLE, 0.25::DOUBLE), ('b_0', 1::INT, 'jay', NULL, 3.0::DOUBLE, NULL)) AS t(file, checkpoint_id, top1, top2, score1, score2)")
def csv_scan(spark, sf_dir):
    """Several files with headers; quoted names, and names that mean none."""
    from corvane.sources import tables

    one = CSV_HEAD + b'a_0,/a.wav,0,0.0,5.0,0,"owl, barred",NA,1.5,0.5\na_1,/a.wav,1,5.0,10.0,0,wren,jay,2.5,0.25\n'
    base = kept(spark, {"checkpoint_0000.csv": one, "checkpoint_0001.csv": CSV_HEAD + b"b_0,/b.wav,0,0.0,5.0,1,jay,nan,3.0,\n", "other.txt": b"x"})
    return tables.predictions(spark, f"{base}/checkpoint_*.csv", k=2).select("file", "checkpoint_id", "top1", "top2", "score1", "score2")


@query("SELECT * FROM (VALUES ('A4', 'a_0', 'owl'), ('A4-2', 'b_0', 'wren'), ('A4-10', 'c_0', 'jay')) AS t(site, file, top1)")
def deployments(spark, sf_dir):
    """The predictions of all deployments of a site, found from one of them."""
    from corvane.sources import tables

    row = lambda f, s: CSV_HEAD + f"{f}_0,/{f}.wav,0,0.0,5.0,0,{s},,1.5,\n".encode()
    base = kept(spark, {f"{site}/{tables.PARTITIONED}/checkpoint_0000.csv": row(f, s) for site, f, s in (("A4", "a", "owl"), ("A4-2", "b", "wren"), ("A4-10", "c", "jay"), ("A40", "d", "tit"), ("B1", "e", "tit"))})
    return tables.site_predictions(spark, f"{base}/A4-2/{tables.PARTITIONED}", k=2).select("site", "file", "top1")


@query("SELECT site, count(*) AS n FROM (SELECT 'S' || o_custkey % 7 AS site FROM orders) GROUP BY 1")
def site_column(spark, sf_dir):
    from corvane.sources import tables

    paths = table(spark, sf_dir, "orders").select(F.concat(F.lit("/data/S"), F.col("o_custkey") % 7, F.lit("/"), F.col("o_orderkey"), F.lit(".wav")).alias("path"))
    return tables.sites(paths).groupBy("site").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT * FROM (VALUES ('A4', '01:00:00', '02:30:00', '1200'), ('B1', '03:00:00', NULL, NULL)) AS t(name, start_time, end_time, total_files)")
def log_scan(spark, sf_dir):
    """A log as one text, with bytes that aren't UTF-8."""
    from corvane.sources import tables

    log = "[01:00:00] Starting: A4\n│ Total Files │ 1,200\n".encode() + b"\xff\xfe\n" + b"[02:30:00] DONE: A4\n[03:00:00] Starting: B1\n"
    return joblog.parse(tables.job_log(spark, f"{kept(spark, {'log.txt': log})}/log.txt")).select("name", "start_time", "end_time", "total_files")


@query("SELECT vec_id::VARCHAR AS file, (label % 3)::INT AS checkpoint_id, embedding[1]::FLOAT AS emb_0, embedding[8]::FLOAT AS emb_7 FROM embeddings")
def embeddings_wide(spark, sf_dir):
    """Embeddings written as wide Parquet by checkpoint, and read again."""
    from corvane.sources import tables

    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("file"), F.col("embedding").cast("array<float>").alias("embedding"), (F.col("label") % 3).cast("int").alias("checkpoint_id"))
    path = f"{kept(spark, {})}/wide"
    tables.write_embeddings(rows, path, wide=8)
    return spark.read.parquet(path).select("file", F.col("checkpoint_id").cast("int"), "emb_0", "emb_7")


@query("SELECT vec_id::VARCHAR AS file, (label % 3)::INT AS checkpoint_id, len(embedding)::INT AS dims, round(embedding[1]::FLOAT::DOUBLE, 6) AS first FROM embeddings")
def legacy_scan(spark, sf_dir):
    """Wide embeddings in plain numbered folders, as arrays; a file that can't be read is left out."""
    from corvane.sources import tables
    from corvane.sources.files import write_file

    path = kept(spark, {})
    e = table(spark, sf_dir, "embeddings")
    dims = e.select(F.max(F.size("embedding"))).first()[0]
    rows = e.select(F.col("vec_id").cast("string").alias("file"), (F.col("label") % 3).cast("int").alias("c"), *A.to_wide(F.col("embedding").cast("array<float>"), dims))
    for c in range(3):
        rows.where(F.col("c") == c).drop("c").write.parquet(f"{path}/{c}")
    write_file(f"{path}/1/broken.parquet", b"PAR1 but no more")
    return tables.legacy_embeddings(spark, path).select("file", "checkpoint_id", F.size("embedding").alias("dims"), F.round(F.get("embedding", F.lit(0)).cast("double"), 6).alias("first"))


WIDE5 = ", ".join(f"max(CASE WHEN rank = {i} THEN 'species_' || idx END) AS top{i}" for i in range(1, 6)) + ", " + ", ".join(f"round(max(CASE WHEN rank = {i} THEN score END), 6) AS score{i}" for i in range(1, 6))


@query(f"{LONG} SELECT vec_id::VARCHAR AS file, {WIDE5} FROM k GROUP BY vec_id")
def csv_round_trip(spark, sf_dir):
    """The five best of each row as wide CSV, and read again."""
    from corvane.sources import tables

    wide = topk.topk_wide(vectors(spark, sf_dir), "x", ["vec_id"], NAMES, 5).withColumnRenamed("vec_id", "file")
    names = ["file", *(f"top{i}" for i in range(1, 6)), *(f"score{i}" for i in range(1, 6))]
    path = f"{kept(spark, {})}/csv"
    tables.write_predictions(wide.select(*names), path)
    read = spark.read.schema(", ".join(f"{n} {'double' if n.startswith('score') else 'string'}" for n in names)).option("header", True).csv(path)
    return tables.null_names(read).select("file", *names[1:6], *[r6(n, n) for n in names[6:]])


@query("SELECT rate::INT AS rate, 16000::INT AS n, true AS close FROM (VALUES (8000), (16000), (22050), (32000), (44100), (48000), (96000)) AS t(rate)")
def resampled_tone(spark, sf_dir):
    """Half a second of a tone at several rates, brought to 32 kHz: as many samples, and within a hundredth of the tone itself but at the ends."""
    from corvane.functions import signal

    def close(batches):
        import pyarrow as pa

        for b in batches:
            rows = []
            for rate in b.column(0).to_pylist():
                y = signal.load(signal.encode_wav(np.sin(2 * np.pi * 1000 * np.arange(rate // 2) / rate) * 0.5, rate))
                want = np.sin(2 * np.pi * 1000 * np.arange(len(y)) / 32_000) * 0.5
                rows.append((rate, len(y), bool(np.abs(y - want)[800:-800].max() < 0.01)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.bool_()), strict=True)], ["rate", "n", "close"])

    return spark.createDataFrame([(r,) for r in (8000, 16_000, 22_050, 32_000, 44_100, 48_000, 96_000)], "rate int").mapInArrow(close, "rate int, n int, close boolean")


RAN = "r(workers, batch_size, i, ok, elapsed, files) AS (VALUES (2, 4, 0, true, 40.0, 100), (2, 4, 1, true, 50.0, 100), (8, 4, 0, true, 20.0, 100), (8, 4, 1, false, NULL, 0), (8, 8, 0, false, NULL, 0), (32, 4, 0, true, 10.0, 100), (32, 4, 1, true, 12.5, 100))"


@query(
    f"WITH {RAN}, m AS (SELECT workers, batch_size, avg(files / elapsed::DOUBLE) AS rate, avg(elapsed)::DOUBLE AS mean_time, count(*)::INT AS good FROM r WHERE ok GROUP BY 1, 2), n AS (SELECT workers, batch_size, count(*)::INT AS asked FROM r GROUP BY 1, 2) "
    "SELECT workers::INT AS workers, batch_size::INT AS batch_size, round(rate, 6) AS mean_throughput, round(rate * 60, 6) AS speedup_factor, round(mean_time, 6) AS mean_time, good AS iterations_successful, asked AS iterations_requested, "
    "row_number() OVER (ORDER BY rate DESC)::INT AS rank FROM m JOIN n USING (workers, batch_size)"
)
def report_round_trip(spark, sf_dir):
    """Runs to a report, the report read again and analysed; a configuration without a run that succeeded isn't in it."""
    import json

    from corvane.plans import benchmark
    from corvane.sources import tables

    ran = [(2, 4, 0, 0, 40.0, 100), (2, 4, 1, 0, 50.0, 100), (8, 4, 0, 0, 20.0, 100), (8, 4, 1, 1, None, 0), (8, 8, 0, 1, None, 0), (32, 4, 0, 0, 10.0, 100), (32, 4, 1, 0, 12.5, 100)]
    runs = [(json.dumps({"workers": w, "batch_size": b}, sort_keys=True), i, code, t, n, 90.0, 500.0, [90.0], [500.0]) for w, b, i, code, t, n in ran]
    path = f"{kept(spark, {})}/report"
    benchmark.write_report(spark.createDataFrame(runs, benchmark.RUNS), path)
    found = benchmark.analysis(tables.benchmark_report(spark, path))
    return found.select("workers", "batch_size", *[r6(c, c) for c in ("mean_throughput", "speedup_factor", "mean_time")], "iterations_successful", "iterations_requested", "rank")


@query("SELECT x::DOUBLE / 4 AS x, y::DOUBLE / 4 AS y, round(least(greatest(x / 4.0, 0), 3) * 3 + least(greatest(y / 4.0, 0), 2) * 2 + 1, 6)::DOUBLE AS value FROM range(-4, 17) a(x), range(-4, 13) b(y)")
def bilinear_samples(spark, sf_dir):
    """A plane on a grid of 4 by 3, sampled between its cells and beyond its edges."""
    from corvane.plans import maps

    grid = np.array([[3.0 * i + 2.0 * j + 1 for i in range(4)] for j in range(3)])
    xs, ys = (a.ravel() for a in np.meshgrid(np.arange(-4, 17) / 4, np.arange(-4, 13) / 4))
    return spark.createDataFrame([tuple(map(float, r)) for r in zip(xs, ys, np.round(maps.bilinear(grid, xs, ys), 6), strict=True)], "x double, y double, value double")


@query("SELECT i::INT AS cell, CASE WHEN h BETWEEN 5 AND 8 OR h >= 22 OR h <= 1 THEN 1.0 ELSE 0.15 END::DOUBLE AS alpha, NOT (h BETWEEN 5 AND 8 OR h >= 22 OR h <= 1) AS grey FROM (SELECT i, 24.0::DOUBLE * i / 287 AS h FROM range(288) t(i))")
def day_ramp(spark, sf_dir):
    """The colours of a day with a morning window and an evening one over midnight: where they are opaque and where grey."""
    from corvane.plans import maps

    c = maps.day_colours([("morning", 5.0, 8.0), ("evening", 22.0, 1.0)])
    return spark.createDataFrame([(i, float(a), bool((rgb == maps.GAP).all())) for i, (a, rgb) in enumerate(zip(c[:, 3], c[:, :3], strict=True))], "cell int, alpha double, grey boolean")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN strptime('20250' || (1 + o_orderkey % 9) || '15_0' || (o_orderkey % 10) || '3000', '%Y%m%d_%H%M%S') END AS ts FROM orders WHERE o_orderkey % 3 < 2")
def key_dates(spark, sf_dir):
    """The time that a chunk's key gives by its first two parts; null if they give none."""
    o = table(spark, sf_dir, "orders").where("o_orderkey % 3 < 2")
    good = F.concat(F.lit("20250"), 1 + F.col("o_orderkey") % 9, F.lit("15_0"), F.col("o_orderkey") % 10, F.lit("3000_7"))
    return o.select("o_orderkey", P.key_timestamp(F.when(F.col("o_orderkey") % 3 == 0, good).otherwise(F.concat(F.lit("rec_"), F.col("o_orderkey")))).alias("ts"))


@query(
    f"WITH {V}, c AS (SELECT label, count(*) AS n FROM v WHERE label % 5 <> 0 GROUP BY 1), top AS (SELECT label, row_number() OVER (ORDER BY n DESC, 'c' || label) AS rn FROM c) "
    "SELECT vec_id::VARCHAR AS file, CASE WHEN v.label % 5 <> 0 THEN 'c' || v.label END AS predicted_class, (CASE WHEN rn <= 4 THEN rn ELSE 0 END)::INT AS class_index FROM v LEFT JOIN top ON top.label = v.label"
)
def class_map_rows(spark, sf_dir):
    """The projected map's rows, written and read again: each embedding with its class and the class's place by frequency."""
    from corvane.plans import maps

    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("file"), F.col("vec_id").cast("string").alias("file_path"), F.lit(0).alias("chunk_idx"), F.lit(0.0).alias("start_time"), F.lit(5.0).alias("end_time"), "embedding", "label")
    p = e.where("label % 5 <> 0").select("file_path", "chunk_idx", F.concat(F.lit("c"), F.col("label")).alias("top1"))
    path = f"{kept(spark, {})}/map"
    maps.write_map(maps.class_map(e.drop("label"), p, n=4), path)
    return spark.read.parquet(path).where("umap_x IS NOT NULL AND umap_y IS NOT NULL").select("file", "predicted_class", "class_index")


@query("SELECT '/data/A4/' || name || '.wav' AS file_path, 0::INT AS chunk_idx, n::INT AS n, e::DOUBLE AS end_time, true AS silent FROM (VALUES ('0_good', 3200, 0.1), ('1_text', 160000, 5), ('2_short_format', 160000, 5), ('3_no_samples', 160000, 5), ('4_no_channels', 160000, 5), ('5_no_rate', 160000, 5), ('6_no_bits', 160000, 5), ('7_other_format', 160000, 5), ('8_empty', 160000, 5), ('9_odd_bits', 160000, 5)) AS t(name, n, e)")
def silent_faults(spark, sf_dir):
    """The other way with files that can't be decoded: a chunk of silence for each."""
    from corvane.sources import audio

    found = audio.chunks(damaged(spark), silent=True)
    return found.select("file_path", "chunk_idx", F.size("samples").alias("n"), "end_time", (F.array_max("samples") == 0).alias("silent"))


@query("SELECT vec_id::VARCHAR AS file, embedding[2]::FLOAT AS emb_1 FROM embeddings")
def embeddings_plain(spark, sf_dir):
    """Wide embeddings as one table, without checkpoints."""
    from corvane.sources import tables

    path = f"{kept(spark, {})}/plain"
    tables.write_embeddings(table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("file"), F.col("embedding").cast("array<float>").alias("embedding")), path, wide=2)
    return spark.read.parquet(path).select("file", "emb_1")
