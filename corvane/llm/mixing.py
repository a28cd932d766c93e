"""Mixing sources to target weights: tokens are summed by source and hash bucket, nested thresholds are read off
the histogram, only the bucket that holds a threshold is refined, and documents are filtered without a sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, scratch, staged

#: Hexadecimal digits of a document's hash that one level of the histogram reads, and levels.
DIGITS, LEVELS = 3, 5
#: Sources whose table is sent to all tasks.
MOST_SENT = 100_000


def water_fill(sizes: Sequence[int], weights: Sequence[float], total: float, cap: float) -> list[float]:
    """Shares of `total` by weight, none above cap times its size, the excess going to the others by weight."""
    caps = [cap * s for s in sizes]
    order = sorted(range(len(sizes)), key=lambda i: (caps[i] / weights[i], i))
    out, spent, weight = [0.0] * len(sizes), 0.0, float(sum(weights))
    level = None
    for i in order:
        if level is None and (total - spent) / weight <= caps[i] / weights[i]:
            level = (total - spent) / weight
        out[i] = caps[i] if level is None else level * weights[i]
        spent += caps[i]
        weight -= weights[i]
    return out


def _hash():
    return F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit("")).cast("binary")), 1, DIGITS * LEVELS)


def mix_sources(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), epochs: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row for each row of docs (doc_id, text, source): doc_id, size, source_size, target, copies, taken.

    Sources by code point, null last, get `weights` in turn; together they get `epochs` times all words, none more than
    `cap` times its own. A source takes every document floor(target / size) times, and once more those whose hash lies
    below the source's threshold: the most that fit in what remains of its target.

    A null text has size 0. A null doc_id is hashed by its text. Rows of one doc_id share a hash and are taken together.
    A null source is a source of its own. No documents give no rows. The driver plans with a row for each source. Extra columns are
    ignored, whatever their names.
    Sizes and hashes are staged once; each level is a sum by (source, next digits), partly summed before its shuffle."""
    rows, final = _thresholds(docs, weights, epochs, cap)
    out = rows.join(final, rows["source"].eqNullSafe(final["src"]))
    copies = F.col("full") + F.when(F.col("h") < F.col("threshold"), 1).otherwise(0)
    return out.select("doc_id", "size", "source_size", "target", copies.cast("long").alias("copies"), (copies * F.col("size")).cast("long").alias("taken"))


def mixed(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), epochs: float = 1.5, cap: float = 2.0) -> DataFrame:
    """The rows of docs, with all their columns, as often as mix_sources takes them. Documents of size 0 count as the others."""
    _, final = _thresholds(docs, weights, epochs, cap)
    final = final.select(F.col("src").alias("_mixing_src"), F.struct("full", "threshold").alias("_mixing_plan"))
    out = docs.withColumn("_mixing_hash", _hash()).join(final, docs["source"].eqNullSafe(final["_mixing_src"]))
    copies = F.col("_mixing_plan.full") + F.when(F.col("_mixing_hash") < F.col("_mixing_plan.threshold"), 1).otherwise(0)
    return out.select(*docs.columns, F.explode(F.array_repeat(F.lit(0), copies.cast("int"))).alias("_mixing_copy")).select(*docs.columns)


def _sent(table: DataFrame, n: int) -> DataFrame:
    """A table with a row for each of n sources: sent to all tasks while these are MOST_SENT at most, else joined by sort-merge."""
    return F.broadcast(table) if n <= MOST_SENT else table.hint("merge")


def _thresholds(docs: DataFrame, weights: Sequence[float], epochs: float, cap: float) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, size, h) of docs, staged, and a row for each source: src, source_size, target, full, threshold."""
    spark = docs.sparkSession
    at = scratch(spark, "mixing")
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)).cast("long"), F.lit(0).cast("long"))
    rows = staged(docs.select("doc_id", "source", size.alias("size"), _hash().alias("h")), f"{at}/sizes")
    totals = rows.groupBy("source").agg(F.sum("size").alias("s")).collect()
    totals.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-32-be")))
    sizes = [int(r["s"]) for r in totals]
    goals = water_fill(sizes, [float(weights[i % len(weights)]) for i in range(len(sizes))], epochs * sum(sizes), cap) if sizes else []
    plan = []
    for r, s, goal in zip(totals, sizes, goals, strict=True):
        full = int(goal // s) if s else 0
        plan.append((r["source"], s, float(goal), full, float(goal - full * s), ""))
    columns = "source string, source_size long, target double, full int, room double, prefix string"
    table = spark.createDataFrame(plan, columns)
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    left = rows
    for level in range(LEVELS):
        t = _sent(table, len(plan))
        if level == 1:
            # Only the boundary buckets of the first level are refined, about one row in 16 ** DIGITS.
            left = staged(left.join(t, same(left, t) & left["h"].startswith(t["prefix"]) & (F.length(t["prefix"]) == DIGITS)).select(left["source"], left["size"], left["h"]), f"{at}/boundary")
        within = left.join(t, same(left, t) & left["h"].startswith(t["prefix"])).select(t["source"], "prefix", "room", F.substring("h", 1 + level * DIGITS, DIGITS).alias("b"), "size")
        hist = within.groupBy("source", "prefix", "room", "b").agg(F.sum("size").alias("n"))
        upto = Window.partitionBy("source").orderBy("b")
        cum = hist.withColumn("upto", F.sum("n").over(upto))
        # The boundary bucket is the first whose sum goes beyond the room.
        edge = cum.where("upto > room").groupBy("source").agg(F.min(F.struct("b", "upto", "n")).alias("e")).collect()
        found = {r["source"]: r["e"] for r in edge}
        after = []
        for source, s, goal, full, room, prefix in plan:
            e = found.get(source)
            if e is not None and len(prefix) == level * DIGITS:
                prefix, room = prefix + e["b"], room - (e["upto"] - e["n"])
            after.append((source, s, goal, full, room, prefix))
        plan = after
        table = spark.createDataFrame(plan, columns)
    # A source without a boundary has room for all; otherwise hashes below the boundary are in. At the last level the boundary bucket is one hash.
    final = spark.createDataFrame([(a, b, c, d, p if p else "g") for a, b, c, d, _, p in plan], "src string, source_size long, target double, full int, threshold string")
    return rows, _sent(final, len(plan))



ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
             substr(md5(coalesce(doc_id::VARCHAR, text, '')), 1, 15) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight FROM s),
o AS (SELECT *, 2.0::DOUBLE * source_size AS cap, row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST) AS k FROM r),
c AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM o),
f AS (SELECT min_by(level, k) AS level, min(k) AS k FROM c WHERE level <= cap / weight),
t AS (SELECT source, source_size, CASE WHEN c.k < f.k THEN cap ELSE f.level * weight END AS target FROM c, f),
g AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size) END AS "full" FROM t),
e AS (SELECT d.doc_id, d.size, g.source_size, g.target, g."full", g.target - g."full" * g.source_size AS room,
        sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) AS upto FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, ("full" + CASE WHEN upto <= room THEN 1 ELSE 0 END)::BIGINT AS copies,
  (size * ("full" + CASE WHEN upto <= room THEN 1 ELSE 0 END))::BIGINT AS taken FROM e
"""
