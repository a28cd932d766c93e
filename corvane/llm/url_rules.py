"""URL filters by a sort-merge range join: keys of reversed hosts turn the rules' hosts into intervals, and one sorted
sweep over urls and rules keeps the stack of rules whose intervals are open."""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, sliced

#: Sampled keys that set the bounds of partitions; they decide only how evenly the rows are dealt.
SAMPLE_KEYS = 20_000
ROWS_EACH = 200_000


@dataclass(frozen=True)
class Rule:
    """It fits its host and all subdomains, where the url's path starts with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def key(self) -> str:
        return host_key(self.host)


def host_key(host: str) -> str:
    """Labels in reverse, each ended by a NUL: a host's key is a prefix of those of its subdomains, and no label's key of another's."""
    return "".join(label + "\0" for label in reversed(host.split(".")))


def parts(url):
    """Columns host and path of a url column: after the first :// the host runs to / ? # or the end, the path from there to ? # or the end."""
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)")).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


class Node:
    """The rules of one host, by the length of their paths and by path."""

    def __init__(self, key: str):
        self.key, self.by_length = key, {}

    def add(self, rule: Rule) -> None:
        same = self.by_length.setdefault(len(rule.path), {})
        # Of equals, one that blocks.
        if rule.path not in same or rule.verdict == "block":
            same[rule.path] = rule

    def fitting(self, path: str) -> Iterator[Rule]:
        for n, rules in self.by_length.items():
            if path[:n] in rules:
                yield rules[path[:n]]


def best(stack: Sequence[Node], path: str) -> Rule | None:
    """The longest rule of the open ones whose path fits; of equals that of the longer host, then one that blocks."""
    fits = [r for node in stack for r in node.fitting(path)]
    return max(fits, key=lambda r: (len(r.name), len(r.host), r.verdict == "block"), default=None)


def sweep(batches: Iterator[pa.RecordBatch], default: str) -> Iterator[pa.RecordBatch]:
    """Rules and urls sorted by part and key, of one key the rules first. A rule's interval is open while its key is a prefix of the
    row's key; the stack holds the open ones."""
    now, stack = None, []
    for batch in sliced(batches):
        out = []
        for part, key, is_url, page, host, path, verdict in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if part != now:
                now, stack = part, []
            while stack and not key.startswith(stack[-1].key):
                stack.pop()
            if is_url:
                rule = best(stack, path) if stack else None
                out.append((page, host, path, rule and rule.name, rule.verdict if rule else default))
            else:
                if not stack or stack[-1].key != key:
                    stack.append(Node(key))
                stack[-1].add(Rule(verdict, host, path))
        if out:
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["page_id", "host", "path", "rule", "verdict"])


def parts_of(key: str, bounds: Sequence[str]) -> tuple[int, int]:
    """The first and last part of a key. Part p holds the keys from bounds[p - 1] up to bounds[p]; a key that stands several times in bounds is
    spread over those parts."""
    first, last = bisect_left(bounds, key), bisect_right(bounds, key)
    return (first + 1, last) if first < last else (last, last)


def filter_urls(pages: DataFrame, rules: Sequence[Rule], default: str = "allow") -> DataFrame:
    """One row for each row of pages (page_id, url): page_id, host, path, rule (host and path of the longest rule that
    fits, else null), verdict (the rule's, else `default`).

    A null url, or one without ://, has an empty host and path and fits no rule but one with both empty. Repeated rows are
    judged one by one; a null page_id stays null. No pages give no rows; other columns are ignored, whatever their names.

    Keys are dealt by ranges whose bounds come from a bounded sample. A key as frequent as several ranges gets as many
    parts, among which its rows are dealt by hash; a rule becomes a row of each part that its interval meets, and is swept over
    with the urls of that part. So no host, however frequent, makes a task longer, a task holds only the rules whose intervals are open,
    and what every task gets is the list of bounds, one for each ROWS_EACH rows."""
    spark = pages.sparkSession
    host, path = parts("url")
    key = F.concat(F.array_join(F.reverse(F.split(F.col("host"), r"\.", -1)), "\0"), F.lit("\0"))
    rows = pages.select(F.col("page_id").cast("long"), "url").select("page_id", host.alias("host"), path.alias("path")).withColumn("key", key)
    n = pages.count()
    n_parts = max(1, -(-n // ROWS_EACH))
    n_parts = max(n_parts, min(64, n // 500)) if n else 1
    share = min(1.0, SAMPLE_KEYS / n) if n else 1.0
    drawn = sorted(r[0] for r in rows.select("key").where(F.pmod(F.xxhash64("page_id", "host", "path"), F.lit(1 << 20)) < int(share * (1 << 20))).limit(4 * SAMPLE_KEYS).collect()) if n_parts > 1 else []
    bounds = [drawn[len(drawn) * i // n_parts] for i in range(1, n_parts)] if drawn else []

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            page, paths, keys = (batch.column(c).to_pylist() for c in (0, 2, 3))
            to = []
            for i, p, k in zip(page, paths, keys, strict=True):
                first, last = parts_of(k, bounds)
                to.append(first if first == last else first + zlib.crc32(f"{i} {p}".encode("utf-8", "surrogatepass")) % (last - first + 1))
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), batch.column(3), *batch.columns[:3]], ["part", "key", "page_id", "host", "path"])

    urls = rows.mapInArrow(deal, "part int, key string, page_id long, host string, path string")
    urls = urls.select("part", "key", F.lit(True).alias("is_url"), "page_id", "host", "path", F.lit(None).cast("string").alias("verdict"))
    # A rule's interval ends before the first key that it isn't a prefix of.
    given = [(bisect_left(bounds, r.key), bisect_right(bounds, r.key + "\U0010ffff"), r.key, r.host, r.path, r.verdict) for r in rules]
    table = spark.createDataFrame(given, "lo int, hi int, key string, host string, path string, verdict string")
    swept = table.select(F.explode(F.sequence("lo", "hi")).alias("part"), "key", F.lit(False).alias("is_url"), F.lit(None).cast("long").alias("page_id"), "host", "path", "verdict")
    dealt = urls.unionByName(swept).repartition(n_parts, "part").sortWithinPartitions("part", "key", "is_url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return sweep(batches, default)

    return dealt.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")


RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))

ORACLE = r"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(rhost, rpath, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m AS (SELECT page_id, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(verdict, length(rhost || rpath)) AS v
      FROM h, r WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT h.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM h LEFT JOIN m USING (page_id)
"""
