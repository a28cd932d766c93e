"""Quality rules, line first: each line is judged by punctuation, navigation and boilerplate rules,
failing lines go, and a document that loses too much of its text this way is rejected."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import WORD_RE, arrow_map

SYMBOLS = "#*$%&|<>"
#: Phrases of notices and page furniture in the corpus's four languages (English, German, French, Spanish).
BOILERPLATE = (
    r"(?i)(cookie policy|privacy policy|terms of (use|service)|all rights reserved|enable javascript|skip to (main )?content|"
    r"subscribe to our newsletter|sign up for|powered by|click here|lorem ipsum|"
    r"cookie-richtlinie|datenschutzerklärung|nutzungsbedingungen|alle rechte vorbehalten|javascript aktivieren|zum inhalt springen|newsletter abonnieren|"
    r"politique de confidentialité|politique (de|des|en matière de) cookies|conditions d.utilisation|mentions légales|tous droits réservés|activer javascript|aller au contenu|abonnez-vous à notre|cliquez ici|"
    r"política de (privacidad|cookies)|términos (de uso|y condiciones)|aviso legal|todos los derechos reservados|activar javascript|saltar al contenido|suscríbete a nuestro|haga clic aquí)"
)
SYMBOL_RE, BANGS_RE, NAV_RE, END_RE = re.compile(r"[#*$%&|<>]"), re.compile(r"!!|\?\?|\.\.\.\."), re.compile(r"[|>]"), re.compile(r"[.!?:;,\"')\]}…]$")
BOILERPLATE_RE = re.compile(BOILERPLATE)


@dataclass(frozen=True)
class LineRules:
    """min_words, max_repeat_pct: the document rules that come first. The line rules:
    max_symbol_pct and max_bang_pct: symbols, and doubled marks, for each hundred words of a line (punctuation);
    nav_pct: bars or angle brackets for each hundred words, two at least (navigation);
    short_words: a line of fewer words that ends in no punctuation mark is a heading or menu entry (navigation).
    max_lost_pct: a document that loses a larger share of its word characters is rejected."""

    min_words: int = 10
    max_repeat_pct: int = 20
    repeat_window: int = 5
    max_symbol_pct: int = 50
    max_bang_pct: int = 50
    nav_pct: int = 30
    short_words: int = 4
    max_lost_pct: int = 50


def repeated_words(words: list[str], width: int) -> int:
    """Words in windows of `width` words that occur twice or more in the text, the first occurrence included.
    Windows are compared by rank, so equality is exact."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    index: dict[str, int] = {}
    ids = np.array([index.setdefault(w, len(index)) for w in words], dtype=np.int64)
    if len(index) == len(words):
        return 0
    rank, have = ids, 1
    while have < width:
        step = min(have, width - have)
        size = len(rank) - step
        pair = rank[:size] * (int(rank.max()) + 1) + rank[step : step + size]
        _, rank = np.unique(pair, return_inverse=True)
        have += step
    again = np.bincount(rank)[rank] > 1
    if not again.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(again)
    edge[at] += 1
    np.add.at(edge, at + width, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def line_fault(line: str, n_words: int, rules: LineRules) -> str | None:
    """The first rule that a line with words breaks: 'punctuation', 'navigation' or 'boilerplate'; else None."""
    n_nav = len(NAV_RE.findall(line))
    if n_nav >= 2 and 100 * n_nav > rules.nav_pct * n_words:
        return "navigation"
    if 100 * len(SYMBOL_RE.findall(line)) > rules.max_symbol_pct * n_words or 100 * len(BANGS_RE.findall(line)) > rules.max_bang_pct * n_words:
        return "punctuation"
    if n_words < rules.short_words and not END_RE.search(line.rstrip(" \t\n\v\f\r")):
        return "navigation"
    if BOILERPLATE_RE.search(line):
        return "boilerplate"
    return None


def judge(text: str | None, rules: LineRules) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_bad_lines, lost_chars, kept, clean text)."""
    text = text or ""
    seen: set[str] = set()
    n_dup = n_bad = lost = chars = 0
    good, words = [], []
    for line in text.split("\n"):
        w = WORD_RE.findall(line)
        if w:
            if line in seen:
                n_dup += 1
            else:
                seen.add(line)
            size = sum(map(len, w))
            chars += size
            words += w
            if line_fault(line, len(w), rules):
                n_bad += 1
                lost += size
                continue
        good.append(line)
    again = repeated_words(words, rules.repeat_window)
    failed = len(words) < rules.min_words or 100 * again > rules.max_repeat_pct * len(words)
    kept = not failed and 100 * lost <= rules.max_lost_pct * chars
    return len(words), chars, len(SYMBOL_RE.findall(text)), n_dup, again, failed, n_bad, lost, kept, "\n".join(good)


FIELDS = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, n_bad_lines long, lost_chars long, kept boolean"
)


def quality_rules(docs: DataFrame, rules: LineRules | None = None, with_text: bool = False) -> DataFrame:
    """One row for each row of docs (doc_id, text): the measures of `judge`, kept, and with_text also clean_text,
    the text without its failing lines.

    A null or empty text has no words: it fails the base rules and isn't kept. A null doc_id stays null.
    Repeated rows are judged one by one. Other columns of docs are ignored, whatever their names.
    One pass, no shuffle; a task holds one Arrow batch of texts."""
    rules = rules or LineRules()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [judge(t, rules) for t in batch.column(1).to_pylist()]
        cols = list(zip(*rows, strict=True))
        kinds = [pa.int64()] * 5 + [pa.bool_()] + [pa.int64()] * 2 + [pa.bool_(), pa.string()]
        arrays = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)][: 10 if with_text else 9]
        names = [f.split()[0] for f in FIELDS.split(", ")] + ["clean_text"] * with_text
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *arrays], names)

    return arrow_map(docs.select("doc_id", "text"), run, FIELDS + ", clean_text string" * with_text)


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (SELECT doc_id, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] || ' ' || ws[i+3] || ' ' || ws[i+4] AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words FROM rep, (SELECT unnest(range(5)) AS o) GROUP BY doc_id),
ln AS (SELECT doc_id, n, l, regexp_extract_all(l, '[^\x20\x09-\x0D]+') AS lw
       FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l, unnest(range(len(string_split(t, chr(10))))) AS n FROM d)),
lj AS (SELECT doc_id, n, len(lw) AS k, length(array_to_string(lw, '')) AS chars,
         row_number() OVER (PARTITION BY doc_id, l ORDER BY n) > 1 AS dup,
         len(regexp_extract_all(l, '[|>]')) AS nav, len(regexp_extract_all(l, '[#*$%&|<>]')) AS sym,
         len(regexp_extract_all(l, '!!|\?\?|\.\.\.\.')) AS bang,
         regexp_matches(rtrim(l, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[.!?:;,"'')\]}…]$') AS ended,
         regexp_matches(l, '{boilerplate}') AS boiler
       FROM ln WHERE len(lw) > 0),
s AS (SELECT doc_id, sum(chars) AS word_chars, sum(dup::INT) AS n_dup_lines, sum(bad::INT) AS n_bad_lines, sum(CASE WHEN bad THEN chars ELSE 0 END) AS lost_chars
      FROM (SELECT *, (nav >= 2 AND 100 * nav > 30 * k) OR 100 * sym > 50 * k OR 100 * bang > 50 * k OR (k < 4 AND NOT ended) OR boiler AS bad FROM lj) GROUP BY doc_id),
a AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
        coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        coalesce(n_bad_lines, 0)::BIGINT AS n_bad_lines, coalesce(lost_chars, 0)::BIGINT AS lost_chars
      FROM w LEFT JOIN cov USING (doc_id) LEFT JOIN s USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM a)
SELECT *, NOT base_failed AND 100 * lost_chars <= 50 * word_chars AS kept FROM b
""".replace("{boilerplate}", BOILERPLATE)
