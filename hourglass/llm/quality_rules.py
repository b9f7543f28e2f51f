"""Quality rules as a short-circuit cascade (operator 2, native).

``statistics`` adds, in one projection chain and without a shuffle, the word
and line statistics of each whole text. A window of three words is a repeat
when its 64-bit hash occurs twice or more in the text; windows are sorted by
hash inside the row, so the cost is n log n in the words of a text.

``cascade`` first rejects by the base rule. The other rules are tried in the
order of rejections per cost, both estimated on a bounded sample (the leading
``sample_rows`` texts of ordinary length; it only decides the order), and a text that one rule
rejects is not looked at by the later, dearer ones: the cascade is one CASE
expression, which stops at its first true branch. The order never changes
which texts are kept.

Defined cases: a null text has no words; a text without words fails the base
rule; empty tables give empty results (rules then keep their given order);
columns of the input named like a new column (``base_failed`` and ``kept`` included)
are replaced; texts of any length are read whole; repeated rows give
repeated results.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.llm.storage import written

#: Texts in the sample at most, and characters in one of them (it is held by the driver).
SAMPLE_ROWS, SAMPLE_CHARS = 500, 100_000


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a SQL condition over the statistics and ``_text``;
    integer arithmetic only, so that it can be compared exactly."""
    name: str
    rejects: str


#: Limits in percent; texts beyond them are markup, tables, shouting, menus or number dumps.
RULES = [
    Rule("symbols", "100 * n_symbols > 10 * n_words"),
    Rule("exclamations", "100 * length(regexp_replace(_text, '[^!]+', '')) > 10 * n_words"),
    Rule("capitals", r"100 * length(regexp_replace(_text, '[^\\p{Lu}]+', '')) > 30 * length(regexp_replace(_text, '[^\\p{L}]+', ''))"),
    Rule("letters", r"100 * length(regexp_replace(_text, '[^\\p{L}]+', '')) < 40 * word_chars"),
    Rule("repeated_lines", "100 * n_dup_lines > 40 * n_lines"),
    Rule("word_length", "word_chars > 15 * n_words OR word_chars < 2 * n_words"),
]
BASE = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` for ``value``, which is computed once. Expressions
    that hold what they need stay linear wherever the optimiser moves them,
    as when it pushes a filter on a statistic below its projection."""
    return f"transform(array({value}), {name} -> {body})[0]"


WORDS = r"array_remove(split(_text, '[\\x20\\x09-\\x0D]+'), '')"
LINES = r"filter(split(_text, '\\n'), line -> line rlike '[^\\x20\\x09-\\x0D]')"
#: Windows of three words by hash, with their places.
WINDOWS = """CASE WHEN size(w) < 3 THEN array() ELSE array_sort(transform(sequence(0, size(w) - 3),
    i -> named_struct('h', xxhash64(w[i], w[i + 1], w[i + 2]), 'i', i))) END"""
#: Where windows start that occur again: beside one of the same hash.
AGAIN = """transform(filter(s, (x, j) -> (j > 0 AND s[greatest(j - 1, 0)].h = x.h)
    OR (j < size(s) - 1 AND s[least(j + 1, size(s) - 1)].h = x.h)), x -> x.i)"""
COVERED = "CASE WHEN size(a) = 0 THEN 0 ELSE size(array_distinct(concat(a, transform(a, i -> i + 1), transform(a, i -> i + 2)))) END"
STATISTICS = {
    "n_words": f"size({WORDS})",
    "word_chars": r"length(regexp_replace(_text, '[\\x20\\x09-\\x0D]+', ''))",
    "n_symbols": "length(regexp_replace(_text, '[^#*$%&|<>]+', ''))",
    "n_lines": f"size({LINES})",
    "n_dup_lines": _let(LINES, "l", "size(l) - size(array_distinct(l))"),
    "n_repeat_words": _let(WORDS, "w", _let(WINDOWS, "s", _let(AGAIN, "a", COVERED))),
}


def statistics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines,
    n_repeat_words (long)."""
    keep = [c for c in df.columns if c not in (*STATISTICS, "_text")]
    df = df.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    return df.select("*", *[F.expr(x).cast("long").alias(n) for n, x in STATISTICS.items()])


def ordered_rules(df: DataFrame, text_col: str = "text", rules: list[Rule] = RULES,
                  sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """``rules`` by rejections per second, each measured on the sample. What
    the base rule rejects is left out: the cascade doesn't see it. The sample
    is taken from as few partitions as it needs."""
    text = F.col(f"`{text_col}`")
    drawn = df.filter(F.length(text) <= SAMPLE_CHARS).select(text.alias("text")).limit(sample_rows).collect()
    texts = df.sparkSession.createDataFrame([(r["text"],) for r in drawn], "text string")
    sample = written(statistics(texts), "rule-sample").filter(f"NOT ({BASE})")

    def measured(condition: Column) -> tuple[int, float]:
        job = sample.agg(F.count_if(condition).alias("n"), F.count("_text").alias("of"))
        job.collect()  # compiles the expression
        began = time.perf_counter()
        rejected = job.collect()[0]["n"]
        return rejected, time.perf_counter() - began

    idle = measured(F.lit(False))[1]
    worth = {}
    for r in rules:
        rejected, seconds = measured(F.expr(r.rejects))
        worth[r.name] = rejected / max(seconds - idle, 1e-3)
    return sorted(rules, key=lambda r: -worth[r.name])


def cascade(df: DataFrame, text_col: str = "text", rules: list[Rule] = RULES,
            sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``df`` with its statistics, ``base_failed`` and ``kept`` (boolean)."""
    stats = statistics(df, text_col)
    verdict = F.when(F.expr(BASE), F.lit(False))
    for r in ordered_rules(df, text_col, rules, sample_rows):
        verdict = verdict.when(F.expr(r.rejects), F.lit(False))
    return stats.withColumns({"base_failed": F.expr(BASE), "kept": verdict.otherwise(True)}).drop("_text", "n_lines")


def query(docs: DataFrame) -> DataFrame:
    return cascade(docs.select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
p AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT r, i, word, lead(word) OVER (PARTITION BY r ORDER BY i) AS b,
             lead(word, 2) OVER (PARTITION BY r ORDER BY i) AS c FROM p),
k AS (SELECT r, i, count(*) OVER (PARTITION BY r, word, b, c) AS n FROM g WHERE c IS NOT NULL),
rep AS (SELECT r, count(*) AS n_repeat_words FROM (
            SELECT DISTINCT r, i + o AS i FROM k, (VALUES (0), (1), (2)) AS v(o) WHERE n > 1) GROUP BY r),
l AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
      FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
s AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
             coalesce(n_lines, 0) AS n_lines, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
             length(regexp_replace(t, '[^!]+', '', 'g')) AS bangs,
             length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) AS capitals,
             length(regexp_replace(t, '[^\p{L}]+', '', 'g')) AS letters
      FROM d JOIN w USING (r) LEFT JOIN rep USING (r) LEFT JOIN l USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 10 * n_words OR 100 * bangs > 10 * n_words
            OR 100 * capitals > 30 * letters OR 100 * letters < 40 * word_chars
            OR 100 * n_dup_lines > 40 * n_lines
            OR word_chars > 15 * n_words OR word_chars < 2 * n_words) AS kept
FROM b
"""
