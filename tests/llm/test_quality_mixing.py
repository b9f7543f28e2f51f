"""Quality rules and mixing: SQL oracle on edge rows, brute force, plans."""

from collections import defaultdict

import duckdb
import pytest

from hourglass.llm import mixing, quality_rules
from llm_edge import EDGE
from oracle_compare import digest


def against(df, documents, sql):
    con = duckdb.connect()
    con.register("documents", documents.toArrow())
    cur = con.execute(sql)
    columns, rows = [d[0] for d in cur.description], cur.fetchall()
    got = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(columns) and len(got) == len(rows)
    assert digest(df.columns, got) == digest(columns, rows)
    return got


JUNK = [(20, "buy now " * 60), (21, "THIS IS LOUD " + "LOUDER STILL " * 40), (22, " | ".join(f"cell{i}" for i in range(80))),
        (23, "\n".join(["same line again"] * 10 + [f"line {i} of words" for i in range(8)])),
        (24, " ".join(f"word{'abcdefghijklmnop'[i % 16]}{'qrstuvwxyz'[i % 10]}" for i in range(80))), (25, "1234 5678 " * 3 + "90 12 " * 30)]


def test_quality_matches_sql_on_edge_rows(frame):
    rows = frame(EDGE + JUNK, extra=False)
    got = against(quality_rules.query(rows), rows, quality_rules.ORACLE_SQL)
    assert len(got) == len(EDGE) + len(JUNK)


def test_quality_keeps_prose_and_rejects_junk(frame):
    kept = {r.doc_id: r.kept for r in quality_rules.query(frame(JUNK)).collect()}
    assert kept == {20: False, 21: False, 22: False, 23: False, 24: True, 25: False}


def test_quality_rules_order_does_not_change_the_verdict(frame):
    rows = frame(EDGE + JUNK)
    a = quality_rules.cascade(rows, rules=quality_rules.RULES).select("doc_id", "kept").collect()
    b = quality_rules.cascade(rows, rules=quality_rules.RULES[::-1], sample_rows=1).select("doc_id", "kept").collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_quality_plan_has_no_python_and_no_shuffle(frame):
    plan = quality_rules.statistics(frame(JUNK))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_empty_tables(frame):
    assert quality_rules.query(frame([])).collect() == []
    assert mixing.query(frame([])).collect() == []


def rows_of_sources():
    rows, i = [], 0
    for source, lang, n in (("src0", "en", 40), ("src1", "en", 10), ("src4", "en", 3), ("src4", "de", 6), ("src8", "fr", 2), ("odd", "es", 5),
                            (None, None, 4), ("src5", "en", 30)):
        for k in range(n):
            rows.append((i, " ".join(["w"] * (1 + (i * 7) % 23)), lang, source))
            i += 1
    return rows + [(None, "no id here", "en", "src0"), (3, "a repeated id", "en", "src0"), (500, None, "en", "src0"), (501, "", "de", "src1")]


@pytest.mark.parametrize("percent,epochs", [(80, 3), (30, 1), (100, 1), (400, 2), (0, 2)])
def test_mixing_matches_sql(frame, percent, epochs):
    rows = frame(rows_of_sources(), extra=False)
    got = mixing.mix(rows, budget_percent=percent, max_epochs=epochs).selectExpr(
        "doc_id", "_domain AS domain", "_lang AS lang", "_source AS source", "epoch", "_tokens AS n_tokens", "tokens_used")
    got = against(got, rows, mixing.oracle_sql(percent, epochs))
    total = sum(len((r[1] or "").split()) for r in rows_of_sources())
    used = sum(r[6] for r in got)
    assert used <= max(total * percent // 100, 0) and (percent > 100 * epochs or used >= total * percent // 100 - 40)


def test_shortage_goes_to_siblings_before_ancestors(frame):
    """A source that is short leaves its rest to the other source of its
    language, not to other languages."""
    text = lambda n: " ".join(["w"] * n)
    rows = [(i, text(10), "en", "src4") for i in range(2)] + [(100 + i, text(10), "en", "src8") for i in range(50)] \
        + [(200 + i, text(10), "de", "src4") for i in range(50)]
    used = defaultdict(int)
    for r in mixing.mix(frame(rows), 50, 1, domain_weights={}, lang_weights={}, source_weights={}).collect():
        used[r._lang, r._source] += r.tokens_used
    assert used[("en", "src4")] == 20 and used[("en", "src8")] == 235 and used[("de", "src4")] == 255


def test_mixing_plan_does_not_shuffle_documents(frame):
    """The final plan holds no exchange: documents meet a broadcast row per leaf."""
    plan = mixing.mix(frame(rows_of_sources()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "hashpartitioning" not in plan
