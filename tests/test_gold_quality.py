"""Gold tables, reports and gates on hand-built inputs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixtures import bronze
from hourglass.functions.exprs import wind_band
from hourglass.operators import gold as G
from hourglass.operators import quality as Q
from hourglass.operators import silver as S


def _dim(spark):
    return spark.createDataFrame([(1, "A", "R1", -33.0, 151.0), (2, "B", "R1", -33.1, 151.1)],
                                 "site_id int, site_name string, region string, latitude double, longitude double")


def test_gold_daily_and_completeness(spark):
    rows = [(1, "PM10", "2024-01-05", h, 10.0 + h) for h in range(1, 19)]
    d = G.gold_daily(S.dedup(S.silver(bronze(spark, rows))), _dim(spark)).first()
    assert d["valid_hours"] == 18 and d["completeness_pct"] == 75.0 and d["daily_max"] == 28.0


def _daily(spark, rows):
    return spark.createDataFrame(
        rows, "site_id int, site_name string, region string, obs_date date, parameter_code string, "
              "daily_avg double, completeness_pct double")


def test_exceedance_boundaries(spark):
    d0 = dt.date(2024, 1, 1)
    rows = [(1, "A", "R", d0 + dt.timedelta(days=i), "PM10", v, c)
            for i, (v, c) in enumerate([(50.0, 100.0), (60.0, 74.9), (61.0, 75.0), (62.0, 100.0), (10.0, 100.0),
                                        (70.0, 100.0)])]
    for method in ("window", "chunked"):
        e = {r["obs_date"]: r for r in G.exceedance_events(_daily(spark, rows), G.standards_frame(spark),
                                                          method=method).collect()}
        # 50.0 equals the standard: not an exceedance; 74.9 % excluded; 75 % included
        assert sorted(e) == [d0 + dt.timedelta(days=i) for i in (2, 3, 5)]
        assert e[d0 + dt.timedelta(days=2)]["consecutive_days"] == 2
        assert e[d0 + dt.timedelta(days=5)]["consecutive_days"] == 1
        assert e[d0 + dt.timedelta(days=2)]["times_standard"] == 1.22


def _fact_months(spark, months: list[tuple[dt.date, float]]):
    return spark.createDataFrame([(1, "PM10", "u", m, v) for m, v in months],
                                 "site_id int, parameter_code string, units string, obs_date date, value_clean double")


def test_regional_lag_by_rows_and_zero_guard(spark):
    months = [(dt.date(2020, m, 1), float(m)) for m in range(1, 13)] + [(dt.date(2021, 2, 1), 5.0),
                                                                      (dt.date(2021, 3, 1), 7.0)]
    months[0] = (dt.date(2020, 1, 1), 0.0)
    r = {x["month_start"]: x for x in G.gold_regional(_fact_months(spark, months), _dim(spark)).collect()}
    # Jan 2021 is missing: LAG 12 (rows) for Feb 2021 reaches Jan 2020 (value 0) -> yoy NULL
    assert r[dt.date(2021, 2, 1)]["same_month_last_year"] == 0.0
    assert r[dt.date(2021, 2, 1)]["yoy_pct_change"] is None
    assert r[dt.date(2021, 3, 1)]["same_month_last_year"] == 2.0
    assert r[dt.date(2021, 3, 1)]["rolling_12m_avg"] == pytest.approx((sum(range(3, 13)) + 5 + 7) / 12)
    cal = {x["month_start"]: x for x in G.gold_regional(_fact_months(spark, months), _dim(spark),
                                                         lag_mode="calendar").collect()}
    assert cal[dt.date(2021, 2, 1)]["same_month_last_year"] == 2.0


def test_wind_bands(spark):
    df = spark.createDataFrame([(0.99,), (1.0,), (3.0,), (6.0,)], "w double")
    assert [r[0] for r in df.select(wind_band(F.col("w"))).collect()] == ["1_still", "2_light", "3_moderate",
                                                                         "4_strong"]


def test_gate_fails_on_bad_input_and_passes_on_good(spark):
    good = S.silver(bronze(spark, [(1, "PM10", "2024-01-05", h, 5.0) for h in range(1, 5)]))
    dim = _dim(spark)
    daily = G.gold_daily(S.dedup(good), dim)
    regional = G.gold_regional(S.dedup(good), dim)
    b = bronze(spark, [(1, "PM10", "2024-01-05", h, 5.0) for h in range(1, 5)])
    gate = Q.quality_gate(b, good, daily, regional)
    assert all(r["passed"] for r in gate.collect())
    Q.assert_gate(gate)
    bad_rows = [(1, "PM10", "2024-01-05", 1, 5.0), (1, "PM10", "2024-01-05", 1, 6.0), (None, "PM10", "x", 1, None),
                (None, "PM10", "x", 1, None)]
    bb = bronze(spark, bad_rows)
    bs = S.silver(bb)
    gate = {r["check_name"]: r for r in Q.quality_gate(bb, bs, daily, regional).collect()}
    assert not gate["drop_rate_pct"]["passed"] and gate["drop_rate_pct"]["observed"] == 50.0
    assert not gate["silver_duplicate_keys"]["passed"]
    with pytest.raises(Q.QualityGateError):
        Q.assert_gate(Q.quality_gate(bb, bs, daily, regional))


def test_gate_fails_closed(spark):
    nothing = bronze(spark, [(1, "PM10", "2024-01-05", 1, 5.0)]).limit(0)
    none, dim = S.silver(nothing), _dim(spark)
    empty = {r["check_name"]: r["passed"] for r in Q.quality_gate(nothing, none, G.gold_daily(none, dim), G.gold_regional(none, dim)).collect()}
    assert not empty["drop_rate_pct"] and not empty["empty_tables"] and not empty["max_completeness_pct"]
    few = bronze(spark, [(1, "PM10", "2024-01-05", 1, 5.0)])
    more = S.silver(bronze(spark, [(1, "PM10", "2024-01-05", h, 5.0) for h in range(1, 5)]))
    over = {r["check_name"]: r["passed"] for r in Q.quality_gate(few, more, G.gold_daily(more, dim), G.gold_regional(more, dim)).collect()}
    assert not over["silver_rows_beyond_bronze"]
    suite = Q.regression_suite(nothing, none, G.hourly_wide(none))
    assert not any(r["passed"] for r in suite.collect())
    with pytest.raises(Q.QualityGateError, match="pipeline_accounting"):
        Q.assert_regression(suite)


@pytest.mark.parametrize("name", ["quality_gate", "grain_checks", "regression_suite", "reconciliation", "pipeline_accounting"])
def test_one_scan_of_each_table(spark, sf_dir, name):
    import re
    from collections import Counter

    from hourglass.plans.catalog import QUERIES
    df = QUERIES[name](spark, sf_dir)
    scans = Counter(re.findall(r"(\w+)\.parquet\]|layer-(\w+)-", df._jdf.queryExecution().optimizedPlan().toString()))
    files = Counter(f for f in re.findall(r"FileScan parquet .*?Location: \S+ (\S+)", df._jdf.queryExecution().executedPlan().toString()))
    assert all(n == 1 for n in files.values()), files
    assert not scans or max(scans.values()) <= 2


def test_regression_suite_rows(spark):
    # hours 1 and 24 map to obs_hour 0 and 23
    rows = [(1, "PM10", "2024-01-05", 1, -1.0), (1, "TEMP", "2024-01-05", 1, -3.0),
            (1, "HUMID", "2024-01-05", 2, 104.0), (1, "HUMID", "2024-01-05", 3, 54.0), (1, "PM10", "2024-01-05", 24, 3.0)]
    b = bronze(spark, rows)
    s = S.silver(b)
    out = {r["test_name"]: r["passed"] for r in Q.regression_suite(b, s, G.hourly_wide(s)).collect()}
    assert out == {"hour_offset_corrected": True, "pipeline_accounting": True, "silver_grain_unique": True,
                   "value_clean_semantics": True, "hourly_wide_grain": True, "humidity_semantics": True}
    Q.assert_regression(Q.regression_suite(b, s, G.hourly_wide(s)))
