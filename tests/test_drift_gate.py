"""Rescued fields as VARIANT, and gates from what was observed while writing."""

import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from hourglass.operators import quality as Q
from hourglass.plans import pipeline
from hourglass.sources import drift, sinks

RESCUED = [None, '{"k":"5"}', '{"k":"6.5","a b":"x \\"quoted\\""}', '{"k":"n/a"}', '{"nested":"{\\"p\\":[1,2]}"}', "no json", '{"k":"7","z":"true"}']


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(list(enumerate(RESCUED)), "id int, _rescued_data string")


def test_drift_schema_finds_the_type_of_all_values(rows):
    got = {r["field"]: (r["rows"], r["data_type"]) for r in drift.drift_schema(rows).collect()}
    assert got["a b"] == (1, "STRING") and got["z"] == (1, "BOOLEAN") and got["nested"] == (1, "OBJECT<p: ARRAY<BIGINT>>")
    assert got["k"][0] == 4 and got["k"][1] == "VARIANT"         # numbers and a text
    assert got[drift.NO_RECORD] == (1, None) and len(got) == 5
    numbers = drift.drift_schema(rows.filter("id in (1, 2)")).filter("field = 'k'").first()
    assert numbers["data_type"].startswith("DECIMAL")


def test_promote_fills_old_rows_and_keeps_what_does_not_fit(rows, tmp_path):
    rows.write.parquet(str(tmp_path / "t"))
    old = rows.sparkSession.read.parquet(str(tmp_path / "t"))
    got = {r["id"]: (r["k"], r["_rescued_data"]) for r in drift.promote(old, "k", "int").collect()}
    assert got[0] == (None, None) and got[1] == (5, None) and got[3] == (None, '{"k":"n/a"}') and got[5] == (None, "no json")
    assert got[6] == (7, '{"z":"true"}') and got[4] == (None, RESCUED[4])
    assert got[2][0] == 6 or got[2] == (None, RESCUED[2])


def test_variant_survives_a_write(rows, tmp_path):
    drift.rescued_variant(rows).write.parquet(str(tmp_path / "v"))
    back = rows.sparkSession.read.parquet(str(tmp_path / "v"))
    assert dict(back.dtypes)["_rescued"] == "variant"
    got = {r["id"]: r["k"] for r in back.select("id", F.try_variant_get("_rescued", "$.k", "string").alias("k")).collect()}
    assert got == {0: None, 1: "5", 2: "6.5", 3: "n/a", 4: None, 5: None, 6: "7"}


def test_observed_metrics_equal_a_second_pass(spark, sf_dir, tmp_path):
    t = pipeline.run(spark, sf_dir, str(tmp_path / "run"))
    want = Q.quality_gate(t.bronze, t.silver, t.daily, t.regional).collect()
    got = Q.observed_gate(t.metrics, t.silver, t.daily, t.regional)
    assert got.collect() == want
    # the written layers are read for their keys only
    plan = got._jdf.queryExecution().executedPlan().toString()
    read = [line.split("ReadSchema:")[1] for line in plan.splitlines() if "ReadSchema:" in line]
    assert len(set(read)) == 3 and not any(c in line for line in read for c in ("value", "completeness_pct", "readings"))


def test_observed_gate_fails_on_what_it_saw(spark):
    silver = spark.createDataFrame([(1, "NO2", dt.datetime(2024, 1, 1))], "site_id int, parameter_code string, obs_time timestamp_ntz")
    daily = spark.createDataFrame([(1, dt.date(2024, 1, 1), "NO2")], "site_id int, obs_date date, parameter_code string")
    regional = spark.createDataFrame([("x", "NO2", dt.date(2024, 1, 1))], "region string, parameter_code string, month_start date")
    metrics = {"bronze": {"rows": 2}, "silver": {"rows": 1, "neg": 1}, "daily": {"rows": 0, "maxc": None}, "regional": {"rows": 1}}
    failed = {r["check_name"] for r in Q.observed_gate(metrics, silver, daily, regional).collect() if not r["passed"]}
    assert failed == {"drop_rate_pct", "empty_tables", "negative_pollutant_value_clean", "max_completeness_pct"}


def test_observed_rows_count_once_after_a_rebalance(spark, tmp_path):
    seen = Observation()
    sinks.overwrite(spark.range(1000).selectExpr("id", "id % 7 AS p"), str(tmp_path / "t"), ["p"], (seen, [F.count(F.lit(1)).alias("n")]))
    assert seen.get == {"n": 1000}
