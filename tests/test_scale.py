"""Figures that must not grow with the input: array files, parses, tasks' rows, sketches made."""

import datetime as dt
import glob
import json
import re

import pytest
from pyspark.sql import functions as F

from fixtures import bronze, fact
from hourglass.operators import anomaly as AN
from hourglass.operators import sketches as SK
from hourglass.operators.sequence import sequence
from hourglass.plans.context import Dense
from hourglass.sources import drift
from hourglass.sources import raw_json as RJ
from hourglass.sources import tables


def plan(df, which="executedPlan"):
    return getattr(df._jdf.queryExecution(), which)().toString()


def landed(path):
    return [json.load(open(f)) for f in glob.glob(f"{path}/*/*.txt")]


def test_array_files_grow_with_records_not_with_ids(spark, tmp_path):
    rows = bronze(spark, [(s, "NO2", "2024-01-01", h, float(h), 0, (s * 24 + h) * 60_000) for s in range(1, 4) for h in range(1, 21)])
    RJ.land(rows, str(tmp_path / "raw"))
    arrays = landed(tmp_path / "raw")
    assert sorted(map(len, arrays)) == [20, 20, 20]        # was a file for each record
    assert all([r["Hour"] for r in a] == list(range(1, 21)) for a in arrays)


def test_array_files_are_bounded_and_lose_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(RJ, "ARRAY_SPAN", 40)
    monkeypatch.setattr(RJ, "CELL_SPAN", 10)
    rows = bronze(spark, [(1 + i % 10 // 9, "NO2", "2024-01-01", 1 + i % 24, float(i), 0, i) for i in range(500)]
                  + [(1, "NO2", "2024-01-01", 1, 1000.0 + i, 0, None) for i in range(3)])
    nameless = rows.withColumn("_source_file", F.when(F.col("Value") % 7 != 0, F.col("_source_file")))
    RJ.land(nameless, str(tmp_path / "raw"))
    arrays = landed(tmp_path / "raw")
    assert max(map(len, arrays)) <= 40 and len(arrays) <= 503 // 30 + 2 * 3
    assert sorted(r["Value"] for a in arrays for r in a) == sorted(r["Value"] for r in rows.collect())


def test_drift_schema_parses_each_text_once(spark, tmp_path):
    RJ.land(bronze(spark, [(1, "NO2", "2024-01-01", 1, 2.5)]), str(tmp_path / "raw"))
    found = drift.drift_schema(RJ.read_rescued(spark, str(tmp_path / "raw")))
    text = plan(found, "optimizedPlan")
    assert text.count("from_json(ArrayType(StringType") == 1 and text.count("map_filter(") <= 2, text


def test_rescue_keeps_null_elements_and_no_empty_arrays(spark):
    texts = spark.createDataFrame([("[]",), ('[null, {"Site_Id": 1}]',), ("[ ]",)], "_raw string")
    assert sorted(str(r["Site_Id"]) for r in RJ.rescue(texts).collect()) == ["1", "None"]


LINES = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, " \
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"


@pytest.fixture()
def small(spark, tmp_path):
    rows = [(i // 4, i, i % 6 if i % 50 else None, i % 4, float(i % 3 + 1), 1.0, 0.0, 0.0, "A", "F", dt.datetime(2024, 1, 1)) for i in range(600)]
    spark.createDataFrame(rows, LINES).write.parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


def test_dense_series_are_cut_into_tasks_by_rows_and_shuffled_once(spark, small, monkeypatch):
    monkeypatch.setattr(tables.tasks_for, "__defaults__", (20,))
    dense = Dense(spark, small)
    for df in (AN.flatline_runs(dense.fact1, value="value", exclude_zero=True, min_rows=2), dense.anomaly):
        shuffles = re.findall(r"Exchange (\w+)\([^)]*?(\d+)\)", plan(df))
        assert shuffles == [("hashpartitioning", "30")], shuffles
    assert tables.tasks_for(spark.range(5), 20) == spark.sparkContext.defaultParallelism
    want = {s: (600 - 12) // 6 for s in range(1, 7)}
    got = {r[0]: r[1] for r in dense.fact1.groupBy("site_id").count().collect()}
    assert sum(got.values()) == sum(want.values()) and set(got) == set(want)


def test_dense_times_are_worked_out_once_for_each_row(spark, small):
    text = plan(Dense(spark, small).fact1, "optimizedPlan")
    filters = [line for line in text.splitlines() if re.match(r"[\s:+-]*Filter", line)]
    assert filters and not any("timestampadd" in line or "row_number" in line or "_we0" in line for line in filters), filters


def test_chunks_are_dealt_out_where_series_are_together(spark):
    f = fact(spark, {(1, "NO2"): [1.0] * 100}).repartition(3, "site_id")
    local = sequence(f, ["site_id", "parameter_code"], "obs_time", F.col("obs_date"), materialize_local=False)
    assert re.search(r"hashpartitioning\(site_id#\d+, parameter_code#\d+, _chunk#\d+", plan(local))


def test_accepted_readings_meet_before_they_are_sketched(spark):
    table = SK.sketch_table(fact(spark, {(1, "NO2"): [1.0] * 100}))
    assert plan(table).count("Exchange ") == 1 and "REPARTITION_BY_COL" in plan(table)
    assert table.count() == 24 and table.agg(F.sum("readings")).first()[0] == 100
