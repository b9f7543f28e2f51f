"""Sketches, incremental gold, stream dedup, session windows and clustered writes."""

import datetime as dt
import math
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from fixtures import T0, bronze, fact
from hourglass.operators import anomaly as AN
from hourglass.operators import gold as G
from hourglass.operators import silver as S
from hourglass.operators import sketches as SK
from hourglass.sources import sinks
from hourglass.streaming import incremental as I
from hourglass.streaming import jobs as J


def test_merged_sketches_keep_the_stated_rank_error(spark):
    k, rng = 256, random.Random(1)
    values = [rng.choice([rng.gauss(20, 5), rng.expovariate(0.1), 7.0]) for _ in range(60_000)]
    rows = spark.createDataFrame([(i % 50, "NO2", i % 24, T0.date() + dt.timedelta(days=i % 90), v) for i, v in enumerate(values)],
                                 "site_id int, parameter_code string, obs_hour int, obs_date date, value_clean double")
    table = SK.sketch_table(rows, k=k)
    one = SK.merged(SK.merged(table, ["site_id", "parameter_code"], k), ["parameter_code"], k)
    ordered = sorted(values)
    import bisect
    for q in (0.01, 0.25, 0.5, 0.95, 0.99):
        r = one.select("readings", SK.quantile(q, 9).alias("v")).first()
        low, high = bisect.bisect_left(ordered, r["v"] - 1e-8) / len(values), bisect.bisect_right(ordered, r["v"] + 1e-8) / len(values)
        assert r["readings"] == len(values)
        assert low - 2 * SK.rank_error(k) <= q <= high + 2 * SK.rank_error(k), (q, low, high)


def test_sketches_of_small_groups_are_exact(spark):
    rng = random.Random(2)
    values = [float(rng.randrange(1000)) for _ in range(SK.SKETCH_K)]
    rows = spark.createDataFrame([(i % 7, "NO2", i % 24, T0.date(), v) for i, v in enumerate(values)] + [(1, "NO2", 1, T0.date(), None)],
                                 "site_id int, parameter_code string, obs_hour int, obs_date date, value_clean double")
    one = SK.merged(SK.sketch_table(rows), ["parameter_code"])
    for q in (0.1, 0.5, 0.95):
        assert one.select(SK.quantile(q, 3)).first()[0] == sorted(values)[math.ceil(q * len(values)) - 1]


DIM = "site_id int, site_name string, region string, latitude double, longitude double"


def batches(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 2, 3]), rng.choice(["NO2", "PM2.5", "TEMP"]), (T0 + dt.timedelta(days=rng.randrange(6))).date().isoformat(),
             rng.randrange(1, 25), rng.choice([None, -1.0, 2.5, 40.0])) for _ in range(400)]
    return [S.silver(bronze(spark, rows[i:i + 100])) for i in range(0, 400, 100)], S.silver(bronze(spark, rows))


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_incremental_gold_equals_full_recompute_after_every_batch(spark, tmp_path):
    parts, whole = batches(spark)
    dim = spark.createDataFrame([(1, "a", "x", 1.0, 1.0), (2, "b", "x", 1.0, 1.0), (3, "c", "y", 1.0, 1.0)], DIM)
    state, rows = str(tmp_path / "state"), lambda df: sorted(tuple(round(x, 9) if isinstance(x, float) else str(x) for x in r) for r in df.collect())
    done = None
    for i, part in enumerate(parts):
        I.add_batch(part, i, state)
        done = part if done is None else done.unionByName(part)
        if i == 1:
            before = files(state)
            I.add_batch(part, i, state)           # a replay
            assert len(files(state)) == len(before)
        assert rows(I.gold_daily(I.read_state(spark, state), dim)) == rows(G.gold_daily(done, dim))
    assert rows(I.gold_regional(I.read_state(spark, state), dim)) == rows(G.gold_regional(whole, dim))
    new = I.compacted(spark, state, str(tmp_path / "new"))
    assert I.read_state(spark, new).count() < I.read_state(spark, state).count()
    I.add_batch(parts[0], 9, new)
    assert rows(I.gold_daily(I.read_state(spark, new), dim)) == rows(G.gold_daily(whole.unionByName(parts[0]), dim))


def test_a_batch_of_one_day_writes_one_partition(spark, tmp_path):
    parts, _ = batches(spark)
    state = str(tmp_path / "state")
    I.add_batch(parts[0], 0, state)
    before = {f: os.stat(f).st_mtime_ns for f in files(state)}
    time.sleep(0.05)
    day = S.silver(bronze(spark, [(1, "NO2", "2024-01-02", h, 1.0) for h in range(1, 25)]))
    I.add_batch(day, 1, state)
    new = files(state) - set(before)
    assert {f: os.stat(f).st_mtime_ns for f in files(state) & set(before)} == before
    assert {os.path.relpath(os.path.dirname(f), state) for f in new} == {"obs_date=2024-01-02/batch_id=1"}


def test_partitioned_writes_make_one_file_for_a_small_partition(spark, tmp_path):
    rows = spark.range(3000).repartition(16).select("id", (F.col("id") % 5).alias("p"))
    sinks.overwrite(rows, str(tmp_path / "t"), ["p"])
    assert len(files(tmp_path / "t")) == 5
    sinks.upsert_partitions(spark, str(tmp_path / "t"), rows.filter("p < 2").repartition(16), ["id"], "p", ("id",))
    assert len(files(tmp_path / "t")) == 5 and spark.read.parquet(str(tmp_path / "t")).count() == 3000


def test_replayed_records_count_once_and_none_is_late(spark, tmp_path):
    rows = [(1, "NO2", "2024-01-01", h, float(h)) for h in range(1, 11)]
    old = [(1, "NO2", "2009-01-01", 1, 3.0)]
    first = bronze(spark, rows)
    steps = [first, first.withColumn("_source_file", F.lit("again.json")), bronze(spark, old + [(1, "NO2", "2024-01-01", 3, 99.0)])]
    src, ck = str(tmp_path / "bronze"), str(tmp_path / "ck")
    columns = [f.name for f in J.BRONZE_SCHEMA]
    for i, step in enumerate(steps):
        stamped = step.withColumns({"_ingested_at": (F.lit(dt.datetime(2024, 5, 1)) + F.expr(f"INTERVAL {i} DAY")).cast("timestamp"),
                                    "HourDescription": F.lit(None).cast("string")})
        stamped.select(*columns).write.mode("append").parquet(src)
        J.stream_silver(spark, src, str(tmp_path / "silver"), str(tmp_path / "q"), ck, dedup_within="7 days")
    got = spark.read.parquet(str(tmp_path / "silver"))
    assert got.count() == 12 and got.filter("obs_date < '2010-01-01'").count() == 1
    assert got.filter("hour_1based = 3 AND obs_date > '2010-01-01'").count() == 2    # another value is another record


def test_streamed_runs_are_the_batch_runs_that_have_ended(spark):
    rng = random.Random(5)
    series = {}
    for site in (1, 2):
        values = []
        while len(values) < 300:
            values += [None] * rng.choice([0, 0, 0, 1, 4]) + [rng.choice([1.0, 2.0])] * rng.randrange(1, 7)
        series[(site, "NO2")] = values
    f = fact(spark, series).cache()
    out, ck = J.run_dir(spark, "t"), J.run_dir(spark, "t")
    for rows in J.arrivals(spark, f.select("site_id", "parameter_code", "obs_time", "obs_date", "value_clean"), 5, "t"):
        J.stream_sessions(rows, ["site_id", "parameter_code", "value_clean"], [], out, ck, 2)
    got = sorted((r["site_id"], r["value_clean"], r["run_start"], r["run_end"], r["run_rows"]) for r in spark.read.parquet(out).collect())
    last = f.agg(F.max("obs_time")).first()[0]
    want = sorted((r["site_id"], r["stuck_value"], r["run_start"], r["run_end"], r["hours_stuck"])
                  for r in AN.flatline_runs(f, min_rows=2, method="time").collect() if r["run_end"] <= last - dt.timedelta(hours=3, minutes=30))
    assert got == want and len(want) > 50


def test_stream_arrivals_of_nothing(spark):
    empty = spark.createDataFrame([], "obs_date date, v int")
    assert list(J.arrivals(spark, empty, 3, "t")) == []
    with pytest.raises(Exception):
        spark.read.parquet(J.run_dir(spark, "none"))


def test_open_runs_alone_are_kept_between_batches(spark, monkeypatch):
    """Runs go on over batches and starts, rows that come too late are dropped, peaks
    are of the whole run, and a batch keeps what is open, not what it has read."""
    monkeypatch.setattr(J, "tasks_for", lambda df: 3)
    values = [5.0] * 7 + [1.0, 2.0] * 100 + [9.0] * 6
    f = fact(spark, {(s, "NO2"): values for s in (1, 2)}).withColumn("load", F.hour("obs_time").cast("long"))
    columns = ["site_id", "parameter_code", "obs_time", "obs_date", "value_clean", "load"]
    hours = F.timestamp_diff("HOUR", F.lit("2024-01-01").cast("timestamp_ntz"), F.col("obs_time"))
    path, out, ck = (J.run_dir(spark, "t") for _ in range(3))
    late = f.filter(hours < 3).withColumn("value_clean", F.lit(3.0))
    for step in (f.filter(hours < 4), f.filter(hours.between(4, 209)), late, f.filter(hours > 209)):
        step.select(*columns).coalesce(1).write.mode("append").parquet(path)
        rows = spark.readStream.schema(step.select(*columns).schema).parquet(path)
        J.stream_sessions(rows, ["site_id", "parameter_code", "value_clean"], [("peak", "load", F.max)], out, ck, 2)
    got = sorted((r["site_id"], r["value_clean"], r["run_rows"], r["peak"]) for r in spark.read.parquet(out).collect())
    assert got == [(1, 5.0, 7, 6), (2, 5.0, 7, 6)]
    kept = [spark.read.parquet(f"{ck}/open_runs/{i}") for i in range(4)]
    assert [k.count() for k in kept] == [2, 4, 4, 2] and kept[3].first()["run_rows"] == 6
