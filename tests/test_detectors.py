"""Detector semantics on hand-built series (FIXTURES.md), and equality of
the two physical plans (window frames vs chunked prefix sums)."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fixtures import T0, fact
from hourglass.operators import anomaly as AN
from hourglass.operators import events as EV
from hourglass.operators.sequence import sequence


@pytest.mark.parametrize("chunk_rows", [None, 200])
def test_short_constant_and_spike(spark, chunk_rows):
    f = fact(spark, {(1, "NO2"): [5.0], (2, "NO2"): [5.0, 6.0], (3, "NO2"): [5.0, 6.0, 7.0],
                     (4, "NO2"): [3.0] * 6, (5, "NO2"): [10, 11, 10, 11, 10, 11, 10, 11, 500]})
    a = {(r["site_id"], r["obs_time"]): r for r in AN.observation_anomaly(f, chunk_rows=chunk_rows).collect()}
    at = lambda s, h: a[(s, T0 + dt.timedelta(hours=h))]
    assert at(1, 0)["roll_sd"] is None and at(1, 0)["anomaly_class"] == "insufficient_history"
    assert at(2, 1)["roll_sd"] is None                       # one previous row: sd undefined
    assert at(3, 2)["roll_sd"] == pytest.approx(0.707, abs=1e-3)
    assert all(at(4, h)["anomaly_class"] == "insufficient_history" for h in range(6))   # sd == 0
    assert at(4, 5)["roll_sd"] == 0.0
    assert at(5, 8)["anomaly_class"] == "extreme"
    assert at(5, 3)["hourly_delta"] == 1.0


@pytest.mark.parametrize("chunk_rows", [None, 4])
def test_strict_thresholds(spark, chunk_rows):
    # previous rows 0, 1, 2: mean 1, sample sd 1 (exact); readings at z = 3 and z = 5 exactly
    f = fact(spark, {(1, "NO2"): [0.0, 1.0, 2.0, 4.0], (2, "NO2"): [0.0, 1.0, 2.0, 6.0]})
    a = {r["site_id"]: (r["z_score"], r["anomaly_class"]) for r in AN.observation_anomaly(f, window=3, chunk_rows=chunk_rows)
         .filter(F.col("obs_hour") == 3).collect()}
    assert a == {1: (3.0, "normal"), 2: (5.0, "unusual")}


def test_whole_series_equal_chunks_on_data(spark, sf_dir):
    from hourglass.plans.context import Pipeline
    p = Pipeline(spark, sf_dir)
    for f in (p.fact1, p.fact_with_nulls):
        x, y = AN.observation_anomaly(f), AN.observation_anomaly(f, chunk_rows=169)
        assert sorted(map(str, x.collect())) == sorted(map(str, y.collect()))
    sx = AN.threshold_sweep(p.fact1).orderBy("window_hours", "z_threshold").collect()
    sy = AN.threshold_sweep(p.fact1, chunk_rows=800).orderBy("window_hours", "z_threshold").collect()
    assert sx == sy


def windowed(spark, f, window):
    """The definition: AVG and STDDEV over the frame."""
    w = Window.partitionBy("site_id", "parameter_code").orderBy("obs_time").rowsBetween(-window, -1)
    return f.select("site_id", "obs_time", F.avg("value_clean").over(w).alias("m"), F.stddev("value_clean").over(w).alias("s"))


@pytest.mark.parametrize("chunk_rows", [None, 7, 25, 1000])
def test_hot_series_with_nulls_gaps_and_constant_stretches(spark, chunk_rows):
    vals = [float((h * 7919) % 101) if h % 50 else 42.0 for h in range(24 * 40)]
    for h in range(500, 540):
        vals[h] = 13.1                                   # a constant stretch
    for h in [0, 1, 2, *range(100, 140), *range(505, 560, 3), *range(0, 960, 11)]:
        vals[h] = None
    f = fact(spark, {(1, "PM10"): vals, (2, "PM10"): [None, 4.2, None, 4.2, 4.2, 5.0, None, None, None, 5.0]},
             skip_hours={h for h in range(5, 24 * 40, 37)})
    for window in (1, 4, 6):
        got = {(r["site_id"], r["obs_time"]): (r["roll_mean"], r["roll_sd"]) for r in
               AN.trailing_baseline(f, [window, 2], chunk_rows=chunk_rows).filter(F.col("window_rows") == window).collect()}
        for r in windowed(spark, f, window).collect():
            m, sd = got[r["site_id"], r["obs_time"]]
            assert m == (None if r["m"] is None else pytest.approx(r["m"], abs=1e-9))
            assert sd == (None if r["s"] is None else 0.0 if r["s"] < 1e-12 else pytest.approx(r["s"], abs=1e-7))


def test_no_job_runs_while_the_plan_is_built(spark, sf_dir):
    from hourglass.plans.context import Pipeline
    sc = spark.sparkContext
    sc.setJobGroup("planning", "planning")
    try:
        AN.observation_anomaly(Pipeline(spark, sf_dir).fact1)
        AN.threshold_sweep(Pipeline(spark, sf_dir).fact1)
        assert not sc.statusTracker().getJobIdsForGroup("planning")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_sequence_index_and_prev(spark):
    f = fact(spark, {(1, "NO2"): [1.0, 1.0, 2.0, 2.0, 2.0, 1.0] * 200}, start=dt.datetime(2024, 1, 28))
    s = sequence(f, ["site_id", "parameter_code"], "obs_time", F.trunc(F.col("obs_date"), "month"),
                 sums=("value",), lags=("value",), runs_of="value").orderBy("obs_time").collect()
    assert [r["_idx"] for r in s] == list(range(1200))
    pre = 0.0
    for i, r in enumerate(s):
        assert r["_pre_value"] == pre
        pre += r["value"]
        assert r["_prev_value"] == (s[i - 1]["value"] if i else None)
    assert s[-1]["_run"] == 3 + 199 * 2     # later blocks open with 1,1 and extend the previous 1


@pytest.mark.parametrize("method", ["window", "chunked"])
def test_flatline_runs(spark, method):
    base = [1.0, 2.0] + [4.1] * 5 + [7.0] + [4.1] * 6 + [8.0]
    f = fact(spark, {(1, "PM10"): base}, skip_hours={10})   # a missing hour inside the 6-run
    out = AN.flatline_runs(f, value="value", min_rows=5, method=method).orderBy("run_start").collect()
    assert [r["hours_stuck"] for r in out] == [5, 5]     # the hole leaves 5 present rows
    out6 = AN.flatline_runs(f, value="value", min_rows=6, method=method).collect()
    assert out6 == []


def test_flatline_raw_excludes_zero(spark):
    f = fact(spark, {(1, "PM10"): [0.0] * 8 + [3.0] * 6})
    assert [r["stuck_value"] for r in AN.flatline_runs(f, value="value", min_rows=6, exclude_zero=True).collect()] == [3.0]
    assert len(AN.flatline_runs(f, min_rows=6).collect()) == 2


def _state(spark, rows):
    return spark.createDataFrame(rows, "obs_time timestamp_ntz, parameter_code string, stations_reporting long, "
                                       "stations_anomalous long, stations_extreme long, network_mean double, "
                                       "network_max double, network_mean_z double")


def test_event_classes(spark):
    t = [T0 + dt.timedelta(hours=h) for h in range(6)]
    st = _state(spark, [(t[0], "PM10", 2, 2, 0, 1.0, 1.0, 0.0), (t[1], "PM10", 8, 0, 0, 1.0, 1.0, 0.0),
                        (t[2], "PM10", 8, 1, 0, 1.0, 1.0, 0.0), (t[3], "PM10", 8, 2, 0, 1.0, 1.0, 0.0),
                        (t[4], "PM10", 8, 4, 0, 1.0, 1.0, 0.0), (t[5], "PM10", 3, 1, 0, 1.0, 1.0, 0.0)])
    c = [r["event_class"] for r in EV.hourly_classification(st).orderBy("obs_time").collect()]
    assert c == ["insufficient_network", "quiet", "isolated_fault", "widespread", "network_wide", "isolated_fault"]


@pytest.mark.parametrize("method", ["window", "chunked"])
def test_episodes_min_length(spark, method):
    t = [T0 + dt.timedelta(hours=h) for h in range(8)]
    flags = [4, 4, 0, 4, 4, 4, 0, 0]
    st = _state(spark, [(t[i], "PM10", 8, a, 0, 1.0, 2.0, 0.0) for i, a in enumerate(flags)])
    ev = EV.air_quality_event(EV.hourly_classification(st), method=method).collect()
    assert len(ev) == 1 and ev[0]["duration_hours"] == 3 and ev[0]["event_start"] == t[3]


def test_network_state_counts_distinct_sites(spark):
    a = spark.createDataFrame(
        [(1, "PM10", T0, 5.0, 4.0, "extreme"), (2, "PM10", T0, 3.0, 1.0, "normal"),
         (3, "PM10", T0, 9.0, 3.5, "unusual"), (4, "PM10", T0, 1.0, None, "insufficient_history")],
        "site_id int, parameter_code string, obs_time timestamp_ntz, value_clean double, z_score double, "
        "anomaly_class string")
    r = EV.hourly_network_state(a).first()
    assert (r["stations_reporting"], r["stations_anomalous"], r["stations_extreme"]) == (3, 2, 1)
    assert r["network_max"] == 9.0 and r["network_mean_z"] == pytest.approx(2.83, abs=1e-2)


def test_sensor_health_boundaries(spark):
    # Feb 2020: 696 expected readings, Feb 2021: 672
    a = spark.createDataFrame(
        [(1, "PM10", dt.date(2020, 2, 1), 1.0, "normal")] * 348 + [(2, "PM10", dt.date(2021, 2, 1), 1.0, "normal")] * 605
        + [(3, "PM10", dt.date(2021, 2, 1), 1.0, "extreme")] * 13 + [(3, "PM10", dt.date(2021, 2, 1), 1.0, "normal")] * 637,
        "site_id int, parameter_code string, obs_date date, value_clean double, anomaly_class string")
    h = {r["site_id"]: r for r in AN.sensor_health(a).collect()}
    assert h[1]["expected_readings"] == 696 and h[2]["expected_readings"] == 672
    assert h[1]["completeness_pct"] == 50.0 and h[1]["health_status"] == "gappy"     # 50 is not poor
    assert h[2]["health_status"] == "healthy"                                          # 605/672 = 90.03
    assert h[3]["extreme_pct"] == 2.0 and h[3]["health_status"] == "healthy"           # exactly 2 %: not suspect


def test_seasonal_option(spark):
    f = fact(spark, {(1, "PM10"): [1.0, 2.0, 3.0]}, start=dt.datetime(2020, 1, 1)).unionByName(
        fact(spark, {(1, "PM10"): [10.0, 20.0, 30.0]}, start=dt.datetime(2021, 1, 1)))
    all_years = {r["obs_time"].year: r for r in AN.seasonal_anomaly(f).filter("obs_hour = 0").collect()}
    assert all_years[2020]["seasonal_mean"] == pytest.approx(11.0)
    other = {r["obs_time"].year: r for r in AN.seasonal_anomaly(f, exclude_current_year=True)
             .filter("obs_hour = 0").collect()}
    assert other[2020]["seasonal_mean"] == 20.0 and other[2021]["seasonal_mean"] == 2.0


def test_runs_window_equals_chunked(spark, sf_dir):
    from hourglass.plans.context import Pipeline
    f = Pipeline(spark, sf_dir).fact1
    a = AN.flatline_runs(f, min_rows=2, method="window").collect()
    b = AN.flatline_runs(f, min_rows=2, method="chunked").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_time_frame_option(spark):
    # readings at hours 0,1,2 then a 10-hour gap: a 3-hour time window sees nothing before hour 12
    f = fact(spark, {(1, "NO2"): [1.0, 2.0, 3.0] + [None] * 9 + [10.0, 11.0]})
    rows = {r["obs_hour"]: r for r in AN.observation_anomaly(f, window=3, frame="time").collect()}
    assert rows[12]["roll_mean"] is None and rows[13]["roll_mean"] == 10.0
    by_rows = {r["obs_hour"]: r for r in AN.observation_anomaly(f, window=3).collect()}
    assert by_rows[12]["roll_mean"] == 2.0                 # rows frame reaches back over the gap


def test_time_strict_runs(spark):
    f = fact(spark, {(1, "PM10"): [4.0] * 8}, skip_hours={4})
    rows_mode = AN.flatline_runs(f, value="value", min_rows=2, method="window").collect()
    time_mode = AN.flatline_runs(f, value="value", min_rows=2, method="time").collect()
    assert [r["hours_stuck"] for r in rows_mode] == [7]
    assert sorted(r["hours_stuck"] for r in time_mode) == [3, 4]


@pytest.mark.parametrize("method", ["window", "chunked", "time"])
def test_run_lengths_sum_to_rows(spark, sf_dir, method):
    from hourglass.plans.context import Pipeline
    f = Pipeline(spark, sf_dir).fact1
    runs_all = AN.flatline_runs(f, min_rows=1, method=method)
    assert runs_all.agg(F.sum("hours_stuck")).first()[0] == f.count()
