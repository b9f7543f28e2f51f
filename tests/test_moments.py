"""Moments that merge: trailing baselines, leave-one-out norms and time chunks
against their definitions."""

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fixtures import T0, fact
from hourglass.operators import anomaly as AN
from hourglass.operators import moments as M


def framed(f, n):
    w = Window.partitionBy("site_id", "parameter_code").orderBy("obs_time").rowsBetween(-n, -1)
    return f.select("site_id", "obs_time", F.avg("value_clean").over(w).alias("m"), F.stddev("value_clean").over(w).alias("s"))


def close(a, b):
    return a == b if a is None or b is None else math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)


@pytest.mark.parametrize("first", [5.0, 9_999.0, 99_999.0, 1e12])
@pytest.mark.parametrize("chunk_rows", [None, 800])
def test_an_outlier_leaves_the_window_with_its_row(spark, first, chunk_rows):
    rng = random.Random(1)
    series = [first] + [round(5.0 + rng.randrange(5) / 100 + (0.1 if rng.random() < 0.01 else 0), 2) for _ in range(1200)]
    f = fact(spark, {(1, "NO2"): series}).cache()
    for n in (72, 168, 720, 5, 1):
        want = {r["obs_time"]: r for r in framed(f, n).collect()}
        got = AN.trailing_baseline(f, [n], chunk_rows=chunk_rows).collect()
        assert len(got) == len(want)
        for r in got:
            # the frame itself loses digits while the outlier is in it
            w = want[r["obs_time"]]
            assert close(r["roll_mean"], w["m"]), (n, r, w)
            if r["obs_time"] > T0 + dt.timedelta(hours=n):
                assert close(r["roll_sd"], w["s"]), (n, r, w)
    classes = {r["obs_time"]: r["anomaly_class"] for r in AN.observation_anomaly(f, chunk_rows=chunk_rows).collect()}
    exact = {}
    for i in range(169, len(series)):
        past = series[i - 168:i]
        z = abs(series[i] - statistics.fmean(past)) / statistics.stdev(past)
        exact[T0 + dt.timedelta(hours=i)] = "extreme" if z > 5 else "unusual" if z > 3 else "normal"
    assert {t: classes[t] for t in exact} == exact


def test_merge_of_parts_is_the_whole(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(40), rng.choice([None, 1e6 + rng.gauss(0, 0.01)])) for _ in range(800)]
    df = spark.createDataFrame(rows, "g int, v double")
    parts = df.groupBy("g").agg(M.aggregate("v").alias("y"))
    one = parts.agg(F.collect_list("y").alias("all")).withColumn("o", M.merge_all(F.col("all")))
    n, m, s = one.select("o.n", M.mean(M.fields("o")), M.sd(M.fields("o"))).first()
    values = [v for _, v in rows if v is not None]
    assert n == len(values) and math.isclose(m, statistics.fmean(values), rel_tol=1e-14)
    assert math.isclose(s, statistics.stdev(values), rel_tol=1e-7)


def test_leave_one_out_norm_keeps_its_digits(spark):
    rng = random.Random(3)
    rows = [(1, "NO2", T0.replace(year=y) + dt.timedelta(hours=h), (T0.replace(year=y) + dt.timedelta(hours=h)).date(), 1e6 + rng.gauss(0, 0.01))
            for y in (2020, 2021, 2022, 2023) for h in range(200)]
    rows.append((2, "NO2", T0, T0.date(), 3.0))
    f = spark.createDataFrame(rows, "site_id int, parameter_code string, obs_time timestamp_ntz, obs_date date, value_clean double")
    got = AN.seasonal_anomaly(f, exclude_current_year=True).collect()
    for r in got:
        others = [v for s, _, t, _, v in rows if s == r["site_id"] and t.year != r["obs_time"].year]
        if r["site_id"] == 2:
            assert r["seasonal_mean"] is None and r["seasonal_z"] is None
            continue
        assert abs(r["seasonal_mean"] - statistics.fmean(others)) < 6e-4
        assert abs(r["seasonal_z"] - (r["value_clean"] - statistics.fmean(others)) / statistics.stdev(others)) < 0.011
    assert len(got) == len(rows)


def gappy(spark):
    rng = random.Random(4)
    series = {}
    for site in (1, 2, 3):
        values, h = [], 0
        while h < 900:
            gap = rng.choice([0] * 30 + [1, 5, 200])
            values += [None] * gap + [rng.choice([1.0, 1.0, 2.0])] * rng.randrange(1, 6)
            h = len(values)
        series[(site, "NO2")] = values
    return fact(spark, series)


@pytest.mark.parametrize("chunk_hours", [24, 37, 2000])
def test_time_frames_by_chunks_equal_whole_series(spark, chunk_hours):
    f = gappy(spark).cache()
    rows = lambda **k: sorted(map(str, AN.trailing_baseline(f, [5, 24], frame="time", **k).collect()))
    assert rows() == rows(chunk_hours=chunk_hours)
    with pytest.raises(ValueError):
        AN.trailing_baseline(f, [25], frame="time", chunk_hours=24)


def test_time_runs_by_chunks_equal_whole_series(spark):
    f = gappy(spark).cache()
    rows = lambda m: sorted(map(str, AN.flatline_runs(f, min_rows=1, method=m).collect()))
    assert rows("time") == rows("time_chunked") and len(rows("time")) > 100
