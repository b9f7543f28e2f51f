"""Every registered query against its SQL oracle (DuckDB) on the supplied
tables: row count, column names and an order-insensitive value hash."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck

# The training-data queries have tests of their own.
OWN = {k for k in E.queries() if not k.startswith("op") and k != "pipeline"}
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in OWN}
QUERIES = {k: v for k, v in E.queries().items() if k in OWN}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, sf_dir, name):
    r = compare(spark, con, QUERIES[name], ORACLE[name], sf_dir)
    assert r["cols_match"], r
    assert r["rows_spark"] == r["rows_oracle"], r
    assert r["hash_match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "daily_avg" in df.columns


@pytest.mark.parametrize("name", ["anomaly_episodes", "anomaly_episodes_chunked"])
def test_episode_islands_against_oracle_on_dense_data(spark, name):
    """At sf0.1 enough stations report per hour for episodes to exist; both
    island plans must reproduce the oracle's episodes exactly."""
    sf = "/root/testdata/sf0.1"
    r = compare(spark, duck(sf), QUERIES[name], ORACLE[name], sf)
    assert r["rows_spark"] == r["rows_oracle"] > 0 and r["hash_match"], r


def test_dense_data_makes_every_branch_fire(spark):
    """At sf0.01 every event class, health state and run type occurs, and no
    dense key compares nothing with nothing."""
    from hourglass import constants as K
    from hourglass.plans.context import Dense
    sf = "/root/testdata/sf0.01"
    p = Dense(spark, sf)
    seen = lambda df, c: {r[0] for r in df.select(c).distinct().collect()}
    assert seen(p.classification, "event_class") == set(K.EVENT_CLASSES)
    assert seen(p.health, "health_status") == {"poor_coverage", "suspect", "gappy", "healthy"}
    assert len(seen(QUERIES["dense_flatline_run_type"](spark, sf), "run_type")) == 2
    for name in ("dense_air_quality_event", "dense_episode_summary", "dense_sensor_flatline_raw", "dense_exceedance_events",
                 "dense_anomaly_episodes_chunked", "dense_threshold_sweep", "dense_sweep_ranked", "dense_month_daily_anomalies",
                 "dense_baseline_adaptation", "dense_flatline_time_chunked", "flatline_stream", "episodes_stream"):
        r = compare(spark, duck(sf), QUERIES[name], ORACLE[name], sf)
        assert r["rows_spark"] == r["rows_oracle"] > 0 and r["hash_match"], (name, r)
