"""Silver rules on the FIXTURES.md edge rows."""

import datetime as dt

from fixtures import bronze
from hourglass.operators import silver as S
from hourglass.operators import gold as G


def _by_id(df):
    return {r["_record_id"]: r for r in df.collect()}


def test_hour_mapping_and_rejects(spark):
    b = bronze(spark, [(1, "PM2.5", "2024-01-05", 1, 5.0), (1, "PM2.5", "2024-01-05", 24, 5.0),
                       (1, "PM2.5", "2024-01-05", 0, 5.0), (1, "PM2.5", "2024-01-05", 25, 5.0),
                       (1, "PM2.5", "2024-01-05", None, 5.0)])
    tagged = _by_id(S.reject_reason(S.clean(S.flatten(b), 1)))
    assert tagged[0]["obs_time"] == dt.datetime(2024, 1, 5, 0, 0)
    assert tagged[1]["obs_time"] == dt.datetime(2024, 1, 5, 23, 0)
    assert [tagged[i]["reject_reason"] for i in range(5)] == [None, None, "hour_out_of_range",
                                                             "hour_out_of_range", "hour_out_of_range"]
    kept = S.silver(b)
    assert sorted(r["_record_id"] for r in kept.collect()) == [0, 1]


def test_cleaning_gen2_and_gen1(spark):
    b = bronze(spark, [(1, "PM2.5", "2024-01-05", 3, -3.5), (1, "TEMP", "2024-01-05", 3, -3.5),
                       (1, "PM2.5", "2024-01-05", 4, -20.0), (1, "PM2.5", "2024-01-05", 5, -20.1)])
    g2 = _by_id(S.silver(b))
    assert g2[0]["below_detection"] is True and g2[0]["value_clean"] == 0.0
    assert g2[1]["below_detection"] is None and g2[1]["value_clean"] == -3.5
    assert set(g2) == {0, 1, 2, 3}                     # Gen 2 keeps both -20.0 and -20.1
    m = {r["expectation"]: r for r in S.expectation_metrics(S.flatten(b)).collect()}
    assert m["above_detection_floor"]["failed_records"] == 2   # both violate the tracked rule
    g1 = _by_id(S.reject_reason(S.clean(S.flatten(b), 1)))
    assert g1[2]["reject_reason"] is None and g1[3]["reject_reason"] == "implausible_negative"
    assert g1[1]["value_clean"] == 0.0                 # Gen 1 floors everything


def test_null_fields_and_rule_order(spark):
    b = bronze(spark, [(1, "NO2", "2024-01-05", 3, None), (None, "NO2", "2024-01-05", 3, 1.0),
                       (1, "NO2", "garbage", 3, 1.0), (None, "NO2", "garbage", 30, None)])
    t = _by_id(S.reject_reason(S.flatten(b)))
    assert [t[i]["reject_reason"] for i in range(4)] == ["null_value", "null_site", "null_date", "null_site"]


def test_dedup_keeps_latest(spark):
    b = bronze(spark, [(1, "NO2", "2024-01-05", 3, 1.0, 0, 10), (1, "NO2", "2024-01-05", 3, 2.0, 5, 11),
                       (1, "NO2", "2024-01-05", 3, 3.0, 1, 12)])
    d = S.dedup(S.silver(b)).collect()
    assert len(d) == 1 and d[0]["value"] == 2.0


def test_dedup_hot_key_many_copies(spark):
    rows = [(1, "NO2", "2024-01-05", 3, float(i), i % 7, i) for i in range(5000)]
    d = S.dedup(S.silver(bronze(spark, rows))).collect()
    assert len(d) == 1 and d[0]["_record_id"] == 4999 - ((4999 - 6) % 7)


def test_humidity_in_wide(spark):
    b = bronze(spark, [(1, "HUMID", "2024-01-05", h + 1, v) for h, v in enumerate([113.8, 100.0, 0.0, -1.0])])
    s = S.silver(b)
    assert s.count() == 4
    wide = {r["obs_hour"]: r["humidity"] for r in G.hourly_wide(s).collect()}
    assert wide == {0: None, 1: 100.0, 2: 0.0, 3: None}


def test_station_dimension(spark):
    rows = [(1, "Supplier#1", "NORTH COAST", -33.0, 151.0), (2, "b", "north west", None, 151.0),
            (3, "c", "Hunter", -32.0, 151.0)]
    d = spark.createDataFrame(rows, "Site_Id int, SiteName string, Region string, Latitude double, Longitude double")
    out = {r["site_id"]: r for r in G.dim_station(d).collect()}
    assert set(out) == {1, 3} and out[1]["region"] == "North Coast"
    assert {r["site_id"] for r in G.dim_station(d, region_prefix="north c").collect()} == {1}


def test_stations_without_data(spark):
    dim = spark.createDataFrame([(1, "a", "r"), (2, "b", "r")], "site_id int, site_name string, region string")
    seen = spark.createDataFrame([(1,)], "site_id int")
    assert [r["site_id"] for r in dim.join(seen, "site_id", "left_anti").collect()] == [2]


def test_reconciliation_balances(spark):
    from hourglass.operators import quality as Q
    b = bronze(spark, [(1, "NO2", "2024-01-05", 3, 1.0), (1, "NO2", "2024-01-05", 3, 2.0),
                       (None, "NO2", "2024-01-05", 3, 1.0), (1, "NO2", "2024-01-05", 4, None)])
    tagged = S.reject_reason(S.clean(S.flatten(b), 1))
    r = Q.reconciliation(tagged).first()
    assert (r["bronze"], r["silver"], r["quarantine"], r["duplicates"], r["balanced"]) == (4, 1, 2, 1, True)
