"""Adapters: sensor-observation records derived from the supplied tables.

No sensor data is supplied, so the raw observation model is derived, row for
row, from whole tables (every row of the source becomes one record; nothing
is sampled or capped):

* ``hourly_records``  — from ``events``: one hourly reading per event over nine
  parameters (pollutants and weather), with NULL sites, unparseable dates,
  out-of-range hours, NULL values, implausible negatives and duplicate grain
  keys seeded by deterministic rules on ``event_id``.
* ``long_records``    — from ``lineitem``: multi-year pollutant readings, one
  station per supplier, for monthly / yearly / seasonal analyses.
* ``dense_records``   — from ``lineitem``: one pollutant series per supplier, an
  hour per row, with shocks at one, some or most stations, stuck readings and
  gaps, so that the detectors meet every case; stations grow with the data.
* ``station_details`` — from ``supplier ⋈ nation ⋈ region``: one station per
  supplier, with mixed-case region names and some NULL coordinates.

The records have the raw API shape (``Site_Id``, nested ``Parameter`` struct,
string ``Date``, 1-based ``Hour``, ``Value``) plus bronze provenance columns,
so the bronze → silver code path is the one real raw files take.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourglass.sources.tables import table, tasks_for

# Fixed values of the hourly adapter: parameter code and units by event_id % 9.
HOURLY_PARAMETERS = [
    ("PM2.5", "ug/m3"), ("PM10", "ug/m3"), ("NO2", "pphm"), ("OZONE", "pphm"),
    ("TEMP", "degC"), ("HUMID", "%"), ("WSP", "m/s"), ("WDR", "deg"), ("RAIN", "mm"),
]
# Fixed values of the long adapter: parameter by (l_returnflag, l_linestatus).
LONG_PARAMETERS = [("AF", "PM2.5", "ug/m3"), ("NF", "PM10", "ug/m3"),
                   ("NO", "NO2", "pphm"), ("RF", "OZONE", "pphm")]
HOURLY_SITES = 8          # site_id = user_id % 8 + 1
FREQUENCY = "Hourly average"


def _case(key: Column, pairs: list[tuple], default=None) -> Column:
    expr = None
    for k, v in pairs:
        expr = F.when(key == k, v) if expr is None else expr.when(key == k, v)
    return expr.otherwise(default) if default is not None else expr


def _aqi(value: Column) -> Column:
    return F.when(value < 20, "GOOD").when(value < 60, "FAIR").otherwise("POOR")


def hourly_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped hourly records, one per row of ``events``."""
    e = table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value", "props"])
    p = (F.col("event_id") % 9).cast("int")
    code = _case(p, [(i, c) for i, (c, _) in enumerate(HOURLY_PARAMETERS)])
    units = _case(p, [(i, u) for i, (_, u) in enumerate(HOURLY_PARAMETERS)])
    v = F.col("value")
    measured = (F.when(p < 4, F.when(F.col("event_id") % 59 == 0, -v).otherwise(v - 5.0))
                 .when(p == 4, v / 10.0 - 2.0)
                 .when(p == 5, v * 3.0)
                 .when(p == 6, v / 10.0)
                 .when(p == 7, (v * 7.0) % 360.0)
                 .otherwise(F.greatest(v - 30.0, F.lit(0.0))))
    site = F.when(F.col("event_id") % 97 == 0, F.lit(None).cast("int")) \
            .otherwise((F.col("user_id") % HOURLY_SITES + 1).cast("int"))
    hour = F.when(F.col("event_id") % 89 == 0, F.lit(25)).otherwise(F.hour("ts") + 1).cast("int")
    date = F.when(F.col("event_id") % 101 == 0, F.lit("n/a")) \
            .otherwise(F.col("ts").cast("date").cast("string"))
    value = F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("double")).otherwise(measured)
    return e.select(
        site.alias("Site_Id"),
        F.struct(code.alias("ParameterCode"), units.alias("Units"),
                 F.lit(FREQUENCY).alias("Frequency")).alias("Parameter"),
        date.alias("Date"),
        hour.alias("Hour"),
        value.alias("Value"),
        F.when(p < 4, _aqi(value)).alias("AirQualityCategory"),
        # fields outside the record schema are kept, as JSON text
        F.col("props").alias("_rescued_data"),
        F.timestamp_add("HOUR", F.lit(1), F.col("ts")).alias("_ingested_at"),
        F.concat(F.lit("site"), F.coalesce(site.cast("string"), F.lit("x")), F.lit("_"),
                 F.translate(code, ".", "_"), F.lit("_"),
                 F.year("ts").cast("string"), F.lit(".json")).alias("_source_file"),
        F.col("event_id").alias("_record_id"),
    )


def long_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped multi-year records, one per row of ``lineitem``."""
    li = table(spark, sf_dir, "lineitem",
               ["l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag",
                "l_linestatus", "l_shipdate"])
    flag = F.concat(F.col("l_returnflag"), F.col("l_linestatus"))
    code = _case(flag, [(f, c) for f, c, _ in LONG_PARAMETERS], "OZONE")
    units = _case(flag, [(f, u) for f, _, u in LONG_PARAMETERS], "pphm")
    value = F.col("l_quantity") - 3.0
    site = (F.col("l_suppkey") + 1).cast("int")
    return li.select(
        site.alias("Site_Id"),
        F.struct(code.alias("ParameterCode"), units.alias("Units"),
                 F.lit(FREQUENCY).alias("Frequency")).alias("Parameter"),
        F.col("l_shipdate").cast("date").cast("string").alias("Date"),
        ((F.col("l_orderkey") % 24) + 1).cast("int").alias("Hour"),
        value.alias("Value"),
        _aqi(value).alias("AirQualityCategory"),
        F.lit(None).cast("string").alias("_rescued_data"),
        F.timestamp_add("DAY", F.lit(1), F.col("l_shipdate")).alias("_ingested_at"),
        F.concat(F.lit("site"), site.cast("string"), F.lit("_"),
                 F.translate(code, ".", "_"), F.lit("_"),
                 F.year("l_shipdate").cast("string"), F.lit(".json")).alias("_source_file"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("_record_id"),
    )


# Fixed values of the dense adapter: first hour, and pollutant by l_suppkey % 4.
DENSE_START = "2023-02-01"
DENSE_PARAMETERS = [("PM2.5", "ug/m3"), ("PM10", "ug/m3"), ("NO2", "pphm"), ("OZONE", "pphm")]


def dense_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped records, one per row of ``lineitem``: the supplier's rows in
    order are its station's hours. With ``k = l_suppkey div 4`` a station has

    * every hour; every third if ``k % 5 = 4``; four of five if ``k % 5 = 3``;
    * ten equal readings in every 200 if ``k % 10`` is 2 (7.0) or 5 (-1.0);
    * a shock of four hours in every 150 at all stations, one at a third of
      them (``k % 3 = 0``), one of an hour at ``k = 1``, and one hour in 40 at
      ``k % 10 = 7``.

    The rows come partitioned by station, in tasks of a fixed number of rows:
    what groups or windows series after it needs no other shuffle."""
    li = table(spark, sf_dir, "lineitem",
               ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"])
    tasks = tasks_for(li)
    li = li.withColumn("site", (F.col("l_suppkey") + 1).cast("int")).repartition(tasks, "site")
    order = Window.partitionBy("site").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
    li = li.withColumn("n", F.row_number().over(order) - 1).withColumn("k", F.floor(F.col("l_suppkey") / 4))
    n, k, site = F.col("n"), F.col("k"), F.col("site")
    code = _case(F.col("l_suppkey") % 4, [(i, c) for i, (c, _) in enumerate(DENSE_PARAMETERS)])
    units = _case(F.col("l_suppkey") % 4, [(i, u) for i, (_, u) in enumerate(DENSE_PARAMETERS)])
    hour = F.when(k % 5 == 4, n * 3).when(k % 5 == 3, n + F.floor(n / 4)).otherwise(n).cast("int")
    shock = (F.when((n % 150).between(100, 103), 400.0).when((n % 150).between(60, 63) & (k % 3 == 0), 400.0)
              .when((n % 150 == 30) & (k == 1), 400.0).when((n % 40 == 20) & (k % 10 == 7), 1500.0).otherwise(0.0))
    stuck = (n % 200).between(150, 159)
    value = F.when(stuck & (k % 10 == 2), 7.0).when(stuck & (k % 10 == 5), -1.0).otherwise(F.col("l_quantity") + shock)
    at = F.timestamp_add("HOUR", hour, F.lit(DENSE_START).cast("timestamp_ntz"))
    # A generator of one row: filters on what is made of these columns stay above it. Below
    # it each use in a filter would be worked out anew, in code too long to be compiled.
    li = li.select("*", F.inline(F.array(F.struct(at.alias("at"), value.alias("value")))))
    at, value = F.col("at"), F.col("value")
    return li.select(
        site.alias("Site_Id"),
        F.struct(code.alias("ParameterCode"), units.alias("Units"), F.lit(FREQUENCY).alias("Frequency")).alias("Parameter"),
        at.cast("date").cast("string").alias("Date"), (F.hour(at) + 1).cast("int").alias("Hour"), value.alias("Value"),
        _aqi(value).alias("AirQualityCategory"), F.lit(None).cast("string").alias("_rescued_data"),
        F.timestamp_add("HOUR", F.lit(1), at).alias("_ingested_at"),
        F.concat(F.lit("site"), site.cast("string"), F.lit("_"), F.translate(code, ".", "_"), F.lit("_"),
                 F.year(at).cast("string"), F.lit(".json")).alias("_source_file"),
        (F.col("l_suppkey") * 10_000_000 + n).alias("_record_id"))


def sentinel_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dense records, but a series begins with 99,999 at every third station
    and with 9,999 twice at the next ones: a start-up sentinel far from where the
    series stays."""
    n, third = F.col("_record_id") % 10_000_000, (F.col("Site_Id") - 1) % 3
    return dense_records(spark, sf_dir).withColumn(
        "Value", F.when((third == 0) & (n == 0), 99_999.0).when((third == 1) & (n < 2), 9_999.0).otherwise(F.col("Value")))


def station_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw station details (``Site_Id, SiteName, Region, Latitude, Longitude``),
    one per supplier; region names arrive upper-case and are normalised by
    the dimension loader."""
    s = table(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    n = table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    r = table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    geo = (s.join(n, s.s_nationkey == n.n_nationkey, "inner")
            .join(r, F.col("n_regionkey") == r.r_regionkey, "inner"))
    return geo.select(
        (F.col("s_suppkey") + 1).cast("int").alias("Site_Id"),
        F.upper(F.col("s_name")).alias("SiteName"),
        F.col("r_name").alias("Region"),
        F.when(F.col("s_suppkey") % 7 == 3, F.lit(None).cast("double"))
         .otherwise(-30.0 - (F.col("s_suppkey") % 100) / 50.0).alias("Latitude"),
        (150.0 + F.col("n_nationkey") / 10.0).cast("double").alias("Longitude"),
    )
