"""Hand-built inputs covering the edge rows listed in FIXTURES.md."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hourglass.sources.raw_json import PARAMETER_STRUCT

BRONZE = T.StructType([
    T.StructField("Site_Id", T.IntegerType()), T.StructField("Parameter", PARAMETER_STRUCT),
    T.StructField("Date", T.StringType()), T.StructField("Hour", T.IntegerType()),
    T.StructField("Value", T.DoubleType()), T.StructField("AirQualityCategory", T.StringType()),
    T.StructField("_rescued_data", T.StringType()), T.StructField("_ingested_at", T.TimestampNTZType()),
    T.StructField("_source_file", T.StringType()), T.StructField("_record_id", T.LongType())])

UNITS = {"PM2.5": "ug/m3", "PM10": "ug/m3", "NO2": "pphm", "OZONE": "pphm", "TEMP": "degC",
         "HUMID": "%", "WSP": "m/s", "WDR": "deg", "RAIN": "mm"}
T0 = dt.datetime(2024, 1, 1)


def bronze(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """rows: (site, code, date, hour, value[, ingested_offset_h, record_id])."""
    out = []
    for i, r in enumerate(rows):
        site, code, date, hour, value = r[:5]
        ing = T0 + dt.timedelta(hours=r[5] if len(r) > 5 else 0)
        rid = r[6] if len(r) > 6 else i
        out.append((site, (code, UNITS.get(code, "x"), "Hourly average"), date, hour, value, None, None, ing,
                    f"site{site}_{code}_2024.json", rid))
    return spark.createDataFrame(out, BRONZE)


FACT = T.StructType([
    T.StructField("site_id", T.IntegerType()), T.StructField("parameter_code", T.StringType()),
    T.StructField("obs_time", T.TimestampNTZType()), T.StructField("obs_date", T.DateType()),
    T.StructField("obs_hour", T.IntegerType()), T.StructField("value", T.DoubleType()),
    T.StructField("value_clean", T.DoubleType())])


def fact(spark: SparkSession, series: dict[tuple[int, str], list[float | None]], start: dt.datetime = T0,
         skip_hours: set[int] | None = None) -> DataFrame:
    """Hourly series per (site, parameter); list index = hour offset; None or
    an index in ``skip_hours`` leaves that hour missing."""
    rows = []
    for (site, code), vals in series.items():
        for h, v in enumerate(vals):
            if v is None or (skip_hours and h in skip_hours):
                continue
            t = start + dt.timedelta(hours=h)
            rows.append((site, code, t, t.date(), t.hour, float(v), max(float(v), 0.0)))
    return spark.createDataFrame(rows, FACT)
