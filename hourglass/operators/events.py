"""Network-wide event detection: hourly network state (D15), classification
(B21) and episodes (D16)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass import constants as K
from hourglass.functions.exprs import event_class, fixed, safe_div
from hourglass.operators.sequence import runs


def hourly_network_state(anomaly: DataFrame) -> DataFrame:
    """Per hour and parameter, stations reporting / anomalous / extreme,
    network mean, max and mean z, over rows with a baseline.

    Two partial aggregates instead of three COUNT(DISTINCT site) (which
    Catalyst would expand 3x): first per (hour, parameter, site), then per
    (hour, parameter). Exact with or without duplicate readings."""
    a = anomaly.filter(F.col("anomaly_class") != "insufficient_history")
    per_site = a.groupBy("obs_time", "parameter_code", "site_id").agg(
        F.max(F.col("anomaly_class").isin("unusual", "extreme").cast("int")).alias("anom"),
        F.max((F.col("anomaly_class") == "extreme").cast("int")).alias("ext"),
        F.sum("value_clean").alias("sv"), F.count("value_clean").alias("nv"),
        F.max("value_clean").alias("mx"), F.sum("z_score").alias("sz"), F.count("z_score").alias("nz"))
    return per_site.groupBy("obs_time", "parameter_code").agg(
        F.count(F.lit(1)).alias("stations_reporting"),
        F.sum("anom").cast("long").alias("stations_anomalous"),
        F.sum("ext").cast("long").alias("stations_extreme"),
        fixed(safe_div(F.sum("sv"), F.sum("nv")), 3).alias("network_mean"),
        fixed(F.max("mx"), 3).alias("network_max"),
        fixed(safe_div(F.sum("sz"), F.sum("nz")), 2).alias("network_mean_z"))


def hourly_classification(state: DataFrame, min_reporting: int = K.MIN_STATIONS_REPORTING,
                          localised: float = K.LOCALISED_FRACTION,
                          widespread: float = K.WIDESPREAD_FRACTION) -> DataFrame:
    """Anomalous fraction and event class (rule order matters)."""
    return state.select(
        "*",
        fixed(safe_div(F.col("stations_anomalous"), F.col("stations_reporting")), 3).alias("anomalous_fraction"),
        event_class(F.col("stations_reporting"), F.col("stations_anomalous"),
                    min_reporting, localised, widespread).alias("event_class"))


def air_quality_event(classification: DataFrame, min_hours: int = K.MIN_EPISODE_HOURS,
                      event_classes: tuple[str, ...] = ("widespread", "network_wide"),
                      method: str = "window") -> DataFrame:
    """Consecutive event hours (present rows) per parameter -> episodes
    of at least ``min_hours`` rows.

    The input has one row per hour and parameter, so its size is bounded by
    the time span (10 years ~ 88k rows per parameter) whatever the data
    volume: a per-parameter window (``method="window"``) is safe. The
    chunked plan remains available for unbounded inputs."""
    flagged = classification.withColumn(
        "is_event", F.when(F.col("event_class").isin(*event_classes), 1).otherwise(0))
    tagged = runs(flagged, ["parameter_code"], "obs_time", "is_event",
                  F.trunc(F.col("obs_time").cast("date"), "month"), method)
    return (tagged.filter(F.col("is_event") == 1)
                  .groupBy("parameter_code", "_run").agg(
                      F.min("obs_time").alias("event_start"), F.max("obs_time").alias("event_end"),
                      F.count(F.lit(1)).alias("duration_hours"),
                      F.max("stations_anomalous").alias("peak_stations_affected"),
                      F.max("stations_reporting").alias("network_size"),
                      fixed(F.max("network_max"), 2).alias("peak_concentration"),
                      fixed(F.avg("network_mean"), 2).alias("mean_concentration"),
                      fixed(F.max("anomalous_fraction"), 3).alias("peak_fraction"))
                  .filter(F.col("duration_hours") >= min_hours)
                  .drop("_run"))
