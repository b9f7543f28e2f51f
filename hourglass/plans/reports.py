"""Reports and ad-hoc analyses (R1-R62) as DataFrame functions over the
produced tables. Each is a short aggregate / filter / top-k; top-k reports
break ties on the grain key so their output is deterministic. Shares of a
total are computed as a window over already-aggregated rows (a handful of
classes), never over readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourglass import constants as K
from hourglass.functions.exprs import (fixed, interpretation, pct, rain_condition, run_type,
                                       safe_corr, wind_band)


def share(df: DataFrame, key: str, digits: int = 2, count_name: str = "rows") -> DataFrame:
    """Rows per ``key`` and their percentage of the total
    (``sum(count(*)) OVER ()`` over the aggregated rows)."""
    agg = df.groupBy(key).agg(F.count(F.lit(1)).alias(count_name))
    return agg.withColumn("pct", fixed(pct(F.col(count_name), F.sum(count_name).over(Window.partitionBy())), digits))


# ---- silver / quarantine -------------------------------------------------

def reject_reason_counts(tagged: DataFrame) -> DataFrame:
    return tagged.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rows"))


def quarantine_profile(tagged: DataFrame) -> DataFrame:
    """Reason, rows and % of bronze, from one scan of the tagged rows: the
    denominator is the sum over the few aggregated rows, accepted ones included."""
    reasons = tagged.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rows")) \
        .withColumn("_bronze", F.sum("rows").over(Window.partitionBy()))
    return reasons.filter(F.col("reject_reason").isNotNull()).select(
        "reject_reason", "rows", fixed(pct(F.col("rows"), F.col("_bronze")), 2).alias("pct_of_bronze"))


def below_detection_profile(silver: DataFrame) -> DataFrame:
    """Below-detection share per parameter (pollutants carry the flag)."""
    bd = F.count_if(F.col("below_detection"))
    return silver.groupBy("parameter_code").agg(
        F.count(F.lit(1)).alias("total"), bd.alias("below_detection"),
        fixed(pct(bd, F.count(F.lit(1))), 2).alias("pct_bdl"))


def null_profile(flat: DataFrame) -> DataFrame:
    """COUNT(*) vs COUNT(value) per parameter, first/last date."""
    return flat.groupBy("parameter_code").agg(
        F.count(F.lit(1)).alias("records"), F.count("value").alias("with_value"),
        (F.count(F.lit(1)) - F.count("value")).alias("null_values"),
        F.min("obs_date").alias("first_date"), F.max("obs_date").alias("last_date"))


def silver_audit(silver: DataFrame) -> DataFrame:
    """Missing-key audit battery in one aggregate."""
    return silver.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("site_id").isNull()).alias("null_site"),
        F.count_if(F.col("obs_date").isNull()).alias("null_date"),
        F.count_if(~F.col("hour_1based").between(1, 24)).alias("bad_hour"),
        F.count_if(F.col("value").isNull()).alias("null_value"),
        F.count_if(F.col("parameter_code").isin(K.POLLUTANTS) & (F.col("value_clean") < 0))
         .alias("negative_clean_pollutant"))


def parameter_rows(silver: DataFrame) -> DataFrame:
    """R45 (first half): rows per parameter."""
    return silver.groupBy("parameter_code").agg(F.count(F.lit(1)).alias("rows"))


def weather_stats(silver: DataFrame) -> DataFrame:
    """Min / max / mean per weather parameter, wind direction excluded
    (it is circular, so its mean is meaningless; see ``wind_direction_range``)."""
    w = silver.filter(F.col("parameter_code").isin("TEMP", "HUMID", "WSP", "RAIN"))
    return w.groupBy("parameter_code").agg(
        F.count(F.lit(1)).alias("rows"), fixed(F.min("value_clean"), 3).alias("min_value"),
        fixed(F.max("value_clean"), 3).alias("max_value"), fixed(F.avg("value_clean"), 3).alias("mean_value"))


def wind_direction_range(silver: DataFrame) -> DataFrame:
    """R46."""
    w = silver.filter(F.col("parameter_code") == "WDR")
    return w.agg(F.count(F.lit(1)).alias("rows"), F.min("value_clean").alias("min_wdr"),
                 F.max("value_clean").alias("max_wdr"))


def parameter_span(silver: DataFrame) -> DataFrame:
    """Rows, stations, date span per weather parameter."""
    w = silver.filter(F.col("parameter_code").isin(K.WEATHER))
    return w.groupBy("parameter_code").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("site_id").alias("stations"),
        F.min("obs_date").alias("first_date"), F.max("obs_date").alias("last_date"))


def humidity_over_100(silver: DataFrame) -> DataFrame:
    """Per station, humidity readings above 100."""
    h = silver.filter((F.col("parameter_code") == "HUMID") & (F.col("value_clean") > 100))
    return h.groupBy("site_id").agg(F.count(F.lit(1)).alias("rows_over_100"),
                                    F.min("value_clean").alias("min_over_100"),
                                    F.max("value_clean").alias("max_over_100"))


def point_lookup(silver: DataFrame, site_id: int, parameter: str, obs_date: str) -> DataFrame:
    """Conjunctive equality filter (pushed into the scan's plan)."""
    return silver.filter((F.col("site_id") == site_id) & (F.col("parameter_code") == parameter)
                         & (F.col("obs_date") == F.lit(obs_date).cast("date")))


# ---- gold -------------------------------------------------------------------

def completeness_stats(daily: DataFrame) -> DataFrame:
    return daily.agg(F.min("completeness_pct").alias("min_completeness"),
                     F.max("completeness_pct").alias("max_completeness"),
                     fixed(F.avg("completeness_pct"), 2).alias("avg_completeness"))


def region_means(daily: DataFrame) -> DataFrame:
    """Mean daily value and station count per region and pollutant."""
    d = daily.filter(F.col("parameter_code").isin("PM2.5", "PM10"))
    return d.groupBy("region", "parameter_code").agg(
        fixed(F.avg("daily_avg"), 2).alias("mean_daily"), F.countDistinct("site_id").alias("stations"))


def yearly_means(daily: DataFrame) -> DataFrame:
    """R30."""
    return daily.groupBy("parameter_code", F.year("obs_date").alias("yr")).agg(
        fixed(F.avg("daily_avg"), 2).alias("mean_daily"))


def exceedance_by_year(exceed: DataFrame) -> DataFrame:
    """R31."""
    return exceed.groupBy(F.year("obs_date").alias("yr"), "parameter_code").agg(
        F.count(F.lit(1)).alias("exceedance_days"))


def exceedance_summary(exceed: DataFrame) -> DataFrame:
    """R10."""
    return exceed.groupBy("parameter_code").agg(
        F.count(F.lit(1)).alias("exceedance_days"), F.max("consecutive_days").alias("longest_run"),
        F.min("obs_date").alias("first_date"), F.max("obs_date").alias("last_date"))


def hourly_curve(profile: DataFrame, parameter: str = "NO2") -> DataFrame:
    """Network hour-of-day curve from the station profiles."""
    return profile.filter(F.col("parameter_code") == parameter).groupBy("obs_hour").agg(
        fixed(F.avg("mean_value"), 3).alias("mean_value"))


def dash_trend(regional: DataFrame, pollutant: str) -> DataFrame:
    """Regional trend for one pollutant, ordered by month —
    the dashboard's SQL with a named parameter marker, over the DataFrame
    passed as a query-scoped relation (no global temp view)."""
    return regional.sparkSession.sql(
        """SELECT region, month_start, monthly_avg, rolling_12m_avg, yoy_pct_change
           FROM {trend} WHERE parameter_code = :pollutant ORDER BY month_start, region""",
        args={"pollutant": pollutant}, trend=regional)


def dash_station_map(daily: DataFrame, pollutant: str, year: int) -> DataFrame:
    """One year's mean per station with coordinates."""
    d = daily.filter((F.col("parameter_code") == pollutant) & (F.year("obs_date") == year))
    return d.groupBy("site_name", "region", "latitude", "longitude").agg(
        fixed(F.avg("daily_avg"), 2).alias("annual_avg"))


def dash_diurnal(profile: DataFrame, pollutant: str, region: str) -> DataFrame:
    """Station hour-of-day means for one region."""
    return (profile.filter((F.col("parameter_code") == pollutant) & (F.col("region") == region))
                   .select("site_name", "obs_hour", "mean_value").orderBy("site_name", "obs_hour"))


# ---- wide -------------------------------------------------------------------

def _paired(c1: str, c2: str):
    return F.col(c1).isNotNull() & F.col(c2).isNotNull()


def pair_coverage(wide: DataFrame) -> DataFrame:
    """Station-hours per measure, paired counts and pair shares."""
    pw, pr = F.count_if(_paired("pm25", "wind_speed")), F.count_if(_paired("pm25", "rainfall"))
    return wide.agg(
        F.count(F.lit(1)).alias("total_station_hours"), F.count("pm25").alias("has_pm25"),
        F.count("temp_c").alias("has_temp"), F.count("humidity").alias("has_valid_humidity"),
        F.count("wind_speed").alias("has_wind"), F.count("rainfall").alias("has_rain"),
        pw.alias("pm25_and_wind"), pr.alias("pm25_and_rain"),
        fixed(pct(pw, F.count("pm25")), 2).alias("pct_pm25_with_wind"),
        fixed(pct(pr, F.count("pm25")), 2).alias("pct_pm25_with_rain"))


def pair_by_station(wide: DataFrame, dim: DataFrame) -> DataFrame:
    """Paired PM2.5+wind hours per station, stations with any only."""
    per = wide.groupBy("site_id").agg(F.count_if(_paired("pm25", "wind_speed")).alias("pm25_wind_hours"))
    return (per.filter(F.col("pm25_wind_hours") > 0)
               .join(dim.select("site_id", "site_name", "region"), "site_id", "inner")
               .select("site_id", "site_name", "region", "pm25_wind_hours"))


def wide_yearly(wide: DataFrame) -> DataFrame:
    """R33."""
    return wide.groupBy("year").agg(
        fixed(F.avg("pm25"), 2).alias("mean_pm25"), fixed(F.avg("pm10"), 2).alias("mean_pm10"),
        fixed(F.avg("no2"), 3).alias("mean_no2"), fixed(F.avg("ozone"), 3).alias("mean_ozone"),
        fixed(F.avg("rainfall"), 4).alias("mean_rainfall"), fixed(F.avg("wind_speed"), 2).alias("mean_wind"),
        fixed(F.avg("humidity"), 1).alias("mean_humidity"), fixed(F.avg("temp_c"), 1).alias("mean_temp"),
        F.count("pm25").alias("pm25_hours"),
        F.count_if(_paired("pm25", "wind_speed")).alias("pm25_wind_hours"),
        F.count_if(_paired("pm25", "rainfall")).alias("pm25_rain_hours"))


def rain_by_year(wide: DataFrame) -> DataFrame:
    """R34."""
    p = wide.filter(_paired("pm25", "rainfall"))
    return p.groupBy("year").agg(
        F.count(F.lit(1)).alias("paired_hours"),
        fixed(pct(F.count_if(F.col("rainfall") > 0), F.count(F.lit(1))), 2).alias("pct_hours_raining"),
        fixed(F.avg("pm25"), 2).alias("mean_pm25"))


def _pollutant_means(df: DataFrame, key) -> DataFrame:
    return df.groupBy(key).agg(
        fixed(F.avg("pm25"), 2).alias("mean_pm25"), fixed(F.avg("pm10"), 2).alias("mean_pm10"),
        fixed(F.avg("no2"), 3).alias("mean_no2"), fixed(F.avg("ozone"), 3).alias("mean_ozone"),
        F.count(F.lit(1)).alias("paired_hours"))


def rain_vs_dry(wide: DataFrame) -> DataFrame:
    """R35/B18."""
    return _pollutant_means(wide.filter(_paired("pm25", "rainfall")),
                            rain_condition(F.col("rainfall")).alias("condition"))


def wind_bands(wide: DataFrame) -> DataFrame:
    """R36/B19."""
    return _pollutant_means(wide.filter(_paired("pm25", "wind_speed")),
                            wind_band(F.col("wind_speed")).alias("wind_band"))


# The eight correlation pairs and their names.
CORRELATION_PAIRS = [
    ("pm25_vs_wind", "pm25", "wind_speed"), ("pm25_vs_rain", "pm25", "rainfall"),
    ("pm25_vs_humidity", "pm25", "humidity"), ("pm25_vs_temp", "pm25", "temp_c"),
    ("pm10_vs_wind", "pm10", "wind_speed"), ("no2_vs_wind", "no2", "wind_speed"),
    ("ozone_vs_temp", "ozone", "temp_c"), ("ozone_vs_no2", "ozone", "no2"),
]


def weather_correlations(wide: DataFrame) -> DataFrame:
    """Pearson correlations over pairwise-complete rows, one pass."""
    return wide.agg(*[fixed(safe_corr(a, b), 3).alias(n) for n, a, b in CORRELATION_PAIRS])


def wide_yearly_cte(wide: DataFrame) -> DataFrame:
    """Yearly PM2.5, wind and % raining (denominator COUNT(rainfall))."""
    p = wide.filter(F.col("pm25").isNotNull())
    return p.groupBy("year").agg(
        fixed(F.avg("pm25"), 3).alias("mean_pm25"), fixed(F.avg("wind_speed"), 3).alias("mean_wind"),
        fixed(pct(F.count_if(F.col("rainfall") > 0), F.count("rainfall")), 2).alias("pct_hours_raining"))


def wide_sample(wide: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` paired rows in time (top-k; ties on site)."""
    cols = ["site_id", "obs_time"] + [c for _, c in K.WIDE_COLUMNS]
    return wide.filter(_paired("pm25", "wind_speed")).select(*cols).orderBy("obs_time", "site_id").limit(n)


def grain_hourly_wide(wide: DataFrame) -> DataFrame:
    """Rows vs distinct (site_id, obs_time) keys."""
    return wide.agg(F.count(F.lit(1)).alias("total_rows"),
                    F.countDistinct(F.struct("site_id", "obs_time")).alias("distinct_keys"))


# ---- detectors --------------------------------------------------------------

def anomaly_by_year(anom: DataFrame) -> DataFrame:
    """R15."""
    return anom.groupBy("parameter_code", F.year("obs_date").alias("yr")).agg(
        F.count_if(F.col("anomaly_class") == "extreme").alias("extreme"),
        F.count_if(F.col("anomaly_class") == "unusual").alias("unusual"))


def flatline_top(flat: DataFrame, dim: DataFrame, n: int = 15) -> DataFrame:
    """Longest runs with station name (top-k, ties broken on the key)."""
    return (flat.join(dim.select("site_id", "site_name"), "site_id", "inner")
                .select("site_name", "parameter_code", "stuck_value", "hours_stuck", "run_start")
                .orderBy(F.desc("hours_stuck"), "run_start", "site_name", "parameter_code").limit(n))


def flatline_summary(flat: DataFrame) -> DataFrame:
    return flat.agg(F.count(F.lit(1)).alias("flatline_runs"), F.max("hours_stuck").alias("longest_run_hours"),
                    F.countDistinct("site_id").alias("stations_affected"))


def flatline_run_type(flat: DataFrame) -> DataFrame:
    """R17/B24."""
    return flat.groupBy(run_type(F.col("stuck_value")).alias("run_type")).agg(
        F.count(F.lit(1)).alias("runs"), F.max("hours_stuck").alias("longest"))


def health_worst(health: DataFrame, dim: DataFrame, n: int = 20) -> DataFrame:
    """Worst non-healthy station-months by completeness."""
    return (health.filter(F.col("health_status") != "healthy")
                  .join(dim.select("site_id", "site_name"), "site_id", "inner")
                  .select("site_name", "parameter_code", "month_start", "completeness_pct",
                          "extreme_pct", "health_status")
                  .orderBy("completeness_pct", "site_name", "parameter_code", "month_start").limit(n))


def month_daily_anomalies(anom: DataFrame, parameter: str, start: str, end: str) -> DataFrame:
    """Daily mean, anomalies and stations inside one month."""
    a = anom.filter((F.col("parameter_code") == parameter) & (F.col("obs_time") >= F.lit(start).cast("timestamp_ntz"))
                    & (F.col("obs_time") < F.lit(end).cast("timestamp_ntz")))
    return a.groupBy(F.col("obs_date").alias("day")).agg(
        fixed(F.avg("value_clean"), 1).alias("mean_value"),
        F.count_if(F.col("anomaly_class").isin("unusual", "extreme")).alias("anomalies"),
        F.countDistinct("site_id").alias("stations"))


def network_summary(state: DataFrame) -> DataFrame:
    """R20."""
    return state.groupBy("parameter_code").agg(
        F.count(F.lit(1)).alias("hours"), fixed(F.avg("stations_reporting"), 1).alias("avg_stations"),
        F.max("stations_anomalous").alias("max_concurrent_anomalies"))


def discrimination_summary(cls: DataFrame) -> DataFrame:
    """Event-class share with its interpretation."""
    return share(cls, "event_class", 2, "hours").withColumn("interpretation", interpretation(F.col("event_class")))


def episode_summary(events: DataFrame) -> DataFrame:
    """R22."""
    return events.groupBy("parameter_code").agg(
        F.count(F.lit(1)).alias("episodes"), F.max("duration_hours").alias("longest_hours"),
        fixed(F.avg("duration_hours"), 1).alias("avg_hours"))


def episode_top(events: DataFrame, parameter: str = "PM2.5", n: int = 15) -> DataFrame:
    """Longest episodes of one parameter."""
    return (events.filter(F.col("parameter_code") == parameter)
                  .select("event_start", "event_end", "duration_hours", "peak_stations_affected",
                          "network_size", "peak_concentration")
                  .orderBy(F.desc("duration_hours"), "event_start").limit(n))


def event_hours_by_month(cls: DataFrame, parameter: str = "PM2.5", n: int = 12) -> DataFrame:
    """R23."""
    c = cls.filter(F.col("parameter_code") == parameter)
    return (c.groupBy(F.trunc(F.col("obs_time").cast("date"), "month").alias("month")).agg(
                F.count_if(F.col("event_class").isin("widespread", "network_wide")).alias("event_hours"),
                fixed(F.avg("network_mean"), 1).alias("mean_value"))
             .orderBy(F.desc("event_hours"), "month").limit(n))


def baseline_adaptation(state: DataFrame, parameter: str, start: str, end: str) -> DataFrame:
    """Daily network mean and most stations flagged, inside a period."""
    s = state.filter((F.col("parameter_code") == parameter) & (F.col("obs_time") >= F.lit(start).cast("timestamp_ntz"))
                     & (F.col("obs_time") < F.lit(end).cast("timestamp_ntz")))
    return s.groupBy(F.col("obs_time").cast("date").alias("day")).agg(
        fixed(F.avg("network_mean"), 1).alias("mean_value"),
        F.max("stations_anomalous").alias("max_anomalous"), F.max("stations_reporting").alias("reporting"))


def seasonal_by_month(seasonal: DataFrame, parameter: str, n: int = 10) -> DataFrame:
    """R25."""
    s = seasonal.filter(F.col("parameter_code") == parameter)
    return (s.groupBy(F.trunc("obs_date", "month").alias("month")).agg(
                fixed(F.avg("seasonal_z"), 2).alias("mean_seasonal_z"),
                F.count_if(F.col("seasonal_z") > 3).alias("extreme_readings"))
             .orderBy(F.desc("mean_seasonal_z"), "month").limit(n))


def fault_vs_event(cls: DataFrame) -> DataFrame:
    """Hours per class, excluding quiet and insufficient_network."""
    c = cls.filter(~F.col("event_class").isin("quiet", "insufficient_network"))
    return c.groupBy("event_class").agg(F.count(F.lit(1)).alias("hours"))


def run_length_summary(runs_df: DataFrame) -> DataFrame:
    """Aggregate of an aggregate: count and longest of runs."""
    return runs_df.agg(F.count(F.lit(1)).alias("run_count"), F.max("hours_stuck").alias("longest"))


def negative_profile(quarantine: DataFrame, reason: str = "implausible_negative") -> DataFrame:
    """R11 (see X5: the reason is a parameter)."""
    q = quarantine.filter(F.col("reject_reason") == reason)
    return q.groupBy("parameter_code").agg(
        F.count(F.lit(1)).alias("negatives"), fixed(F.min("value"), 3).alias("most_negative"),
        fixed(F.percentile_approx("value", 0.5), 3).alias("median_negative"))


def negative_floor(quarantine: DataFrame, at_or_under: float = -9.9,
                   reason: str = "implausible_negative") -> DataFrame:
    """R12."""
    q = quarantine.filter((F.col("reject_reason") == reason) & (F.col("value") <= at_or_under))
    return q.groupBy("parameter_code").agg(F.count(F.lit(1)).alias("at_or_near_floor"))


# Quantiles of the quarantine profile.
PROFILE_QUANTILES = [("p01", 0.01), ("p10", 0.10), ("p25", 0.25), ("p50", 0.50), ("p90", 0.90)]


def quantile_profile(quarantine: DataFrame, reason: str = "implausible_negative") -> DataFrame:
    """Five quantiles from ONE sketch per group."""
    q = quarantine.filter(F.col("reject_reason") == reason)
    arr = q.groupBy("parameter_code").agg(
        F.percentile_approx("value", [p for _, p in PROFILE_QUANTILES]).alias("_q"))
    return arr.select("parameter_code", *[fixed(F.col("_q")[i], 2).alias(n)
                                          for i, (n, _) in enumerate(PROFILE_QUANTILES)])


def floor_bias(fact: DataFrame, quarantine: DataFrame, reason: str = "implausible_negative") -> DataFrame:
    """Mean with negatives floored (kept rows plus quarantined
    negatives, UNION ALL) vs mean of kept rows; % overstated."""
    neg = quarantine.filter(F.col("reject_reason") == reason).select(
        "parameter_code", "value", F.lit(False).alias("_kept"))
    both = fact.select("parameter_code", "value", F.lit(True).alias("_kept")).unionByName(neg)
    # one pass over the union: both means from one aggregate (the fact is read once)
    j = both.groupBy("parameter_code").agg(
        fixed(F.avg(F.greatest(F.col("value"), F.lit(0.0))), 3).alias("avg_floored"),
        fixed(F.avg(F.when(F.col("_kept"), F.col("value"))), 3).alias("avg_excluded"),
        F.count_if(F.col("_kept")).alias("_n_kept")).filter(F.col("_n_kept") > 0)
    return j.select("parameter_code", "avg_excluded", "avg_floored",
                    fixed(pct(F.col("avg_excluded") - F.col("avg_floored"), F.col("avg_floored")), 2)
                    .alias("pct_overstated"))


# ---- samples and re-aggregations ---------------------------------------------

def sweep_ranked(sweep: DataFrame) -> DataFrame:
    """The sweep's settings (a fixed grid) by the share of their anomalies
    that fall in the slice."""
    order = Window.orderBy(F.desc("slice_share_pct"), "z_threshold", "window_hours")
    return sweep.withColumn("share_rank", F.row_number().over(order))


def humidity_top(silver: DataFrame, n: int = 20) -> DataFrame:
    """The highest humidity readings above 100 (top-k, ties on the key)."""
    return silver.filter((F.col("parameter_code") == "HUMID") & (F.col("value_clean") > 100)) \
        .select("site_id", "obs_time", "value_clean", "_record_id") \
        .orderBy(F.desc("value_clean"), "site_id", "obs_time", "_record_id").limit(n)


def silver_sample(silver: DataFrame, condition: Column, n: int = 10) -> DataFrame:
    """The first rows of a kind in time (top-k, ties on the record)."""
    return silver.filter(condition).select(
        "site_id", "parameter_code", "obs_date", "hour_1based", "obs_time", "value", "value_clean", "below_detection", "_record_id") \
        .orderBy("obs_time", "_record_id").limit(n)


def widget_sum(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """A widget's re-aggregation: the sum of a report's column by keys."""
    return df.groupBy(*keys).agg(F.sum(value).alias("total"))


def widget_daily_mean(daily: DataFrame) -> DataFrame:
    """Mean of the stations' daily means by day and parameter."""
    return daily.groupBy("obs_date", "parameter_code").agg(fixed(F.avg("daily_avg"), 3).alias("mean_daily_avg"))
