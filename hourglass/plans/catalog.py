"""Query catalog: one callable ``(spark, sf_dir) -> DataFrame`` per operator
of the inventory. Every query starts from the supplied tables (through the
adapters), over all their rows.

Where a registered query passes a parameter different from the library
default, it is an adapter-scale choice noted inline (the hourly adapter
covers one month, so e.g. daily completeness is far below 75 % at small
scale factors); the library defaults remain the reference values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass import constants as K
from hourglass.operators import anomaly as AN
from hourglass.operators import events as EV
from hourglass.operators import gold as G
from hourglass.operators import quality as Q
from hourglass.operators import silver as S
from hourglass.operators import sketches as SK
from hourglass.plans import reports as R
from hourglass.plans.context import Dense, Pipeline, Sentinel, Written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
REPORTS: dict[str, Callable[[Pipeline], DataFrame]] = {}

from hourglass.plans.params import (DIURNAL, EPISODE_CLASSES_ADAPTER,  # noqa: E402
                                    EPISODE_MIN_HOURS_ADAPTER, EXCEEDANCE_MIN_COMPLETENESS,
                                    FLATLINE_MIN_ROWS_ADAPTER, LOOKUP, MAP_YEAR, TREND_POLLUTANT)


def query(name: str, pipeline: type[Pipeline] = Pipeline):
    def deco(fn: Callable[[Pipeline], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(pipeline(spark, sf_dir))
        REPORTS[name] = fn
        return fn
    return deco


# ---- sources / silver -------------------------------------------------------
@query("dim_station")
def _dim_station(p): return p.dim


@query("dim_parameter")
def _dim_parameter(p): return G.dim_parameter(p.bronze)


@query("silver_flatten")
def _silver_flatten(p):
    return p.flat.select("_record_id", "site_id", "parameter_code", "units", "frequency", "obs_date",
                         "hour_1based", "value", "aqi_category", "obs_hour", "obs_time", "year", "month")


@query("silver_time")
def _silver_time(p):
    return p.silver.groupBy("hour_1based").agg(
        F.min("obs_hour").alias("obs_hour"), F.count(F.lit(1)).alias("rows"),
        F.min(F.hour("obs_time")).alias("min_clock_hour"), F.max(F.hour("obs_time")).alias("max_clock_hour"))


@query("silver_clean")
def _silver_clean(p):
    return p.silver.select("_record_id", "site_id", "parameter_code", "obs_time", "value",
                           "below_detection", "value_clean")


@query("expect_drop")
def _expect_drop(p):
    return S.expect_or_drop(p.flat, S.drop_rules()).select("_record_id", "site_id", "parameter_code", "obs_time")


@query("expectation_metrics")
def _expectation_metrics(p): return S.expectation_metrics(p.flat)


@query("reject_reasons")
def _reject_reasons(p): return R.reject_reason_counts(p.tagged)


@query("quarantine")
def _quarantine(p):
    return p.quarantine.select("_record_id", "site_id", "parameter_code", "obs_date", "hour_1based", "value",
                               "reject_reason", "quarantined_at")


@query("silver_dedup")
def _silver_dedup(p):
    return p.fact.select("site_id", "parameter_code", "obs_time", "value", "value_clean", "_record_id")


@query("point_lookup")
def _point_lookup(p):
    return R.point_lookup(p.silver, *LOOKUP).select("site_id", "parameter_code", "obs_date", "hour_1based",
                                                    "obs_time", "value", "value_clean")


@query("null_profile")
def _null_profile(p): return R.null_profile(p.flat)


@query("silver_audit")
def _silver_audit(p): return R.silver_audit(p.silver)


@query("quarantine_profile")
def _quarantine_profile(p): return R.quarantine_profile(p.tagged)


@query("below_detection_profile")
def _below_detection_profile(p): return R.below_detection_profile(p.silver)


@query("parameter_stats")
def _parameter_stats(p): return R.weather_stats(p.silver)


@query("parameter_rows")
def _parameter_rows(p): return R.parameter_rows(p.silver)


@query("wind_direction_range")
def _wdr(p): return R.wind_direction_range(p.silver)


@query("parameter_span")
def _parameter_span(p): return R.parameter_span(p.silver)


@query("humidity_over_100")
def _humidity_over_100(p): return R.humidity_over_100(p.silver)


@query("stations_without_data")
def _stations_without_data(p):
    seen = p.bronze.select(F.col("Site_Id").alias("site_id")).filter(F.col("site_id").isNotNull()).distinct()
    return p.dim.join(seen, "site_id", "left_anti").select("site_id", "site_name", "region")


@query("retention_pct")
def _retention_pct(p):
    kept, _ = S.split_quarantine(p.tagged)
    # rows after dedup = distinct grain keys (a hash aggregate on the keys only)
    c = Q.row_counts({"kept": kept.select(*K.SILVER_GRAIN).distinct(), "bronze": p.bronze})
    return c.select(F.round(F.try_divide(F.col("kept") * 100.0, F.col("bronze")).cast("decimal(38,9)"), 2)
                    .cast("double").alias("pct_retained"))


# ---- gold -------------------------------------------------------------------
@query("gold_daily")
def _gold_daily(p): return p.daily


@query("site_hourly_profile")
def _site_hourly_profile(p): return p.profile


@query("gold_regional")
def _gold_regional(p): return p.regional


@query("hourly_wide")
def _hourly_wide(p): return p.wide


@query("exceedance_events")
def _exceedance_events(p): return p.exceedance(EXCEEDANCE_MIN_COMPLETENESS)


@query("exceedance_summary")
def _exceedance_summary(p): return R.exceedance_summary(p.exceedance(EXCEEDANCE_MIN_COMPLETENESS))


@query("exceedance_by_year")
def _exceedance_by_year(p): return R.exceedance_by_year(p.exceedance(EXCEEDANCE_MIN_COMPLETENESS))


@query("completeness_stats")
def _completeness_stats(p): return R.completeness_stats(p.daily)


@query("region_means")
def _region_means(p): return R.region_means(p.daily)


@query("yearly_means")
def _yearly_means(p): return R.yearly_means(p.daily)


@query("hourly_curve")
def _hourly_curve(p): return R.hourly_curve(p.profile, "NO2")


@query("dash_trend")
def _dash_trend(p): return R.dash_trend(p.regional, TREND_POLLUTANT)


@query("dash_station_map")
def _dash_station_map(p): return R.dash_station_map(p.daily, TREND_POLLUTANT, MAP_YEAR)


@query("dash_diurnal")
def _dash_diurnal(p): return R.dash_diurnal(p.profile, *DIURNAL)


@query("floor_bias")
def _floor_bias(p): return R.floor_bias(p.fact1, p.quarantine)


@query("negative_profile")
def _negative_profile(p): return R.negative_profile(p.quarantine)


@query("negative_floor")
def _negative_floor(p): return R.negative_floor(p.quarantine)


@query("quantile_profile")
def _quantile_profile(p): return R.quantile_profile(p.quarantine)


# ---- wide analyses ----------------------------------------------------------
@query("pair_coverage")
def _pair_coverage(p): return R.pair_coverage(p.wide)


@query("pair_by_station")
def _pair_by_station(p): return R.pair_by_station(p.wide, p.dim)


@query("wide_yearly")
def _wide_yearly(p): return R.wide_yearly(p.wide)


@query("rain_by_year")
def _rain_by_year(p): return R.rain_by_year(p.wide)


@query("rain_vs_dry")
def _rain_vs_dry(p): return R.rain_vs_dry(p.wide)


@query("wind_bands")
def _wind_bands(p): return R.wind_bands(p.wide)


@query("weather_correlations")
def _weather_correlations(p): return R.weather_correlations(p.wide)


@query("wide_yearly_cte")
def _wide_yearly_cte(p): return R.wide_yearly_cte(p.wide)


@query("wide_sample")
def _wide_sample(p): return R.wide_sample(p.wide)


@query("grain_hourly_wide")
def _grain_hourly_wide(p): return R.grain_hourly_wide(p.wide)


# ---- detectors --------------------------------------------------------------
@query("observation_anomaly")
def _observation_anomaly(p): return p.anomaly


@query("anomaly_share")
def _anomaly_share(p): return R.share(p.anomaly, "anomaly_class", 2)


@query("anomaly_by_year")
def _anomaly_by_year(p): return R.anomaly_by_year(p.anomaly)


@query("sensor_flatline")
def _sensor_flatline(p): return AN.flatline_runs(p.fact1, min_rows=FLATLINE_MIN_ROWS_ADAPTER)


@query("sensor_flatline_raw")
def _sensor_flatline_raw(p): return AN.flatline_runs(p.fact1, value="value", exclude_zero=True)


@query("run_length_summary")
def _run_length_summary(p):
    return R.run_length_summary(AN.flatline_runs(p.fact1, value="value", exclude_zero=True, min_rows=2))


@query("flatline_run_type")
def _flatline_run_type(p): return R.flatline_run_type(AN.flatline_runs(p.fact1, min_rows=FLATLINE_MIN_ROWS_ADAPTER))


@query("flatline_top")
def _flatline_top(p): return R.flatline_top(AN.flatline_runs(p.fact1, min_rows=FLATLINE_MIN_ROWS_ADAPTER), p.dim)


@query("flatline_compare")
def _flatline_compare(p):
    return Q.row_counts({"floored_runs": AN.flatline_runs(p.fact1, min_rows=FLATLINE_MIN_ROWS_ADAPTER),
                      "raw_runs": AN.flatline_runs(p.fact1, value="value", exclude_zero=True,
                                                   min_rows=FLATLINE_MIN_ROWS_ADAPTER)})


@query("sensor_health")
def _sensor_health(p): return p.health


@query("health_share")
def _health_share(p): return R.share(p.health, "health_status", 1, "station_months")


@query("health_worst")
def _health_worst(p): return R.health_worst(p.health, p.dim)


@query("month_daily_anomalies")
def _month_daily_anomalies(p): return R.month_daily_anomalies(p.anomaly, "PM2.5", *p.month)


@query("hourly_network_state")
def _hourly_network_state(p): return p.state


@query("network_summary")
def _network_summary(p): return R.network_summary(p.state)


@query("hourly_classification")
def _hourly_classification(p): return p.classification


@query("discrimination_summary")
def _discrimination_summary(p): return R.discrimination_summary(p.classification)


@query("fault_vs_event")
def _fault_vs_event(p): return R.fault_vs_event(p.classification)


@query("air_quality_event")
def _air_quality_event(p): return p.events


@query("episode_summary")
def _episode_summary(p): return R.episode_summary(p.events)


@query("episode_top")
def _episode_top(p): return R.episode_top(p.events)


@query("event_hours_by_month")
def _event_hours_by_month(p): return R.event_hours_by_month(p.classification)


@query("baseline_adaptation")
def _baseline_adaptation(p): return R.baseline_adaptation(p.state, "PM2.5", *p.month)


@query("seasonal_anomaly")
def _seasonal_anomaly(p): return p.seasonal


@query("seasonal_by_month")
def _seasonal_by_month(p): return R.seasonal_by_month(p.seasonal, "PM2.5")


@query("threshold_sweep")
def _threshold_sweep(p): return AN.threshold_sweep(p.fact1, "PM2.5", slice_start=p.sweep_slice[0],
                                                  slice_end=p.sweep_slice[1])


# ---- quality ----------------------------------------------------------------
@query("grain_checks", Written)
def _grain_checks(p):
    return Q.grain_checks({
        "silver": (p.silver, K.SILVER_GRAIN), "fact": (p.fact, K.SILVER_GRAIN),
        "gold_daily": (p.daily, K.DAILY_GRAIN), "gold_regional": (p.regional, K.REGIONAL_GRAIN),
        "hourly_wide": (p.wide, K.WIDE_GRAIN), "observation_anomaly": (p.anomaly, K.SILVER_GRAIN),
        "sensor_health": (p.health, ["site_id", "parameter_code", "month_start"])})


@query("reconciliation")
def _reconciliation(p): return Q.reconciliation(p.tagged)


@query("pipeline_accounting", Written)
def _pipeline_accounting(p): return Q.pipeline_accounting(p.bronze, p.silver, p.daily, p.regional)


@query("quality_gate", Written)
def _quality_gate(p): return Q.quality_gate(p.bronze, p.silver, p.daily, p.regional)


@query("check_hour_offset")
def _check_hour_offset(p): return Q.check_hour_offset(p.silver)


@query("check_value_clean")
def _check_value_clean(p): return Q.check_value_clean(p.silver)


@query("check_humidity")
def _check_humidity(p): return Q.check_humidity(p.silver, p.wide)


@query("regression_suite", Written)
def _regression_suite(p): return Q.regression_suite(p.bronze, p.silver, p.wide)


@query("units_per_parameter")
def _units_per_parameter(p): return Q.units_per_parameter(p.long_fact)


# Rows of a series in a chunk, where chunks are asked for.
CHUNK_ROWS = 1000


# The skew-safe chunked plans, registered separately so both physical
# strategies are checked against the same oracle.
@query("observation_anomaly_chunked")
def _observation_anomaly_chunked(p): return AN.observation_anomaly(p.fact1, chunk_rows=CHUNK_ROWS)


@query("sensor_flatline_chunked")
def _sensor_flatline_chunked(p):
    return AN.flatline_runs(p.fact1, min_rows=FLATLINE_MIN_ROWS_ADAPTER, method="chunked")


@query("threshold_sweep_chunked")
def _threshold_sweep_chunked(p):
    return AN.threshold_sweep(p.fact1, "PM2.5", slice_start=p.sweep_slice[0], slice_end=p.sweep_slice[1],
                              chunk_rows=CHUNK_ROWS)


@query("anomaly_episodes")
def _anomaly_episodes(p):
    return EV.air_quality_event(p.classification, min_hours=EPISODE_MIN_HOURS_ADAPTER,
                                event_classes=EPISODE_CLASSES_ADAPTER)


@query("anomaly_episodes_chunked")
def _anomaly_episodes_chunked(p):
    return EV.air_quality_event(p.classification, min_hours=EPISODE_MIN_HOURS_ADAPTER,
                                event_classes=EPISODE_CLASSES_ADAPTER, method="chunked")


@query("seasonal_anomaly_other_years")
def _seasonal_other_years(p): return AN.seasonal_anomaly(p.long_fact, exclude_current_year=True)


@query("gold_regional_calendar")
def _gold_regional_calendar(p): return G.gold_regional(p.long_silver, p.dim, lag_mode="calendar")


@query("observation_anomaly_nulls")
def _observation_anomaly_nulls(p):
    """Over readings of which some are NULL: they take a place in the window."""
    return AN.observation_anomaly(p.fact_with_nulls)


@query("observation_anomaly_nulls_chunked")
def _observation_anomaly_nulls_chunked(p):
    return AN.observation_anomaly(p.fact_with_nulls, chunk_rows=CHUNK_ROWS)


@query("observation_anomaly_time")
def _observation_anomaly_time(p):
    """The previous 168 hours instead of the previous 168 rows."""
    return AN.observation_anomaly(p.fact1, frame="time")


# Hours of a chunk of a series, where time frames are asked for in chunks.
CHUNK_HOURS = 240


@query("observation_anomaly_time_chunked")
def _observation_anomaly_time_chunked(p): return AN.observation_anomaly(p.fact1, frame="time", chunk_hours=CHUNK_HOURS)


@query("flatline_time_chunked")
def _flatline_time_chunked(p): return AN.flatline_runs(p.fact1, min_rows=2, method="time_chunked")


@query("flatline_time")
def _flatline_time(p):
    """A missing hour breaks a run."""
    return AN.flatline_runs(p.fact1, min_rows=2, method="time")


@query("flatline_summary")
def _flatline_summary(p): return R.flatline_summary(AN.flatline_runs(p.fact1, min_rows=FLATLINE_MIN_ROWS_ADAPTER))


@query("flatline_raw_summary")
def _flatline_raw_summary(p): return R.flatline_summary(_sensor_flatline_raw(p))


@query("flatline_raw_top")
def _flatline_raw_top(p): return R.flatline_top(_sensor_flatline_raw(p), p.dim)


@query("sweep_ranked")
def _sweep_ranked(p): return R.sweep_ranked(_threshold_sweep(p))


@query("humidity_top")
def _humidity_top(p): return R.humidity_top(p.silver)


@query("hour1_sample")
def _hour1_sample(p): return R.silver_sample(p.silver, F.col("hour_1based") == 1)


@query("below_detection_sample")
def _below_detection_sample(p): return R.silver_sample(p.silver, F.col("below_detection"))


@query("widget_year_parameter")
def _widget_year_parameter(p): return R.widget_sum(R.anomaly_by_year(p.anomaly), ["yr", "parameter_code"], "unusual")


@query("widget_region_month")
def _widget_region_month(p): return R.widget_sum(p.regional, ["region", "month_start"], "readings")


@query("widget_site_hour")
def _widget_site_hour(p): return R.widget_sum(p.profile, ["site_id", "obs_hour"], "readings")


@query("widget_class")
def _widget_class(p): return R.widget_sum(p.state, ["parameter_code"], "stations_anomalous")


@query("widget_daily_mean")
def _widget_daily_mean(p): return R.widget_daily_mean(p.daily)


@query("sketch_profile")
def _sketch_profile(p): return SK.profile(p.sketches, p.dim)


@query("sketch_negative_quantiles")
def _sketch_negative_quantiles(p): return SK.rejected_quantiles(p.sketches, R.PROFILE_QUANTILES)


@query("sketch_regional_p95")
def _sketch_regional_p95(p): return SK.regional_quantile(p.sketches, p.dim)


@query("schema_inspection")
def _schema_inspection(p):
    """Columns of the silver table in order, with types and NULLs."""
    return Q.schema_profile(p.silver.select(*S.FACT_COLUMNS, "hour_1based", "below_detection"))


# The detectors and their reports over the dense records, where every class,
# state and run type occurs and the library's own limits select something.
DENSE = ["observation_anomaly", "observation_anomaly_chunked", "observation_anomaly_time", "anomaly_share", "hourly_network_state",
         "hourly_classification", "discrimination_summary", "fault_vs_event", "air_quality_event", "episode_summary",
         "episode_top", "event_hours_by_month", "anomaly_episodes", "sensor_flatline", "sensor_flatline_chunked",
         "sensor_flatline_raw", "flatline_raw_summary", "flatline_raw_top", "flatline_run_type", "flatline_time",
         "run_length_summary", "sensor_health", "health_share", "health_worst", "exceedance_events", "exceedance_summary",
         "exceedance_by_year",
         "threshold_sweep", "threshold_sweep_chunked", "sweep_ranked", "anomaly_by_year", "month_daily_anomalies",
         "network_summary", "baseline_adaptation", "anomaly_episodes_chunked", "observation_anomaly_time_chunked",
         "flatline_time_chunked", "sketch_profile", "sketch_regional_p95"]
for _name in DENSE:
    query(f"dense_{_name}", Dense)(REPORTS[_name])

# The baselines over series that begin with a sentinel.
SENTINEL = ["observation_anomaly", "observation_anomaly_chunked", "threshold_sweep", "network_summary"]
for _name in SENTINEL:
    query(f"sentinel_{_name}", Sentinel)(REPORTS[_name])
