"""Column-expression helpers. All are built-in Spark expressions (JVM side,
inside whole-stage codegen); none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourglass import constants as K


def fixed(c: Column | str, digits: int) -> Column:
    """Round half-up to ``digits`` places through DECIMAL, as DOUBLE.

    Plain ``round(double)`` rounds the shortest decimal text in Spark but the
    binary value in other engines; going through decimal(38,9) first makes
    the result independent of last-bit noise from different summation orders.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("decimal(38,9)"), digits).cast("double")


def safe_div(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI-safe NULLIF division)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def safe_corr(a: Column | str, b: Column | str) -> Column:
    """Pearson correlation over rows where both are present; NULL (not an
    ANSI division error, not NaN) when a variance is zero or n < 2."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def pct(num: Column, den: Column) -> Column:
    """100 * num / den as DOUBLE (never DECIMAL), NULL on a zero denominator."""
    return safe_div(num.cast("double") * F.lit(100.0), den)


def passes(cond: Column) -> Column:
    """An expectation passes only when its condition is TRUE (NULL fails)."""
    return F.coalesce(cond, F.lit(False))


def obs_time_from(obs_date: Column, obs_hour: Column) -> Column:
    """Midnight of ``obs_date`` plus ``obs_hour`` hours, as TIMESTAMP_NTZ."""
    return F.timestamp_add("HOUR", obs_hour, obs_date.cast("timestamp_ntz"))


def anomaly_class(sd: Column, z_abs: Column, unusual: float = K.UNUSUAL_Z,
                  extreme: float = K.EXTREME_Z) -> Column:
    """insufficient_history when the baseline sd is NULL or 0, then strict
    thresholds: |z| > extreme, |z| > unusual, else normal."""
    return (F.when(sd.isNull() | (sd == 0), "insufficient_history")
             .when(z_abs > extreme, "extreme")
             .when(z_abs > unusual, "unusual")
             .otherwise("normal"))


def event_class(reporting: Column, anomalous: Column,
                min_reporting: int = K.MIN_STATIONS_REPORTING,
                localised: float = K.LOCALISED_FRACTION,
                widespread: float = K.WIDESPREAD_FRACTION) -> Column:
    """Rule order matters: reporting < min, 0 anomalous, exactly 1, then by
    fraction (< localised, < widespread, else network_wide)."""
    frac = safe_div(anomalous, reporting)
    return (F.when(reporting < min_reporting, "insufficient_network")
             .when(anomalous == 0, "quiet")
             .when(anomalous == 1, "isolated_fault")
             .when(frac < localised, "localised")
             .when(frac < widespread, "widespread")
             .otherwise("network_wide"))


def health_status(completeness: Column, extreme_pct: Column,
                  poor_below: float = K.HEALTH_POOR_BELOW,
                  suspect_above: float = K.HEALTH_SUSPECT_ABOVE,
                  gappy_below: float = K.HEALTH_GAPPY_BELOW) -> Column:
    return (F.when(completeness < poor_below, "poor_coverage")
             .when(extreme_pct > suspect_above, "suspect")
             .when(completeness < gappy_below, "gappy")
             .otherwise("healthy"))


def wind_band(speed: Column) -> Column:
    expr = None
    for limit, label in K.WIND_BANDS:
        expr = F.when(speed < limit, label) if expr is None else expr.when(speed < limit, label)
    return expr.otherwise(K.WIND_BAND_OTHER)


def rain_condition(rain: Column) -> Column:
    return F.when(rain > 0, "raining").otherwise("dry")


def run_type(stuck_value: Column) -> Column:
    return F.when(stuck_value == 0, "zero (below detection)").otherwise("non-zero (likely fault)")


def interpretation(cls: Column) -> Column:
    expr = None
    for label, text in K.EVENT_INTERPRETATION:
        expr = F.when(cls == label, text) if expr is None else expr.when(cls == label, text)
    return expr.otherwise(K.EVENT_INTERPRETATION_OTHER)
