"""Detectors over the hourly fact: trailing-window z-scores (E1, E4, B20),
flatline runs (D17, D18, D22), sensor health (D19), seasonal z-scores
(D20, C3) and the threshold x window sweep (D24).

The trailing baseline (the previous ``n`` rows, the current one excluded) is
put together from mergeable moments (``operators.moments``) of the blocks that
end at a row: blocks of 1, 4, 16, ... rows, each merged from four shorter ones
some rows back (``lag``), and a window from the few blocks that make up its
length. O(rows) for each of the log4(n) block lengths, which all windows share;
one shuffle, one sort. Nothing is ever subtracted from a larger sum, so an
outlier leaves a window with its last row and spoils no other; equal readings
have an ``sd`` of exactly 0.

``chunk_rows`` (``chunk_hours`` for time frames) cuts each series into chunks, each with the
rows before it that its windows reach back to (a halo), for inputs whose
series are too long for one task; the caller asks for it, no size decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourglass import constants as K
from hourglass.functions.exprs import anomaly_class, fixed, health_status, pct, safe_div
from hourglass.operators import moments as M
from hourglass.operators.sequence import CHUNK, runs, sequence

SERIES = ["site_id", "parameter_code"]


def _month_chunk() -> Column:
    return F.trunc(F.col("obs_time").cast("date"), "month")


def trailing_baseline(fact: DataFrame, windows: list[int], keys: list[str] | None = None,
                      value: str = "value_clean", frame: str = "rows",
                      chunk_rows: int | None = None, chunk_hours: int | None = None) -> DataFrame:
    """Rows of ``fact`` x ``windows`` (long format, column ``window_rows``)
    with ``roll_mean`` / ``roll_sd`` (sample sd) of ``value`` over the
    previous ``window_rows`` rows of the series, and ``prev_value``. NULL
    readings take a place in the window but no part in its mean and sd. sd is
    NULL with fewer than 2 readings and exactly 0 when they are equal.

    ``frame="rows"`` is the previous n *rows* (gaps stretch it in time);
    ``frame="time"`` is the previous n *hours* (a RANGE frame on epoch
    seconds)."""
    keys = keys or SERIES
    if frame == "time":
        return _trailing_time(fact, windows, keys, value, chunk_hours)
    return _per_window(trailing_wide(fact, windows, keys, value, chunk_rows), fact.columns, windows)


def _per_window(wide: DataFrame, columns: list[str], windows: list[int]) -> DataFrame:
    """One row per reading and window from the wide form."""
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("window_rows"), F.col(f"_m{n}").alias("roll_mean"),
                                        F.col(f"_s{n}").alias("roll_sd")) for n in windows])).alias("_w")
    return wide.select(*columns, "prev_value", each).select(*columns, "prev_value", "_w.*")


def trailing_wide(fact: DataFrame, windows: list[int], keys: list[str] | None = None,
                  value: str = "value_clean", chunk_rows: int | None = None) -> DataFrame:
    """One row per reading: ``_m{n}`` / ``_s{n}`` for every window n and
    ``prev_value``."""
    keys = keys or SERIES
    part, rows = keys, fact
    if chunk_rows is not None:
        halo = max(windows) + 1
        if chunk_rows < halo:
            raise ValueError(f"chunk_rows must be at least {halo}, the longest window and one")
        at = sequence(fact, keys, "obs_time", _month_chunk()).drop(CHUNK)
        own = F.floor(F.col("_idx") / chunk_rows)
        last = F.col("_idx") % chunk_rows >= chunk_rows - halo  # the next chunk's halo, too
        rows = at.withColumn("_own", own).withColumn("_part", F.explode(F.when(last, F.array(own, own + 1))
                                                                        .otherwise(F.array(own))))
        part = [*keys, "_part"]
    w = Window.partitionBy(*part).orderBy("obs_time")
    v = F.col(value)
    rows = rows.withColumns({"prev_value": F.lag(value, 1).over(w)} | M.as_columns("_b1", M.of_value(v)))
    # Blocks: _b4 are the moments of the four rows that end at this one, _b16 of sixteen, ...
    size = 1
    while size * 4 <= max(windows):
        rows = _merged_lags(rows, w, f"_b{size * 4}", [(f"_b{size}", k * size) for k in range(4)])
        size *= 4
    for n in windows:
        rows = _merged_lags(rows, w, f"_w{n}", _blocks(n, size))
    cols = []
    for n in windows:
        moments = M.columns(f"_w{n}")
        cols += [M.mean(moments).alias(f"_m{n}"), M.sd(moments).alias(f"_s{n}")]
    if chunk_rows is not None:
        return rows.select(*fact.columns, "prev_value", "_own", "_part", *cols) \
            .filter("_own = _part").drop("_own", "_part")
    return rows.select(*fact.columns, "prev_value", *cols)


def _blocks(n: int, size: int) -> list[tuple[str, int]]:
    """The blocks (largest first) that make up the ``n`` rows before a row, and
    how many rows back each ends."""
    out, back = [], 1
    while n:
        while size > n:
            size //= 4
        out.append((f"_b{size}", back))
        back, n = back + size, n - size
    return out


def _merged_lags(rows: DataFrame, w, name: str, blocks: list[tuple[str, int]]) -> DataFrame:
    """``rows`` with the moments ``name`` of the union of the ``blocks``."""
    lagged = {}
    for i, (block, back) in enumerate(blocks):
        for c in M.columns(block):
            lagged[f"_l{i}{c[-2:]}"] = F.coalesce(F.lag(c, back).over(w), F.lit(0.0)) if back else F.col(c)
    rows = rows.withColumns(lagged)
    for i in range(1, len(blocks)):
        rows = rows.withColumns(M.as_columns("_l0", M.merge(M.columns("_l0"), M.columns(f"_l{i}")))).drop(*M.columns(f"_l{i}"))
    return rows.withColumnsRenamed(dict(zip(M.columns("_l0"), M.columns(name))))


def _trailing_time(fact: DataFrame, windows: list[int], keys: list[str], value: str,
                   chunk_hours: int | None = None) -> DataFrame:
    secs = F.col("obs_time").cast("timestamp").cast("long")
    f, part = fact.withColumn("_secs", secs), keys
    if chunk_hours is None:
        f = f.withColumn("prev_value", F.lag(value, 1).over(Window.partitionBy(*keys).orderBy("obs_time")))
    else:
        if chunk_hours < max(windows):
            raise ValueError(f"chunk_hours must be at least {max(windows)}, the longest window")
        # The row before may lie any time back, beyond the halo: chunks hand their last reading on.
        length = chunk_hours * 3600
        own = F.floor(F.col("_secs") / length)
        f = sequence(f, keys, "obs_time", own, lags=(value,)).withColumnRenamed(f"_prev_{value}", "prev_value").drop(CHUNK, "_idx")
        late = F.col("_secs") >= (own + 1) * length - max(windows) * 3600  # the next chunk's halo, too
        f = f.withColumn("_own", own).withColumn("_part", F.explode(F.when(late, F.array(own, own + 1)).otherwise(F.array(own))))
        part = [*keys, "_part"]
    w = Window.partitionBy(*part).orderBy("_secs")
    cols = []
    for n in windows:
        fr = w.rangeBetween(-n * 3600, -1)
        cols += [F.avg(value).over(fr).alias(f"_m{n}"), F.stddev(value).over(fr).alias(f"_s{n}")]
    wide = f.select("*", *cols)
    return _per_window(wide if chunk_hours is None else wide.filter("_own = _part"), fact.columns, windows)


def observation_anomaly(fact: DataFrame, window: int = K.ANOMALY_WINDOW_ROWS,
                        unusual: float = K.UNUSUAL_Z, extreme: float = K.EXTREME_Z,
                        frame: str = "rows", chunk_rows: int | None = None,
                        chunk_hours: int | None = None) -> DataFrame:
    """Per reading, trailing mean/sd over the previous ``window``
    rows, z-score, hourly delta and class. Output columns are rounded like
    the published table; the class uses the unrounded values."""
    b = trailing_baseline(fact, [window], frame=frame, chunk_rows=chunk_rows, chunk_hours=chunk_hours)
    m, s, v = F.col("roll_mean"), F.col("roll_sd"), F.col("value_clean")
    z = safe_div(v - m, s)
    return b.select(
        "site_id", "parameter_code", "obs_time", "obs_date", "obs_hour", "value_clean",
        fixed(m, 3).alias("roll_mean"), fixed(s, 3).alias("roll_sd"),
        fixed(z, 2).alias("z_score"), fixed(v - F.col("prev_value"), 3).alias("hourly_delta"),
        anomaly_class(s, F.abs(z), unusual, extreme).alias("anomaly_class"))


def threshold_sweep(fact: DataFrame, parameter: str = "PM2.5",
                    thresholds: list[float] | None = None, windows: list[int] | None = None,
                    slice_start: str = "2024-01-01", slice_end: str = "2024-01-08",
                    chunk_rows: int | None = None) -> DataFrame:
    """Anomaly counts for every (threshold, window) in ONE pass: all
    baselines come from one trailing computation, thresholds become count_if
    columns of one aggregate (no cross join), and ``stack`` turns them into
    rows. Per series the site is the partition (as in the published sweep)."""
    thresholds = thresholds or K.SWEEP_Z
    windows = windows or K.SWEEP_WINDOWS
    one = fact.filter(F.col("parameter_code") == parameter)
    in_slice = (F.col("obs_date") >= F.lit(slice_start).cast("date")) & \
               (F.col("obs_date") < F.lit(slice_end).cast("date"))
    # one row per reading carrying all window baselines: aggregate the
    # (window, threshold) cells directly, without a row per window
    wide = trailing_wide(one, windows, chunk_rows=chunk_rows)
    aggs = []
    for wi, n in enumerate(windows):
        s_, m_ = F.col(f"_s{n}"), F.col(f"_m{n}")
        valid = s_.isNotNull() & (s_ > 0)
        az = F.abs(safe_div(F.col("value_clean") - m_, s_))
        aggs.append(F.count_if(valid).alias(f"t{wi}"))
        for ti, t in enumerate(thresholds):
            aggs.append(F.count_if(valid & (az > t)).alias(f"a{wi}_{ti}"))
            aggs.append(F.count_if(valid & (az > t) & in_slice).alias(f"j{wi}_{ti}"))
    cells = [f"CAST({t} AS DOUBLE), {n}, t{wi}, a{wi}_{ti}, j{wi}_{ti}"
             for wi, n in enumerate(windows) for ti, t in enumerate(thresholds)]
    long = wide.agg(*aggs).selectExpr(
        f"stack({len(cells)}, {', '.join(cells)}) AS (z_threshold, window_hours, total, anomalies, slice_anomalies)")
    return _sweep_rates(long)


def _sweep_rates(long: DataFrame) -> DataFrame:
    return long.select(
        "z_threshold", "window_hours", "total", "anomalies", "slice_anomalies",
        F.coalesce(fixed(pct(F.col("anomalies"), F.col("total")), 4), F.lit(0.0)).alias("anomaly_rate_pct"),
        F.coalesce(fixed(pct(F.col("slice_anomalies"), F.col("anomalies")), 4), F.lit(0.0)).alias("slice_share_pct"))


def flatline_runs(fact: DataFrame, value: str = "value_clean", min_rows: int = K.FLATLINE_MIN_ROWS,
                  exclude_zero: bool = False, method: str = "window") -> DataFrame:
    """Maximal runs of identical consecutive readings (present
    rows; a missing hour does not break a run) of at least ``min_rows``.
    ``exclude_zero`` drops zero readings first (the raw-value detector).
    ``method="time"`` makes a missing hour break the run, ``method="time_chunked"``
    the same by chunks of a series."""
    f = fact.filter(F.col(value) != 0) if exclude_zero else fact
    tagged = runs(f.select(*SERIES, "obs_time", value), SERIES, "obs_time", value, _month_chunk(), method,
                  step_seconds=3600)
    return (tagged.groupBy(*SERIES, "_run")
                  .agg(F.min(value).alias("stuck_value"), F.min("obs_time").alias("run_start"),
                       F.max("obs_time").alias("run_end"), F.count(F.lit(1)).alias("hours_stuck"))
                  .filter(F.col("hours_stuck") >= min_rows)
                  .drop("_run"))


def sensor_health(anomaly: DataFrame) -> DataFrame:
    """Station-month report card."""
    monthly = anomaly.groupBy("site_id", "parameter_code",
                              F.trunc("obs_date", "month").alias("month_start")).agg(
        F.count(F.lit(1)).alias("readings"),
        F.count_if(F.col("anomaly_class") == "extreme").alias("extreme_count"),
        F.count_if(F.col("anomaly_class") == "unusual").alias("unusual_count"),
        fixed(F.avg("value_clean"), 3).alias("mean_value"),
        fixed(F.stddev("value_clean"), 3).alias("sd_value"))
    expected = F.dayofmonth(F.last_day("month_start")) * 24
    comp = pct(F.col("readings"), F.col("expected_readings"))
    ext = pct(F.col("extreme_count"), F.col("readings"))
    return (monthly.withColumn("expected_readings", expected)
                   .select("*", fixed(comp, 1).alias("completeness_pct"),
                           fixed(ext, 2).alias("extreme_pct"),
                           health_status(comp, ext).alias("health_status")))


def seasonal_anomaly(fact: DataFrame, exclude_current_year: bool = False) -> DataFrame:
    """Z-score of each reading against its station's calendar-month
    norm. Default: the norm over all years (current included). With
    ``exclude_current_year`` the norm uses the other years only, so no reading
    is compared with itself: the moments of the years before and after, merged."""
    f = fact.withColumn("mth", F.month("obs_date"))
    keys = [*SERIES, "mth"]
    if not exclude_current_year:
        # One scan and one shuffle: a group holds a month of each year of a series.
        same = Window.partitionBy(*keys)
        j = f.withColumns({"seasonal_mean": F.avg("value_clean").over(same), "seasonal_sd": F.stddev("value_clean").over(same)})
    else:
        yr = f.withColumn("yr", F.year("obs_date"))
        per = yr.groupBy(*keys, "yr").agg(M.aggregate("value_clean").alias("_y"))
        by_year = Window.partitionBy(*keys).orderBy("yr")  # a row for each year
        others = F.concat(F.collect_list("_y").over(by_year.rowsBetween(Window.unboundedPreceding, -1)),
                          F.collect_list("_y").over(by_year.rowsBetween(1, Window.unboundedFollowing)))
        norms = per.withColumn("_o", M.merge_all(others)).select(
            *keys, "yr", M.mean(M.fields("_o")).alias("seasonal_mean"), M.sd(M.fields("_o")).alias("seasonal_sd"))
        j = yr.join(norms, [*keys, "yr"], "inner")
    return j.select("site_id", "parameter_code", "obs_time", "obs_date", "value_clean",
                    fixed(F.col("seasonal_mean"), 3).alias("seasonal_mean"),
                    fixed(safe_div(F.col("value_clean") - F.col("seasonal_mean"), F.col("seasonal_sd")), 2)
                    .alias("seasonal_z"))
