"""Ordered-sequence primitives that do not put a whole series in one task.

A window ``PARTITION BY series ORDER BY time`` sends every row of a series to
one task; if one station/parameter holds a third of all rows, that task holds
a third of the data. Here a series is cut into time chunks (e.g. months) and
the work is done in two levels, like a parallel prefix sum:

1. one window pass over ``(series, chunk)`` partitions computes chunk-local
   row numbers, prefix sums, previous values and change flags;
2. the first row of every chunk carries the chunk totals; a window over those
   few rows per series (one per chunk) turns them into offsets;
3. the offsets are joined back on ``(series, chunk)`` — the big side is
   already hash-partitioned on exactly those columns, so it is not shuffled
   again.

Outputs (global, i.e. across chunks, per series):
``_idx``   0-based row position;
``_pre_<c>`` sum of ``c`` over all *earlier* rows (exclusive prefix);
``_prev_<c>`` value of ``c`` on the previous row (NULL on the first row);
``_run``   1-based id of the maximal run of equal ``runs_of`` values (null-safe);
``_chg``   1 when the row starts a new run, else 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CHUNK = "_chunk"


def sequence(df: DataFrame, keys: list[str], order: str, chunk: Column,
             sums: tuple[str, ...] = (), lags: tuple[str, ...] = (),
             runs_of: str | None = None, materialize_local: bool = True) -> DataFrame:
    lags = tuple(dict.fromkeys(lags + ((runs_of,) if runs_of else ())))
    # dealt out by chunk even where the rows come partitioned by series
    d = df.withColumn(CHUNK, chunk).repartition(*keys, CHUNK)
    w = Window.partitionBy(*keys, CHUNK).orderBy(order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = w.rowsBetween(Window.unboundedPreceding, -1)

    local = [F.row_number().over(w).alias("_rn"), F.count(F.lit(1)).over(whole).alias("_cn")]
    for c in sums:
        local += [F.sum(c).over(before).alias(f"_lx_{c}"), F.sum(c).over(whole).alias(f"_tot_{c}")]
    for c in lags:
        local += [F.lag(c).over(w).alias(f"_ll_{c}"), F.last(c).over(whole).alias(f"_last_{c}")]
    for c in ((runs_of,) if runs_of else ()):
        local += [F.first(c).over(whole).alias(f"_f_{c}")]
    d = d.select("*", *local)
    if runs_of:
        # change flag inside the chunk; the chunk's first row is settled at level 2
        chg = F.when(F.col("_rn") == 1, F.lit(0)).otherwise(
            F.when(F.col(runs_of).eqNullSafe(F.col(f"_ll_{runs_of}")), 0).otherwise(1))
        d = d.withColumn("_lchg", chg)
        d = d.select("*", F.sum("_lchg").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_lrun"),
                     F.sum("_lchg").over(whole).alias("_tchg"))

    if materialize_local:
        # the chunk-local pass feeds both the chunk table and the join back:
        # write it once instead of planning it (and everything upstream) twice
        from hourglass.sources.sinks import materialize
        d = materialize(d, "sequence-local")

    # level 2: one row per chunk -> offsets
    carry = ["_cn"] + [f"_tot_{c}" for c in sums] + [f"_last_{c}" for c in lags] + \
            ([f"_f_{runs_of}"] if runs_of else []) + \
            (["_tchg"] if runs_of else [])
    chunks = d.filter(F.col("_rn") == 1).select(*keys, CHUNK, *carry)
    wc = Window.partitionBy(*keys).orderBy(CHUNK)
    wc_before = wc.rowsBetween(Window.unboundedPreceding, -1)
    off = [F.coalesce(F.sum("_cn").over(wc_before), F.lit(0)).alias("_off_n")]
    for c in sums:
        off += [F.coalesce(F.sum(f"_tot_{c}").over(wc_before), F.lit(0)).alias(f"_off_{c}")]
    for c in lags:
        off += [F.lag(f"_last_{c}").over(wc).alias(f"_pl_{c}")]
    if runs_of:
        first_flag = F.when(F.row_number().over(wc) == 1, F.lit(1)).when(
            F.col(f"_f_{runs_of}").eqNullSafe(F.lag(f"_last_{runs_of}").over(wc)), 0).otherwise(1)
        off += [first_flag.alias("_ff")]
    chunks = chunks.select(*keys, CHUNK, "_tchg" if runs_of else F.lit(0).alias("_tchg"), *off)
    if runs_of:
        chunks = chunks.withColumn(
            "_runs_before",
            F.coalesce(F.sum(F.col("_ff") + F.col("_tchg")).over(wc_before), F.lit(0)))
    chunks = chunks.drop("_tchg")

    j = d.drop(*[f"_tot_{c}" for c in sums], *[f"_last_{c}" for c in lags], "_tchg", "_cn",
               *[c for c in d.columns if c.startswith("_f_")]).join(chunks, [*keys, CHUNK], "inner")
    out = [F.col("*"), (F.col("_off_n") + F.col("_rn") - 1).alias("_idx")]
    for c in sums:
        out.append((F.col(f"_off_{c}") + F.coalesce(F.col(f"_lx_{c}"), F.lit(0))).alias(f"_pre_{c}"))
    for c in lags:
        out.append(F.when(F.col("_rn") == 1, F.col(f"_pl_{c}")).otherwise(F.col(f"_ll_{c}")).alias(f"_prev_{c}"))
    if runs_of:
        out.append((F.col("_runs_before") + F.col("_ff") + F.col("_lrun")).alias("_run"))
        out.append(F.when(F.col("_rn") == 1, F.col("_ff")).otherwise(F.col("_lchg")).alias("_chg"))
    res = j.select(*out)
    internal = ["_rn", "_off_n", "_ff", "_runs_before", "_lchg", "_lrun"] + \
        [f"_lx_{c}" for c in sums] + [f"_off_{c}" for c in sums] + \
        [f"_ll_{c}" for c in lags] + [f"_pl_{c}" for c in lags]
    return res.drop(*[c for c in internal if c in res.columns])


def runs(df: DataFrame, keys: list[str], order: str, state: str, chunk: Column,
         method: str = "window", step_seconds: int | None = None) -> DataFrame:
    """Gaps-and-islands: tag each row with the id of its maximal run of equal
    ``state`` values in ``order`` within ``keys`` (``_run``; rows of one run
    share it, within ``keys``).

    ``method="window"``: ROW_NUMBER() - ROW_NUMBER() BY state, one shuffle,
    every series sorted in one task. ``method="chunked"``: run ids from the
    chunked sequence (no single-task series), if the caller asks for it. ``method="time"``: runs must also be consecutive in
    time (``step_seconds`` apart for timestamps, 1 for day numbers); ``method="time_chunked"``: the same from two chunked
    sequences, one for the row before, one to number the breaks. Both take one row per time."""
    if method == "time":
        # consecutive in time: rows one ``step_seconds`` apart with equal state;
        # island key = time - rank-within-state * step (missing hours break runs)
        w_state = Window.partitionBy(*keys, state).orderBy(order)
        secs = F.col(order).cast("timestamp").cast("long") if step_seconds else F.col(order)
        grp = secs - F.row_number().over(w_state) * F.lit(step_seconds or 1)
        return df.withColumn("_run", F.struct(F.col(state).alias("s"), grp.alias("g")))
    if method == "time_chunked":
        secs = F.col(order).cast("timestamp").cast("long") if step_seconds else F.col(order)
        d = sequence(df.withColumn("_secs", secs), keys, order, chunk, lags=(state, "_secs")).drop(CHUNK, "_idx")
        goes_on = F.col(state).eqNullSafe(F.col(f"_prev_{state}")) & F.col("_prev__secs").eqNullSafe(F.col("_secs") - (step_seconds or 1))
        d = d.withColumn("_break", F.when(goes_on, 0).otherwise(1)).drop(f"_prev_{state}", "_prev__secs", "_secs")
        return sequence(d, keys, order, chunk, sums=("_break",)).withColumn("_run", F.col("_pre__break") + F.col("_break")) \
            .drop(CHUNK, "_idx", "_break", "_pre__break")
    if method == "window":
        w_all = Window.partitionBy(*keys).orderBy(order)
        w_state = Window.partitionBy(*keys, state).orderBy(order)
        grp = F.row_number().over(w_all) - F.row_number().over(w_state)
        return df.withColumn("_run", F.struct(F.col(state).alias("s"), grp.alias("g")))
    return sequence(df, keys, order, chunk, runs_of=state).drop(CHUNK, f"_prev_{state}", "_chg", "_idx")
