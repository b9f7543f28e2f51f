"""Incremental gold (A11, H4): partial aggregates that micro-batches add to, and
the gold tables as views over them.

The state holds, for each batch, the sum, count and extremes of every station,
parameter, units and date that the batch touches, in the directory
``obs_date=<day>/batch_id=<id>``. A batch writes its own directories only (dynamic
partition overwrite): a batch of one day writes one, nothing that is there is read,
changed or deleted, a replayed batch overwrites what it wrote before, and a
crash between two directories is mended by the replay. The views add the
partial rows up: as many for a day as batches touched it, until ``compacted``
writes them as one into a new state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass import constants as K
from hourglass.operators import gold as G
from hourglass.functions.exprs import fixed, pct, safe_div

GRAIN = ["site_id", "parameter_code", "units", "obs_date"]
STATE_SCHEMA = T.StructType([
    T.StructField("site_id", T.IntegerType()), T.StructField("parameter_code", T.StringType()), T.StructField("units", T.StringType()),
    T.StructField("total", T.DoubleType()), T.StructField("valid", T.LongType()), T.StructField("least", T.DoubleType()),
    T.StructField("most", T.DoubleType()), T.StructField("obs_date", T.DateType()), T.StructField("batch_id", T.LongType())])


def partials(silver: DataFrame) -> DataFrame:
    obs = silver.filter(F.col("parameter_code").isin(K.POLLUTANTS))
    v = F.col("value_clean")
    return obs.groupBy(*GRAIN).agg(F.sum(v).alias("total"), F.count(v).alias("valid"), F.min(v).alias("least"), F.max(v).alias("most"))


def _summed(state: DataFrame) -> DataFrame:
    return state.groupBy(*GRAIN).agg(F.sum("total").alias("total"), F.sum("valid").alias("valid"),
                                     F.min("least").alias("least"), F.max("most").alias("most"))


def _written(rows: DataFrame, state_dir: str) -> None:
    rows.select(*[f.name for f in STATE_SCHEMA]).hint("rebalance", "obs_date") \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .option("compression", "zstd").partitionBy("obs_date", "batch_id").parquet(state_dir)


def add_batch(batch: DataFrame, batch_id: int, state_dir: str) -> None:
    """Adds a micro-batch of silver rows to the state; the same batch twice counts once."""
    _written(partials(batch).withColumn("batch_id", F.lit(batch_id).cast("long")), state_dir)


def read_state(spark: SparkSession, state_dir: str) -> DataFrame:
    return spark.read.schema(STATE_SCHEMA).parquet(state_dir)


def compacted(spark: SparkSession, state_dir: str, new_dir: str) -> str:
    """The state with one partial row for each grain, under ``new_dir``, to which
    later batches are added. The rows bear the last batch's id; as that batch may
    be replayed once more, it must be committed before."""
    state = read_state(spark, state_dir)
    last = state.agg(F.max("batch_id")).first()[0] or 0  # one number
    _written(_summed(state).withColumn("batch_id", F.lit(last).cast("long")), new_dir)
    return new_dir


def gold_daily(state: DataFrame, dim: DataFrame) -> DataFrame:
    """D1 over the state, as ``gold.gold_daily`` over all silver rows."""
    daily = _summed(state).select(
        *GRAIN, safe_div(F.col("total"), F.col("valid")).alias("daily_avg"), F.col("most").alias("daily_max"),
        F.col("least").alias("daily_min"), F.col("valid").alias("valid_hours"),
        fixed(pct(F.col("valid"), F.lit(24)), 1).alias("completeness_pct"))
    return G.with_station(daily, dim)


def gold_regional(state: DataFrame, dim: DataFrame, lag_mode: str = "rows") -> DataFrame:
    """D3, E2, E3 over the same state."""
    per_site = state.groupBy("site_id", "parameter_code", "units", F.trunc("obs_date", "month").alias("month_start")) \
        .agg(F.sum("total").alias("s"), F.sum("valid").alias("n"))
    return G.regional_trend(G.regional_months(per_site, dim), lag_mode)
