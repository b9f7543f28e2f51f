"""The pipeline as lazily-built DataFrames over one scale-factor directory.

``Pipeline(spark, sf_dir)`` exposes every layer as a property; nothing runs
until an action. Two source chains feed it:

* hourly — ``events`` -> bronze -> silver (Gen 2 rules) -> deduplicated fact
  -> daily / profile / wide / exceedance; and the Gen 1 pollutant fact ->
  anomaly -> network state -> classification -> episodes, flatline, health,
  sweep;
* long   — ``lineitem`` -> bronze -> silver -> fact -> regional trend,
  seasonal z-scores.

``plans.pipeline.run`` is the same chain with every layer written to shared
storage and read back (lineage cut at each layer).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass import constants as K
from hourglass.operators import anomaly as AN
from hourglass.operators import events as EV
from hourglass.operators import gold as G
from hourglass.operators import silver as S
from hourglass.operators import sketches as SK
from hourglass.plans.params import DENSE_MONTH, DENSE_SWEEP_SLICE, MONTH, SWEEP_SLICE
from hourglass.sources import adapters as A
from hourglass.sources.sinks import materialize


class Pipeline:
    month, sweep_slice = MONTH, SWEEP_SLICE

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    # ---- hourly chain ---------------------------------------------------
    @cached_property
    def bronze(self) -> DataFrame:
        return A.hourly_records(self.spark, self.sf_dir)

    @cached_property
    def flat(self) -> DataFrame:
        return S.flatten(self.bronze)

    @cached_property
    def silver(self) -> DataFrame:
        return S.silver(self.bronze)

    @cached_property
    def fact(self) -> DataFrame:
        """Gen 2 silver, one row per grain key."""
        return S.dedup(self.silver.select(*S.FACT_COLUMNS))

    @cached_property
    def tagged(self) -> DataFrame:
        """Gen 1 tagging over all parameters (reject reasons)."""
        return S.reject_reason(S.clean(self.flat, generation=1))

    @cached_property
    def quarantine(self) -> DataFrame:
        return S.split_quarantine(self.tagged)[1]

    @cached_property
    def fact1(self) -> DataFrame:
        """Gen 1 pollutant fact (input of the detectors)."""
        return S.fact_observation(self.bronze)

    @cached_property
    def fact_with_nulls(self) -> DataFrame:
        """As ``fact1``, with rows whose reading is missing."""
        rows = self.tagged.filter(F.coalesce("reject_reason", F.lit("null_value")) == "null_value")
        return S.dedup(rows.filter(F.col("parameter_code").isin(K.POLLUTANTS)).select(*S.FACT_COLUMNS))

    @cached_property
    def dim(self) -> DataFrame:
        """Station dimension, unhinted: AQE broadcasts it when its size, as
        measured in the running query, allows that."""
        return G.dim_station(A.station_details(self.spark, self.sf_dir))

    @cached_property
    def daily(self) -> DataFrame:
        return G.gold_daily(self.silver, self.dim)

    @cached_property
    def profile(self) -> DataFrame:
        return G.site_hourly_profile(self.fact1, self.dim)

    @cached_property
    def sketches(self) -> DataFrame:
        """The sketch table, written once; reports merge its column."""
        return materialize(SK.sketch_table(self.fact1, self.quarantine), "sketches")

    @cached_property
    def wide(self) -> DataFrame:
        return G.hourly_wide(self.silver)

    def exceedance(self, min_completeness: float = K.MIN_DAILY_COMPLETENESS) -> DataFrame:
        return G.exceedance_events(self.daily, G.standards_frame(self.spark), min_completeness)

    @cached_property
    def anomaly(self) -> DataFrame:
        return AN.observation_anomaly(self.fact1)

    @cached_property
    def state(self) -> DataFrame:
        return EV.hourly_network_state(self.anomaly)

    @cached_property
    def classification(self) -> DataFrame:
        return EV.hourly_classification(self.state)

    @cached_property
    def events(self) -> DataFrame:
        return EV.air_quality_event(self.classification)

    @cached_property
    def health(self) -> DataFrame:
        return AN.sensor_health(self.anomaly)

    # ---- long chain -----------------------------------------------------
    @cached_property
    def long_bronze(self) -> DataFrame:
        return A.long_records(self.spark, self.sf_dir)

    @cached_property
    def long_silver(self) -> DataFrame:
        return S.silver(self.long_bronze)

    @cached_property
    def long_fact(self) -> DataFrame:
        return S.dedup(self.long_silver.select(*S.FACT_COLUMNS))

    @cached_property
    def regional(self) -> DataFrame:
        return G.gold_regional(self.long_silver, self.dim)

    @cached_property
    def seasonal(self) -> DataFrame:
        return AN.seasonal_anomaly(self.long_fact)


class Dense(Pipeline):
    """The hourly chain over the dense records."""

    month, sweep_slice = DENSE_MONTH, DENSE_SWEEP_SLICE

    @cached_property
    def bronze(self) -> DataFrame:
        return A.dense_records(self.spark, self.sf_dir)


class Sentinel(Dense):
    """The dense records with start-up readings far off in some series."""

    @cached_property
    def bronze(self) -> DataFrame:
        return A.sentinel_records(self.spark, self.sf_dir)


class Written(Pipeline):
    """The pipeline with every layer written once under the shared folder and
    read back, for checks that read several layers: each source is scanned
    once, and a layer is one scan of the layer before it."""


def _written(name: str):
    def layer(self: Written) -> DataFrame:
        return materialize(getattr(Pipeline, name).func(self), f"layer-{name}")
    layer.__name__ = name
    return layer


for _name in ("bronze", "flat", "silver", "tagged", "fact", "fact1", "dim", "daily", "wide", "anomaly", "long_silver", "regional", "health"):
    _layer = cached_property(_written(_name))
    _layer.__set_name__(Written, _name)
    setattr(Written, _name, _layer)
