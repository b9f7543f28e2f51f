"""The pipeline as a production run: every layer is written under a root in
shared storage and read back before the next one is built.

Writing a layer cuts the lineage (a lost executor recomputes from the last
written layer, not from the raw scan) and lets later steps prune: the silver
layer is partitioned by ``parameter_code`` and ``year``, so a query on one
pollutant reads only its folders. Layers are written with ``mode("overwrite")``
into the run's own root; a rerun uses a new root.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from hourglass import constants as K
from hourglass.operators import anomaly as AN
from hourglass.operators import events as EV
from hourglass.operators import gold as G
from hourglass.operators import quality as Q
from hourglass.operators import silver as S
from hourglass.sources import adapters as A
from hourglass.sources.sinks import overwrite


@dataclass
class Layers:
    bronze: DataFrame
    silver: DataFrame
    fact: DataFrame
    dim: DataFrame
    daily: DataFrame
    regional: DataFrame
    wide: DataFrame
    anomaly: DataFrame
    classification: DataFrame
    metrics: dict[str, dict]


def run(spark: SparkSession, sf_dir: str, root: str) -> Layers:
    """Writes every layer; ``metrics`` holds what was observed of them on the way."""
    wanted, metrics = Q.write_metrics(), {}

    def put(df: DataFrame, name: str, partition_by: list[str] | None = None, layer: str | None = None) -> DataFrame:
        path = f"{root.rstrip('/')}/{name}"
        seen = Observation() if layer else None
        overwrite(df, path, partition_by, (seen, wanted[layer]) if layer else None)
        if layer:
            metrics[layer] = seen.get
        return spark.read.parquet(path)

    bronze = put(A.hourly_records(spark, sf_dir), "bronze", layer="bronze")
    silver = put(S.silver(bronze), "silver", ["parameter_code", "year"], "silver")
    fact = put(S.dedup(silver.select(*S.FACT_COLUMNS)), "fact")
    dim = put(G.dim_station(A.station_details(spark, sf_dir)), "dim_station")
    daily = put(G.gold_daily(silver, dim), "gold_daily", layer="daily")
    long_silver = put(S.silver(A.long_records(spark, sf_dir)), "long_silver", ["parameter_code", "year"])
    regional = put(G.gold_regional(long_silver, dim), "gold_regional", layer="regional")
    wide = put(G.hourly_wide(silver), "hourly_wide")
    fact1 = put(S.fact_observation(bronze), "fact_observation")
    anomaly = put(AN.observation_anomaly(fact1), "observation_anomaly")
    cls = put(EV.hourly_classification(EV.hourly_network_state(anomaly)), "hourly_classification")
    return Layers(bronze, silver, fact, dim, daily, regional, wide, anomaly, cls, metrics)


def gate(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """Run the materialized pipeline; the quality gate comes from what was
    observed while the layers were written, and from their grain."""
    t = run(spark, sf_dir, root)
    return Q.observed_gate(t.metrics, t.silver, t.daily, t.regional, K.MAX_DROP_RATE)


def main(argv: list[str] | None = None) -> None:
    """``python -m hourglass.plans.pipeline SF_DIR OUT_ROOT``: build every layer
    under OUT_ROOT (shared storage on a cluster), then print the gate and
    exit non-zero when a check fails."""
    import sys

    from hourglass.session import get_session
    args = argv if argv is not None else sys.argv[1:]
    if len(args) != 2:
        raise SystemExit("usage: python -m hourglass.plans.pipeline SF_DIR OUT_ROOT")
    spark = get_session()
    g = gate(spark, args[0], args[1])
    g.show(truncate=False)
    Q.assert_gate(g)


if __name__ == "__main__":
    main()
