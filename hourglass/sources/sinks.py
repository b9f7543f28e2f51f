"""Sinks: overwrite with schema replacement (A9) and an idempotent upsert
(A14) for tables stored as plain Parquet (no MERGE available).

``upsert`` writes a new version of a small table. ``upsert_partitions`` works
in place on a table partitioned by a column: only the partitions that the
source touches are read, merged and rewritten (dynamic partition overwrite);
all others keep their files. Replaying the same source yields the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from hourglass.operators.silver import dedup


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None,
              observed: tuple[Observation, list[Column]] | None = None) -> str:
    """Rows of a partitioned table meet by partition first (REBALANCE: large
    partitions are split over several tasks), so that each partition gets one
    file or few, not one from every task."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if observed:  # by the writing tasks, whose results count once whatever is recomputed before them
        df = df.observe(observed[0], *observed[1])
    w = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder
    (``spark.checkpoint.dir``) and return a DataFrame reading it back.

    Used where one intermediate feeds several branches of a plan (Spark
    would otherwise recompute it per branch) and to cut long lineages: a
    lost executor recomputes from this table, not from the raw scan. (A
    reliable ``checkpoint()`` would compute the input twice unless it is
    also persisted.)"""
    import uuid

    from hourglass.session import shared_path
    spark = df.sparkSession
    path = shared_path(spark, "tmp", f"{tag}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def merged(target: DataFrame, source: DataFrame, keys: list[str], order: tuple[str, ...]) -> DataFrame:
    """Target rows with the source's in place of those of equal keys. Of several
    source rows of one key the one that sorts last on ``order`` counts."""
    src = dedup(source, keys, order)
    return target.join(src.select(*keys), keys, "left_anti").unionByName(src.select(*target.columns))


def upsert(spark: SparkSession, target_path: str, source: DataFrame, keys: list[str],
           out_path: str, order: tuple[str, ...]) -> DataFrame:
    """Update matched keys, insert unmatched ones, into ``out_path``."""
    overwrite(merged(spark.read.parquet(target_path), source, keys, order), out_path)
    return spark.read.parquet(out_path)


def upsert_partitions(spark: SparkSession, path: str, source: DataFrame, keys: list[str], partition: str,
                      order: tuple[str, ...]) -> None:
    """Upsert into the table at ``path``, partitioned by ``partition`` (which
    the keys determine). The touched partitions are merged into a table of
    their own first, so that nothing is overwritten while it is read. Of the
    overwrite, partitions are replaced one after the other: a crash between two
    leaves some new and some old, each whole; the same source again replaces
    them all, with the same rows."""
    target = spark.read.parquet(path)
    touched = source.select(partition).distinct()
    new = materialize(merged(target.join(touched, partition, "left_semi"), source, keys, order), "upsert")
    new.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd") \
        .partitionBy(partition).parquet(path)
