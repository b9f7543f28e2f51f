"""Intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from hourglass.session import shared_path


def new_path(spark: SparkSession, tag: str) -> str:
    """A fresh path under the folder that ``spark.checkpoint.dir`` names."""
    return shared_path(spark, "llm", f"{tag}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once and return the reread table: cuts lineage, and several
    readers share one computation. Files outlive the loss of any executor."""
    path = new_path(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows in an Arrow batch: they hold whole texts, and both sides keep a batch in memory.
BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's rows per Arrow batch if it allows more."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


@contextmanager
def batch_rows(spark: SparkSession, rows: int):
    """At most ``rows`` rows in an Arrow batch of what is run inside; the session's
    setting comes back afterwards."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) <= rows:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)
