"""Scans of the supplied parquet tables.

Column lists are passed explicitly so the ReadSchema of every scan holds only
what the query uses; predicates written on bare columns reach the parquet
reader as PushedFilters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Declared schemas of the supplied tables this library reads. Passing the
# schema skips the footer-inference job Spark otherwise runs per read (one
# job per table per query) and pins the types the code relies on
# (timestamps are wall-clock TIMESTAMP_NTZ).
SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


#: Rows of a table that one task sorts, where a query cuts its tasks by rows.
TASK_ROWS = 100_000


def tasks_for(df: DataFrame, rows: int = TASK_ROWS) -> int:
    """Tasks that take ``rows`` rows of ``df`` each. Spark merges shuffled partitions
    until they are as few as the cores or of its advisory size *compressed*, which
    sorts and windows hold unpacked; a number given keeps a task's memory the same
    however large the table is. The rows of a table are counted from its files' footers."""
    return max(-(-df.count() // rows), df.sparkSession.sparkContext.defaultParallelism)
