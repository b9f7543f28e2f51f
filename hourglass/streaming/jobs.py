"""Incremental ingest and streaming silver, plus the file-based keys.

* ``stream_bronze``  (A2/A3/A4/H1/H3): file source over the landing folder,
  ``availableNow`` trigger, checkpointed, so a rerun reads only files it
  has not seen; the rescue column is built inside the stream.
* ``stream_silver``  (A5/H2/B8/B10): stream over the bronze sink; each
  micro-batch writes kept rows and rejected rows (two sinks) through
  ``foreachBatch`` into a directory named by the batch id, so a replayed
  batch overwrites its own output (idempotent); expectation counts are
  published with ``observe``. ``dedup_within`` puts watermarked dedup state
  between bronze and silver (D14), ``state_dir`` adds each batch to the
  incremental gold (A11/H4).
* ``stream_sessions`` (D16/E5/X3): session windows give runs of consecutive
  hours as they end.

Output folders live under the shared checkpoint folder of the session
(``spark.checkpoint.dir``), never under the input directory."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass import constants as K
from hourglass.operators import quality as Q
from hourglass.operators import silver as S
from hourglass.functions.exprs import fixed
from hourglass.operators.gold import dim_station
from hourglass.plans.catalog import QUERIES
from hourglass.plans.context import Dense
from hourglass.session import shared_path
from hourglass.sources import adapters as A
from hourglass.sources import drift
from hourglass.sources import raw_json as RJ
from hourglass.sources.sinks import materialize, overwrite, upsert_partitions
from hourglass.sources.tables import tasks_for
from hourglass.streaming import incremental

BRONZE_SCHEMA = T.StructType(RJ.RAW_SCHEMA.fields + [
    T.StructField("_rescued_data", T.StringType()), T.StructField("_ingested_at", T.TimestampType()),
    T.StructField("_source_file", T.StringType())])


def run_dir(spark: SparkSession, tag: str) -> str:
    return shared_path(spark, "runs", f"{tag}-{uuid.uuid4().hex[:12]}")


def land_hourly(spark: SparkSession, sf_dir: str) -> str:
    return RJ.land(A.hourly_records(spark, sf_dir), run_dir(spark, "raw"))


def bronze_stream_frame(spark: SparkSession, raw_dir: str, max_files_per_trigger: int | None = None,
                        whole: bool = True) -> DataFrame:
    """``whole``: files are JSON arrays; otherwise one record per line."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = RJ.rescue(RJ.raw_text(reader, raw_dir, whole))
    return rows.select(*RJ.KNOWN, "_rescued_data", F.current_timestamp().alias("_ingested_at"),
                       RJ.chunk_name(F.col("_source_path")).alias("_source_file"))


def stream_bronze(spark: SparkSession, raw_dir: str, bronze_dir: str, checkpoint: str,
                  max_files_per_trigger: int | None = None, whole: bool = True) -> None:
    q = (bronze_stream_frame(spark, raw_dir, max_files_per_trigger, whole).writeStream.format("parquet")
         .outputMode("append").option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(bronze_dir))
    q.awaitTermination()


#: What makes two streamed records the same: everything but where they came from.
RECORD = ["site_id", "parameter_code", "units", "frequency", "obs_date", "hour_1based", "value", "aqi_category"]


def once(flat: DataFrame, within: str) -> DataFrame:
    """D14 in the stream: a record that came before, in whatever file, is dropped
    if it was ingested at most ``within`` before. The watermark is on ingest
    time, which only grows, so no record is ever late: observations of any age
    are kept. A replay after more than ``within`` counts as new; the state holds
    the records of that span."""
    stamped = flat.withColumn("_ingested_at", F.col("_ingested_at").cast("timestamp"))
    return stamped.withWatermark("_ingested_at", within).dropDuplicatesWithinWatermark(RECORD)


def stream_silver(spark: SparkSession, bronze_dir: str, silver_dir: str, quarantine_dir: str,
                  checkpoint: str, max_files_per_trigger: int | None = None,
                  dedup_within: str | None = None, state_dir: str | None = None) -> list[dict]:
    """Returns the per-batch expectation metrics collected by ``observe``."""
    reader = spark.readStream.schema(BRONZE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.parquet(bronze_dir)
    flat = S.flatten(src)
    flat = S.clean(once(flat, dedup_within) if dedup_within else flat, generation=2)
    metrics: list[dict] = []

    def per_batch(df: DataFrame, batch_id: int) -> None:
        # one micro-batch (bounded by maxFilesPerTrigger) feeds two sinks:
        # keep it for the duration of this function instead of reading it twice
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            obs = Observation(f"silver_{batch_id}")
            checks = [F.count_if(~S.passes(c)).alias(f"failed_{n}") for n, c in S.drop_rules() + S.track_rules()]
            observed = df.observe(obs, F.count(F.lit(1)).alias("rows"), *checks)
            # One rule set decides both sinks: a row has a reason exactly when a
            # drop expectation fails; implausible negatives are only counted.
            kept, _ = S.split_quarantine(S.reject_reason(observed, floor=None))
            overwrite(kept, f"{silver_dir}/batch_id={batch_id}")
            rejected = S.split_quarantine(S.reject_reason(df, floor=None))[1]
            overwrite(rejected, f"{quarantine_dir}/batch_id={batch_id}")
            if state_dir:
                incremental.add_batch(spark.read.parquet(f"{silver_dir}/batch_id={batch_id}"), batch_id, state_dir)
            metrics.append({"batch_id": batch_id, **obs.get})
        finally:
            df.unpersist()

    q = (flat.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return metrics


#: Longer than an hour, shorter than two: rows an hour apart are one session.
SESSION_GAP, SESSION_DELAY = "90 minutes", "2 hours"


def stream_sessions(rows: DataFrame, keys: list[str], aggregates: list, out_dir: str, checkpoint: str, min_rows: int) -> None:
    """X3 as a stream: runs of rows of equal ``keys`` an hour apart (``obs_time``),
    written to ``out_dir`` once they have ended. A run has ended when rows more than
    ``SESSION_DELAY`` after it have come; rows that come later than that are
    dropped. Runs that are open are kept under ``checkpoint`` for the next batch.

    ``aggregates``: (name, column, function), where the function of a run is that
    of its parts' results and of their type, as with min and max.

    Each micro-batch puts its rows and the runs left open together in tasks of a
    fixed number of rows. Only open runs are kept from batch to batch (a stateful
    aggregation keeps every run of a batch in its executors' memory until the next
    one). What a batch writes is named by its id: a replayed batch overwrites it."""
    state = f"{checkpoint}/open_runs"
    at, end = F.col("run_start").cast("timestamp"), F.col("run_end").cast("timestamp") + F.expr(f"INTERVAL {SESSION_GAP}")
    gap = F.make_interval(secs=(F.unix_micros(end) - F.unix_micros(at)) / 1_000_000)
    merged = [F.min("run_start").alias("run_start"), F.max("run_end").alias("run_end"), F.sum("run_rows").alias("run_rows"),
              *[fn(name).alias(name) for name, _, fn in aggregates]]
    # Text, so that it comes back in the column's type and the session's time zone.
    limit = (F.max("run_end") - F.expr(f"INTERVAL {SESSION_GAP}") - F.expr(f"INTERVAL {SESSION_DELAY}")).cast("string")

    def per_batch(df: DataFrame, batch_id: int) -> None:
        parts = df.select(*keys, F.col("obs_time").alias("run_start"), F.col("obs_time").alias("run_end"),
                          F.lit(1).cast("long").alias("run_rows"), *[F.col(c).alias(name) for name, c, _ in aggregates])
        time = parts.schema["run_end"].dataType
        if batch_id > 0:
            still_open = df.sparkSession.read.schema(parts.schema).parquet(f"{state}/{batch_id - 1}")
            before = still_open.agg(limit).first()[0]  # the latest row so far belongs to an open run
            if before is not None:
                parts = parts.filter(F.col("run_end") > F.lit(before).cast(time))
            parts = parts.unionByName(still_open)
        now = parts.agg(limit).first()[0]
        ended = F.col("run_end") <= F.lit(now).cast(time) if now is not None else F.lit(False)
        found = (parts.withColumn("_at", at).repartition(tasks_for(parts), *keys)
                 .groupBy(*keys, F.session_window("_at", gap)).agg(*merged).drop("session_window")
                 .filter(~ended | (F.col("run_rows") >= min_rows)).persist(StorageLevel.MEMORY_AND_DISK))
        try:
            overwrite(found.filter(~ended), f"{state}/{batch_id}")
            overwrite(found.filter(ended), f"{out_dir}/batch_id={batch_id}")
        finally:
            found.unpersist()

    q = (rows.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def arrivals(spark: SparkSession, rows: DataFrame, parts: int, tag: str):
    """``rows`` as a table that grows in ``parts`` steps of time; yields the file
    stream over it after each step. A stream drains what has come and goes on
    from its checkpoint."""
    rows = materialize(rows, tag)
    path = run_dir(spark, tag)
    first, last = rows.agg(F.min("obs_date"), F.max("obs_date")).first()  # two dates
    step = (last - first).days // parts + 1 if first else 1
    for i in range(parts if first else 0):
        part = rows.filter(F.datediff("obs_date", F.lit(first)).between(i * step, (i + 1) * step - 1))
        part.write.mode("append").parquet(path)
        yield spark.readStream.schema(rows.schema).parquet(path)


# ---- registered keys ----------------------------------------------------------
def _flat_raw(df: DataFrame) -> DataFrame:
    return df.select("Site_Id", "Parameter.*", "Date", "Hour", "Value", "AirQualityCategory",
                     *[c for c in df.columns if c in ("_rescued_data", "_source_file")])


def _bronze_batch(spark, sf_dir):
    raw = land_hourly(spark, sf_dir)
    df = RJ.read_raw(spark, raw)
    return _flat_raw(df.withColumn("_source_file", RJ.chunk_name(F.col("_source_path"))))


def _bronze_rescued(spark, sf_dir):
    return _flat_raw(RJ.read_rescued(spark, land_hourly(spark, sf_dir)))


def _drift_schema(spark, sf_dir):
    return drift.drift_schema(RJ.read_rescued(spark, land_hourly(spark, sf_dir)))


def _promoted_field(spark, sf_dir):
    """The drifting field ``k`` as a typed column, of a table that was written before it was known."""
    path = run_dir(spark, "bronze")
    RJ.read_rescued(spark, land_hourly(spark, sf_dir)).write.parquet(path)
    rows = drift.promote(spark.read.parquet(path), "k", "int")
    return rows.select("Site_Id", "Parameter.ParameterCode", "Date", "Hour", "Value", "k", "_rescued_data")


def _bronze_stream(spark, sf_dir):
    raw, out = land_hourly(spark, sf_dir), run_dir(spark, "bronze")
    ck = run_dir(spark, "ckpt")
    stream_bronze(spark, raw, out, ck, max_files_per_trigger=16)
    stream_bronze(spark, raw, out, ck)      # rerun: nothing new, nothing added
    return _flat_raw(spark.read.parquet(out))


def _silver_stream(spark, sf_dir):
    return _streamed_silver(spark, sf_dir).select(
        "site_id", "parameter_code", "units", "obs_date", "hour_1based", "obs_time", "value",
        "below_detection", "value_clean", "_source_file")


def _streamed(spark, sf_dir) -> tuple[str, str, str]:
    """Paths of bronze, silver and quarantine after the streams have drained."""
    raw, bronze, silver, quar = (land_hourly(spark, sf_dir), run_dir(spark, "bronze"),
                                 run_dir(spark, "silver"), run_dir(spark, "quarantine"))
    stream_bronze(spark, raw, bronze, run_dir(spark, "ckpt"))
    stream_silver(spark, bronze, silver, quar, run_dir(spark, "ckpt"))
    return bronze, silver, quar


def _streamed_silver(spark, sf_dir) -> DataFrame:
    return spark.read.parquet(_streamed(spark, sf_dir)[1])


def stream_reconciliation(bronze: DataFrame, silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Bronze rows against silver and quarantine rows, and the silver rows that
    would be rejected (``overlap``)."""
    overlap = S.reject_reason(silver, floor=None).agg(
        F.count(F.lit(1)).alias("silver"), F.count_if(F.col("reject_reason").isNotNull()).alias("overlap"))
    one = Q.side_by_side(b=bronze.agg(F.count(F.lit(1)).alias("bronze")), s=overlap,
                         q=quarantine.agg(F.count(F.lit(1)).alias("quarantine")))
    return one.select("b.*", "s.silver", "q.*", "s.overlap").withColumn(
        "balanced", F.col("bronze") == F.col("silver") + F.col("quarantine"))


def _stream_reconciliation(spark, sf_dir):
    return stream_reconciliation(*(spark.read.parquet(p) for p in _streamed(spark, sf_dir)))


def stream_upsert(spark: SparkSession, source: DataFrame, path: str, keys: list[str], partition: str,
                  order: tuple[str, ...], checkpoint: str) -> None:
    """A14 from a stream: each micro-batch is upserted into the partitions it
    touches; a replayed batch changes nothing."""
    q = (source.writeStream.foreachBatch(lambda df, _: upsert_partitions(spark, path, df, keys, partition, order))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def _gold_daily_streamed(spark, sf_dir):
    """H4: the daily table as a batch view over the streaming silver table,
    read after the streams have drained (silver as streamed, duplicates
    included, as the declarative pipeline's view reads it)."""
    from hourglass.operators import gold as G
    return G.gold_daily(_streamed_silver(spark, sf_dir), dim_station(A.station_details(spark, sf_dir)))


def _replayed(spark, sf_dir) -> tuple[str, str]:
    """Silver and incremental state of a stream that got every raw file twice:
    the second time under other names and in later batches."""
    raw, bronze, silver, quar, state = (run_dir(spark, t) for t in ("raw", "bronze", "silver", "quarantine", "gold-state"))
    records = A.hourly_records(spark, sf_dir)
    again = records.withColumn("_source_file", F.concat(F.lit("again-"), "_source_file"))
    cks = run_dir(spark, "ckpt"), run_dir(spark, "ckpt")
    for part in (records, again):
        RJ.land(part, raw, mode="append")
        stream_bronze(spark, raw, bronze, cks[0])
        stream_silver(spark, bronze, silver, quar, cks[1], max_files_per_trigger=4, dedup_within="7 days", state_dir=state)
    return silver, state


def _silver_stream_replayed(spark, sf_dir):
    return spark.read.parquet(_replayed(spark, sf_dir)[0]).select(
        "site_id", "parameter_code", "units", "obs_date", "hour_1based", "obs_time", "value", "below_detection", "value_clean")


def _state(spark, sf_dir) -> DataFrame:
    """The incremental state after a stream of several batches."""
    raw, bronze, silver, quar, state = (run_dir(spark, t) for t in ("raw", "bronze", "silver", "quarantine", "gold-state"))
    RJ.land(A.hourly_records(spark, sf_dir), raw)
    stream_bronze(spark, raw, bronze, run_dir(spark, "ckpt"), max_files_per_trigger=16)
    stream_silver(spark, bronze, silver, quar, run_dir(spark, "ckpt"), max_files_per_trigger=8, state_dir=state)
    return incremental.read_state(spark, state)


def _gold_daily_incremental(spark, sf_dir):
    return incremental.gold_daily(_state(spark, sf_dir), dim_station(A.station_details(spark, sf_dir)))


def _gold_regional_incremental(spark, sf_dir):
    return incremental.gold_regional(_state(spark, sf_dir), dim_station(A.station_details(spark, sf_dir)))


STREAM_PARTS = 4


def _flatline_stream(spark, sf_dir):
    """Runs of equal readings in consecutive hours on the dense records that have ended."""
    out, ck = run_dir(spark, "sessions"), run_dir(spark, "ckpt")
    fact = Dense(spark, sf_dir).fact1.select(*K.SILVER_GRAIN, "obs_date", "value_clean")
    for rows in arrivals(spark, fact, STREAM_PARTS, "fact-stream"):
        stream_sessions(rows, ["site_id", "parameter_code", "value_clean"], [], out, ck, min_rows=2)
    return spark.read.schema("site_id int, parameter_code string, value_clean double, run_start timestamp_ntz, run_end timestamp_ntz, run_rows long") \
        .parquet(out).select("site_id", "parameter_code", F.col("value_clean").alias("stuck_value"), "run_start", "run_end",
                             F.col("run_rows").alias("hours_stuck"))


def _episodes_stream(spark, sf_dir):
    """Episodes of consecutive event hours on the dense records that have ended."""
    out, ck = run_dir(spark, "sessions"), run_dir(spark, "ckpt")
    hours = Dense(spark, sf_dir).classification
    hours = hours.withColumns({"obs_date": F.col("obs_time").cast("date"), "is_event": F.col("event_class").isin("widespread", "network_wide")})
    peaks = [("peak_stations_affected", "stations_anomalous", F.max), ("network_size", "stations_reporting", F.max),
             ("peak_concentration", "network_max", F.max)]
    for rows in arrivals(spark, hours, STREAM_PARTS, "hours-stream"):
        stream_sessions(rows, ["parameter_code", "is_event"], peaks, out, ck, min_rows=K.MIN_EPISODE_HOURS)
    found = spark.read.schema("parameter_code string, is_event boolean, run_start timestamp_ntz, run_end timestamp_ntz, run_rows long, "
                              "peak_stations_affected long, network_size long, peak_concentration double").parquet(out)
    return found.filter("is_event").select("parameter_code", F.col("run_start").alias("event_start"), F.col("run_end").alias("event_end"),
                                           F.col("run_rows").alias("duration_hours"), "peak_stations_affected", "network_size",
                                           fixed(F.col("peak_concentration"), 2).alias("peak_concentration"))


def _upsert_stream(spark, sf_dir):
    """A14 from a stream: the table after a stream of upserts, and the same files
    under a new checkpoint, as after its loss: each batch is replayed."""
    fact = S.dedup(S.silver(A.hourly_records(spark, sf_dir))).select(*UPSERT_COLS)
    path, source = run_dir(spark, "upsert"), run_dir(spark, "upsert-source")
    overwrite(fact, path, ["obs_date"])
    week = materialize(_reprocessed_week(spark.read.parquet(path).select(*UPSERT_COLS)), "upsert-week")
    week.repartition(4, "obs_date").write.parquet(source)
    for _ in range(2):
        rows = spark.readStream.schema(week.schema).option("maxFilesPerTrigger", 2).parquet(source)
        stream_upsert(spark, rows, path, K.SILVER_GRAIN, "obs_date", UPSERT_ORDER, run_dir(spark, "ckpt"))
    return spark.read.parquet(path).select(*[c for c in UPSERT_COLS if c != "obs_date"])


def _replay_equals_incremental(spark, sf_dir):
    """H5: bronze from a stream in small batches with a restart between, and from
    a replay of all files into an empty table: rows of both, and rows of one only."""
    raw = land_hourly(spark, sf_dir)
    step, whole, ck = run_dir(spark, "bronze"), run_dir(spark, "bronze"), run_dir(spark, "ckpt")
    for files in (8, None):
        stream_bronze(spark, raw, step, ck, max_files_per_trigger=files)
    stream_bronze(spark, raw, whole, run_dir(spark, "ckpt"))
    columns = [c.name for c in BRONZE_SCHEMA if c.name != "_ingested_at"]
    a, b = (spark.read.schema(BRONZE_SCHEMA).parquet(p).select(*columns) for p in (step, whole))
    side = a.withColumn("_a", F.lit(1)).unionByName(b.withColumn("_a", F.lit(-1)))
    each = side.groupBy(*columns).agg(F.count_if(F.col("_a") == 1).alias("n"), F.sum("_a").alias("_d"))
    return each.agg(F.sum("n").alias("incremental_rows"), (F.sum("n") - F.sum("_d")).alias("replayed_rows"),
                    F.coalesce(F.sum(F.abs("_d")), F.lit(0)).alias("different_rows"))


def _manifest(spark, sf_dir):
    return RJ.manifest(spark, land_hourly(spark, sf_dir))


def _chunk_status(spark, sf_dir):
    man = RJ.manifest(spark, land_hourly(spark, sf_dir))
    span = man.agg(F.min("year").alias("a"), F.max("year").alias("b")).first()   # two scalars
    stations = dim_station(A.station_details(spark, sf_dir))
    plan = RJ.chunk_plan(stations, K.PARAMETERS, span["a"], span["b"])
    return plan, man


def _rows_vs_manifest(spark, sf_dir):
    raw = land_hourly(spark, sf_dir)
    one = Q.side_by_side(t=RJ.read_raw(spark, raw).agg(F.count(F.lit(1)).alias("table_rows")),
                         m=RJ.manifest(spark, raw).agg(F.sum("records").alias("records_on_disk")))
    return one.select("t.*", "m.*").withColumn("difference", F.col("table_rows") - F.col("records_on_disk"))


def _reprocessed_week(fact: DataFrame) -> DataFrame:
    """The upsert source: one week of the fact re-cleaned with the Gen 1 rule
    (universal floor), so negative weather readings change value."""
    week = fact.filter((F.col("obs_date") >= F.lit("2024-01-08").cast("date")) &
                       (F.col("obs_date") < F.lit("2024-01-15").cast("date")))
    return week.withColumn("value_clean", F.greatest(F.col("value"), F.lit(0.0)))


UPSERT_COLS = ["site_id", "parameter_code", "obs_time", "obs_date", "value", "value_clean"]
UPSERT_ORDER = ("value", "value_clean")


def _upsert_versions(spark, sf_dir):
    """The table before, after the upsert and after its replay, by versions of
    the partitioned table; and the source."""
    fact = S.dedup(S.silver(A.hourly_records(spark, sf_dir))).select(*UPSERT_COLS)
    root = run_dir(spark, "upsert")
    overwrite(fact, f"{root}/v0")
    v0 = spark.read.parquet(f"{root}/v0")
    table = f"{root}/table"
    v0.write.partitionBy("obs_date").parquet(table)
    src = _reprocessed_week(v0)
    after = []
    for _ in range(2):  # the upsert, and its replay
        upsert_partitions(spark, table, src, K.SILVER_GRAIN, "obs_date", UPSERT_ORDER)
        after.append(materialize(spark.read.parquet(table).select(*UPSERT_COLS), "upsert-version"))
    return [v0, *after], src


def _upsert_replay(spark, sf_dir):
    return _upsert_versions(spark, sf_dir)[0][2].drop("obs_date")


def _upsert_counts(spark, sf_dir):
    """Rows before, after the upsert, after the replay; changed rows."""
    (v0, v1, v2), src = _upsert_versions(spark, sf_dir)
    changed = (v0.alias("a").join(v2.alias("b"), K.SILVER_GRAIN)
                 .filter(~F.col("a.value_clean").eqNullSafe(F.col("b.value_clean"))))
    return Q.row_counts({"rows_before": v0, "rows_after_upsert": v1, "rows_after_replay": v2,
                         "source_rows": src, "changed_rows": changed})


QUERIES.update({
    "bronze_batch": _bronze_batch,
    "bronze_rescued": _bronze_rescued,
    "drift_schema": _drift_schema,
    "promoted_field": _promoted_field,
    "bronze_stream": _bronze_stream,
    "silver_stream": _silver_stream,
    "stream_reconciliation": _stream_reconciliation,
    "gold_daily_streamed": _gold_daily_streamed,
    "ingest_manifest": _manifest,
    "manifest_by_class": lambda spark, sf_dir: RJ.manifest_by_class(_manifest(spark, sf_dir)),
    "chunk_plan": lambda spark, sf_dir: _chunk_status(spark, sf_dir)[0],
    "manifest_summary": lambda spark, sf_dir: RJ.manifest_summary(RJ.chunk_status(*_chunk_status(spark, sf_dir))),
    "rows_vs_manifest": _rows_vs_manifest,
    "upsert_replay": _upsert_replay,
    "upsert_counts": _upsert_counts,
    "upsert_stream": _upsert_stream,
    "silver_stream_replayed": _silver_stream_replayed,
    "gold_daily_incremental": _gold_daily_incremental,
    "gold_regional_incremental": _gold_regional_incremental,
    "flatline_stream": _flatline_stream,
    "episodes_stream": _episodes_stream,
    "replay_equals_incremental": _replay_equals_incremental,
    "pipeline_gate": lambda spark, sf_dir: _pipeline_gate(spark, sf_dir),
})


def _pipeline_gate(spark, sf_dir):
    from hourglass.plans import pipeline
    return pipeline.gate(spark, sf_dir, run_dir(spark, "pipeline"))
