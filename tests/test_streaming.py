"""Incremental ingest: the stream reads each landed file once, a rerun adds
nothing, and the streamed silver equals the batch silver."""

from pyspark.sql import functions as F

from hourglass.operators import silver as S
from hourglass.sources import adapters as A
from hourglass.sources import raw_json as RJ
from hourglass.sources import sinks as SK
from hourglass.streaming import jobs as J


def test_stream_equals_batch_and_replay_adds_nothing(spark, sf_dir):
    raw = J.land_hourly(spark, sf_dir)
    bronze, ck = J.run_dir(spark, "bronze"), J.run_dir(spark, "ckpt")
    J.stream_bronze(spark, raw, bronze, ck, max_files_per_trigger=10)
    n1 = spark.read.parquet(bronze).count()
    J.stream_bronze(spark, raw, bronze, ck)
    assert spark.read.parquet(bronze).count() == n1 == A.hourly_records(spark, sf_dir).count()
    silver, quar = J.run_dir(spark, "silver"), J.run_dir(spark, "quar")
    metrics = J.stream_silver(spark, bronze, silver, quar, J.run_dir(spark, "ckpt"))
    streamed = spark.read.parquet(silver)
    batch = S.silver(A.hourly_records(spark, sf_dir))
    key = ["site_id", "parameter_code", "obs_time", "value"]
    assert streamed.count() == batch.count()
    assert streamed.select(*key).exceptAll(batch.select(*key)).count() == 0
    assert sum(m["rows"] for m in metrics) == n1
    q = spark.read.parquet(quar)
    assert q.count() + streamed.count() == n1
    r = J.stream_reconciliation(spark.read.parquet(bronze), streamed, q).first()
    assert r["overlap"] == 0 and r["balanced"]


def test_rescue_keeps_unknown_and_mistyped(spark):
    text = spark.createDataFrame([('{"Site_Id": 3, "Value": "abc", "Extra": 1, "Hour": 2}',),
                                  ('{"Site_Id": 4, "Value": 1.5}',)], "_raw string")
    out = {r["Site_Id"]: r for r in RJ.rescue(text).collect()}
    assert out[3]["Value"] is None and out[3]["Hour"] == 2
    assert out[3]["_rescued_data"] == '{"Value":"abc","Extra":"1"}'
    assert out[4]["_rescued_data"] is None and out[4]["Value"] == 1.5


SHAPES = [
    ('{"Site_Id": 5, "Parameter": {"ParameterCode": "NO2", "Extra": {"a": 1}}, "Value": 1.5}', 5, "NO2", '{"Parameter":'),
    ('{"Site_Id": 6, "Parameter": "NO2", "Value": 1.5}', 6, None, '{"Parameter":"NO2"}'),
    ('{"Site_Id": 7, "Value": ', None, None, '{"Site_Id": 7, "Value": '),
    ("not json at all", None, None, "not json at all"),
    ('{"Site_Id": 8, "HourDescription": "12 am - 1 am", "Value": 2.5}', 8, None, None)]


def test_rescue_loses_no_text(spark):
    text = spark.createDataFrame([(t,) for t, *_ in SHAPES], "_raw string")
    rows = J.RJ.rescue(text).collect()
    assert len(rows) == len(SHAPES)
    for text, site, code, rescued in SHAPES:
        row = next(r for r in rows if r["Site_Id"] == site and (site or (r["_rescued_data"] or "").startswith(rescued)))
        assert (row["Parameter"]["ParameterCode"] if row["Parameter"] else None) == code
        assert (row["_rescued_data"] or "").startswith(rescued or "") and (row["_rescued_data"] is None) == (rescued is None)
    assert '"Extra"' in next(r for r in rows if r["Site_Id"] == 5)["_rescued_data"].replace("\\", "")


def test_rescue_reads_arrays_and_keeps_broken_ones(spark):
    good = "[" + ",\n ".join(t for t, site, *_ in SHAPES if site) + "]"
    rows = J.RJ.rescue(spark.createDataFrame([(good,), ("[]",), ("  ",), ('[{"Site_Id": 1}, {"Site',)], "_raw string")).collect()
    assert sorted(r["Site_Id"] for r in rows if r["Site_Id"]) == [5, 6, 8]
    assert [r["_rescued_data"] for r in rows if r["Site_Id"] is None] == ['[{"Site_Id": 1}, {"Site']


def test_array_files_in_batch_stream_and_manifest(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "site1_PM10_2024.json").write_text('[{"Site_Id": 1, "Date": "2024-01-01", "Hour": 1, "Value": 2.5},\n'
                                              ' {"Site_Id": 1, "Date": "2024-01-01", "Hour": 2, "Value": 3.5}]')
    (raw / "site1_PM10_2025.json").write_text("[]")
    assert sorted(r["Value"] for r in RJ.read_raw(spark, str(raw)).collect()) == [2.5, 3.5]
    J.stream_bronze(spark, str(raw), str(tmp_path / "bronze"), str(tmp_path / "ck"))
    assert sorted(r["Value"] for r in spark.read.parquet(str(tmp_path / "bronze")).collect()) == [2.5, 3.5]
    assert {(r["year"], r["records"], r["status"]) for r in RJ.manifest(spark, str(raw)).collect()} == {
        (2024, 2, "landed"), (2025, 0, "empty")}


def test_lines_layout(spark, sf_dir, tmp_path):
    raw = RJ.land(A.hourly_records(spark, sf_dir), str(tmp_path / "lines"), arrays=False)
    n = A.hourly_records(spark, sf_dir).count()
    assert RJ.read_rescued(spark, raw, whole=False).count() == RJ.read_raw(spark, raw, multiline=False).count() == n
    assert RJ.manifest(spark, raw, multiline=False).groupBy().sum("records").first()[0] == n


def test_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.createDataFrame([(d, k, 1.0) for d in ("a", "b", "c") for k in range(3)], "d string, k int, v double") \
        .write.partitionBy("d").parquet(path)
    files = lambda: {str(f.relative_to(path)) for f in (tmp_path / "table").rglob("*.parquet")}
    before = files()
    src = spark.createDataFrame([("b", 1, 5.0), ("b", 1, 7.0), ("b", 9, 8.0), ("n", 0, 9.0)], "d string, k int, v double")
    SK.upsert_partitions(spark, path, src, ["d", "k"], "d", ("v",))
    want = {("a", 0, 1.0), ("a", 1, 1.0), ("a", 2, 1.0), ("c", 0, 1.0), ("c", 1, 1.0), ("c", 2, 1.0),
            ("b", 0, 1.0), ("b", 1, 7.0), ("b", 2, 1.0), ("b", 9, 8.0), ("n", 0, 9.0)}
    rows = lambda: {tuple(r) for r in spark.read.parquet(path).select("d", "k", "v").collect()}
    assert rows() == want
    assert {f for f in before if f[2] != "b"} <= files() and not {f for f in before if f[2] == "b"} & files()
    src.coalesce(1).write.parquet(str(tmp_path / "src"))
    J.stream_upsert(spark, spark.readStream.schema(src.schema).parquet(str(tmp_path / "src")), path, ["d", "k"], "d", ("v",), str(tmp_path / "ck"))
    assert rows() == want and spark.read.parquet(path).count() == len(want)


def test_upsert_replay_idempotent(spark, sf_dir):
    (v0, v1, v2), src = J._upsert_versions(spark, sf_dir)
    assert v0.count() == v1.count() == v2.count()
    assert v1.exceptAll(v2).count() == 0
    changed = v0.alias("a").join(v2.alias("b"), ["site_id", "parameter_code", "obs_time"]) \
        .filter(F.col("a.value_clean") != F.col("b.value_clean")).count()
    expected = src.filter((F.col("value") < 0) & ~F.col("parameter_code").isin("PM2.5", "PM10", "NO2", "OZONE")).count()
    assert changed == expected


def test_full_replay_equals_incremental(spark, sf_dir):
    raw = J.land_hourly(spark, sf_dir)
    inc, full = J.run_dir(spark, "inc"), J.run_dir(spark, "full")
    J.stream_bronze(spark, raw, inc, J.run_dir(spark, "ckpt"), max_files_per_trigger=3)
    J.stream_bronze(spark, raw, full, J.run_dir(spark, "ckpt"))
    cols = [c for c in spark.read.parquet(inc).columns if c != "_ingested_at"]
    a, b = spark.read.parquet(inc).select(*cols), spark.read.parquet(full).select(*cols)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_materialized_pipeline_partitions_silver(spark, sf_dir, tmp_path):
    from hourglass.plans import pipeline
    t = pipeline.run(spark, sf_dir, str(tmp_path / "run"))
    assert (tmp_path / "run" / "silver" / "parameter_code=PM2.5").exists()
    plan = t.silver.filter(F.col("parameter_code") == "PM2.5")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "PM2.5" in plan


def test_manifest_counts_empty_array_files(spark, tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    (d / "site1_PM10_2024.json").write_text('[{"Site_Id": 1, "Hour": 1}, {"Site_Id": 1, "Hour": 2}]')
    (d / "site1_WSP_2024.json").write_text("[]")
    m = {r["path"]: r for r in RJ.manifest(spark, str(d), multiline=True).collect()}
    assert m["site1_PM10_2024.json"]["records"] == 2 and m["site1_PM10_2024.json"]["pollutant"] == "PM10"
    assert m["site1_WSP_2024.json"]["records"] == 0 and m["site1_WSP_2024.json"]["status"] == "empty"
    assert RJ.read_raw(spark, str(d), multiline=True).count() == 2
