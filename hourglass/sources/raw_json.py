"""Raw observation files: landing, batch scan, rescued data, manifest,
chunk plan (A1, A3, A4, A15, A16, A17).

Raw files hold the records of a station-parameter-year chunk
(``site{id}_{param}_{year}.json``) as a JSON array, the layout of the source
API, or one record per line; scans, streams and the rescue column take both.
Everything is a distributed scan; the file name is parsed with
``regexp_extract`` (no driver-side listing or parsing)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from hourglass import constants as K
from hourglass.sources.sinks import materialize

PARAMETER_STRUCT = T.StructType([T.StructField("ParameterCode", T.StringType()),
                                 T.StructField("Units", T.StringType()),
                                 T.StructField("Frequency", T.StringType())])
RAW_SCHEMA = T.StructType([
    T.StructField("Site_Id", T.IntegerType()), T.StructField("Parameter", PARAMETER_STRUCT),
    T.StructField("Date", T.StringType()), T.StructField("Hour", T.IntegerType()),
    T.StructField("HourDescription", T.StringType()),
    T.StructField("Value", T.DoubleType()), T.StructField("AirQualityCategory", T.StringType()),
])
KNOWN = [f.name for f in RAW_SCHEMA.fields]
CHUNK_FILE = "_chunk_file"
RAW_TEXT = "_raw"
FILE_PATTERN = r"site(\d+|x)_(.+)_(\d{4})\.json"


def raw_lines(records: DataFrame, *more: str) -> DataFrame:
    """Serialise bronze-shaped records to the raw API text: one JSON object
    per line, plus one field outside the schema (``k`` from the source
    ``_rescued_data``) and a text ``Value`` where the reading is missing —
    the shapes the rescue column exists for. ``more``: columns to keep."""
    k = F.get_json_object(F.col("_rescued_data"), "$.k")
    body = F.to_json(F.struct(F.col("Site_Id"), F.col("Parameter"), F.col("Date"), F.col("Hour"),
                              F.col("Value"), F.col("AirQualityCategory"), k.alias("k")))
    # a missing reading arrives as text, as the source API sends it
    body = F.when(F.col("Value").isNull(), F.regexp_replace(body, r"^\{", '{"Value":"n/a",')).otherwise(body)
    return records.select(F.col("_source_file").alias(CHUNK_FILE), body.alias(RAW_TEXT), "_record_id", *more)


#: Records that an array file holds at most, where record ids are unique.
ARRAY_SPAN = 50_000
#: Record ids of a chunk that stay together when it is cut into array files.
CELL_SPAN = ARRAY_SPAN // 4


def _cells(records: DataFrame) -> DataFrame:
    return records.withColumn("_cell", F.floor(F.col("_record_id") / CELL_SPAN))


def array_files(records: DataFrame) -> DataFrame:
    """The array file (``_file``, numbered within its chunk) of each chunk's
    ranges of ``CELL_SPAN`` ids that have records: ranges that follow each other
    share a file until it is full. So the number of files grows with the records,
    not with the number of chunks times the range of the ids."""
    counts = _cells(records).groupBy(F.col("_source_file").alias("_chunk"), F.col("_cell").alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_chunk").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    full = ARRAY_SPAN - CELL_SPAN
    return counts.select("_chunk", "_of", F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / full).alias("_file"))


def land(records: DataFrame, out_dir: str, arrays: bool = True, mode: str = "overwrite") -> str:
    """A landing step: write records as raw chunk files under ``out_dir``
    (one directory per chunk file name). ``arrays``: each file is one JSON
    array of up to ``ARRAY_SPAN`` records of the chunk (``array_files``), so that
    neither arrays nor the number of small files grow with the input; the
    writing tasks are as many as the files, so that each holds few of them.
    Otherwise one record per line, clustered by
    a REBALANCE on the file name: AQE splits a chunk that holds a large share
    of the rows over several writer tasks."""
    if arrays:
        files = materialize(array_files(records), "array-files")
        tasks = files.select("_chunk", "_file").distinct().count() or 1  # one number
        cells = _cells(records)
        placed = cells.join(files, F.col("_source_file").eqNullSafe(F.col("_chunk")) & F.col("_cell").eqNullSafe(F.col("_of")))
        body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_record_id", RAW_TEXT))), lambda x: x[RAW_TEXT]), ",\n ")
        whole = raw_lines(placed, "_file").repartition(tasks, CHUNK_FILE, "_file").groupBy(CHUNK_FILE, "_file") \
            .agg(F.concat(F.lit("["), body, F.lit("]")).alias(RAW_TEXT)).drop("_file")
        whole.write.mode(mode).option("maxRecordsPerFile", 1).partitionBy(CHUNK_FILE).text(out_dir)
    else:
        (raw_lines(records).hint("rebalance", CHUNK_FILE).sortWithinPartitions(CHUNK_FILE, "_record_id").drop("_record_id")
              .write.mode(mode).partitionBy(CHUNK_FILE).text(out_dir))
    return out_dir


def chunk_name(path: Column) -> Column:
    """The chunk file name from a file path: the landing folder name
    (``_chunk_file=<name>/part-…``) or, for plain files, the file name."""
    landed = F.regexp_extract(path, rf"{CHUNK_FILE}=([^/]+)/", 1)
    return F.when(landed != "", landed).otherwise(F.regexp_extract(path, r"([^/]+)$", 1))


def read_raw(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """A1/A4: typed batch scan of raw files with provenance. Fields that do
    not fit the schema become NULL (see ``read_rescued`` to keep them)."""
    df = (spark.read.schema(RAW_SCHEMA).option("multiLine", multiline).option("mode", "PERMISSIVE")
               .json(path))
    return df.select(*KNOWN, F.col("_metadata.file_path").alias("_source_path"),
                     F.current_timestamp().alias("_ingested_at"))


def rescue(text: DataFrame, value_col: str = RAW_TEXT) -> DataFrame:
    """A3: parse raw text — a JSON array of records or one record — into rows,
    type the known fields with ``try_cast``, and keep whatever did not fit as
    JSON in ``_rescued_data`` (NULL when nothing): unknown fields, values of
    the wrong type, a ``Parameter`` that isn't the known struct (its whole
    text), and text that isn't a record at all (as it is). A blank text has
    no records."""
    raw = F.trim(F.col(value_col))
    is_array = raw.startswith("[")
    parsed = F.from_json(raw, "array<string>")
    # Text that looks like an array but can't be read as one stays whole.
    each = F.coalesce(F.when(is_array, parsed), F.array(value_col))
    # outer, and filtered by position: for an inner explode Spark infers a filter that parses every text once more
    d = text.filter(F.length(raw) > 0).select("*", F.posexplode_outer(each).alias("_pos", "_rec")).filter(F.col("_pos").isNotNull()).drop("_pos")
    d = d.withColumn("_m", F.when(F.trim("_rec").startswith("{") & F.try_parse_json("_rec").isNotNull(), F.from_json("_rec", "map<string,string>")))
    d = d.withColumn("_pm", F.from_json(F.col("_m")["Parameter"], "map<string,string>"))
    fields = ", ".join(repr(f.name) for f in PARAMETER_STRUCT.fields)
    d = d.withColumn("_bad", F.expr(
        "_m['Parameter'] IS NOT NULL AND (_pm IS NULL OR NOT startswith(trim(_m['Parameter']), '{') "
        f"OR size(array_except(map_keys(_pm), array({fields}))) > 0)"))
    typed = []
    for f in RAW_SCHEMA.fields:
        value = F.col("_m")[f.name]
        if isinstance(f.dataType, T.StructType):
            typed.append(F.when(F.startswith(F.trim(value), F.lit("{")), F.from_json(value, f.dataType)).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            typed.append(value.alias(f.name))
        else:
            typed.append(F.expr(f"try_cast(_m['{f.name}'] AS {f.dataType.simpleString()})").alias(f.name))
    d = d.select("*", *typed)
    known = ", ".join(repr(n) for n in KNOWN)
    checks = " OR ".join(
        [f"NOT array_contains(array({known}), k)", "(k = 'Parameter' AND _bad)"] +
        [f"(k = '{f.name}' AND v IS NOT NULL AND try_cast(v AS {f.dataType.simpleString()}) IS NULL)"
         for f in RAW_SCHEMA.fields if not isinstance(f.dataType, (T.StringType, T.StructType))])
    leftover = F.expr(f"map_filter(_m, (k, v) -> {checks})")
    rescued = F.when(F.col("_m").isNull(), F.col("_rec")).when(F.size(leftover) > 0, F.to_json(leftover))
    return d.withColumn("_rescued_data", rescued).drop("_m", "_pm", "_bad", "_rec", value_col)


def raw_text(reader, path: str, whole: bool = True) -> DataFrame:
    """Raw files as text with their path: whole files (arrays), or lines.
    ``reader`` is ``spark.read`` or ``spark.readStream``."""
    return reader.format("text").option("wholetext", whole).load(path) \
        .select(F.col("value").alias(RAW_TEXT), F.col("_metadata.file_path").alias("_source_path"))


def read_rescued(spark: SparkSession, path: str, whole: bool = True) -> DataFrame:
    """A3 over landed files: text scan -> rescue, with provenance."""
    return rescue(raw_text(spark.read, path, whole)).select(*KNOWN, "_rescued_data", "_source_path")


def manifest(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """One row per landed chunk: site, parameter, year parsed from the
    file name, and the number of records — 0 for an empty file.

    Files are listed with the ``binaryFile`` source selecting only path and
    length (file contents are not read); records are counted per file in a
    distributed scan (lines, or ``json_array_length`` of each JSON-array file,
    whose size is bounded by one station-parameter-year), then joined to the
    listing. No driver loop over files."""
    files = (spark.read.format("binaryFile").load(path)
                  .select(chunk_name(F.col("path")).alias("path")).distinct())
    if multiline:
        text = spark.read.text(path, wholetext=True)
        counted = text.select(chunk_name(F.col("_metadata.file_path")).alias("path"),
                              F.coalesce(F.json_array_length("value"), F.lit(0)).alias("_n"))
    else:
        text = spark.read.text(path)
        counted = text.select(chunk_name(F.col("_metadata.file_path")).alias("path"),
                              (F.length("value") > 0).cast("int").alias("_n"))
    per = counted.groupBy("path").agg(F.sum("_n").cast("long").alias("records"))
    per = files.join(per, "path", "left").select("path", F.coalesce("records", F.lit(0)).cast("long")
                                                 .alias("records"))
    return per.select(
        F.regexp_extract("path", FILE_PATTERN, 1).try_cast("int").alias("site_id"),
        F.regexp_replace(F.regexp_extract("path", FILE_PATTERN, 2), "_", ".").alias("pollutant"),
        F.regexp_extract("path", FILE_PATTERN, 3).try_cast("int").alias("year"),
        "path", "records",
        F.when(F.col("records") > 0, "landed").otherwise("empty").alias("status"))


def chunk_plan(stations: DataFrame, parameters: list[str], first_year: int, last_year: int) -> DataFrame:
    """Stations x parameters x years. The two short lists are exploded
    from literal arrays on each station row (no cross join)."""
    return stations.select(
        "site_id", F.explode(F.array(*[F.lit(p) for p in parameters])).alias("pollutant")).select(
        "site_id", "pollutant", F.explode(F.sequence(F.lit(first_year), F.lit(last_year))).alias("year"))


def chunk_status(plan: DataFrame, man: DataFrame) -> DataFrame:
    """Planned chunks with their landed record counts (0 when no file)."""
    j = plan.join(man.select("site_id", "pollutant", "year", "records"), ["site_id", "pollutant", "year"], "left")
    return j.select("site_id", "pollutant", "year", F.coalesce("records", F.lit(0)).cast("long").alias("records"),
                    F.when(F.coalesce("records", F.lit(0)) > 0, "landed").otherwise("empty").alias("status"))


def manifest_summary(status: DataFrame) -> DataFrame:
    """Chunks, empty chunks, records."""
    return status.agg(F.count(F.lit(1)).alias("chunks"),
                      F.count_if(F.col("status") == "empty").alias("empty_chunks"),
                      F.sum("records").alias("records"))


def manifest_by_class(man: DataFrame) -> DataFrame:
    """Landed files and records per parameter class."""
    cls = F.when(F.col("pollutant").isin(K.POLLUTANTS), "pollutant").otherwise("weather")
    return man.groupBy(cls.alias("parameter_class")).agg(F.count(F.lit(1)).alias("files"),
                                                         F.sum("records").alias("records"))
