"""Dataset-level quality gates and regression checks.

Each check is an aggregate that returns a small DataFrame; all checks of one
table come from one pass over it, and the one-row results are put side by
side as scalar subqueries. A check passes only when it is known to hold: a
NULL observation, as of an empty table, fails. ``assert_gate`` and
``assert_regression`` are the only driver-side steps: they collect the handful
of check rows and raise once with every failure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass import constants as K
from hourglass.functions.exprs import pct


def grain_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """K1: number of grain keys that occur more than once (one row)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
              .agg(F.count(F.lit(1)).alias("duplicate_keys")))


def grain_checks(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """K1 over several tables: rows ``(table_name, duplicate_keys)``."""
    out = None
    for name, (df, keys) in tables.items():
        one = grain_violations(df, keys).select(F.lit(name).alias("table_name"), "duplicate_keys")
        out = one if out is None else out.unionByName(one)
    return out


def units_per_parameter(df: DataFrame) -> DataFrame:
    """Distinct units per parameter (the regional windows partition by
    region and parameter only, so more than one unit would mix series);
    ``consistent`` is false where a parameter carries several units."""
    return df.groupBy("parameter_code").agg(F.countDistinct("units").alias("units_count")) \
             .withColumn("consistent", F.col("units_count") <= 1)


def row_counts(named: dict[str, DataFrame]) -> DataFrame:
    """Row counts of several DataFrames as ONE row (union of one-row
    aggregates pivoted on their names — no cross join)."""
    parts = None
    for name, df in named.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("t"), "n")
        parts = one if parts is None else parts.unionByName(one)
    return parts.groupBy().pivot("t", list(named)).agg(F.first("n")).select(*list(named))


def pipeline_accounting(bronze: DataFrame, silver: DataFrame, daily: DataFrame,
                        regional: DataFrame) -> DataFrame:
    """Layer row counts, dropped rows and drop rate (NULL on an
    empty bronze instead of a division error)."""
    c = row_counts({"bronze_rows": bronze, "silver_rows": silver, "daily_gold_rows": daily,
                 "regional_gold_rows": regional})
    return (c.withColumn("dropped_rows", F.col("bronze_rows") - F.col("silver_rows"))
             .withColumn("drop_rate_pct", pct(F.col("dropped_rows"), F.col("bronze_rows"))))


def reconciliation(tagged: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """K2: bronze = silver + quarantine + duplicates removed, from one pass
    over the tagged rows: rejected rows, kept rows, and distinct grain keys
    of the kept ones."""
    keys = keys or K.SILVER_GRAIN
    kept = F.col("reject_reason").isNull()
    per_key = tagged.groupBy(kept.alias("_kept"), *[F.when(kept, F.col(k)).alias(k) for k in keys]) \
        .agg(F.count(F.lit(1)).alias("_n"))
    c = per_key.agg(F.sum("_n").alias("bronze"), F.count_if("_kept").alias("silver"),
                    F.sum(F.when(~F.col("_kept"), F.col("_n")).otherwise(0)).alias("quarantine"),
                    F.sum(F.when(F.col("_kept"), F.col("_n")).otherwise(0)).alias("_before"))
    return c.select("bronze", "silver", "quarantine", (F.col("_before") - F.col("silver")).alias("duplicates")) \
        .withColumn("balanced", F.col("bronze") == F.col("silver") + F.col("quarantine") + F.col("duplicates"))


def grain_profile(df: DataFrame, keys: list[str], extra: dict | None = None) -> DataFrame:
    """Rows, duplicate grain keys and optional extra counters of one table in
    ONE pass: a partial aggregate per grain key, then a global aggregate.
    ``extra`` maps a name to a boolean Column counted per row (``count_if``)
    or to ``("max", Column)`` / ``("min", Column)``."""
    extra = extra or {}
    per_key = [F.count(F.lit(1)).alias("_n")]
    final = [F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count_if(F.col("_n") > 1).alias("duplicate_keys")]
    for name, spec in extra.items():
        if isinstance(spec, tuple):
            of = {"max": F.max, "min": F.min}[spec[0]]
            per_key.append(of(spec[1]).alias(f"_{name}"))
            final.append(of(f"_{name}").alias(name))
        else:
            per_key.append(F.count_if(spec).alias(f"_{name}"))
            final.append(F.sum(f"_{name}").alias(name))
    return df.groupBy(*keys).agg(*per_key).agg(*final)


def side_by_side(**rows: DataFrame) -> DataFrame:
    """One row with a struct column for each one-row DataFrame."""
    spark = next(iter(rows.values())).sparkSession
    return spark.range(1).select(*[df.select(F.struct("*")).scalar().alias(n) for n, df in rows.items()])


def quality_gate(bronze: DataFrame, silver: DataFrame, daily: DataFrame, regional: DataFrame,
                 max_drop_rate: float = K.MAX_DROP_RATE) -> DataFrame:
    """K4-K6: rows ``(check_name, observed, limit_value, passed)``. Each
    table is read once: rows, duplicate keys and the table's own checks come
    from one grain profile. Empty tables, more silver than bronze rows and
    unknown observations fail."""
    one = side_by_side(
        b=bronze.agg(F.count(F.lit(1)).alias("rows")),
        s=grain_profile(silver, K.SILVER_GRAIN, {
            "neg": F.col("parameter_code").isin(K.POLLUTANTS) & (F.col("value_clean") < 0)}),
        d=grain_profile(daily, K.DAILY_GRAIN, {"maxc": ("max", F.col("completeness_pct"))}),
        r=grain_profile(regional, K.REGIONAL_GRAIN))
    return _gate_rows(one, max_drop_rate)


#: What is observed of each layer while it is written.
def write_metrics() -> dict[str, list]:
    rows = F.count(F.lit(1)).alias("rows")
    return {"bronze": [rows], "regional": [rows], "daily": [rows, F.max("completeness_pct").alias("maxc")],
            "silver": [rows, F.count_if(F.col("parameter_code").isin(K.POLLUTANTS) & (F.col("value_clean") < 0)).alias("neg")]}


def observed_gate(metrics: dict[str, dict], silver: DataFrame, daily: DataFrame, regional: DataFrame,
                  max_drop_rate: float = K.MAX_DROP_RATE) -> DataFrame:
    """The quality gate from ``write_metrics`` of the layers (a few numbers for
    each); only grain, which no row shows by itself, takes a pass over the
    written keys."""
    duplicates = side_by_side(**{n: grain_violations(df, keys) for n, df, keys in (
        ("silver", silver, K.SILVER_GRAIN), ("daily", daily, K.DAILY_GRAIN), ("regional", regional, K.REGIONAL_GRAIN))})

    def layer(name: str, of: str) -> Column:
        kinds = {"maxc": "double"}
        known = [F.lit(v).cast(kinds.get(k, "long")).alias(k) for k, v in metrics[name].items()]
        return F.struct(*known, *([F.col(f"{name}.duplicate_keys")] if name != "bronze" else [])).alias(of)

    return _gate_rows(duplicates.select(layer("bronze", "b"), layer("silver", "s"), layer("daily", "d"), layer("regional", "r")), max_drop_rate)


def _gate_rows(one: DataFrame, max_drop_rate: float) -> DataFrame:
    empty = sum((F.col(f"{t}.rows") == 0).cast("int") for t in "bsdr")
    cells = [("drop_rate_pct", pct(F.col("b.rows") - F.col("s.rows"), F.col("b.rows")), max_drop_rate),
             ("empty_tables", empty, 0.0),
             ("silver_rows_beyond_bronze", F.greatest(F.col("s.rows") - F.col("b.rows"), F.lit(0)), 0.0),
             ("silver_duplicate_keys", F.col("s.duplicate_keys"), 0.0),
             ("daily_duplicate_keys", F.col("d.duplicate_keys"), 0.0),
             ("regional_duplicate_keys", F.col("r.duplicate_keys"), 0.0),
             ("negative_pollutant_value_clean", F.col("s.neg"), 0.0),
             ("max_completeness_pct", F.col("d.maxc"), 100.0)]
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("check_name"), o.cast("double").alias("observed"),
                                        F.lit(lim).alias("limit_value")) for n, o, lim in cells])).alias("c")
    return (one.select(rows).select("c.*")
               .withColumn("passed", F.coalesce(F.col("observed") <= F.col("limit_value"), F.lit(False))))


class QualityGateError(Exception):
    pass


def assert_gate(gate: DataFrame) -> None:
    """K6: collect the (few) check rows and raise once listing every failure."""
    failures = [f"{r['check_name']}={r['observed']} (limit {r['limit_value']})"
                for r in gate.filter(~F.col("passed")).collect()]
    if failures:
        raise QualityGateError(" | ".join(failures))


def check_hour_offset(silver: DataFrame) -> DataFrame:
    """K7: hour 1 maps to midnight; obs_hour spans 0-23."""
    return silver.agg(
        F.count_if((F.col("hour_1based") == 1) & (F.hour("obs_time") != 0)).alias("incorrect_hour_1"),
        F.min("obs_hour").alias("min_obs_hour"), F.max("obs_hour").alias("max_obs_hour"))


def check_value_clean(silver: DataFrame) -> DataFrame:
    """Cleaned pollutants non-negative, below-detection present,
    negative temperatures kept unaltered."""
    pol = F.col("parameter_code").isin(K.POLLUTANTS)
    neg_t = (F.col("parameter_code") == "TEMP") & (F.col("value") < 0)
    return silver.agg(
        F.count_if(pol & (F.col("value_clean") < 0)).alias("negative_pollutants"),
        F.count_if(pol & F.col("below_detection")).alias("below_detection_count"),
        F.count_if(neg_t).alias("negative_temp"),
        F.count_if(neg_t & (F.col("value_clean") != F.col("value"))).alias("altered_negative_temp"),
        F.min(F.when(neg_t, F.col("value"))).alias("minimum_temperature"))


def check_humidity(silver: DataFrame, wide: DataFrame) -> DataFrame:
    """The source keeps humidity above 100, the wide table does
    not."""
    one = side_by_side(
        h=silver.filter(F.col("parameter_code") == "HUMID").agg(
            F.count(F.lit(1)).alias("total_humidity"),
            F.count_if(F.col("value_clean") > 100).alias("above_100"),
            F.max("value_clean").alias("max_source_humidity")),
        w=wide.agg(F.count("humidity").alias("valid_humidity_in_wide"),
                   F.min("humidity").alias("min_analytical_humidity"),
                   F.max("humidity").alias("max_analytical_humidity")))
    return one.select("h.*", "w.*").withColumn("pct_humidity_over_100", pct(F.col("above_100"), F.col("total_humidity")))


def regression_suite(bronze: DataFrame, silver: DataFrame, wide: DataFrame,
                     max_drop_rate: float = K.MAX_DROP_RATE) -> DataFrame:
    """The six regression checks as rows ``(test_name, passed, detail)``;
    one pass over each table. A check whose numbers are missing fails."""
    pol, code, v = F.col("parameter_code").isin(K.POLLUTANTS), F.col("parameter_code"), F.col("value_clean")
    cold = (code == "TEMP") & (F.col("value") < 0)
    one = side_by_side(
        b=bronze.agg(F.count(F.lit(1)).alias("rows")),
        s=grain_profile(silver, K.SILVER_GRAIN, {
            "hour1": (F.col("hour_1based") == 1) & (F.hour("obs_time") != 0),
            "first": ("min", F.col("obs_hour")), "last": ("max", F.col("obs_hour")),
            "neg": pol & (v < 0), "low": pol & F.col("below_detection"), "cold": cold,
            "altered": cold & (v != F.col("value")), "humid": (code == "HUMID") & (v > 100)}),
        w=grain_profile(wide, K.WIDE_GRAIN, {"least": ("min", F.col("humidity")), "most": ("max", F.col("humidity"))}))
    c = F.col
    drop = pct(c("b.rows") - c("s.rows"), c("b.rows"))
    tests = [
        ("hour_offset_corrected", (c("s.hour1") == 0) & (c("s.first") == 0) & (c("s.last") == 23),
         ["s.hour1", "s.first", "s.last"]),
        ("pipeline_accounting", (c("s.rows") > 0) & (c("s.rows") <= c("b.rows")) & (drop <= max_drop_rate), ["b.rows", "s.rows"]),
        ("silver_grain_unique", (c("s.rows") > 0) & (c("s.duplicate_keys") == 0), ["s.duplicate_keys"]),
        ("value_clean_semantics", (c("s.neg") == 0) & (c("s.low") > 0) & (c("s.cold") > 0) & (c("s.altered") == 0),
         ["s.neg", "s.low", "s.cold", "s.altered"]),
        ("hourly_wide_grain", (c("w.rows") > 0) & (c("w.duplicate_keys") == 0), ["w.duplicate_keys"]),
        ("humidity_semantics", (c("s.humid") > 0) & (c("w.least") >= 0) & (c("w.most") <= 100), ["s.humid"])]
    rows = F.explode(F.array(*[F.struct(
        F.lit(n).alias("test_name"), F.coalesce(ok, F.lit(False)).alias("passed"),
        F.concat_ws(" ", *[F.coalesce(c(x).cast("string"), F.lit("none")) for x in told]).alias("detail"))
        for n, ok, told in tests])).alias("t")
    return one.select(rows).select("t.*")


def assert_regression(suite: DataFrame) -> None:
    """Raise once, naming every failed check with its numbers."""
    failures = [f"{r['test_name']} ({r['detail']})" for r in suite.filter(~F.col("passed")).collect()]
    if failures:
        raise QualityGateError(" | ".join(failures))


def schema_profile(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, nulls, rows) of a table, in one
    aggregate; types as Spark names them."""
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(f.name).isNull()).alias(f"n{i}") for i, f in enumerate(df.schema)])
    cells = ", ".join(f"{i + 1}, '{f.name}', '{f.dataType.simpleString()}', n{i}, rows" for i, f in enumerate(df.schema))
    return counts.selectExpr(f"stack({len(df.schema)}, {cells}) AS (position, column_name, data_type, nulls, rows)")
