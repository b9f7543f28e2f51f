"""Bronze -> silver: flatten, typed time, cleaning, expectations, rejects,
quarantine and grain dedup (B1-B10, D14). All narrow transformations except
the dedup, which is a partially-aggregated groupBy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass import constants as K
from hourglass.functions.exprs import obs_time_from, passes

PROVENANCE = ["_source_file", "_ingested_at", "_rescued_data", "_record_id"]


def flatten(bronze: DataFrame) -> DataFrame:
    """Nested struct -> columns, 1-based hour -> obs_hour and
    obs_time (hour 1 = 00:00, hour 24 = 23:00), calendar parts. Dates that do
    not parse become NULL (``try_to_date``) instead of failing under ANSI."""
    prov = [c for c in PROVENANCE if c in bronze.columns]
    obs_date = F.try_to_date(F.col("Date"))
    hour1 = F.col("Hour").cast("int")
    # one projection (one analyzer pass), columns in the published order
    return bronze.select(
        F.col("Site_Id").cast("int").alias("site_id"),
        F.col("Parameter.ParameterCode").alias("parameter_code"),
        F.col("Parameter.Units").alias("units"),
        F.col("Parameter.Frequency").alias("frequency"),
        obs_date.alias("obs_date"),
        hour1.alias("hour_1based"),
        F.col("Value").cast("double").alias("value"),
        F.col("AirQualityCategory").alias("aqi_category"),
        *prov,
        (hour1 - 1).alias("obs_hour"),
        obs_time_from(obs_date, hour1 - 1).alias("obs_time"),
        F.year(obs_date).alias("year"),
        F.month(obs_date).alias("month"),
    )


def clean(flat: DataFrame, generation: int = 2) -> DataFrame:
    """B4/B5. Gen 2: pollutants get ``below_detection = value < 0`` and
    ``value_clean = greatest(value, 0)``; weather keeps its value and a NULL
    flag. Gen 1: the floor and flag apply to every parameter."""
    v = F.col("value")
    if generation == 1:
        return flat.select("*", (v < 0).alias("below_detection"),
                           F.greatest(v, F.lit(0.0)).alias("value_clean"))
    is_pol = F.col("parameter_code").isin(K.POLLUTANTS)
    return flat.select("*", F.when(is_pol, v < 0).otherwise(F.lit(None).cast("boolean")).alias("below_detection"),
                       F.when(is_pol, F.greatest(v, F.lit(0.0))).otherwise(v).alias("value_clean"))


def drop_rules() -> list[tuple[str, Column]]:
    """Expectations whose failures are dropped."""
    return [
        ("valid_site", F.col("site_id").isNotNull()),
        ("valid_date", F.col("obs_date").isNotNull()),
        ("valid_hour", F.col("hour_1based").between(1, 24)),
        ("has_reading", F.col("value").isNotNull()),
    ]


def track_rules(floor: float = K.PLAUSIBLE_FLOOR) -> list[tuple[str, Column]]:
    """Expectations that are only counted."""
    return [("above_detection_floor",
             ~F.col("parameter_code").isin(K.POLLUTANTS) | (F.col("value") > floor))]


def expect_or_drop(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    cond = None
    for _, c in rules:
        cond = passes(c) if cond is None else cond & passes(c)
    return df.filter(cond)


def expectation_metrics(flat: DataFrame, drop: list[tuple[str, Column]] | None = None,
                        track: list[tuple[str, Column]] | None = None) -> DataFrame:
    """Per-expectation pass/fail counts in ONE aggregate (one job), as rows
    ``(expectation, action, passed_records, failed_records)``. Drop rules are
    evaluated in order on the rows that survived the earlier ones, like a
    chain of ``expect_or_drop``; track rules run on the rows kept."""
    drop = drop_rules() if drop is None else drop
    track = track_rules() if track is None else track
    aggs, names, alive = [], [], F.lit(True)
    for name, c in drop:
        aggs += [F.count_if(alive & passes(c)).alias(f"p{len(names)}"),
                 F.count_if(alive & ~passes(c)).alias(f"f{len(names)}")]
        names.append((name, "drop"))
        alive = alive & passes(c)
    for name, c in track:
        aggs += [F.count_if(alive & passes(c)).alias(f"p{len(names)}"),
                 F.count_if(alive & ~passes(c)).alias(f"f{len(names)}")]
        names.append((name, "track"))
    one = flat.agg(*aggs)
    rows = ", ".join(f"'{n}', '{a}', p{i}, f{i}" for i, (n, a) in enumerate(names))
    return one.selectExpr(f"stack({len(names)}, {rows}) AS (expectation, action, passed_records, failed_records)")


def silver(bronze: DataFrame, generation: int = 2) -> DataFrame:
    """Gen 2 silver: flatten, clean, drop rows failing the drop expectations.
    Rows are appended as they come: duplicates are not removed here."""
    return expect_or_drop(clean(flatten(bronze), generation), drop_rules())


def reject_reason(flat: DataFrame, floor: float | None = K.PLAUSIBLE_FLOOR) -> DataFrame:
    """First failing rule wins; NULL when the row is clean. A NULL hour
    counts as out of range. ``floor=None`` leaves implausible negatives in:
    then a row has a reason exactly when the drop expectations fail."""
    h = F.col("hour_1based")
    reason = (F.when(F.col("site_id").isNull(), "null_site")
               .when(F.col("obs_date").isNull(), "null_date")
               .when(~passes(h.between(1, 24)), "hour_out_of_range")
               .when(F.col("value").isNull(), "null_value"))
    if floor is not None:
        reason = reason.when(F.col("value") < floor, "implausible_negative")
    return flat.withColumn("reject_reason", reason)


def split_quarantine(tagged: DataFrame, quarantined_at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean rows without the reason column, rejected rows with
    ``quarantined_at``). ``quarantined_at`` defaults to the landing time
    ``_ingested_at`` so results are reproducible; pass
    ``F.current_timestamp()`` for wall-clock audit stamps."""
    stamp = quarantined_at if quarantined_at is not None else F.col("_ingested_at")
    rejected = tagged.filter(F.col("reject_reason").isNotNull()).withColumn("quarantined_at", stamp)
    kept = tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return kept, rejected


DEDUP_ORDER = ("_ingested_at", "_record_id", "value")


def dedup(df: DataFrame, keys: list[str] | None = None,
          order: tuple[str, ...] = DEDUP_ORDER) -> DataFrame:
    """One row per grain key; the row that sorts last on ``order``
    (latest landing, then highest record id) survives, deterministically.

    ``max_by`` over a struct is partially aggregated map-side, so a key with
    a huge number of copies is collapsed before the shuffle instead of
    landing whole in one task (which a ROW_NUMBER window would do)."""
    keys = keys or K.SILVER_GRAIN
    rest = [c for c in df.columns if c not in keys]
    ordk = F.struct(*[F.col(c) for c in order])
    return (df.groupBy(*keys)
              .agg(F.max_by(F.struct(*[F.col(c) for c in rest]), ordk).alias("_r"))
              .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])
              .select(*df.columns))


# Columns of the deduplicated fact: what the gold tables and detectors read,
# plus the ordering of the dedup (only these travel through its shuffle).
FACT_COLUMNS = ["site_id", "parameter_code", "units", "obs_date", "obs_hour", "obs_time", "value",
                "value_clean", "_ingested_at", "_record_id"]


def fact_observation(bronze: DataFrame, parameters: list[str] | None = None) -> DataFrame:
    """Gen 1 fact: rejects removed by reason, universal floor, one row per
    grain key. Restricted to ``parameters`` (default: the pollutants, the
    scope the detectors were built for)."""
    parameters = parameters or K.POLLUTANTS
    tagged = reject_reason(clean(flatten(bronze), generation=1))
    kept, _ = split_quarantine(tagged)
    return dedup(kept.filter(F.col("parameter_code").isin(parameters)).select(*FACT_COLUMNS))


def quarantine(bronze: DataFrame) -> DataFrame:
    """Rejected rows with their reason (Gen 1 tagging over all parameters)."""
    _, rejected = split_quarantine(reject_reason(clean(flatten(bronze), generation=1)))
    return rejected
