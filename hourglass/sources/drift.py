"""Drifting fields (A3, H3): what the rescue column holds, as VARIANT.

``rescued_variant`` keeps rescued records as VARIANT: nested fields stay
reachable by path without a schema. ``drift_schema`` finds in one distributed
aggregate which fields drift, how many rows have them and which type fits all
their values. ``promote`` makes such a field a typed column, filled from the old
rows as well; values that don't fit stay in the rescue column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESCUED = "_rescued_data"
#: The field name under which text is counted that is no record at all.
NO_RECORD = "(no record)"


def _variant(text: Column) -> Column:
    """A rescued value as VARIANT: JSON by its type, other text as a string."""
    return F.coalesce(F.try_parse_json(text), F.try_parse_json(F.concat(F.lit('"'), F.regexp_replace(text, r'(["\\])', r"\\$1"), F.lit('"'))))


def _fields(column: str = RESCUED) -> Column:
    """The rescued record as a map of texts; NULL where it is no JSON object."""
    text = F.col(column)
    return F.when(F.trim(text).startswith("{") & F.try_parse_json(text).isNotNull(), F.from_json(text, "map<string,string>"))


def rescued_variant(df: DataFrame, column: str = RESCUED, name: str = "_rescued") -> DataFrame:
    """Replaces the rescued text by a VARIANT column ``name``, NULL where nothing was rescued."""
    return df.withColumn(name, _variant(F.col(column))).drop(column)


def drift_schema(df: DataFrame, column: str = RESCUED) -> DataFrame:
    """(field, rows, data_type) of the rescued fields; ``data_type`` is the least
    type of all values of the field. Text that is no record is one field, of type
    NULL; rows without rescued data count nothing."""
    # a filter on the rescued text, or one that Spark infers for an inner explode, would build and parse it once more
    none = F.when(F.col(column).isNotNull(), F.create_map(F.lit(NO_RECORD), F.lit(None).cast("string")))
    each = df.select(F.explode_outer(F.coalesce(_fields(column), none)).alias("field", "v")).filter(F.col("field").isNotNull())
    return each.groupBy("field").agg(F.count(F.lit(1)).alias("rows"), F.schema_of_variant_agg(_variant(F.col("v"))).alias("_t")) \
        .select("field", "rows", F.when(F.col("field") != NO_RECORD, F.col("_t")).alias("data_type"))


def promote(df: DataFrame, field: str, data_type: str, name: str | None = None, column: str = RESCUED) -> DataFrame:
    """Adds the rescued ``field`` as a column of ``data_type``. It leaves the rescue
    column (NULL when nothing else is in it) wherever its value fits the type;
    a value that doesn't stays there and the new column is NULL."""
    held = df.withColumn("_m", _fields(column))
    typed = F.try_variant_get(_variant(F.col("_m")[field]), "$", data_type)
    held = held.withColumn(name or field, typed)
    left = F.map_filter("_m", lambda k, v: (k != F.lit(field)) | F.col(name or field).isNull())
    return held.withColumn(column, F.when(F.col("_m").isNull(), F.col(column)).when(F.size(left) > 0, F.to_json(left))).drop("_m")
