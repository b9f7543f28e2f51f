"""Quantiles from mergeable sketches (D2, D11): one table holds a KLL sketch of
the readings of each cell — kind, station, parameter, hour of day and month (or
day) — and reports merge its column to any period, region or parameter instead
of reading all readings again.

A cell keeps its readings as they are up to ``SKETCH_K`` of them and about that many beyond;
so do merged sketches, however many cells they cover. A quantile of a group of
at most ``SKETCH_K`` readings is exact (the least reading with at least that
share at or below it); of a larger group its rank is off by at most
``rank_error()`` of the group with a confidence of 99 %."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.functions.exprs import fixed, safe_div
from hourglass.operators.gold import _stations

SKETCH_K = 2048
CELL = ["kind", "site_id", "parameter_code", "obs_hour", "period_start"]


def rank_error(k: int = SKETCH_K) -> float:
    """The sketch's rank error (99 % confidence, one quantile) as a share of
    the rows; a fixed formula of the sketch family."""
    return 2.296 / k ** 0.9723


def sketch_table(fact: DataFrame, quarantine: DataFrame | None = None, reason: str = "implausible_negative",
                 period: str = "month", k: int = SKETCH_K) -> DataFrame:
    """A row for each cell: readings, their sum and sketch. Kind ``accepted``
    holds the cleaned readings of ``fact``, kind ``reason`` the raw ones that
    ``quarantine`` rejected for it. After dedup a cell of ``period="day"`` is a
    single reading, so months are the default.

    The accepted readings of a cell, which dedup keeps few, meet before they are
    sketched: a sketch is made for a cell, not for each of its readings wherever it lies."""
    rows = fact.select(F.lit("accepted").alias("kind"), *CELL[1:4], "obs_date", F.col("value_clean").alias("v")) \
        .repartition(*CELL[1:4])
    if quarantine is not None:
        rows = rows.union(quarantine.filter(F.col("reject_reason") == reason)
                          .select(F.lit(reason).alias("kind"), *CELL[1:4], "obs_date", F.col("value").alias("v")))
    return rows.groupBy(*CELL[:4], F.date_trunc(period, "obs_date").cast("date").alias("period_start")).agg(
        F.count("v").alias("readings"), F.sum("v").alias("total"), F.kll_sketch_agg_double("v", k).alias("sketch"))


def merged(table: DataFrame, keys: list[str], k: int = SKETCH_K) -> DataFrame:
    """The table's cells merged to groups of ``keys``."""
    return table.groupBy(*keys).agg(F.sum("readings").alias("readings"), F.sum("total").alias("total"),
                                    F.kll_merge_agg_double("sketch", k).alias("sketch"))


def quantile(q: float, digits: int):
    return fixed(F.when(F.col("readings") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(q))), digits)


def profile(table: DataFrame, dim: DataFrame) -> DataFrame:
    """D2 from sketches: mean, median, p95 and readings per station, parameter and hour of day."""
    cells = merged(table.filter("kind = 'accepted'"), ["site_id", "parameter_code", "obs_hour"])
    return cells.join(_stations(dim, ["site_name", "region"]), "site_id").select(
        "site_id", "site_name", "region", "parameter_code", "obs_hour",
        fixed(safe_div(F.col("total"), F.col("readings")), 3).alias("mean_value"),
        quantile(0.5, 3).alias("median_value"), quantile(0.95, 3).alias("p95_value"), "readings")


def rejected_quantiles(table: DataFrame, quantiles: list[tuple[str, float]], reason: str = "implausible_negative") -> DataFrame:
    """D11 from sketches: quantiles of the rejected readings per parameter."""
    groups = merged(table.filter(F.col("kind") == reason), ["parameter_code"])
    return groups.select("parameter_code", *[quantile(q, 2).alias(name) for name, q in quantiles])


def regional_quantile(table: DataFrame, dim: DataFrame, q: float = 0.95) -> DataFrame:
    """A quantile of all readings of a region and parameter in each period: cells
    are merged to stations first, stations to regions."""
    stations = merged(table.filter("kind = 'accepted'"), ["site_id", "parameter_code", "period_start"])
    groups = merged(stations.join(_stations(dim, ["region"]), "site_id"), ["region", "parameter_code", "period_start"])
    return groups.select("region", "parameter_code", "period_start", "readings", quantile(q, 3).alias("quantile_value"))
