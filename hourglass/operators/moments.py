"""Mergeable central moments: (count, mean, M2) of a set of readings, M2 being
the sum of squared distances from the mean.

Two disjoint sets merge by the parallel-variance formula. No sums of squares
are kept and none is subtracted, so that the digits of a small variance survive
any level of the readings. NULL readings count nothing; an empty set is
(0, 0, 0). All are expressions over doubles, for columns ``<name>_n``,
``<name>_m`` and ``<name>_q``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTS = ("n", "m", "q")
Moments = tuple


def columns(name: str) -> list[str]:
    return [f"{name}_{p}" for p in PARTS]


def as_columns(name: str, moments: Moments) -> dict[str, Column]:
    return dict(zip(columns(name), moments))


def fields(struct: str) -> list[Column]:
    return [F.col(f"{struct}.{p}") for p in PARTS]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def of_value(v: Column) -> Moments:
    return F.when(v.isNull(), 0.0).otherwise(1.0), F.coalesce(v, F.lit(0.0)), F.lit(0.0)


def merge(a: Moments, b: Moments) -> Moments:
    """The moments of the union of two disjoint sets."""
    (na, ma, qa), (nb, mb, qb) = (tuple(map(_col, x)) for x in (a, b))
    n = na + nb
    share = F.coalesce(F.try_divide(nb, n), F.lit(0.0))
    return n, ma + (mb - ma) * share, qa + qb + (mb - ma) * (mb - ma) * na * share


def mean(moments: Moments) -> Column:
    n, m, _ = map(_col, moments)
    return F.when(n >= 1, m)


def sd(moments: Moments) -> Column:
    """Sample standard deviation, NULL for fewer than two readings."""
    n, _, q = map(_col, moments)
    return F.when(n >= 2, F.sqrt(F.try_divide(q, n - 1.0)))


def aggregate(value: str) -> Column:
    """The moments of a group as a struct (n, m, q); Spark's own variance merges
    partial aggregates by the same formula."""
    n = F.count(value).cast("double")
    return F.struct(n.alias("n"), F.coalesce(F.avg(value), F.lit(0.0)).alias("m"),
                    F.coalesce(F.var_pop(value) * n, F.lit(0.0)).alias("q"))


def merge_all(structs: Column) -> Column:
    """The moments of the union of an array of (n, m, q)."""
    none = F.struct(*[F.lit(0.0).alias(p) for p in PARTS])

    def step(a: Column, b: Column) -> Column:
        merged = merge([a[p] for p in PARTS], [b[p] for p in PARTS])
        return F.struct(*[c.alias(p) for p, c in zip(PARTS, merged)])

    return F.aggregate(structs, none, step)
