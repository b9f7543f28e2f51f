"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension is broadcast only when it is proven to hold at most this many rows.
MAX_BROADCAST_ROWS = 200_000


def bounded_broadcast(dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``dim`` only after checking its size.

    ``limit(max_rows + 1).count()`` stops reading as soon as the bound is
    exceeded, so the check is cheap even when the dimension is huge. Above
    the bound the dimension is joined by shuffle (AQE may still convert the
    join at runtime from measured shuffle sizes)."""
    n = dim.limit(max_rows + 1).count()
    return F.broadcast(dim) if n <= max_rows else dim


def fixed_broadcast(dim: DataFrame) -> DataFrame:
    """Broadcast a relation whose size is fixed by construction (an inline
    list of standards or thresholds), not by data."""
    return F.broadcast(dim)
