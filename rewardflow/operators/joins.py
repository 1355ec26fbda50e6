"""Joins against dimensions whose size is checked before they are broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What may be broadcast: rows, and bytes of their text form. A dimension row here
# is a few dozen bytes.
DEFAULT_MAX_BROADCAST_ROWS = 200_000
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20


def is_bounded(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
               max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    """True when ``df`` is within both bounds. One aggregate with partial sums per
    task, so no rows are moved to find out."""
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    rows, size = df.agg(F.count(F.lit(1)), size).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def largest_group(df: DataFrame, *keys) -> int:
    """Rows of the largest group (0 for an empty table)."""
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def small_side(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
               source: DataFrame | None = None, bounded: bool | None = None) -> DataFrame:
    """``broadcast(df)`` when it is within the bounds, else ``df`` unchanged, so the
    join is planned as a shuffle join (AQE then splits skewed keys of the big side).

    ``source``: a frame ``df`` was derived from without adding rows (filter,
    group, distinct); checking it bounds ``df`` as well. ``bounded``: the
    caller already knows the outcome of the check.
    """
    if bounded is None:
        bounded = is_bounded(source if source is not None else df, max_rows)
    return F.broadcast(df) if bounded else df
