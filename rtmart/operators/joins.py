"""Join helpers: broadcast a side only when its size is proven small.

The proof counts rows, so it is meant for a side that is stored already (a
persisted micro-batch). Dimensions are left to adaptive execution, which
measures a side once it has been computed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Largest side (in rows) that is broadcast to every task; beyond it the join
# shuffles.
DEFAULT_BROADCAST_MAX_ROWS = 200_000
# Catalyst's size estimate above which no row count is even attempted.
DEFAULT_BROADCAST_MAX_BYTES = 256 * 1024 * 1024


def estimated_size_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimised plan (no job runs)."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size if isinstance(size, int) else size.toString())


def bounded_row_count(df: DataFrame, bound: int) -> int:
    """Count rows, but stop after ``bound + 1``: the check never scans more
    than needed to prove the bound is exceeded."""
    return df.limit(bound + 1).count()


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                       max_bytes: int | None = DEFAULT_BROADCAST_MAX_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only when its row count is proven <= max_rows.

    A plan whose estimated size is already above ``max_bytes`` (a dimension
    that grows with the data) is returned as is without running anything;
    otherwise a bounded count decides. ``max_bytes=None`` leaves the estimate
    out, for narrow rows whose number is bound enough.
    """
    if max_bytes is not None and estimated_size_bytes(df) > max_bytes:
        return df
    if bounded_row_count(df, max_rows) <= max_rows:
        return F.broadcast(df)
    return df
