"""Broadcast decisions based on measured sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F, types as T

from lodestat.session import settle

MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def _row_bytes(df: DataFrame):
    total = F.lit(16 + 8 * len(df.columns))
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType)):
            # Element width of the fixed-size structs and doubles used here.
            total = total + F.greatest(F.size(c), F.lit(0)) * 48
    return total


def is_small(df: DataFrame, max_rows=MAX_BROADCAST_ROWS, max_bytes=MAX_BROADCAST_BYTES) -> bool:
    """True when ``df`` is measured to be within both bounds.

    The limit keeps the probe itself bounded when ``df`` is huge.
    """
    rows, size = (
        df.select(_row_bytes(df).alias("b"))
        .limit(max_rows + 1)
        .agg(F.count(F.lit(1)), F.coalesce(F.sum("b"), F.lit(0)))
        .first()
    )
    return rows <= max_rows and size <= max_bytes


def broadcast_checked(df: DataFrame, derived: bool = True) -> DataFrame:
    """Hint a broadcast for ``df`` only when it is measured to be small.

    A derived table (an aggregate, a join) is computed once, kept, and measured by
    the same job. A larger table is returned unhinted: Spark then shuffles, and AQE
    splits skewed partitions.
    """
    if not derived:
        return F.broadcast(df) if is_small(df) else df
    size = Observation()
    watched = df.observe(size, F.count(F.lit(1)).alias("rows"),
                         F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("bytes"))
    kept = settle(watched)
    found = size.get
    small = found["rows"] <= MAX_BROADCAST_ROWS and found["bytes"] <= MAX_BROADCAST_BYTES
    return F.broadcast(kept) if small else kept


def lookup_join(left: DataFrame, right: DataFrame, on, how: str = "left",
                derived: bool = True) -> DataFrame:
    """Join ``left`` to a table that is unique on ``on``."""
    return left.join(broadcast_checked(right, derived), on, how)
