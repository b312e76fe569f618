"""Broadcast behind a check of the size."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# 256 MB of row data (headers of about a million files); an executor holds up to twice that as a
# hash table.
BROADCAST_BYTES = 256 * 1024 * 1024


def broadcast_within(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only if the rows of ``df`` are counted and fit; otherwise return it unhinted,
    to be joined by shuffle with the adaptive skew split. ``df`` should be a stored table: it is
    read once more for the check."""
    size = F.lit(16 * len(df.columns)).cast("bigint")
    for name, kind in df.dtypes:
        cell = F.col(name)
        length = F.octet_length(cell if kind in ("string", "binary") else F.to_json(F.struct(cell)))
        size = size + F.coalesce(length, F.lit(0))
    total = df.agg(F.sum(size).alias("total")).first()["total"] or 0
    return F.broadcast(df) if total <= max_bytes else df
