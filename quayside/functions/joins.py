"""Broadcasts behind a measured size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 << 20


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the values in ``df``: 8 each, and for text its length on top."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    lengths = [F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c in texts]
    return sum(df.agg(F.count("*") * 8 * len(df.columns), *lengths).first())


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast if it measures at most ``limit`` bytes, else leave the join to the planner.

    The planner's own estimate is no help for a table that is itself a join: it multiplies the input sizes. A
    larger table goes through a shuffle join, in which adaptive execution splits hot keys.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df
