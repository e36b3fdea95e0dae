"""Broadcast only what is proven small.

``bounded_broadcast`` counts at most ``max_rows + 1`` rows of a side (a cheap,
early-stopping job) and adds the broadcast hint only when the side is within
the bound; otherwise the join stays a shuffle join and AQE may still convert
it at run time from real sizes.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_ROWS = 100_000


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
