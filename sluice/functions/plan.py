"""Helpers that shape plans."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fence(df: DataFrame) -> DataFrame:
    """Stop later filters and column pruning at this point of the plan.

    A filter on a derived column (``is_valid``) would otherwise be pushed
    below the projections that derive it, with every alias inlined -- the
    JSON parse and each field pick would then run once per reference in the
    condition and again in the projection. Filters cannot pass a generator
    whose output they read, so one ``inline`` of a one-element array keeps
    the parse at one evaluation per row. Likewise two consumers of a fenced
    frame keep one identical exchange below it, which Spark reuses.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))
