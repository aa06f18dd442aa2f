"""Joining a table with a small one, with the size checked before it is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_LOOKUP_ROWS = 50_000


def join_small(df: DataFrame, lookup: DataFrame, on: list[str], how: str = "inner",
               max_rows: int = MAX_LOOKUP_ROWS) -> DataFrame:
    """Join with a lookup table expected to be small (one row per symbol, model or key).

    The lookup is computed once. Up to ``max_rows`` rows it is broadcast, so the large side
    is not shuffled. A larger one is joined by key; hot keys are then split by the adaptive
    skew join.
    """
    rows = lookup.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df.join(lookup, on, how)
    local = df.sparkSession.createDataFrame(rows, lookup.schema)
    return df.join(F.broadcast(local), on, how)
