"""Using small tables next to large ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 100_000


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a global aggregate, which is one row by construction."""
    return df.crossJoin(F.broadcast(one_row))


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, counted: DataFrame | None = None) -> DataFrame:
    """Hint a broadcast only after counting that the table is small.

    A larger table is returned unhinted, so the join falls back to a shuffle whose
    skewed partitions adaptive execution splits. ``counted`` is a table of the same
    number of rows that is cheaper to count, such as the bare keys of an aggregate.
    """
    rows = (df if counted is None else counted).limit(max_rows + 1).count()
    return F.broadcast(df) if rows <= max_rows else df
