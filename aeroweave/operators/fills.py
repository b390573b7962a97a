"""Removing duplicate rows and filling gaps along time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroweave.operators.schema import SEQ, with_seq
from aeroweave.plans.chunks import CHUNK, TARGET_ROWS, Chunked, in_chunks, join_known_or_not, measure_density, order_key
from aeroweave.plans.shift import Shift, shift_rows

KEYS = ("city_key",)


def dedupe_keep_first(df: DataFrame, keys=("city_key", "datetime"), seq: str = SEQ) -> DataFrame:
    """One row per key, the first by source order.

    The rank filter lets Spark cut each key to one row before the shuffle, so a key with
    very many copies costs no more than any other.
    """
    had_seq = seq in df.columns
    ranked = with_seq(df).withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(seq))
    )
    kept = ranked.filter(F.col("_rank") == 1).drop("_rank")
    return kept if had_seq else kept.drop(seq)


def _along_time(chunked: Chunked, keys, order, columns: dict[str, tuple[str, str, str]]) -> DataFrame:
    """Fill ``name`` from (own value, last value to carry on, first value to carry back).

    A gap that nothing earlier can fill takes the first value of the whole key: if all
    earlier values are null, the next one and the first one are the same.
    """
    df = chunked.df
    within = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    earlier = within.rowsBetween(Window.unboundedPreceding, -1)
    whole = within.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    if not chunked.single:
        rank = order_key(order)
        edges = df.groupBy(*keys, CHUNK).agg(*[
            edge
            for name, (_, last, first) in columns.items()
            for edge in (
                F.max_by(last, F.when(F.col(last).isNotNull(), rank)).alias(f"_last_{name}"),
                F.min_by(first, F.when(F.col(first).isNotNull(), rank)).alias(f"_first_{name}"),
            )
        ])
        over_chunks = Window.partitionBy(*keys).orderBy(CHUNK)
        before = over_chunks.rowsBetween(Window.unboundedPreceding, -1)
        every = over_chunks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        carried = edges.select(*keys, CHUNK, *[
            side
            for name in columns
            for side in (
                F.last(f"_last_{name}", ignorenulls=True).over(before).alias(f"_before_{name}"),
                F.first(f"_first_{name}", ignorenulls=True).over(every).alias(f"_start_{name}"),
            )
        ])
        df = join_known_or_not(df, carried, [*keys, CHUNK])

    def filled(name: str, own: str, last: str, first: str) -> Column:
        on = F.last(last, ignorenulls=True).over(earlier)
        if chunked.single:
            return F.coalesce(F.col(own), on, F.first(first, ignorenulls=True).over(whole))
        return F.coalesce(F.col(own), on, F.col(f"_before_{name}"), F.col(f"_start_{name}"))

    return df.select(
        *[c for c in chunked.df.columns if c not in columns and c != CHUNK],
        *[filled(name, *parts).alias(name) for name, parts in columns.items()],
    )


def fill_ffill_bfill(
    df: DataFrame, cols, keys=KEYS, ts: str = "datetime", seq: str = SEQ, target_rows: int = TARGET_ROWS
) -> DataFrame:
    """Carry the last known value forward, then the first known one back, within each key."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    order = (ts, seq)
    chunked = in_chunks(with_seq(df), keys, order, target_rows)
    return _along_time(chunked, keys, order, {c: (c, c, c) for c in cols}).select(*df.columns)


def fill_and_keep_first(
    df: DataFrame, fill_cols, keys=KEYS, ts: str = "datetime", seq: str = SEQ, target_rows: int = TARGET_ROWS,
    counted: dict[str, str] | None = None,
) -> DataFrame:
    """Fill along time, then keep the first row per key and instant, as one aggregation.

    ``counted`` maps names of flag columns to names of new columns: how many rows of an instant have the flag set.

    Copies of an instant are first reduced to three values per column: the one of the
    first row, the first known and the last known. That is all the fill ever looks at, and
    it is computed before the shuffle, so a pile of copies never meets in one task.
    """
    fill_cols, counted = [c for c in fill_cols if c in df.columns], counted or {}
    counts = [F.count_if(flag).alias(name) for flag, name in counted.items()]
    raw, rows = with_seq(df), with_seq(df).drop(*counted)
    others = [c for c in rows.columns if c not in (*keys, ts, seq, *fill_cols)]
    position = F.col(seq)
    aggs = [F.min(seq).alias(seq)]
    aggs += [F.min_by(c, position).alias(c) for c in [*others, *fill_cols]]
    for c in fill_cols:
        known = F.when(F.col(c).isNotNull(), position)
        aggs += [F.min_by(c, known).alias(f"_first_{c}"), F.max_by(c, known).alias(f"_last_{c}")]
    instants = raw.groupBy(*keys, ts).agg(*aggs, *counts)
    density = measure_density(rows, keys, ts)
    if density.rows_in_hottest_hour > target_rows:  # copies of one instant may be all there is to it
        density = measure_density(rows.select(*keys, ts).distinct(), keys, ts)
    chunked = in_chunks(instants, keys, (ts,), target_rows, density)
    columns = {c: (c, f"_last_{c}", f"_first_{c}") for c in fill_cols}
    return _along_time(chunked, keys, (ts,), columns).select(*rows.columns, *counted.values())


def fill_forward_limit1(
    df: DataFrame, cols, keys=KEYS, ts: str = "datetime", seq: str = SEQ, target_rows: int = TARGET_ROWS
) -> DataFrame:
    """Carry a value over one missing row at most."""
    cols = [c for c in cols if c in df.columns]
    order = (ts, seq) if seq in df.columns else (ts,)
    shifted = shift_rows(df, [Shift(c, 1, f"_prev_{c}") for c in cols], keys, order, target_rows)
    filled = shifted.withColumns({c: F.coalesce(F.col(c), F.col(f"_prev_{c}")) for c in cols})
    return filled.select(*df.columns)
