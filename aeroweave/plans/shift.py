"""Values of earlier rows of the same key."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aeroweave.plans.chunks import CHUNK, TARGET_ROWS, Density, in_chunks


class Shift(NamedTuple):
    column: str
    rows: int
    name: str


def shift_rows(
    df: DataFrame, shifts: list[Shift], keys, order, target_rows: int = TARGET_ROWS,
    density: Density | None = None,
) -> DataFrame:
    """Add ``name`` = value of ``column`` that many rows earlier along ``order``.

    When a key spans several chunks, each chunk is given copies of the few rows that come
    just before it, so the shift never has to look outside its own chunk.
    """
    if not shifts:
        return df
    chunked = in_chunks(df, keys, order, target_rows, density)
    rows = chunked.df
    reach = max(s.rows for s in shifts)
    if not chunked.single:
        carried = list(dict.fromkeys([*order, *(s.column for s in shifts)]))
        latest_first = [F.col(c).desc() for c in order]
        tails = (
            rows.select(*dict.fromkeys([*keys, CHUNK, *carried]))
            .withColumn("_r", F.row_number().over(Window.partitionBy(*keys, CHUNK).orderBy(*latest_first)))
            .filter(F.col("_r") <= reach)
            .drop("_r")
        )
        # every row among the last `reach` before a chunk is among the last of its own chunk
        by_key = Window.partitionBy(*keys).orderBy(*order)
        prior = F.collect_list(F.struct(*carried)).over(by_key.rowsBetween(-reach, -1))
        first_of_chunk = F.lag(CHUNK).over(by_key) != F.col(CHUNK)
        # the first tail row of a chunk sits right behind the rows of earlier chunks
        starts = tails.select(*keys, CHUNK, prior.alias("_prior"), first_of_chunk.alias("_start"))
        copies = (
            starts.filter("_start")
            .select(*keys, CHUNK, F.explode("_prior").alias("_row"))
            .select(*keys, CHUNK, *[F.col("_row")[c].alias(c) for c in carried if c not in keys])
        )
        rows = rows.withColumn("_home", F.lit(True)).unionByName(
            copies.withColumn("_home", F.lit(False)), allowMissingColumns=True
        )
    along = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    shifted = rows.withColumns({s.name: F.lag(s.column, s.rows).over(along) for s in shifts})
    if not chunked.single:
        shifted = shifted.filter("_home")
    return shifted.select(*df.columns, *[s.name for s in shifts])
