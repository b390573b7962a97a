"""Rolling means over a span of days."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aeroweave.functions.calendar import micros
from aeroweave.plans.chunks import CHUNK, HOUR_US, TARGET_ROWS, Density, join_known_or_not, measure_density

KEYS = ("city_key",)
DAY_US = 24 * HOUR_US
#: A day, an hour, a minute, a second: the first in which the fullest hour fits the target.
BLOCKS_US = (DAY_US, HOUR_US, HOUR_US // 60, HOUR_US // 3600)


def rolling_mean(
    df: DataFrame, cols, days=(7, 30), keys=KEYS, ts: str = "datetime", target_rows: int = TARGET_ROWS,
    density: Density | None = None,
) -> DataFrame:
    """``{column}_rolling_{N}d``: mean of the known values in ``(t - N days, t]`` per key.

    A sliding frame would re-add up to N days of values for every row. Here time is cut
    into blocks (a day, or less for dense feeds), and the window is the values of the own
    block so far, the whole blocks between, and what is left of the block it begins in. A row
    of that block goes N days after its time, in the same place of the own block; it is sent
    there as an extra row, with the sum of what comes after it in its own block. Nothing is
    ever subtracted, so a very large value leaves no trace when it goes. All groups are one key and
    one block. Expects one row per key and instant; a row without a time has no window.
    """
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    density = density or measure_density(df, keys, ts)
    block_us = next((b for b in BLOCKS_US if density.rows_in_hottest_hour * b <= target_rows * HOUR_US), BLOCKS_US[-1])
    spans = {n: n * DAY_US // block_us for n in days}
    timed = df.withColumn("_us", micros(F.col(ts))).withColumn(CHUNK, F.floor(F.col("_us") / F.lit(block_us)))

    after = Window.partitionBy(*keys, CHUNK).orderBy("_us").rangeBetween(1, Window.unboundedFollowing)
    rest = {}
    for c in cols:
        rest[f"_sr_{c}"] = F.coalesce(F.sum(c).over(after), F.lit(0).cast("double"))
        rest[f"_kr_{c}"] = F.count(c).over(after)
    sent = timed.withColumns(rest).withColumn("_left", F.explode(F.array(*[F.lit(n) for n in (0, *days)])))
    moved = F.create_map(*[F.lit(x) for n in (0, *days) for x in (n, spans.get(n, 0))])
    moves = sent.withColumns({
        "_us": F.col("_us") + F.col("_left") * F.lit(DAY_US), CHUNK: F.col(CHUNK) + moved[F.col("_left")],
    })
    # whatever leaves at an instant has left before a row of that instant is looked at
    since = (
        Window.partitionBy(*keys, CHUNK).orderBy("_us", F.col("_left") == 0)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    running = {}
    for c in cols:
        own = F.when(F.col("_left") == 0, F.col(c))
        running[f"_s_own_{c}"], running[f"_k_own_{c}"] = F.sum(own).over(since), F.count(own).over(since)
        for n in days:
            for kind in ("s", "k"):
                left = F.when(F.col("_left") == n, F.col(f"_{kind}r_{c}"))
                running[f"_{kind}{n}_{c}"] = F.last(left, ignorenulls=True).over(since)
    here = moves.withColumns(running).filter(F.col("_left") == 0)

    blocks = timed.groupBy(*keys, CHUNK).agg(
        *[F.sum(c).alias(f"_s_{c}") for c in cols], *[F.count(c).alias(f"_k_{c}") for c in cols]
    )
    by_block = Window.partitionBy(*keys).orderBy(CHUNK)
    base = blocks.select(*keys, CHUNK, *[
        F.sum(f"_{kind}_{c}").over(by_block.rangeBetween(-spans[n] + low, high)).alias(f"_{kind}{name}{n}_{c}")
        for c in cols for n in days for kind in ("s", "k")
        for name, low, high in (("b", 1, -1), ("e", 0, -spans[n]))
    ])

    def total(kind: str, n: int, c: str):
        begun = F.coalesce(F.col(f"_{kind}{n}_{c}"), F.col(f"_{kind}e{n}_{c}"))
        return reduce(lambda a, b: a + b, [
            F.coalesce(part, F.lit(0)) for part in (F.col(f"_{kind}_own_{c}"), F.col(f"_{kind}b{n}_{c}"), begun)])

    means = []
    for c in cols:
        for n in days:
            known = F.when(F.col("_us").isNotNull(), total("k", n, c))
            means.append(F.try_divide(F.when(known > 0, total("s", n, c).cast("double")), known).alias(f"{c}_rolling_{n}d"))
    return join_known_or_not(here, base, [*keys, CHUNK]).select(*df.columns, *means)
