"""Rank correlation, and correlations at lags and by season."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroweave.functions.calendar import season
from aeroweave.operators.stats import POLLUTANTS, STUDY_COLUMNS, pair_correlations
from aeroweave.plans.chunks import TARGET_ROWS
from aeroweave.plans.ranks import attach_by_value, average_ranks
from aeroweave.plans.shared import written
from aeroweave.plans.shift import Shift, shift_rows

ROW, SPACE, VALUE = "_row", "_space", "_v"


def _spaces(narrow: DataFrame, pairs) -> tuple[list[tuple[int, int | None]], list[tuple[int, int]]]:
    """The different orders that pairs need: (column, other column that must be known too), and per pair its two orders.

    A pair is ranked over the rows that know both sides. Where that is every row that knows x, the order of x alone serves; one
    counting pass tells.
    """
    columns = sorted({c for pair in pairs for c in pair})
    known = lambda i: F.col(f"_x{i}").isNotNull()
    counts = narrow.agg(
        *[F.count_if(known(i)).alias(f"a{i}") for i in columns],
        *[F.count_if(known(i) & known(j)).alias(f"b{i}_{j}") for i, j in pairs]).first()
    wanted, spaces = [], []
    for i, j in pairs:
        both = counts[f"b{i}_{j}"]
        mine = (i, None if both == counts[f"a{i}"] else j)
        other = (j, None if both == counts[f"a{j}"] else i)
        for space in (mine, other):
            if space not in spaces:
                spaces.append(space)
        wanted.append((spaces.index(mine), spaces.index(other)))
    return spaces, wanted


def rank_correlations(df: DataFrame, pairs, by=()) -> DataFrame:
    """x, y, rho, n for every pair, per group: Pearson's r of average ranks over the rows that know both sides.

    Unknown and NaN values are left out pair by pair. rho is null where a side does not vary or no row knows both.

    Values are counted first, so that ties are one row, and ranked in a range-partitioned order (:func:`average_ranks`); ranks go back
    to the rows by value, hot ones by broadcast. Each row then gives the products of its own ranks, summed in the task. Ranks are
    taken from their mean, which is known beforehand, so the sums keep their digits.
    """
    pairs, by = list(pairs), list(by)
    names = list(dict.fromkeys(c for pair in pairs for c in pair))
    numbers = [F.col(c).cast("double") for c in names]
    held = [f"_by{i}" for i in range(len(by))]
    # equal unknown groups meet in joins as a struct of them does
    group = F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"k{i}") for i, c in enumerate(by)],
                     *[F.col(c).isNull().alias(f"n{i}") for i, c in enumerate(by)], F.lit(0).alias("one"))
    narrow = written(df.select(
        F.monotonically_increasing_id().alias(ROW), group.alias("_group"), *[F.col(c).alias(h) for c, h in zip(by, held)],
        *[F.when(~F.isnan(v), v).alias(f"_x{i}") for i, v in enumerate(numbers)]), "ranked-rows")
    spaces, wanted = _spaces(narrow, [(names.index(x), names.index(y)) for x, y in pairs])

    cells = F.filter(F.array(*[
        F.struct(F.lit(s).alias(SPACE), (F.col(f"_x{i}") if j is None else F.when(F.col(f"_x{j}").isNotNull(), F.col(f"_x{i}"))).alias(VALUE))
        for s, (i, j) in enumerate(spaces)]), lambda c: c[VALUE].isNotNull())
    long = narrow.select(ROW, "_group", F.explode(cells).alias("_c")).select(ROW, "_group", f"_c.{SPACE}", f"_c.{VALUE}")
    key = ["_group", SPACE]
    counts = long.groupBy(*key, VALUE).agg(F.count("*").alias("n"))
    ranks = written(average_ranks(counts, key, VALUE), "ranks")
    from_mean = F.col("rank") - (F.col("total") + 1) / 2.0
    ranked = attach_by_value(long, ranks, key, VALUE).select(ROW, "_group", SPACE, from_mean.alias("d"))
    rows = ranked.groupBy("_group", ROW).agg(*[
        F.max(F.when(F.col(SPACE) == s, F.col("d"))).alias(f"_d{s}") for s in range(len(spaces))])
    products = F.filter(F.array(*[
        F.struct(F.lit(p).alias("i"), F.col(f"_d{a}").alias("dx"), F.col(f"_d{b}").alias("dy")) for p, (a, b) in enumerate(wanted)]),
        lambda c: c["dx"].isNotNull() & c["dy"].isNotNull())
    sums = rows.select("_group", F.explode(products).alias("_p")).select("_group", "_p.*").groupBy("_group", "i").agg(
        F.count("*").alias("n"), F.sum(F.col("dx") * F.col("dy")).alias("xy"), F.sum(F.col("dx") * F.col("dx")).alias("xx"),
        F.sum(F.col("dy") * F.col("dy")).alias("yy"))

    # every pair of every group has a row, those without common rows too
    each = F.explode(F.array(*[
        F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.lit(i).alias("i")) for i, (x, y) in enumerate(pairs)])).alias("_p")
    groups = narrow.select("_group", *held).distinct() if by else narrow.agg(F.first("_group").alias("_group")).filter("_group is not null")
    wide = groups.select("_group", *held, each).select("_group", *held, "_p.*")
    rho = F.try_divide(F.col("xy"), F.sqrt("xx") * F.sqrt("yy"))
    # equal steps can add up a hair beyond 1
    bounded = F.when(rho > 1, 1.0).when(rho < -1, -1.0).otherwise(rho)
    return wide.join(sums, ["_group", "i"], "left").select(
        *[F.col(h).alias(c) for c, h in zip(by, held)], "x", "y", bounded.alias("rho"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def spearman_matrix(df: DataFrame, cols=STUDY_COLUMNS, by=()) -> DataFrame:
    """Full symmetric matrix of rank correlations in long form, diagonal included."""
    cols = [c for c in cols if c in df.columns]
    half = rank_correlations(df, [*((c, c) for c in cols), *combinations(cols, 2)], by)
    both_ways = F.when(F.col("x") == F.col("y"), F.array(F.struct("x", "y"))).otherwise(
        F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y"))))
    return half.select(*by, F.explode(both_ways).alias("_p"), "rho", "n").select(*by, "_p.x", "_p.y", "rho", "n")


def lagged_correlations(
    df: DataFrame, predictors, pollutants=POLLUTANTS, lags=(0, 1, 3, 6, 12, 24), keys=("city_key",), ts: str = "datetime",
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """predictor, pollutant, lag, r, n: pollutants against what predictors were ``lag`` rows earlier, over all keys.

    On a full hourly grid that is hours. One row per key and instant is expected, as for :func:`lag_features`.
    """
    predictors = [c for c in predictors if c in df.columns]
    pollutants = [c for c in pollutants if c in df.columns]
    named = {(c, n): f"_{c}_{n}" if n else c for c in predictors for n in lags}
    shifts = [Shift(c, n, name) for (c, n), name in named.items() if n]
    narrow = df.select(*dict.fromkeys([*keys, ts, *predictors, *pollutants]))
    shifted = shift_rows(narrow, shifts, list(keys), (ts,), target_rows)
    found = pair_correlations(shifted, [(name, p) for name in named.values() for p in pollutants])
    label = F.create_map(*[F.lit(v) for (c, n), name in named.items() for v in (name, f"{c}|{n}")])[F.col("x")]
    return found.select(
        F.split(label, r"\|")[0].alias("predictor"), F.col("y").alias("pollutant"), F.split(label, r"\|")[1].cast("int").alias("lag"), "r", "n")


def seasonal_correlations(df: DataFrame, pairs, date: str = "date") -> DataFrame:
    """season, x, y, r, n: each pair's correlation within the meteorological seasons."""
    return pair_correlations(df.withColumn("season", season(F.month(date))), pairs, ["season"])
