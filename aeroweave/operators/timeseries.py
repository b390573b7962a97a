"""Autocorrelation, decomposition and tests for stationarity of each key's history."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroweave.functions.calendar import micros
from aeroweave.plans.chunks import CHUNK, HOUR_US, TARGET_ROWS, in_chunks, join_known_or_not
from aeroweave.plans.shared import written
from aeroweave.plans.shift import Shift, shift_rows

KEYS = ("city_key",)
X, MEAN, ROWS = "_x", "_mean", "_n"

# MacKinnon's response surface for the test with a constant, per level of significance
DICKEY_FULLER = {
    0.01: (-3.43035, -6.5393, -16.786, -79.433),
    0.05: (-2.86154, -2.8903, -4.234, -40.040),
    0.10: (-2.56677, -1.5384, -2.809, 0.0),
}
# Critical values of Kwiatkowski, Phillips, Schmidt and Shin around a level
LEVEL_STATIONARY = {0.01: 0.739, 0.05: 0.463, 0.10: 0.347}


def kinds_of(df: DataFrame, keys) -> str:
    """The key columns as the beginning of a DDL schema."""
    kinds = dict(df.dtypes)
    return "".join(f"`{c}` {kinds[c]}, " for c in keys)


def centred(df: DataFrame, column: str, keys, ts: str) -> DataFrame:
    """keys, ts, ``_x`` and ``_n``: known values less their key's mean, and how many there are."""
    value = F.col(column).cast("double")
    known = df.select(*keys, ts, value.alias(X)).filter(F.col(X).isNotNull() & ~F.isnan(X) & F.col(ts).isNotNull())
    means = known.groupBy(*keys).agg(F.avg(X).alias(MEAN), F.count("*").alias(ROWS))
    return join_known_or_not(known, means, keys).select(*keys, ts, (F.col(X) - F.col(MEAN)).alias(X), ROWS)


def lag_products(series: DataFrame, keys, ts: str, lags: int, target_rows: int) -> DataFrame:
    """``n``, ``varies`` and ``c``, an array of the sums of ``x[t] x[t - k]`` for k = 0 ... lags, per key.

    All lags come from one pass: a chunk is handed the last ``lags`` rows before it, and the products are added up in the task.
    """
    shifted = shift_rows(series, [Shift(X, k, f"_l{k}") for k in range(1, lags + 1)], list(keys), (ts,), target_rows)
    sums = [F.sum(F.col(X) * F.col(X)), *[F.sum(F.col(X) * F.col(f"_l{k}")) for k in range(1, lags + 1)]]
    return shifted.groupBy(*keys).agg(
        F.count("*").alias("n"), (F.min(X) < F.max(X)).alias("varies"),
        *[F.coalesce(s, F.lit(0.0)).alias(f"_c{k}") for k, s in enumerate(sums)],
    ).select(*keys, "n", "varies", F.array(*[f"_c{k}" for k in range(lags + 1)]).alias("c"))


def partial_autocorrelations(r: np.ndarray) -> np.ndarray:
    """Durbin and Levinson's recursion on autocorrelations at lags 1, 2, ...; unknown from where the past explains everything."""
    found = np.full(len(r), np.nan)
    phi = np.zeros(0)
    for k in range(len(r)):
        rest = 1.0 - phi @ r[:k]
        if not np.isfinite(r[k]) or rest <= 0:
            break
        found[k] = (r[k] - phi @ r[:k][::-1]) / rest
        phi = np.append(phi - found[k] * phi[::-1], found[k])
    return found


def autocorrelation(
    df: DataFrame, column: str, keys=KEYS, ts: str = "datetime", lags: int = 48, target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """lag (1 ... lags), acf, pacf, bound, n per key: correlation with the value that many known rows earlier.

    Rows without the value or the time are left out; on a full hourly grid a row is an hour. ``bound`` is what white
    noise stays within in 95 of 100 cases. Lags of as many rows as there are, and histories that do not vary, have null.
    One row per key and instant is expected.
    """
    keys = list(keys)
    sums = lag_products(centred(df, column, keys, ts), keys, ts, lags, target_rows)

    def solve(frames):
        for pdf in frames:
            out = []
            for row in pdf.itertuples(index=False):
                c = np.asarray(row.c, float)
                r = c[1:] / c[0] if row.varies and c[0] > 0 else np.full(lags, np.nan)
                r[np.arange(1, lags + 1) >= row.n] = np.nan
                pacf = partial_autocorrelations(r)
                base = tuple(row[:len(keys)])
                out += [(*base, k + 1, *(None if np.isnan(v) else float(v) for v in (r[k], pacf[k])), 1.96 / np.sqrt(row.n), row.n)
                        for k in range(lags)]
            yield pd.DataFrame(out, columns=[*keys, "lag", "acf", "pacf", "bound", "n"])

    return sums.mapInPandas(solve, kinds_of(df, keys) + "lag int, acf double, pacf double, bound double, n bigint")


def decompose(
    df: DataFrame, column: str, period: int = 24, step_us: int = HOUR_US, keys=KEYS, ts: str = "datetime",
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """observed, trend, seasonal and residual of each key and step, which add up to the observed value.

    A step is a span of ``step_us`` (an hour), and several values of one are averaged first. The trend is the centred mean over a
    period (with half weights at both ends if that is even), and null unless all its steps are known: next to gaps and at both
    ends. The season is the mean of what the trend leaves, per phase of the period counted from 1970, less the mean of the phases;
    a phase without any trend, as in a history shorter than a period, has null. Steps without a value have no row.

    The window looks forward and back by half a period. Time is cut into spans that several windows fit into, and
    rows near a border are copied to the span beyond it, so each window lies in one span.
    """
    if period < 2:
        raise ValueError("a period has two steps at least")
    keys, half = list(keys), period // 2
    place = F.floor(micros(F.col(ts)) / F.lit(step_us))
    value = F.col(column).cast("double")
    steps = df.filter(value.isNotNull() & ~F.isnan(value) & F.col(ts).isNotNull()).groupBy(*keys, place.alias("_at")).agg(
        F.avg(value).alias("observed"))
    span = max(target_rows, 4 * period)
    home = F.floor(F.col("_at") / span)
    spans = F.array_distinct(F.array(home, F.floor((F.col("_at") - half) / span), F.floor((F.col("_at") + half) / span)))
    copies = steps.withColumn("_home", home).withColumn(CHUNK, F.explode(spans))
    along = Window.partitionBy(*keys, CHUNK).orderBy("_at")
    over = along.rangeBetween(-half, half)
    total, count = F.sum("observed").over(over), F.count("observed").over(over)
    if period % 2 == 0:
        total = (total + F.sum("observed").over(along.rangeBetween(1 - half, half - 1))) / 2
    phase = F.pmod(F.col("_at"), F.lit(period))
    trended = (
        copies.withColumn("trend", F.when(count == 2 * half + 1, total / period)).filter(F.col(CHUNK) == F.col("_home"))
        .select(*keys, "_at", phase.alias("_phase"), "observed", "trend"))
    trended = written(trended, "trend")
    phases = trended.filter("trend is not null").groupBy(*keys, "_phase").agg(F.avg(F.col("observed") - F.col("trend")).alias("_s"))
    # at most one row per key and phase
    seasons = phases.select(*keys, "_phase", (F.col("_s") - F.avg("_s").over(Window.partitionBy(*keys))).alias("seasonal"))
    instant = F.timestamp_micros(F.col("_at") * F.lit(step_us)).cast("timestamp_ntz")
    return join_known_or_not(trended, seasons, [*keys, "_phase"]).select(
        *keys, instant.alias(ts), "observed", "trend", "seasonal",
        (F.col("observed") - F.col("trend") - F.col("seasonal")).alias("residual"))


def default_lags(n: Column) -> Column:
    """``floor(12 (n / 100)^(1/4))``, a usual number of lags for n values."""
    return F.floor(12 * F.pow(n / 100.0, F.lit(0.25)))


def kpss(df: DataFrame, column: str, keys=KEYS, ts: str = "datetime", lags: int = 24, target_rows: int = TARGET_ROWS) -> DataFrame:
    """statistic, long_run_variance, n, stationary per key: the test whose null hypothesis is a constant level.

    The statistic is the sum of squared partial sums over the squared number of values and the long-run variance, which weighs
    autocovariances at 1 ... ``lags`` by Bartlett's kernel. ``stationary`` says that it stays below the critical value at 5 %.
    A history that does not vary has null. Unknown values and times are left out.

    Partial sums run inside a chunk of a history; what earlier chunks add up to is one number per chunk.
    """
    keys = list(keys)
    series = written(centred(df, column, keys, ts), "centred")
    chunked = in_chunks(series, keys, (ts,), target_rows)
    inside = Window.partitionBy(*keys, CHUNK).orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    runs = chunked.df.withColumn("_u", F.sum(X).over(inside)).groupBy(*keys, CHUNK).agg(
        F.count("*").alias("_k"), F.sum(X).alias("_sum"), F.sum("_u").alias("_u"), F.sum(F.col("_u") * F.col("_u")).alias("_uu"))
    before = F.sum("_sum").over(Window.partitionBy(*keys).orderBy(CHUNK)) - F.col("_sum")
    squares = runs.withColumn("_b", before).groupBy(*keys).agg(
        F.sum(F.col("_uu") + 2 * F.col("_b") * F.col("_u") + F.col("_k") * F.col("_b") * F.col("_b")).alias("_squares"))
    weighted = F.aggregate(
        F.transform(F.slice("c", 2, lags), lambda c, k: c * (1 - (k + 1) / float(lags + 1))), F.lit(0.0), lambda a, c: a + c)
    variances = lag_products(series, keys, ts, lags, target_rows).select(
        *keys, "n", "varies", ((F.element_at("c", 1) + 2 * weighted) / F.col("n")).alias("long_run_variance"))
    both = join_known_or_not(variances, squares, keys)
    statistic = F.when(F.col("varies") & (F.col("long_run_variance") > 0), F.col("_squares") / (
        F.col("n").cast("double") * F.col("n") * F.col("long_run_variance")))
    return both.select(*keys, statistic.alias("statistic"), "long_run_variance", "n",
                       (statistic < LEVEL_STATIONARY[0.05]).alias("stationary"))


def adf(df: DataFrame, column: str, keys=KEYS, ts: str = "datetime", lags: int = 2, target_rows: int = TARGET_ROWS) -> DataFrame:
    """statistic, coefficient, n, critical_5, stationary per key: the augmented Dickey-Fuller test with a constant.

    Regresses each change on the level before it and on the ``lags`` changes before; the statistic is the t value of the level's
    coefficient. ``n`` counts the changes that have all of these. ``stationary`` rejects a unit root at 5 %. Where there are too few
    changes, or they do not determine the fit, all but n are null. Unknown values and times are left out.

    One pass over rows that were given their predecessors sums up centred moments; a key's fit solves ``lags + 1`` equations.
    """
    keys, size = list(keys), lags + 1
    series = centred(df, column, keys, ts)
    shifted = shift_rows(series, [Shift(X, k, f"_l{k}") for k in range(1, lags + 2)], keys, (ts,), target_rows)
    levels = [X, *[f"_l{k}" for k in range(1, lags + 2)]]
    terms = {"_d0": F.col(X) - F.col("_l1"), "_level": F.col("_l1")}
    terms |= {f"_d{k}": F.col(levels[k]) - F.col(levels[k + 1]) for k in range(1, lags + 1)}
    changes = shifted.select(*keys, F.col(f"_l{lags + 1}").isNotNull().alias("_full"), *[v.alias(c) for c, v in terms.items()])
    full = lambda c: F.when(F.col("_full"), F.col(c))
    names = ["_level", *[f"_d{k}" for k in range(1, lags + 1)]]
    moments = changes.groupBy(*keys).agg(
        F.count_if("_full").alias("n"), F.var_pop(full("_d0")).alias("yy"),
        F.array(*[F.covar_pop(full(a), full("_d0")) for a in names]).alias("xy"),
        F.array(*[F.covar_pop(full(a), full(b)) for a in names for b in names]).alias("xx"))

    def solve(frames):
        for pdf in frames:
            out = []
            for row in pdf.itertuples(index=False):
                found = (None, None, None)
                free = row.n - size - 1
                if free > 0:
                    xx, xy = np.asarray(row.xx, float).reshape(size, size), np.asarray(row.xy, float)
                    scale = np.sqrt(np.diag(xx))
                    if (scale > 0).all() and np.linalg.matrix_rank(xx / np.outer(scale, scale), hermitian=True) == size:
                        inverse = np.linalg.inv(xx)
                        weights = inverse @ xy
                        error = max(row.yy - float(weights @ xy), 0.0) * row.n / free
                        if error > 0:
                            found = (float(weights[0] / np.sqrt(error * inverse[0, 0] / row.n)), float(weights[0]),
                                     float(sum(b / row.n**i for i, b in enumerate(DICKEY_FULLER[0.05]))))
                statistic, weight, critical = found
                out.append((*row[:len(keys)], statistic, weight, row.n, critical, None if statistic is None else statistic < critical))
            yield pd.DataFrame(out, columns=[*keys, "statistic", "coefficient", "n", "critical_5", "stationary"]).astype({"stationary": object})

    return moments.mapInPandas(solve, kinds_of(df, keys) + "statistic double, coefficient double, n bigint, critical_5 double, stationary boolean")
