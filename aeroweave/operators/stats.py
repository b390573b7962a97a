"""Correlation, significance and linear regression from one-pass aggregates."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroweave.functions.student import student_t_p_value

POLLUTANTS = ("no2", "pm10", "o3")
STUDY_COLUMNS = (
    "no2", "pm10", "o3", "temperature", "wind_speed", "precipitation", "pressure",
    "traffic_index", "congestion_level",
)
CITY_COLUMNS = ("no2", "pm10", "o3", "traffic_index", "temperature", "wind_speed")
REGRESSION_PREDICTORS = ("traffic_index", "temperature", "wind_speed", "precipitation")

# The relationships tested and plotted, as (predictor, pollutant)
TESTED_PAIRS = (
    ("traffic_index", "no2"), ("temperature", "no2"), ("wind_speed", "no2"),
    ("traffic_index", "pm10"), ("wind_speed", "pm10"), ("precipitation", "pm10"),
    ("temperature", "o3"), ("wind_speed", "o3"),
)
SCATTER_PAIRS = (*TESTED_PAIRS, ("traffic_index", "o3"))

# Significance levels and their marks
SIGNIFICANCE = ((0.001, "***"), (0.01, "**"), (0.05, "*"))


def pair_correlations(df: DataFrame, pairs, by=()) -> DataFrame:
    """x, y, r, n for every pair, per group; r is null where a side does not vary.

    Each row contributes one value pair per requested pair of columns, and these are summed
    up inside the task that read them: what is shuffled is one row per pair, group and task.
    A few narrow aggregates over many pairs compile to tight code; hundreds of wide ones
    would not.
    """
    pairs, by = list(pairs), list(by)
    cells = F.array(*[
        F.struct(
            F.lit(i).alias("_i"),
            F.when(F.col(y).isNotNull(), F.col(x).cast("double")).alias("vx"),
            F.when(F.col(x).isNotNull(), F.col(y).cast("double")).alias("vy"),
        )
        for i, (x, y) in enumerate(pairs)
    ])
    moments = df.select(*by, F.explode(cells).alias("_c")).select(*by, "_c.*").groupBy(*by, "_i").agg(
        F.count("vx").alias("n"), F.var_pop("vx").alias("_sx"), F.var_pop("vy").alias("_sy"),
        F.covar_pop("vx", "vy").alias("_sxy"),
        # merged partial variances of a constant can end up a hair above zero, its extremes cannot
        ((F.min("vx") < F.max("vx")) & (F.min("vy") < F.max("vy"))).alias("_varies"),
    )
    raw = F.when(F.col("_varies"), F.try_divide(F.col("_sxy"), F.sqrt("_sx") * F.sqrt("_sy")))
    r = F.when(raw > 1, 1.0).when(raw < -1, -1.0).otherwise(raw)
    names = [F.array(*[F.lit(pair[side]) for pair in pairs])[F.col("_i")].alias("xy"[side]) for side in (0, 1)]
    return moments.select(*by, *names, r.alias("r"), "n")


def correlation_matrix(df: DataFrame, cols=STUDY_COLUMNS, by=()) -> DataFrame:
    """Full symmetric matrix in long form, diagonal included."""
    cols = [c for c in cols if c in df.columns]
    half = pair_correlations(df, [*((c, c) for c in cols), *combinations(cols, 2)], by)
    both_ways = F.when(F.col("x") == F.col("y"), F.array(F.struct("x", "y"))).otherwise(
        F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))
    )
    return half.select(*by, F.explode(both_ways).alias("_p"), "r", "n").select(*by, "_p.x", "_p.y", "r", "n")


def pollutant_pairs(df: DataFrame, cols=STUDY_COLUMNS, pollutants=POLLUTANTS) -> DataFrame:
    """The rows of the matrix that start from a pollutant, and nothing else: for when the rest isn't wanted."""
    cols = [c for c in cols if c in df.columns]
    return pair_correlations(df, [(p, c) for p in pollutants if p in cols for c in cols if c != p])


def pollutant_correlations(corr: DataFrame, pollutants=POLLUTANTS) -> DataFrame:
    """Rows of pollutants against everything that is not a pollutant."""
    return corr.filter(F.col("x").isin(*pollutants) & ~F.col("y").isin(*pollutants))


def city_correlations(df: DataFrame, by: str = "city", cols=CITY_COLUMNS) -> DataFrame:
    """Pollutants against predictors within each city."""
    cols = [c for c in cols if c in df.columns]
    pairs = [(p, x) for p in cols if p in POLLUTANTS for x in cols if x not in POLLUTANTS]
    return pair_correlations(df, pairs, [by])


def top_correlations(corr: DataFrame, pollutants=POLLUTANTS) -> DataFrame:
    """Per pollutant the other variables by strength of correlation.

    Strengths that agree to twelve digits are ties, ordered by name: beyond that the digits
    depend on the order in which tasks were added up.
    """
    ranked = corr.filter(F.col("x").isin(*pollutants) & (F.col("x") != F.col("y")) & F.col("r").isNotNull())
    order = Window.partitionBy("x").orderBy(F.round(F.abs("r"), 12).desc(), "y")
    return ranked.select(
        F.col("x").alias("pollutant"), F.col("y").alias("variable"), "r", F.row_number().over(order).alias("rank")
    )


def significance(p: Column) -> Column:
    stars = F.lit("")
    for level, mark in reversed(SIGNIFICANCE):
        stars = F.when(p < level, mark).otherwise(stars)
    return F.when(p.isNotNull(), stars)


def pearson_tests(df: DataFrame, pairs=TESTED_PAIRS, by=()) -> DataFrame:
    """pollutant, predictor, correlation, n, p_value, significance for pairs with n > 2.

    The correlations come from one pass; the t distribution, which no built-in offers, is
    evaluated on the few resulting rows.
    """
    pairs = [(x, y) for x, y in pairs if x in df.columns and y in df.columns]
    tested = pair_correlations(df, pairs, by).filter(F.col("n") > 2)
    named = tested.select(
        *by, F.upper("y").alias("pollutant"), F.col("x").alias("predictor"), F.col("r").alias("correlation"), "n"
    )
    p = student_t_p_value(F.col("correlation"), F.col("n"))
    return named.withColumn("p_value", p).withColumn("significance", significance(F.col("p_value")))


def scatter_tests(df: DataFrame, pairs=SCATTER_PAIRS) -> DataFrame:
    """r and p of each relationship that is plotted, next to :func:`scatter_points`."""
    return pearson_tests(df, pairs)


def scatter_points(df: DataFrame, pairs=SCATTER_PAIRS) -> DataFrame:
    """predictor, pollutant, x, y for every row where both sides of a pair are known."""
    pairs = [(x, y) for x, y in pairs if x in df.columns and y in df.columns]
    points = F.array(*[
        F.struct(
            F.lit(x).alias("predictor"), F.lit(y).alias("pollutant"),
            F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"),
        )
        for x, y in pairs
    ])
    exploded = df.select(F.explode(points).alias("_p")).select("_p.*")
    return exploded.dropna(subset=["x", "y"])


def _solve(frames, predictors, by):
    """Least squares of each row's centred moments; a rank-deficient fit takes the shortest solution."""
    k = len(predictors)
    for pdf in frames:
        out = []
        for row in pdf.itertuples(index=False):
            sxx = np.asarray(row.sxx, dtype=float).reshape(k, k)
            sxy = np.asarray(row.sxy, dtype=float)
            weights = np.linalg.pinv(sxx, hermitian=True) @ sxy
            intercept = row.mean_y - float(np.dot(weights, np.asarray(row.mean_x, dtype=float)))
            r2 = float(weights @ sxy / row.syy) if row.varies else None
            base = {name: getattr(row, name) for name in (*by, "pollutant", "n")}
            named = [*zip(predictors, weights), ("intercept", intercept)]
            out += [{**base, "term": t, "coefficient": float(w), "r2": r2} for t, w in named]
        yield pd.DataFrame(out, columns=[*by, "pollutant", "term", "coefficient", "r2", "n"])


def pollutant_regression(
    df: DataFrame, pollutants=POLLUTANTS, predictors=REGRESSION_PREDICTORS, by=()
) -> DataFrame:
    """Linear regression with intercept per pollutant: one row per term, with in-sample R² and n.

    Only rows with the pollutant and all predictors known take part, and a fit needs more
    rows than predictors. One aggregation gives the centred moments of all fits; solving
    them means inverting a matrix the size of the predictor list.
    """
    predictors = [p for p in predictors if p in df.columns]
    pollutants = [p for p in pollutants if p in df.columns]
    by = list(by)
    fits = F.array(*[
        F.struct(F.lit(y).alias("pollutant"), F.col(y).cast("double").alias("y")) for y in pollutants
    ])
    xs = [f"_x{i}" for i in range(len(predictors))]
    known = df.dropna(subset=predictors)
    cases = (
        known.select(*by, *[F.col(p).cast("double").alias(x) for p, x in zip(predictors, xs)], F.explode(fits).alias("_f"))
        .select(*by, *xs, "_f.*").filter(F.col("y").isNotNull())
    )
    moments = cases.groupBy(*by, "pollutant").agg(
        F.count("*").alias("n"),
        F.avg("y").alias("mean_y"), F.var_pop("y").alias("syy"), (F.min("y") < F.max("y")).alias("varies"),
        F.array(*[F.avg(x) for x in xs]).alias("mean_x"),
        F.array(*[F.covar_pop(x, "y") for x in xs]).alias("sxy"),
        F.array(*[F.covar_pop(a, b) for a in xs for b in xs]).alias("sxx"),
    ).filter(F.col("n") > len(predictors))
    kinds = dict(df.dtypes)
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in by],
                        "pollutant string, term string, coefficient double, r2 double, n bigint"])
    return moments.mapInPandas(lambda frames: _solve(frames, predictors, by), schema)


def study_summary(df: DataFrame) -> DataFrame:
    """item, value: rows, first and last date, and one ``city`` row per city."""
    totals = df.agg(
        F.count("*").cast("string").alias("records"),
        F.count_distinct("city").cast("string").alias("cities"),
        F.min("date").cast("string").alias("date_min"), F.max("date").cast("string").alias("date_max"),
    )
    items = totals.unpivot([], ["records", "cities", "date_min", "date_max"], "item", "value")
    return items.unionByName(df.select(F.lit("city").alias("item"), F.col("city").alias("value")).distinct())
