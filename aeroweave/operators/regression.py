"""Polynomial regression by orthogonal factors, and its diagnostics."""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroweave.functions.special import chi_square_tail, f_tail, t_tail
from aeroweave.operators.timeseries import kinds_of
from aeroweave.plans.chunks import join_known_or_not
from aeroweave.plans.shared import written
from aeroweave.plans.small import broadcast_if_small

#: Factors that one task multiplies together at a time.
FAN_IN = 32
#: Groups whose factors a task holds before it hands them on.
HELD_GROUPS = 5_000


def polynomial_terms(predictors, degree: int, interactions: bool) -> list[tuple[str, ...]]:
    """Products of predictors up to ``degree``, as tuples of names; without ``interactions`` powers of single ones only."""
    found = [t for n in range(1, degree + 1) for t in combinations_with_replacement(predictors, n)]
    return [t for t in found if interactions or len(set(t)) == 1]


def term_name(term: tuple[str, ...]) -> str:
    return "*".join(c if n == 1 else f"{c}^{n}" for c in dict.fromkeys(term) for n in [term.count(c)])


def _triangle(rows: np.ndarray) -> np.ndarray:
    """R of a QR factorisation, square also where there are few rows, with a diagonal that is not negative."""
    size = rows.shape[1]
    r = np.linalg.qr(rows, mode="r")
    r = np.vstack([r, np.zeros((size - len(r), size))]) if len(r) < size else r
    return r * np.where(np.diag(r) < 0, -1.0, 1.0)[:, None]


def orthogonal_factors(rows: DataFrame, columns, by=()) -> DataFrame:
    """n and r per group: the triangular factor of the matrix of ``columns``, flattened row by row.

    Rows are factored where they are, batch by batch, and factors of tasks are joined in groups of FAN_IN until one per group is
    left. Unlike sums of products, this keeps the digits of ill-conditioned columns.
    """
    by, columns, size = list(by), list(columns), len(columns)
    ddl = kinds_of(rows, by) + "part bigint, n bigint, r array<double>"
    names = [f"k{i}" for i in range(len(by))]

    def flushed(held, kinds):
        keys, parts = zip(*held), list(held.values())
        return pa.RecordBatch.from_arrays(
            [*(pa.array(k, t) for k, t in zip(keys, kinds)), pa.array([0] * len(parts), pa.int64()), pa.array([n for n, _ in parts], pa.int64()),
             pa.array([r.ravel() for _, r in parts], pa.list_(pa.float64()))], names=[*by, "part", "n", "r"])

    def factor(batches):
        held: dict = {}
        kinds: list = []
        for batch in batches:
            matrix = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in columns])
            kinds = [batch.schema.field(c).type for c in by]
            table = pa.Table.from_arrays([*(batch.column(c) for c in by), pa.array(np.arange(len(matrix)))], names=[*names, "i"])
            # without keys a batch is one group
            grouped = table.group_by(names).aggregate([("i", "list")]).to_pylist() if by else [{"i_list": slice(None)}]
            for row in grouped:
                key, part = tuple(row[c] for c in names), matrix[row["i_list"]]
                n, r = held.get(key, (0, np.zeros((0, size))))
                held[key] = n + len(part), _triangle(np.vstack([r, part]))
            if len(held) > HELD_GROUPS:
                yield flushed(held, kinds)
                held = {}
        if held:
            yield flushed(held, kinds)

    def joined(pdf):
        first = pdf.iloc[:1].copy()
        first["n"] = pdf["n"].sum()
        first["r"] = [_triangle(np.vstack([np.asarray(r, float).reshape(size, size) for r in pdf["r"]])).ravel().tolist()]
        return first

    found = rows.mapInArrow(factor, ddl).withColumn("part", F.monotonically_increasing_id())
    found = written(found, "factors")
    while True:
        most = found.groupBy(*by).count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return found.drop("part")
        groups = -(-most // FAN_IN)
        dealt = found.withColumn("part", F.pmod(F.xxhash64("part"), F.lit(groups)))
        found = written(dealt.groupBy(*by, "part").applyInPandas(joined, ddl).withColumn(
            "part", F.monotonically_increasing_id()), "factors")


def _solved(r: np.ndarray):
    """Coefficients, residual sum of squares and inverse of X'X from a factor whose last column is the response; None if singular."""
    inner = r[:-1, :-1]
    scale = np.sqrt((inner * inner).sum(axis=0))
    if (np.abs(np.diag(inner)) <= 1e-13 * scale).any():
        return None
    inverse = np.linalg.inv(inner / scale) / scale[:, None]
    return inverse @ r[:-1, -1], float(r[-1, -1] ** 2), inverse @ inverse.T


def _centred_squares(r: np.ndarray) -> np.ndarray:
    """Squared deviations of each column; the first one is the constant."""
    return (r[1:] ** 2).sum(axis=0)


def design(df: DataFrame, response: str, terms, by=()) -> DataFrame:
    """by, ``_1`` (the constant), ``_t0`` ..., ``_y``, of rows that know the response and all predictors."""
    names = list(dict.fromkeys(c for t in terms for c in t))
    value = lambda c: F.col(c).cast("double")
    known = df
    for c in (response, *names):
        known = known.filter(F.abs(value(c)) < float("inf"))  # not null, NaN or infinite
    products = []
    for i, term in enumerate(terms):
        product = value(term[0])
        for c in term[1:]:
            product = product * value(c)
        products.append(product.alias(f"_t{i}"))
    return known.select(*by, F.lit(1.0).alias("_1"), *products, value(response).alias("_y"))


def polynomial_regression(
    df: DataFrame, response: str, predictors, degree: int = 2, interactions: bool = True, by=(),
) -> tuple[DataFrame, DataFrame]:
    """Least squares on all products of predictors up to ``degree``: its coefficients, and a summary, per group.

    Coefficients: term, coefficient, std_error, statistic, p_value, vif (of terms other than the constant). Summary: n, r2, adjusted_r2,
    rmse, f_statistic, f_p_value, bp_statistic, bp_freedom, bp_p_value: the last three are Breusch and Pagan's test for errors whose
    spread depends on the terms, in Koenker's form (n times the R² of squared errors). Rows with unknown values are left out. A group
    whose terms are not independent or that has no more rows than terms is absent from the coefficients, and has only n in the summary.

    The first pass factors ``[1, terms, response]`` (:func:`orthogonal_factors`); the second one does so with the squared errors of
    the first fit as response. Only triangles the size of the term list are shuffled.
    """
    by = list(by)
    terms = polynomial_terms(predictors, degree, interactions)
    k, labels = len(terms), ["const", *map(term_name, terms)]
    rows = design(df, response, terms, by)
    inputs = ["_1", *[f"_t{i}" for i in range(k)]]
    factors = orthogonal_factors(rows, [*inputs, "_y"], by)
    kinds = kinds_of(df, by)

    def fit(frames):
        for pdf in frames:
            fits = [_solved(np.asarray(r, float).reshape(k + 2, k + 2)) for r in pdf["r"]]
            yield pdf[by].assign(beta=[None if f is None or n <= k + 1 else f[0].tolist() for f, n in zip(fits, pdf["n"])])

    fitted = written(factors.mapInPandas(fit, kinds + "beta array<double>"), "fit") if by else factors.mapInPandas(fit, "beta array<double>")
    known = fitted.filter("beta is not null")
    placed = (join_known_or_not(rows, broadcast_if_small(known), by).filter("beta is not null") if by
              else rows.crossJoin(F.broadcast(known)))  # one row
    predicted = F.col("beta")[0]
    for i in range(k):
        predicted = predicted + F.col("beta")[i + 1] * F.col(f"_t{i}")
    squared = placed.select(*by, *inputs, ((F.col("_y") - predicted) * (F.col("_y") - predicted)).alias("_y"))
    second = orthogonal_factors(squared, [*inputs, "_y"], by).select(*by, F.col("r").alias("errors"))
    both = join_known_or_not(factors, second, by) if by else factors.join(second, F.lit(True), "left")  # one row each

    def coefficients(frames):
        for pdf in frames:
            out = []
            for row in pdf.itertuples(index=False):
                r, free = np.asarray(row.r, float).reshape(k + 2, k + 2), row.n - k - 1
                solved = _solved(r)
                if solved is None or free <= 0:
                    continue
                beta, sse, inverse = solved
                errors = np.sqrt(np.diag(inverse) * sse / free)
                inflation = np.diag(inverse) * _centred_squares(r)[:-1]
                for i, label in enumerate(labels):
                    t = float(beta[i] / errors[i]) if errors[i] > 0 else None
                    out.append((*row[:len(by)], label, float(beta[i]), float(errors[i]), t, None if t is None else t_tail(t, free),
                                float(inflation[i]) if i else None))
            yield pd.DataFrame(out, columns=[*by, "term", "coefficient", "std_error", "statistic", "p_value", "vif"])

    def summary(frames):
        for pdf in frames:
            out = []
            for row in pdf.itertuples(index=False):
                r, free = np.asarray(row.r, float).reshape(k + 2, k + 2), row.n - k - 1
                solved, found = _solved(r), [None] * 8
                total = float(_centred_squares(r)[-1])
                if solved is not None and free > 0 and total > 0:
                    sse = solved[1]
                    r2 = 1.0 - sse / total
                    f = (total - sse) / k / (sse / free) if sse > 0 else None
                    found = [r2, 1.0 - (1.0 - r2) * (row.n - 1) / free, float(np.sqrt(sse / row.n)), f, None if f is None else f_tail(f, k, free)]
                    spread = None
                    if row.errors is not None:
                        e = np.asarray(row.errors, float).reshape(k + 2, k + 2)
                        varied = float(_centred_squares(e)[-1])
                        spread = row.n * (1.0 - float(e[-1, -1] ** 2) / varied) if varied > 0 else None
                    found += [spread, k, None if spread is None else chi_square_tail(spread, k)]
                out.append((*row[:len(by)], row.n, *found))
            yield pd.DataFrame(out, columns=[*by, "n", *SUMMARY])

    ordered = both.select(*by, "n", "r", "errors")
    return (
        ordered.mapInPandas(coefficients, kinds + "term string, coefficient double, std_error double, statistic double, p_value double, vif double"),
        ordered.mapInPandas(summary, kinds + "n bigint, " + ", ".join(f"{c} {'int' if c == 'bp_freedom' else 'double'}" for c in SUMMARY)))


SUMMARY = ("r2", "adjusted_r2", "rmse", "f_statistic", "f_p_value", "bp_statistic", "bp_freedom", "bp_p_value")
