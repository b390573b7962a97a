"""ARIMA models of each key's history, fitted by conditional least squares over chunks."""

from __future__ import annotations

from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroweave.operators.timeseries import KEYS, kinds_of
from aeroweave.plans.chunks import CHUNK, HOUR_US, TARGET_ROWS, in_chunks, join_known_or_not
from aeroweave.plans.shared import discard, written
from aeroweave.plans.shift import Shift, shift_rows
from aeroweave.plans.small import MAX_BROADCAST_ROWS

MAX_ITERATIONS = 60
#: A step this small, relative to the coefficients, ends the search.
PRECISION = 1e-9
#: Values of a history that one chunk's arrays hold.
CHUNK_VALUES = 200_000
_GIVE_UP = 1e12


def recursive(inputs: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """z with ``z[t] + theta[0] z[t-1] + ... = inputs[t]`` along the last axis, from zeros.

    The recursion splits into one of first order per root; each of them is summed by doubling, in about log2 of the length
    vector operations, and ends early where powers of the root vanish.
    """
    z = inputs
    for root in np.roots([1.0, *theta]) if len(theta) else ():
        factor, width = root, 1
        z = z.astype(np.result_type(z, root))
        while width < z.shape[-1] and 1e-18 < abs(factor) < 1e18:
            late = z[..., width:] + factor * z[..., :-width]
            z = np.concatenate([z[..., :width], late], axis=-1)
            factor, width = factor * factor, 2 * width
    return z.real


def _started(inputs: np.ndarray, theta: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The same from ``start``, the values before the first one, latest first."""
    q, inputs = len(theta), np.array(inputs, float)
    for t in range(min(q, inputs.shape[-1])):
        for j in range(t, q):
            inputs[..., t] -= theta[j] * start[..., j - t]
    return recursive(inputs, theta)


def _latest(z: np.ndarray, before: np.ndarray, q: int) -> np.ndarray:
    """The last q values, latest first, looking back into ``before`` where z is shorter."""
    return np.concatenate([z[..., ::-1][..., :q], before], axis=-1)[..., :q]


def run_chunk(beta: np.ndarray, p: int, q: int, w: np.ndarray, past: np.ndarray, start: np.ndarray):
    """Errors and their derivatives by each coefficient over a chunk, and the state it ends in.

    ``w`` are the values, ``past`` the p values before each (p x n), ``start`` the last q errors (row 0) and derivatives.
    """
    theta = beta[1 + p:]
    errors = _started(w - beta[0] - beta[1:1 + p] @ past, theta, start[0])
    n = len(w)
    inputs = np.empty((1 + p + q, n))
    inputs[0], inputs[1:1 + p] = -1.0, -past
    for j in range(q):
        earlier = np.concatenate([start[0][:j + 1][::-1], errors])[:n]
        inputs[1 + p + j] = -earlier
    slopes = _started(inputs, theta, start[1:])
    ends = np.vstack([_latest(errors, start[0], q)[None], _latest(slopes, start[1:], q)]) if q else np.zeros((2 + p, 0))
    return errors, slopes, ends


def _carry(beta: np.ndarray, p: int, q: int, n: int) -> np.ndarray:
    """What n steps without any input make of a state: a matrix on the flattened state."""
    m = 1 + p + q
    size = (1 + m) * q
    if not size:
        return np.zeros((0, 0))
    theta = beta[1 + p:]
    step = np.zeros((size, size))
    for row in range(1 + m):
        at = row * q
        step[at, at:at + q] = -theta
        for j in range(1, q):
            step[at + j, at + j - 1] = 1.0
    for j in range(q):
        step[(2 + p + j) * q, j] -= 1.0  # the derivative by theta[j] takes in the error j + 1 steps back
    return np.linalg.matrix_power(step, n)


def _arrays(row, p: int):
    """Values of a chunk, and the p values before each as p rows."""
    w = np.asarray(row.w, float)
    return w, np.asarray(row.past, float).reshape(len(w), p).T


def _names(p: int, q: int) -> list[str]:
    return ["const", *[f"ar{i + 1}" for i in range(p)], *[f"ma{i + 1}" for i in range(q)]]


def _upper(m: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(m) for j in range(i, m)]


class Fit:
    """Differenced histories in chunks, and the passes a search makes over them."""

    def __init__(self, df: DataFrame, column: str, order, keys, ts: str, target_rows: int):
        self.p, self.d, self.q = order
        if not keys:
            raise ValueError("histories need a key; a constant column makes them one")
        self.keys, self.ts, self.kinds = list(keys), ts, kinds_of(df, keys)
        value = F.col(column).cast("double")
        known = df.select(*keys, ts, value.alias("x0")).filter((F.abs("x0") < float("inf")) & F.col(ts).isNotNull())
        # the differences of every order, and the p values before the last of them
        reach = self.p + self.d
        rows = shift_rows(known, [Shift("x0", k, f"x{k}") for k in range(1, reach + 1)], self.keys, (ts,), target_rows)

        def difference(order: int, back: int):
            terms = [F.col(f"x{back + i}") * float((-1) ** i * comb(order, i)) for i in range(order + 1)]
            return sum(terms[1:], terms[0])

        self.rows = rows.select(
            *keys, ts, difference(self.d, 0).alias("w"), F.array(*[difference(self.d, i) for i in range(1, self.p + 1)]).cast(
                "array<double>").alias("past"), F.array(*[difference(i, 0) for i in range(self.d)]).cast("array<double>").alias("levels"),
            F.col(f"x{reach}").isNotNull().alias("_full"))
        usable = written(self.rows.filter("_full").select(*keys, ts, "w", "past", "levels"), "arima")
        chunked = in_chunks(usable, self.keys, (ts,), min(target_rows, CHUNK_VALUES))
        self.single = chunked.single
        # a chunk's rows are bounded by the target
        self.chunks = written(chunked.df.groupBy(*keys, CHUNK).agg(
            F.sort_array(F.collect_list(F.struct(ts, "w", "past"))).alias("_r"),
            F.max_by(F.struct(F.col(ts).alias("ts"), "levels"), F.col(ts)).alias("last")).select(
                *keys, CHUNK, F.col("_r.w").alias("w"), F.flatten("_r.past").alias("past"), "last"), "arima-chunks")
        discard(usable)
        self.few_keys = self.chunks.count() <= MAX_BROADCAST_ROWS  # chunks are no fewer than keys

    @property
    def m(self) -> int:
        return 1 + self.p + self.q

    def _with(self, state: DataFrame) -> DataFrame:
        few = F.broadcast(state) if self.few_keys else state
        return join_known_or_not(self.chunks, few, self.keys).filter("trial is not null")

    def starts(self, state: DataFrame) -> DataFrame:
        """keys, chunk, start: the state each chunk begins in, by composing what the chunks before make of a state."""
        p, q, m, keys, size = self.p, self.q, self.m, self.keys, (1 + self.m) * self.q

        def from_zero(frames):
            for pdf in frames:
                ends = []
                for row in pdf.itertuples(index=False):
                    beta = np.asarray(row.trial, float)
                    with np.errstate(all="ignore"):
                        ends.append(run_chunk(beta, p, q, *_arrays(row, p), np.zeros((1 + m, q)))[2].ravel().tolist())
                yield pd.DataFrame({**{c: pdf[c] for c in (*keys, CHUNK, "trial")}, "size": pdf["w"].map(len), "ending": ends})

        def compose(key, pdf):
            pdf = pdf.sort_values(CHUNK)
            beta, now, found = np.asarray(pdf["trial"].iloc[0], float), np.zeros(size), []
            for n, ending in zip(pdf["size"], pdf["ending"]):
                found.append(now.tolist())
                with np.errstate(all="ignore"):
                    now = _carry(beta, p, q, int(n)) @ now + np.asarray(ending, float)
            return pd.DataFrame({**{c: [key[i]] * len(pdf) for i, c in enumerate(keys)}, CHUNK: pdf[CHUNK], "start": found})

        ends = self._with(state).select(*self.keys, CHUNK, "w", "past", "trial").mapInPandas(
            from_zero, f"{self.kinds}{CHUNK} bigint, trial array<double>, size bigint, ending array<double>")
        return ends.groupBy(*self.keys).applyInPandas(compose, f"{self.kinds}{CHUNK} bigint, start array<double>")

    def _placed(self, state: DataFrame) -> DataFrame:
        """Chunks with their key's trial and the state they begin in."""
        joined = self._with(state)
        if self.single or not self.q:
            return joined.withColumn("start", F.array_repeat(F.lit(0.0), (1 + self.m) * self.q))
        return join_known_or_not(joined, self.starts(state), [*self.keys, CHUNK])

    def sums(self, state: DataFrame) -> DataFrame:
        """Squared errors and the normal equations of a Gauss-Newton step at each key's trial."""
        p, q, m, keys = self.p, self.q, self.m, self.keys
        names = ["n", "sse", *[f"g{i}" for i in range(m)], *[f"h{i}_{j}" for i, j in _upper(m)]]

        def add(frames):
            for pdf in frames:
                out = []
                for row in pdf.itertuples(index=False):
                    with np.errstate(all="ignore"):
                        errors, slopes, _ = run_chunk(
                            np.asarray(row.trial, float), p, q, *_arrays(row, p), np.asarray(row.start, float).reshape(1 + m, q))
                        hessian = slopes @ slopes.T
                        out.append([float(len(errors)), float(errors @ errors), *(slopes @ errors).tolist(),
                                    *[float(hessian[i, j]) for i, j in _upper(m)]])
                frame = pd.DataFrame(out, columns=names)
                yield pd.concat([pdf[keys].reset_index(drop=True), frame], axis=1)

        schema = self.kinds + ", ".join(f"{c} double" for c in names)
        parts = self._placed(state).select(*self.keys, "w", "past", "trial", "start").mapInPandas(add, schema)
        return parts.groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in names])

    def search(self) -> DataFrame:
        """keys, beta, sse, n, iterations, converged: a damped Gauss-Newton search for all keys side by side."""
        m = self.m
        zeros = F.array_repeat(F.lit(0.0), m)
        none = F.lit(None).cast("double")
        state = written(self.chunks.select(*self.keys).distinct().select(
            *self.keys, zeros.alias("trial"), F.lit(None).cast("array<double>").alias("beta"), none.alias("sse"),
            F.lit(1e-3).alias("damping"), F.lit(None).cast("array<double>").alias("g"), F.lit(None).cast("array<double>").alias("h"),
            F.lit(0.0).alias("n"), F.lit(0).alias("iterations"), F.lit(False).alias("done")), "arima-state")
        schema = state.schema
        upper = _upper(m)

        def update(frames):
            for pdf in frames:
                rows = []
                for row in pdf.itertuples(index=False):
                    s = {c: getattr(row, c) for c in schema.names}
                    if not s["done"]:
                        sse = row.new_sse
                        first = s["beta"] is None
                        if np.isfinite(sse) and (first or sse <= s["sse"]):
                            better = first or sse < s["sse"]
                            s.update(beta=list(s["trial"]), sse=sse, n=row.new_n, damping=max(s["damping"] / 10, 1e-12),
                                     g=[getattr(row, f"g{i}") for i in range(m)], h=[getattr(row, f"h{i}_{j}") for i, j in upper])
                        else:
                            better, s["damping"] = True, s["damping"] * 10
                        hessian = np.zeros((m, m))
                        for (i, j), v in zip(upper, s["h"]):
                            hessian[i, j] = hessian[j, i] = v
                        # what hardly varies is left where it is
                        scale = np.maximum(np.diag(hessian), 1e-12 * max(np.diag(hessian).max(), 1e-300))
                        step = -np.linalg.lstsq(hessian + s["damping"] * np.diag(scale), np.asarray(s["g"], float), rcond=None)[0]
                        beta = np.asarray(s["beta"], float)
                        s["trial"] = (beta + step).tolist()
                        s["iterations"] += 1
                        small = np.abs(step).max() <= PRECISION * (1.0 + np.abs(beta).max())
                        s["done"] = bool(small or not better or s["damping"] > _GIVE_UP or s["sse"] == 0.0)
                    rows.append(s)
                yield pd.DataFrame(rows, columns=schema.names)

        for _ in range(MAX_ITERATIONS):
            renamed = self.sums(state.filter("not done")).withColumnsRenamed({"n": "new_n", "sse": "new_sse"})
            after = written(join_known_or_not(state, renamed, self.keys).mapInPandas(update, schema), "arima-state")
            discard(state)
            state = after
            if state.filter("not done").isEmpty():
                break
        return state.select(*self.keys, "beta", "sse", F.col("n").cast("bigint").alias("n"), "iterations", F.col("done").alias("converged"))

    def endings(self, fitted: DataFrame) -> DataFrame:
        """keys, last, recent (last p values of the differenced history), errors (last q): where each history stops."""
        p, q, m, keys = self.p, self.q, self.m, self.keys

        def end(frames):
            for pdf in frames:
                recent, errors = [], []
                for row in pdf.itertuples(index=False):
                    w, past = _arrays(row, p)
                    ends = run_chunk(np.asarray(row.trial, float), p, q, w, past, np.asarray(row.start, float).reshape(1 + m, q))[2]
                    recent.append(np.concatenate([w[-1:], past[:, -1]])[:p].tolist())
                    errors.append(ends[0].tolist())
                yield pd.DataFrame({**{c: pdf[c] for c in (*keys, CHUNK)}, "recent": recent, "errors": errors})

        placed = self._placed(fitted.withColumnRenamed("beta", "trial"))
        newest = placed.groupBy(*self.keys).agg(F.max(CHUNK).alias("_newest"))
        kept = join_known_or_not(placed, newest, self.keys).filter(F.col(CHUNK) == F.col("_newest"))
        found = kept.select(*self.keys, CHUNK, "w", "past", "trial", "start").mapInPandas(
            end, f"{self.kinds}{CHUNK} bigint, recent array<double>, errors array<double>")
        last = self.chunks.groupBy(*self.keys).agg(F.max_by("last", CHUNK).alias("last"))
        return join_known_or_not(found.drop(CHUNK), last, self.keys)


def _check(order) -> None:
    if len(order) != 3 or min(order) < 0 or order[0] + order[2] == 0:
        raise ValueError("an order is (p, d, q), none below 0 and p or q above it")


def arima(df: DataFrame, column: str, order=(1, 1, 1), keys=KEYS, ts: str = "datetime", target_rows: int = TARGET_ROWS) -> DataFrame:
    """term, coefficient, sigma2, n, iterations, converged per key: ``const``, ``ar1`` ..., ``ma1`` ... of the differenced history.

    The model is ``w[t] = const + ar w[t-i] + e[t] + ma e[t-j]``, where w is the history differenced d times; rows are steps, and rows
    without value or time are left out. Coefficients minimise the sum of squared errors given the first p values and no
    earlier errors. ``sigma2`` is that sum over n, the number of errors. Histories of at most p + d values are absent; coefficients that
    the values do not determine stay where the damped search left them.

    A pass over a chunk works on whole arrays. Errors at a chunk's end are an affine function of those at its beginning, so chunks run
    from zeros first, their functions are composed in order (a row per chunk), and each runs again from its true beginning.
    """
    _check(order)
    p, _, q = order
    fitted = Fit(df, column, order, keys, ts, target_rows).search()
    terms = F.array(*[F.struct(F.lit(t).alias("term"), F.col("beta")[i].alias("coefficient")) for i, t in enumerate(_names(p, q))])
    return fitted.select(*keys, F.explode(terms).alias("_t"), (F.col("sse") / F.col("n")).alias("sigma2"), "n", "iterations", "converged").select(
        *keys, "_t.term", "_t.coefficient", "sigma2", "n", "iterations", "converged")


def forecast(
    df: DataFrame, column: str, order=(1, 1, 1), steps: int = 24, step_us: int = HOUR_US, keys=KEYS, ts: str = "datetime",
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """step (1 ...), ts and forecast per key: the expected values after each history by its fitted :func:`arima` model."""
    _check(order)
    p, d, q = order
    fit = Fit(df, column, order, keys, ts, target_rows)
    fitted = written(fit.search().select(*keys, "beta"), "arima-fit")
    keys = list(keys)

    def ahead(frames):
        for pdf in frames:
            out = []
            for row in pdf.itertuples(index=False):
                beta = np.asarray(row.beta, float)
                recent, errors = list(row.recent), list(row.errors)
                levels = list(row.levels)
                for step in range(1, steps + 1):
                    value = float(beta[0] + beta[1:1 + p] @ np.asarray(recent[:p], float) + beta[1 + p:] @ np.asarray(errors[:q], float))
                    recent, errors = [value, *recent][:p], [0.0, *errors][:q]
                    for i in reversed(range(d)):  # back from differences to levels
                        levels[i] += value
                        value = levels[i]
                    out.append((*row[:len(keys)], step, row.us + step * step_us, value))
            yield pd.DataFrame(out, columns=[*keys, "step", "us", "forecast"])

    joined = join_known_or_not(fit.endings(fitted), fitted, keys)
    ready = joined.select(*keys, "beta", "recent", "errors", F.col("last.levels").alias("levels"),
                          F.unix_micros(F.col("last.ts").cast("timestamp")).alias("us"))
    found = ready.mapInPandas(ahead, f"{fit.kinds}step int, us bigint, forecast double")
    return found.select(*keys, "step", F.timestamp_micros("us").cast("timestamp_ntz").alias(ts), "forecast")
