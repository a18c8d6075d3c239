"""Iterative imputation (C9): chained Bayesian ridge regressions from Gram matrices.

A round needs one pass over the rows.  Each task fills the missing cells, replays the
rounds fitted so far on its rows, and sums the products of all columns: once over all
rows, and once over the rows that miss column c, for each c.  Their difference is the
Gram matrix of the rows that hold c, so one aggregate of (columns with gaps + 1) x p x p
numbers serves every regression of the round, whatever the number of rows; rows are
neither written nor shuffled.  The regressions themselves (evidence maximisation on a
p x p matrix) run on the driver.
"""

from __future__ import annotations

from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.functions.nullsafe import nan_to_null
from attrition.operators.stats import fit_stats
from attrition.session import ship_package

PRIOR = 1e-6            # shape and rate of the gamma priors over both precisions
EVIDENCE_STEPS = 300
EVIDENCE_TOL = 1e-3


def bayesian_ridge(gram: np.ndarray, target: int, steps: int = EVIDENCE_STEPS, tol: float = EVIDENCE_TOL) -> np.ndarray:
    """Coefficients ``w`` (intercept first, 0 at ``target``) of the regression of column
    ``target`` on all others.

    ``gram`` holds the products of ``[1, x]`` summed over rows.  The noise precision and the
    precision of the coefficients maximise the evidence (MacKay's fixed point); the
    intercept is not shrunk.  No rows: all zero.
    """
    p = len(gram) - 1
    n = gram[0, 0]
    w = np.zeros(p + 1)
    if n <= 0:
        return w
    mean = gram[0, 1:] / n
    centred = gram[1:, 1:] - n * np.outer(mean, mean)
    others = np.flatnonzero(np.arange(p) != target - 1)
    a, b, yy = centred[np.ix_(others, others)], centred[others, target - 1], max(centred[target - 1, target - 1], 0.0)
    values, vectors = np.linalg.eigh((a + a.T) / 2) if len(others) else (np.zeros(0), np.zeros((0, 0)))
    values = np.maximum(values, 0.0)
    values[values <= values.max(initial=0.0) * 1e-12] = 0.0       # rounding: directions without variance
    turned = np.where(values > 0, vectors.T @ b, 0.0)
    noise, shrink = 1.0 / (yy / n + np.finfo(float).eps), 1.0
    coef, last = np.zeros(len(others)), None
    for _ in range(steps):
        inner = turned / (values + shrink / noise)
        coef = vectors @ inner
        rest = max(yy - 2 * inner @ turned + (values * inner) @ inner, 0.0)
        used = float(np.sum(noise * values / (shrink + noise * values)))
        shrink = (used + 2 * PRIOR) / (float(inner @ inner) + 2 * PRIOR)
        noise = (n - used + 2 * PRIOR) / (rest + 2 * PRIOR)
        if last is not None and np.abs(coef - last).sum() < tol:
            break
        last = coef
    w[others + 1] = coef
    w[0] = mean[target - 1] - coef @ mean[others]
    return w


def replay(x: np.ndarray, missing: np.ndarray, rounds: Sequence[Sequence[tuple]]) -> tuple[np.ndarray, np.ndarray]:
    """Apply fitted rounds to ``x`` (rows of ``[1, columns]``, gaps at their start values) in
    place.  Each column uses what the columns before it got in the same round.  Returns
    ``x`` and each column's largest change in the last round."""
    change = np.zeros(x.shape[1])
    for i, steps in enumerate(rounds):
        for c, w in steps:
            at = missing[:, c - 1]
            if at.any():
                new = x[at] @ w
                if i == len(rounds) - 1:
                    change[c] = np.abs(new - x[at, c]).max()
                x[at, c] = new
    return x, change


class IterativeImputer:
    """Multivariate imputation by chained equations, fitted on one table.

    Gaps (NULL, NaN, ±inf) start at the median (or mean) of their column.  In each of up
    to ``max_iter`` rounds every column, those with fewest gaps first, is predicted from
    all others by a Bayesian ridge regression on the rows that hold it, and its gaps take
    the prediction.  The regressions of a round are fitted on the table as the round
    found it, then applied one after another, so that columns missing together do not just
    swap their values.  Stops when no gap moved by ``tol`` × the largest value held, or more.
    ``transform`` replays the fitted rounds on another table, no refit; columns without gaps
    here may have some there.  Columns are centred and scaled for the regressions.

    All columns named become double and keep the values they hold; a column of gaps only
    takes no part and stays as it is.  A table without rows gives an imputer that
    changes nothing.  Memory: a task holds one batch and (g + 1) p² numbers, g ≤ p columns
    with gaps.
    """

    def __init__(self, cols: Sequence[str], max_iter: int = 10, initial: str = "median", tol: float = 1e-3):
        self.cols, self.max_iter, self.initial, self.tol = list(dict.fromkeys(cols)), max_iter, initial, tol
        self.start: dict = {}
        self.used: list[str] = []         # columns with a value; order of the matrices
        self.centre = self.spread = np.zeros(0)
        self.sequence: list[list[tuple]] = []         # a list of (place, coefficients) for each round
        self.rounds = 0

    def _matrix(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        x = np.empty((batch.num_rows, len(self.used) + 1))
        x[:, 0] = 1.0
        for i, c in enumerate(self.used, 1):
            column = batch.column(batch.schema.names.index(c))
            x[:, i] = column.cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)
        missing = ~np.isfinite(x[:, 1:])
        first = np.array([self.start[c] for c in self.used])
        x[:, 1:] = (np.where(missing, first, x[:, 1:]) - self.centre) / self.spread
        return x, missing

    def _grams(self, df: DataFrame, gaps: list[int]) -> tuple[dict, float]:
        """Gram matrices after the rounds so far: of all rows (0) and of the rows that miss
        column i (i), and the largest change of the last round in the columns' own units."""
        width = len(self.used) + 1

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((len(gaps) + 1, width, width))
            moved = np.zeros(width)
            for batch in batches:
                x, missing = self._matrix(batch)
                x, change = replay(x, missing, self.sequence)
                moved = np.maximum(moved, change)
                sums[0] += x.T @ x
                for k, i in enumerate(gaps, 1):
                    part = x[missing[:, i - 1]]
                    sums[k] += part.T @ part
            upper = np.triu_indices(width)
            slot = np.repeat(np.arange(len(gaps) + 1), len(upper[0]))
            cell = np.tile(np.arange(len(upper[0])), len(gaps) + 1)
            most = float(np.max(moved[1:] * self.spread, initial=0.0))
            yield pa.RecordBatch.from_arrays([pa.array(np.append(slot, -1), pa.int32()), pa.array(np.append(cell, 0), pa.int32()),
                                              pa.array(np.append(sums[:, upper[0], upper[1]].ravel(), most), pa.float64())],
                                             names=["slot", "cell", "v"])

        out: dict = {k: np.zeros((width, width)) for k in [0, *gaps]}
        moved = 0.0
        rows, cols = np.triu_indices(width)
        parts = df.select(*self.used).mapInArrow(run, "slot int, cell int, v double")
        for r in parts.groupBy("slot", "cell").agg(F.sum("v").alias("s"), F.max("v").alias("m")).collect():   # (g + 1) p² numbers
            if r.slot < 0:
                moved = r.m
            else:
                i, j = rows[r.cell], cols[r.cell]
                g = out[[0, *gaps][r.slot]]
                g[i, j] = g[j, i] = r.s
        return out, moved

    def fit(self, df: DataFrame) -> "IterativeImputer":
        ship_package(df.sparkSession)
        held = df.select(*[nan_to_null(c).alias(c) for c in self.cols])
        kind = "median" if self.initial == "median" else "mean"
        st = fit_stats(held, [(k, c) for c in self.cols for k in (kind, "nulls", "max", "min", "mean", "std_pop")])
        self.start = {c: None if st[(kind, c)] is None else float(st[(kind, c)]) for c in self.cols}
        self.used = [c for c in self.cols if self.start[c] is not None]
        self.centre = np.array([float(st[("mean", c)]) for c in self.used])
        self.spread = np.array([float(st[("std_pop", c)] or 0.0) or 1.0 for c in self.used])
        self.sequence, self.rounds = [], 0
        places = range(1, len(self.used) + 1)
        gap_counts = [0, *[st[("nulls", c)] for c in self.used]]
        gaps = [i for i in places if gap_counts[i]]
        order = sorted(places, key=lambda i: (gap_counts[i], i))
        scale = max([abs(float(st[(k, c)])) for c in self.used for k in ("max", "min")], default=0.0)
        for _ in range(self.max_iter if gaps else min(self.max_iter, len(places), 1)):
            grams, moved = self._grams(df, gaps)
            if self.sequence and moved < self.tol * scale:
                break
            self.sequence.append([(i, bayesian_ridge(grams[0] - grams[i] if i in gaps else grams[0], i)) for i in order])
            self.rounds += 1
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with its gaps filled, in one pass without a shuffle; other columns as they are."""
        if not self.used:
            return df
        ship_package(df.sparkSession)
        schema = T.StructType([T.StructField(f.name, T.DoubleType() if f.name in self.used else f.dataType, True, f.metadata)
                               for f in df.schema.fields])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, missing = self._matrix(batch)
                x, _ = replay(x, missing, self.sequence)
                arrays = list(batch.columns)
                for i, c in enumerate(self.used, 1):
                    at = batch.schema.names.index(c)
                    held = batch.column(at).cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)
                    arrays[at] = pa.array(np.where(missing[:, i - 1], x[:, i] * self.spread[i - 1] + self.centre[i - 1], held))
                yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

        return df.mapInArrow(run, schema)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)


def iterative_impute(train: DataFrame, test: DataFrame | None, cols: Sequence[str], **kw):
    """C9 on a train/test pair: fit on train only, replay on test."""
    imp = IterativeImputer(cols, **kw)
    tr = imp.fit_transform(train)
    return tr, imp.transform(test) if test is not None else None, imp
