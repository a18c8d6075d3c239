"""Rounds from Gram matrices against a row-wise numpy replay."""

import numpy as np
from pyspark.sql import functions as F

from attrition.operators.impute import IterativeImputer, bayesian_ridge, iterative_impute


def _ridge(x, y):
    """Evidence maximisation on the rows themselves."""
    mean, middle = x.mean(0), y.mean()
    x, y = x - mean, y - middle
    noise, shrink, last = 1.0 / (y.var() + np.finfo(float).eps), 1.0, None
    for _ in range(300):
        w = np.linalg.solve(x.T @ x + shrink / noise * np.eye(x.shape[1]), x.T @ y)
        spread = np.linalg.inv(noise * x.T @ x + shrink * np.eye(x.shape[1]))
        used = x.shape[1] - shrink * np.trace(spread)
        shrink = (used + 2e-6) / (w @ w + 2e-6)
        noise = (len(y) - used + 2e-6) / (((y - x @ w) ** 2).sum() + 2e-6)
        if last is not None and np.abs(w - last).sum() < 1e-3:
            break
        last = w
    return w, middle - w @ mean


def _planted(n=1000, seed=3):
    r = np.random.default_rng(seed)
    a, b = r.normal(50, 10, n), r.normal(0, 1, n)
    full = np.c_[a, b, 2 * a - 5 * b + r.normal(0, .5, n), 1000 + 30 * b + r.normal(0, 3, n)]
    x = full.copy()
    x[r.random(n) < .1, 2] = np.nan
    x[r.random(n) < .2, 3] = np.nan
    x[r.random(n) < .05, 0] = np.nan
    return full, x


def _table(spark, x, parts=4):
    rows = [(i, *[None if np.isnan(v) else float(v) for v in row], f"t{i}") for i, row in enumerate(x)]
    return spark.createDataFrame(rows, "row_id long, a double, b double, c double, d double, note string").repartition(parts)


def test_rounds_equal_a_replay_on_rows(spark):
    _, x = _planted()
    imp = IterativeImputer(["a", "b", "c", "d"], max_iter=4, tol=0.0)
    got = imp.fit_transform(_table(spark, x)).orderBy("row_id").toPandas()
    gaps = np.isnan(x)
    mean, std = np.nanmean(x, 0), np.nanstd(x, 0)
    z = (np.where(gaps, np.nanmedian(x, 0), x) - mean) / std
    for _ in range(4):
        was, fits = z.copy(), {}
        for c in sorted(range(4), key=lambda c: (gaps[:, c].sum(), c)):
            rest = [i for i in range(4) if i != c]
            fits[c] = _ridge(was[~gaps[:, c]][:, rest], was[~gaps[:, c], c])
        for c, (w, base) in fits.items():
            z[gaps[:, c], c] = z[gaps[:, c]][:, [i for i in range(4) if i != c]] @ w + base
    assert np.allclose(got[["a", "b", "c", "d"]].to_numpy(), np.where(gaps, z * std + mean, x), rtol=1e-7, atol=1e-7)
    assert list(got.note) == [f"t{i}" for i in range(len(x))]
    held = ~gaps
    assert (got[["a", "b", "c", "d"]].to_numpy()[held] == x[held]).all()


def test_finds_a_planted_relation_and_stops(spark):
    full, x = _planted()
    out, _, imp = iterative_impute(_table(spark, x), None, ["a", "b", "c", "d"])
    got = out.orderBy("row_id").toPandas()[["a", "b", "c", "d"]].to_numpy()
    gaps = np.isnan(x[:, 2]) & ~np.isnan(x[:, 0])
    error = np.sqrt(np.mean((got[gaps, 2] - full[gaps, 2]) ** 2))
    median = np.sqrt(np.mean((np.nanmedian(x[:, 2]) - full[gaps, 2]) ** 2))
    assert error < 0.1 * median
    assert 1 < imp.rounds <= 10
    more = IterativeImputer(["a", "b", "c", "d"]).fit(_table(spark, x, 7))
    assert more.rounds == imp.rounds
    assert all(np.allclose(u, v, atol=1e-9) for r, s in zip(imp.sequence, more.sequence) for (_, u), (_, v) in zip(r, s))


def test_columns_missing_together_do_not_swap(spark):
    r = np.random.default_rng(5)
    a = r.normal(0, 1, 400)
    x = np.c_[a, a + r.normal(0, .01, 400), a + r.normal(0, .01, 400), r.normal(0, 1, 400)]
    x[:80, 0] = x[:80, 1] = np.nan
    out, _, imp = iterative_impute(_table(spark, x), None, ["a", "b", "c", "d"], max_iter=30)
    got = out.orderBy("row_id").toPandas()
    assert imp.rounds < 30
    assert np.abs(got.a[:80] - x[:80, 2]).max() < 0.1 and np.abs(got.b[:80] - x[:80, 2]).max() < 0.1


def test_edges(spark):
    schema = "row_id long, a double, b int, c double, d double"
    nan, inf = float("nan"), float("inf")
    rows = [(1, 1.0, 1, None, 5.0), (2, 2.0, 2, None, 5.0), (3, nan, 3, None, 5.0), (4, inf, 4, None, 5.0), (5, 5.0, None, None, 5.0),
            (5, 5.0, None, None, 5.0)]
    train = spark.createDataFrame(rows, schema)
    test = spark.createDataFrame([(9, None, None, 7.0, None)], schema)
    tr, te, imp = iterative_impute(train, test, ["a", "b", "c", "d"])
    got = sorted(map(tuple, tr.collect()))
    assert len(got) == 6 and got[4] == got[5]
    assert all(np.isfinite([r[1], r[2], r[4]]).all() and r[3] is None for r in got)
    assert [r[1] for r in got if r[0] in (1, 2, 5)] == [1.0, 2.0, 5.0, 5.0]
    one = te.first()
    assert np.isfinite([one.a, one.b, one.d]).all() and one.c == 7.0 and abs(one.d - 5.0) < 1e-9
    empty = train.where("row_id < 0")
    tr, te, imp = iterative_impute(empty, test, ["a", "b", "c", "d"])
    assert tr.count() == 0 and te.collect() == test.collect() and imp.rounds == 0


def test_complete_table_still_serves_another(spark):
    full, x = _planted()
    imp = IterativeImputer(["a", "b", "c", "d"]).fit(_table(spark, full))
    assert imp.rounds == 1
    got = imp.transform(_table(spark, x)).orderBy("row_id").toPandas()
    gaps = np.isnan(x[:, 2]) & ~np.isnan(x[:, 0]) & ~np.isnan(x[:, 3])
    assert np.abs(got.c[gaps] - full[gaps, 2]).max() < 4


def test_ridge_without_rows_or_variance():
    assert not bayesian_ridge(np.zeros((3, 3)), 1).any()
    x = np.c_[np.ones(5), np.full(5, 2.0), np.full(5, 7.0)]
    w = bayesian_ridge(x.T @ x, 2)
    assert np.isfinite(w).all() and abs(x[0] @ w - 7.0) < 1e-9
