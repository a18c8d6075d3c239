"""Properties of fitted and distributed operators."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from attrition.operators import blend as B
from attrition.operators import encode as N
from attrition.operators import evaluate as V
from attrition.operators import folds as K
from attrition.operators import resample as RS
from attrition.operators.clean import fill_median, iterative_impute, sweep_inf
from attrition.operators.ordered import exact_quantiles, rank_within, running_sums
from attrition.operators.stats import fit_stats
from attrition.plans import recipes
from attrition.plans.scores import pseudo_scores
from attrition.sources.mart import materialized_mart, train_test
from tests.conftest import SF_SMALL


def _train(spark):
    return train_test(materialized_mart(spark, SF_SMALL))[0]


def test_folds_cover_every_row_once_and_balance(spark):
    f = K.stratified_folds(_train(spark).select("row_id", "churn"), 5, 42)
    assert f.count() == f.select("row_id").distinct().count() == _train(spark).count()
    for cls in (0, 1):
        counts = [r.n for r in f.where(F.col("churn") == cls).groupBy("fold").agg(F.count("*").alias("n")).collect()]
        assert max(counts) - min(counts) <= 1


def test_folds_with_three_positives(spark):
    df = spark.createDataFrame([(i, 1 if i < 3 else 0) for i in range(20)], "row_id long, churn int")
    f = K.stratified_folds(df, 5, 7)
    pos = [r.n for r in f.where("churn = 1").groupBy("fold").count().withColumnRenamed("count", "n").collect()]
    assert sum(pos) == 3 and max(pos) == 1


def test_oof_target_mean_ignores_own_fold(spark):
    df = K.stratified_folds(_train(spark).select("row_id", "churn", "city"), 5, 99)
    base = {r.row_id: r.city_te for r in N.target_encode_oof(df, ["city"]).collect()}
    victim = df.where("fold = 0").first().row_id
    flipped = df.withColumn("churn", F.when(F.col("row_id") == victim, 1 - F.col("churn")).otherwise(F.col("churn")))
    after = {r.row_id: (r.city_te, r.fold) for r in N.target_encode_oof(flipped, ["city"]).collect()}
    for rid, (v, fold) in after.items():
        if fold == 0:
            assert abs(v - base[rid]) < 1e-12


def test_exact_beats_grid_and_blend_identity(spark):
    sc = pseudo_scores(_train(spark))
    for m in ("gbt", "linear"):
        one = sc.where(F.col("model") == m)
        ex = V.best_f1_exact(one, "p", "label").first().best_f1
        gr = V.best_threshold(one, V.grid("full"), "p", "label").first().best_f1
        assert ex >= gr - 1e-12
    wide = B.pivot_scores(sc, ["gbt", "forest", "linear"])
    a = V.best_f1_exact(wide.withColumn("p", B.weighted(["gbt", "forest", "linear"], [1.0, 0.0, 0.0])), "p", "label")
    b = V.best_f1_exact(wide.withColumn("p", F.col("gbt")), "p", "label")
    assert a.first().best_f1 == b.first().best_f1


def test_quantiles_and_ranks_match_numpy(spark):
    tr = sweep_inf(_train(spark))
    pdf = tr.select("activity_score", "estimated_salary").toPandas()
    q = exact_quantiles(tr, ["activity_score", "estimated_salary"], [0.1, 0.5, 0.75])
    for c in ("activity_score", "estimated_salary"):
        for p in (0.1, 0.5, 0.75):
            assert abs(q[(c, p)] - pdf[c].dropna().quantile(p)) < 1e-9 * max(1, abs(q[(c, p)]))
    r = rank_within(tr.select("row_id"), ["row_id"]).orderBy("row_id").collect()
    assert [x._pos for x in r] == list(range(len(r)))


def test_imputed_table_has_no_nulls(spark):
    tr, te = train_test(materialized_mart(spark, SF_SMALL))
    a, b = recipes.light(sweep_inf(tr)), recipes.light(sweep_inf(te))
    cols = ["estimated_salary", "data_used", "calls_per_day", "sms_per_day", "data_per_day", "salary_data_ratio",
            "calls_made", "activity_score"]
    out, test_out, imp = iterative_impute(a, b, cols, max_iter=2)
    for c in cols:
        assert out.where(F.col(c).isNull()).count() == 0
        assert test_out.where(F.col(c).isNull()).count() == 0


def test_knn_exact_and_smote_inside_box(spark):
    cols = ["age", "num_dependents", "calls_made", "activity_score"]
    df = fill_median(sweep_inf(_train(spark).select("row_id", "churn", *cols)), exclude=["row_id", "churn"])
    pdf = df.toPandas()
    got = {}
    for r in RS.knn(df, "row_id", cols, k=3, tables=2, window=len(pdf), seed=3).collect():
        got.setdefault(r.id, []).append(r.dist)
    X = pdf[cols].to_numpy(float)
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    for i, rid in enumerate(pdf.row_id):
        want = sorted(np.delete(D[i], i))[:3]
        assert np.allclose(sorted(got[rid]), want)
    s = RS.smote(df, cols, label="churn", k=3, seed=1)
    counts = {r.churn: r["count"] for r in s.groupBy("churn").count().collect()}
    assert counts[0] == counts[1]
    mino = pdf[pdf.churn == 1][cols]
    syn = s.where("synthetic").toPandas()[cols]
    assert (syn.min() >= mino.min() - 1e-9).all() and (syn.max() <= mino.max() + 1e-9).all()


def test_recipe_widths_match_logged_runs(spark):
    tr = _train(spark)
    assert len(recipes.simple(tr).columns) - 2 == 27      # logged width of the 1-model run
    assert len(recipes.v2(tr).columns) - 2 == 46          # logged width of the 3-model run


def test_medians_of_the_ranked_pass_equal_spark_percentile(spark):
    tr = sweep_inf(_train(spark))
    cols = ["age", "calls_made", "activity_score", "estimated_salary"]
    got = fit_stats(tr, [("median", c) for c in cols] + [("quantile", c, 0.9) for c in cols])
    for c in cols:
        want = tr.agg(F.median(c).alias("m"), F.percentile(c, F.lit(0.9)).alias("q")).first()
        assert abs(got[("median", c)] - want.m) <= 1e-9 * max(1.0, abs(want.m))
        assert abs(got[("quantile", c, 0.9)] - want.q) <= 1e-9 * max(1.0, abs(want.q))


def _neighbours(spark, rows, k, **kw):
    n = len(rows[0])
    cols = [f"x{i}" for i in range(n)]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rows)], "id long, " + ", ".join(f"{c} double" for c in cols))
    got = {}
    for r in RS.knn(df, "id", cols, k=k, **kw).collect():
        got.setdefault(r.id, []).append((r.nb_rank, r.nb_id, r.dist))
    X = np.array(rows, float)
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    np.fill_diagonal(D, np.inf)
    return {i: [d for _, _, d in sorted(v)] for i, v in got.items()}, D


def test_knn_recall_outliers_and_equal_rows(spark):
    rng = np.random.default_rng(4)
    for width, least in ((8, 0.9), (46, 0.4)):
        X = rng.standard_normal((4000, width))
        X[:20] *= 1000                           # outliers
        X[1000:2000] = X[999]                    # a quarter of the rows are equal
        got, D = _neighbours(spark, X.tolist(), 5)
        assert len(got) == len(X) and all(len(v) == 5 for v in got.values())
        radius = np.sort(D, axis=1)[:, 4]
        hits = np.mean([np.mean(np.array(v) <= radius[i] + 1e-9) for i, v in got.items()])
        assert hits >= least, (width, hits)


def test_knn_many_identical_points(spark):
    # a third of the rows share one point: its neighbours are its copies, at distance 0
    rows = [(1.0, 2.0)] * 60 + [(float(i), float(i % 7)) for i in range(120)]
    got, D = _neighbours(spark, rows, 3)
    for i in range(len(rows)):
        assert np.allclose(got[i], np.sort(D[i])[:3])


def test_running_sums_with_null_groups_and_values(spark):
    rows = [(None if i % 3 == 0 else i % 3, i, None if i % 5 == 0 else i) for i in range(200)]
    df = spark.createDataFrame(rows, "g int, o int, v int")
    got = {r.o: r.cum_v for r in running_sums(df, ["o"], ["v"], ["g"], num_partitions=7).collect()}
    held = {}
    for g, o, v in rows:
        held[g] = held.get(g, 0) + (v or 0)
        assert got[o] == held[g]
    assert running_sums(df.limit(0), ["o"], ["v"], ["g"]).count() == 0


def test_ordinal_codes_follow_the_sorted_values(spark):
    tr = _train(spark).select("row_id", "city", "state")
    codes = {(r.column_name, r.value): r.code for r in N.fit_ordinal(tr, ["city", "state"]).collect()}
    for c in ("city", "state"):
        values = sorted(v for k, v in codes if k == c)
        assert [codes[c, v] for v in values] == list(range(len(values)))


def test_search_maps_fit_every_tree_member(spark):
    from attrition.operators import train as M
    for kind in ("xgb", "lgb", "cat"):
        maps = M.random_param_maps(M.make_member(kind), 3)
        assert len(maps) == 3 and all(len(m) >= 3 for m in maps)


def test_knn_is_exact_at_several_sizes_and_widths(spark):
    rng = np.random.default_rng(5)
    for n, width in ((3000, 8), (3000, 46), (9000, 46)):
        X = rng.standard_normal((n, width))
        X[:20] *= 1000                           # outliers
        X[1000:1400] = X[999]                    # equal rows
        cols = [f"x{i}" for i in range(width)]
        df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(X)], "id long, " + ", ".join(f"{c} double" for c in cols))
        got = RS.knn(df, "id", cols, k=5).toPandas().sort_values(["id", "nb_rank"])
        assert len(got) == 5 * n and not got.duplicated(["id", "nb_id"]).any() and (got["id"] != got["nb_id"]).all()
        dist = got["dist"].to_numpy().reshape(n, 5)
        for i in range(0, n, 37):
            want = np.sqrt(((X - X[i]) ** 2).sum(-1))
            want[i] = np.inf
            assert np.allclose(dist[i], np.sort(want)[:5]), (n, width, i)


@pytest.mark.parametrize("size", [4096, 64])
def test_quantiles_by_sketch_and_refine_equal_pandas(spark, monkeypatch, size):
    """64: sketches so small that several passes are needed, with hot values and ties."""
    from attrition.operators import ordered
    monkeypatch.setattr(ordered, "SKETCH_K", size)
    monkeypatch.setattr(ordered, "GRID", size)
    rng = np.random.default_rng(1)
    n = 20_000
    pdf = pd.DataFrame({"a": rng.normal(size=n), "b": np.where(rng.random(n) < .4, 1., rng.integers(0, 5, n)),
                        "c": np.r_[np.full(n // 2, 7.0), rng.exponential(size=n - n // 2)], "d": np.full(n, 3.0)})
    df = spark.createDataFrame(pdf).withColumns({"a": F.when(F.col("a") < 1.5, F.col("a")), "e": F.lit(None).cast("double"),
                                                 "f": F.when(F.col("b") == 4, float("nan")).otherwise(F.col("b"))}).repartition(5)
    pdf.loc[pdf.a >= 1.5, "a"] = np.nan
    probs = [0, .01, .5, .9, .999, 1]
    got = ordered.exact_quantiles(df, list("abcdef"), probs)
    for c in "abcd":
        for q in probs:
            assert got[(c, q)] == pytest.approx(pdf[c].quantile(q), rel=1e-12, abs=1e-12)
    assert all(got[("e", q)] is None for q in probs)
    assert np.isnan(got[("f", 1)]) and got[("f", 0)] == 0       # NaN ranks last


def test_quantiles_recover_from_a_sketch_that_is_off(spark, monkeypatch):
    """Brackets that miss the rank are moved by the counts."""
    from attrition.operators import ordered
    monkeypatch.setattr(ordered, "GRID", 16)
    real = ordered._around
    monkeypatch.setattr(ordered, "_around", lambda s, n, rank, error: real(s, n, F.least(rank + n / 4, n - 1), 0.0))
    df = spark.range(1000).select((F.col("id") * 7 % 1000).cast("double").alias("x"))
    monkeypatch.setattr(ordered, "_select_ranks", lambda d, w, e, run=ordered._select_ranks: (monkeypatch.setattr(ordered, "_around", real), run(d, w, e))[1])
    assert ordered.exact_quantiles(df, ["x"], [.1, .5, .95]) == {("x", q): pytest.approx(999 * q) for q in (.1, .5, .95)}


def test_column_facts_of_empty_and_odd_tables(spark):
    from attrition.operators.profile import column_list
    rows = [(1, None, "x"), (2, None, "x"), (None, None, "")]
    df = spark.createDataFrame(rows, "n int, `a.b` double, v string")
    assert [tuple(r) for r in column_list(df).orderBy("ordinal").collect()] == [
        (1, "n", "int", 2, 2), (2, "a.b", "double", 0, 0), (3, "v", "string", 3, 2)]
    assert [r.n_present for r in column_list(df.limit(0)).collect()] == [0, 0, 0]


def test_knn_boxes_leave_most_blocks_out(spark, monkeypatch):
    """Open blocks a row grow far slower than blocks; copies and columns of other scales included."""
    monkeypatch.setattr(RS, "REFINED", 64)
    rng = np.random.default_rng(6)
    X = np.column_stack([rng.uniform(0, 1e5, 6000), rng.integers(0, 5, 6000), rng.normal(0, 2e4, 6000), rng.uniform(0, 300, 6000)])
    X[:300] = X[0]
    X[300:310] *= 1000
    seen = {}

    def spy(points, near, k, own=RS._refine):
        seen["points"] = points.toPandas()
        return own(points, near, k)

    monkeypatch.setattr(RS, "_refine", spy)
    got, D = _neighbours(spark, X.tolist(), 3)
    radius = np.sort(D, axis=1)[:, 2]
    assert all(np.allclose(got[i], np.sort(D[i])[:3]) for i in range(0, len(X), 7))
    p = seen["points"].sort_values("id")
    assert p["id"].tolist() == list(range(len(X))) and p.groupby("a").size().max() <= 64
    boxes = [(X[i].min(axis=0), X[i].max(axis=0)) for i in (g["id"].to_numpy() for _, g in p.groupby("a"))]
    low, high = np.array([b[0] for b in boxes]), np.array([b[1] for b in boxes])
    gap = np.maximum(np.maximum(low - X[:, None], X[:, None] - high), 0)
    assert (np.sqrt((gap ** 2).sum(-1)) < radius[:, None]).sum(axis=1).mean() < 6


def test_running_sums_deal_rows_evenly(spark, monkeypatch):
    """A few long ranges would fall on some of the tasks only, with a large share of the rows in one."""
    import pandas as pd
    from attrition.operators import ordered
    monkeypatch.setattr(ordered, "RUN_BITS", 8)
    n = 100_000
    df = spark.range(n).select(F.col("id").alias("o"), (F.col("id") % 10 < 3).cast("int").alias("g"), (F.col("id") % 7).cast("double").alias("v"))
    merges = "spark.sql.adaptive.coalescePartitions.enabled"       # of partitions of a few bytes
    spark.conf.set(merges, "false")
    try:
        got = ordered.running_sums(df, ["o"], ["v"], ["g"]).withColumn("task", F.spark_partition_id()).toPandas()
    finally:
        spark.conf.unset(merges)
    share = got.groupby("task").size().max() / n
    assert len(got) == n and share < 0.2, share
    want = pd.DataFrame({"o": range(n)}).assign(g=lambda d: (d.o % 10 < 3).astype(int), v=lambda d: d.o % 7)
    want["cum"] = want.groupby("g").v.cumsum()
    assert (got.set_index("o").cum_v.sort_index() == want.cum).all()
