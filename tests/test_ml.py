"""ML operators: rows-only plus signal and reproducibility checks."""
from pyspark.sql import functions as F

from attrition.operators import evaluate as V
from attrition.operators import train as M
from attrition.operators.folds import stratified_folds
from attrition.sources.mart import materialized_mart, train_test
from tests.conftest import SF_SMALL


def _planted(spark):
    tr = train_test(materialized_mart(spark, "/root/testdata/sf0.01"))[0]
    df = tr.select("row_id", "age", "calls_made", "activity_score",
                   (F.col("activity_score") > 0).cast("double").alias("label"))
    df = stratified_folds(df.withColumnRenamed("label", "churn"), 3, 1).withColumnRenamed("churn", "label")
    return M.assemble(df, ["age", "calls_made", "activity_score"])


def test_oof_has_signal_and_is_reproducible(spark):
    data = _planted(spark)
    est = M.make_member("xgb", "full", 7, None, 5)
    oof1, models = M.oof_fit(data, est, 3)
    auc = V.roc_auc(oof1, "p", "label").first().auc
    assert auc > 0.9
    oof2, _ = M.oof_fit(data, est, 3)
    a = {r.row_id: r.p for r in oof1.collect()}
    b = {r.row_id: r.p for r in oof2.collect()}
    assert a == b and len(a) == data.count()
    imp = M.importances(models, ["age", "calls_made", "activity_score"]).first()
    assert imp.feature == "activity_score"


def test_f1_prefix_early_stopping(spark):
    data = _planted(spark)
    model = M.make_member("xgb", "full", 7, None, 4).fit(data.where("fold != 0"))
    best = M.best_prefix_by_f1(model, data.where("fold = 0")).collect()
    assert len(best) == 4 and best[0].best_f1 > 0.8


def test_pipeline_writes_all_outputs(spark):
    import os
    from attrition.plans import oof
    from attrition.session import scratch_path
    out = scratch_path(spark, "pipeline-out")
    res = oof.run(spark, SF_SMALL, max_iter=2, output_dir=out)
    assert all(r.passed for r in res["check"].collect())
    local = out[len("file:"):] if out.startswith("file:") else out
    assert {"submission", "submission_proba", "per_model", "run_metrics"} <= set(os.listdir(local))
    per_model = spark.read.option("header", True).schema("id long, churn int, model string").csv(out + "/per_model")
    assert per_model.select("model").distinct().count() == 3
    assert per_model.count() == 3 * res["submission"].count()


def test_reference_flows_run_end_to_end(spark):
    from attrition.plans import oof
    for flow in ("simple", "f1", "union", "wide", "raw"):
        res = oof.run_flow(spark, SF_SMALL, flow, max_iter=3)
        assert res["folds"].count() == 5 * len(oof.FLOWS[flow]["members"]), flow
        assert set(res["kept"].values()) <= {1, 2, 3}, flow
        assert all(r.passed for r in res["check"].collect()), flow
        assert abs(sum(res["weights"]) - 1.0) < 1e-9
        assert 0.0 <= res["best_f1"] <= 1.0


def test_resample_training_balances_and_keeps_nominal(spark):
    from attrition.plans import oof
    prep = oof.prepare(spark, SF_SMALL, "simple")
    out = M.resample_training(prep.train.where("fold != 0"), prep.feature_cols, prep.cardinality, "smote", 3)
    counts = {r.label: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts[0.0] == counts[1.0]
    assert {r.weight for r in out.select("weight").distinct().collect()} == {1.0}
    attrs = out.schema["features"].metadata["ml_attr"]["attrs"]
    assert len(attrs.get("nominal", [])) == len(prep.cardinality)


def test_registered_queries_use_the_presets(spark, monkeypatch):
    import pytest
    from attrition.plans import catalog as Q
    from attrition.streaming import scoring

    class Asked(Exception):
        pass

    def stop(*a, **kw):
        raise Asked(a, kw)

    def asked(name):
        with pytest.raises(Asked) as e:
            Q.QUERIES[name](spark, SF_SMALL)
        return e.value.args

    monkeypatch.setattr(M, "oof_fit", stop)
    assert asked("m2_forest_oof")[0][1].getOrDefault("numTrees") == 700
    monkeypatch.setattr(Q.BO, "fit", stop)
    trees = {"m1_gbt_oof": [700], "m2_leafwise_oof": [700], "m3_nominal_gbt_oof": [600], "m4_early_stopping": [700, 600],
             "m5_f1_early_stopping": [700], "m6_oof_score_table": [700, 700, 600], "m7_test_fold_mean": [700], "m8_refit_full_train": [700]}
    for name, n in trees.items():
        members = asked(name)[0][1]
        assert [m.trees for m in members.values()] == n, name
        assert {k: m.patience for k, m in members.items() if k != "xgb"} == {k: 80 for k in members if k != "xgb"}
    assert asked("m5_f1_early_stopping")[0][1]["xgb"].patience == 300
    monkeypatch.setattr(Q, "parzen_search", stop)
    args, kw = asked("m10_random_search")
    assert args[2].trees == 600 and not {"trials", "patience"} & set(kw)
    monkeypatch.setattr(Q.OOF, "run", stop)
    assert "max_iter" not in asked("pipeline_oof_submission")[1]
    monkeypatch.setattr(Q.C, "iterative_impute", stop)
    assert "max_iter" not in asked("c9_iterative_impute")[1]
    monkeypatch.setattr(scoring, "fit_scorer", stop)
    assert "max_iter" not in asked("streaming_score_new_customers")[1]


def test_f1_prefix_over_several_blocks(spark, monkeypatch):
    data = _planted(spark)
    model = M.make_member("xgb", "full", 7, None, 5).fit(data.where("fold != 0"))
    val = data.where("fold = 0")
    monkeypatch.setattr(M, "PREFIX_TREES", 2)
    got = {r.n_trees: (r.best_threshold, r.best_f1) for r in M.best_prefix_by_f1(model, val).collect()}
    whole = model.transform(val).select(F.col("label").cast("int").alias("label"), M.p1().alias("p"))
    want = V.best_threshold(whole, V.grid("trial"), "p", "label", tie="lowest").first()
    assert sorted(got) == [1, 2, 3, 4, 5] and abs(got[5][1] - want.best_f1) < 1e-12


def test_queries_cover_both_tables_and_every_fold(spark, monkeypatch):
    from attrition.plans import catalog as Q
    train, test = train_test(materialized_mart(spark, SF_SMALL))
    want = {True: train.count(), False: test.count()}
    for name in ("c13_common_columns_tables", "n1_ordinal_union_tables", "n2_ordinal_self_tables",
                 "n7_one_hot_tables", "recipe_simple_tables", "recipe_f1_tables"):
        got = Q.QUERIES[name](spark, SF_SMALL)
        assert {r.is_train: r["count"] for r in got.groupBy("is_train").count().collect()} == want, name
    hot = Q.QUERIES["n7_one_hot_tables"](spark, SF_SMALL)
    assert {f"{c}_ohe" for c in Q.CATS} <= set(hot.columns)
    first = hot.first()
    assert all(sum(first[f"{c}_ohe"].toArray()) == 1 for c in Q.CATS)
    monkeypatch.setattr(Q.C, "iterative_impute", lambda tr, te, num: (tr, te, None))      # only to keep the test short
    assert Q.QUERIES["c9_iterative_impute"](spark, SF_SMALL).groupBy("is_train").count().count() == 2
    monkeypatch.setitem(M.PRESETS["full"], "xgb", (3, 0.05, 2))      # only to keep the test short
    got = Q.QUERIES["m5_f1_early_stopping"](spark, SF_SMALL).collect()
    assert sorted((r.fold, r.n_trees) for r in got) == [(f, n) for f in range(5) for n in (1, 2)]


def test_forest_keeps_nodes_of_rows_and_scores_as_without(spark):
    rows = [(i, float((i * 37 % 101) + (i % 3) * 20 > 60), i % 3, 1.0 + i % 2, float(i * 37 % 101), float(i % 3), float(i * 11 % 17)) for i in range(600)]
    df = M.assemble(spark.createDataFrame(rows, "row_id long, label double, fold int, weight double, a double, b double, c double"), ["a", "b", "c"]).cache()
    member = M.make_member("lgb", "full", 42, "weight", 20)
    assert member.getCacheNodeIds() and member.getCheckpointInterval() == -1
    with_nodes, _ = M.oof_fit(df, member, 3)
    without, _ = M.oof_fit(df, member.copy().setCacheNodeIds(False), 3)
    a, b = ({r.row_id: (r.fold, r.label, r.p) for r in t.collect()} for t in (with_nodes, without))
    assert a == b and len(a) == 600
