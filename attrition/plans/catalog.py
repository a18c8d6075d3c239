"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator id.

Every query reads the driver tables (through the customer mart or directly),
runs over whole tables, and aliases every computed column so the names match
the DuckDB oracle text in ``checks/oracle_sql.py``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.plans import recipes
from attrition.sources.mart import materialized_mart as customer_mart
from attrition.sources.mart import train_test
from attrition.sources.tables import input_version

QUERIES: dict = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_test(customer_mart(spark, sf_dir))[0]


# ------------------------------------------------------------------ the mart and the flagship
@query("mart_customer")
def q_mart(spark, sf_dir):
    from attrition.sources.mart import customer_mart as build
    return build(spark, sf_dir)


@query("flagship_churn_by_segment")
def q_flagship(spark, sf_dir):
    """Minimum slice: mart → ``simple`` recipe → churn rate and usage by segment."""
    feats = recipes.simple(_train(spark, sf_dir))
    return feats.groupBy("telecom_partner").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("churn").cast("long").alias("churned"),
        F.avg("churn").alias("churn_rate"),
        F.avg("total_usage").alias("avg_total_usage"),
        F.avg("daily_engage").alias("avg_daily_engage"),
        F.avg("is_new").alias("share_new"),
        F.avg("is_risky").alias("share_risky"),
        F.avg("log_estimated_salary").alias("avg_log_salary"),
    )


# ------------------------------------------------------------------ recipes (F ids)
def _recipe_query(name):
    def fn(spark, sf_dir):
        if name == "union":
            return recipes.union(customer_mart(spark, sf_dir))
        return recipes.RECIPES[name](_train(spark, sf_dir))
    fn.__name__ = f"q_recipe_{name}"
    return fn


for _r in ("simple", "fast", "wide", "v2", "full", "f1", "union", "light", "raw"):
    QUERIES[f"recipe_{_r}"] = _recipe_query(_r)


# ==================================================================== shared inputs
from attrition.functions.nullsafe import safe_div_fill  # noqa: E402
from attrition.operators import blend as B  # noqa: E402
from attrition.operators import clean as C  # noqa: E402
from attrition.operators import encode as N  # noqa: E402
from attrition.operators import evaluate as V  # noqa: E402
from attrition.operators import folds as K  # noqa: E402
from attrition.operators import profile as E  # noqa: E402
from attrition.plans.scores import MODELS, md5_fraction, pseudo_scores  # noqa: E402
from attrition.session import scratch_path  # noqa: E402
from attrition.sources import io as S  # noqa: E402

CATS = ["telecom_partner", "gender", "state", "city"]


def _pair(spark, sf_dir):
    return train_test(customer_mart(spark, sf_dir))


def _flagged(train, test):
    """Both tables in one, told apart by ``is_train``; a column of one only is NULL in the other."""
    return train.withColumn("is_train", F.lit(True)).unionByName(test.withColumn("is_train", F.lit(False)), allowMissingColumns=True)


def _recipe_tables(name):
    def fn(spark, sf_dir):
        train, test = _pair(spark, sf_dir)
        return _flagged(recipes.RECIPES[name](train), recipes.RECIPES[name](test))
    fn.__name__ = f"q_recipe_{name}_tables"
    return fn


# the queries above return the labelled table; these also build the unlabelled one
for _r in ("simple", "fast", "wide", "v2", "full", "f1", "light", "raw"):
    QUERIES[f"recipe_{_r}_tables"] = _recipe_tables(_r)


_SCORES: dict = {}


def _scores(spark, sf_dir):
    """Deterministic score table, checkpointed once per session and input folder."""
    from attrition.session import cut_lineage
    key = (spark.sparkContext.applicationId, sf_dir, input_version(spark, sf_dir))
    if key not in _SCORES:
        _SCORES[key] = cut_lineage(pseudo_scores(_train(spark, sf_dir)))
    return _SCORES[key]


def _wide_scores(spark, sf_dir):
    return B.pivot_scores(_scores(spark, sf_dir), MODELS)


def _test_probs(spark, sf_dir):
    """Test rows with a dense 1-based id (by row_id) and a deterministic probability."""
    test = _pair(spark, sf_dir)[1]
    ided = S.dense_ids(test.select("row_id"), ["row_id"], base=1)
    return ided.withColumn("p", md5_fraction(F.concat_ws(":", F.lit("test"), F.col("row_id").cast("string"))))


# ==================================================================== S: sources and sinks
@query("s1_csv_scan")
def q_s1(spark, sf_dir):
    train = _train(spark, sf_dir)
    path = S.write_csv(train, scratch_path(spark, "s1"))
    return S.read_csv(spark, path, S.MART_SCHEMA)


@query("s2_csv_encoding_fallback")
def q_s2(spark, sf_dir):
    """A latin-1 file (city carries U+00B7): UTF-8 read shows U+FFFD → re-read as latin-1."""
    train = _train(spark, sf_dir).withColumn("city", F.concat(F.col("city"), F.lit("·")))
    path = S.write_csv(train, scratch_path(spark, "s2"), encoding="ISO-8859-1")
    return S.load_csv(spark, path, S.MART_SCHEMA)


@query("s3_dense_ids")
def q_s3(spark, sf_dir):
    test = _pair(spark, sf_dir)[1]
    return S.dense_ids(test.select("row_id", "city"), ["row_id"], base=1)


@query("s4_write_labels")
def q_s4(spark, sf_dir):
    path = S.write_csv(S.hard_labels(_test_probs(spark, sf_dir), 0.5), scratch_path(spark, "s4"))
    return S.read_csv(spark, path, T.StructType([T.StructField("id", T.LongType()),
                                                 T.StructField("churn", T.IntegerType())]))


@query("s5_write_probabilities")
def q_s5(spark, sf_dir):
    probs = _test_probs(spark, sf_dir).select(
        F.col("p").alias("predicted_proba"), (F.col("p") >= 0.5).cast("int").alias("predicted_churn"))
    path = S.write_csv(probs, scratch_path(spark, "s5"))
    return S.read_csv(spark, path, T.StructType([T.StructField("predicted_proba", T.DoubleType()),
                                                 T.StructField("predicted_churn", T.IntegerType())]))


@query("s6_per_model_files")
def q_s6(spark, sf_dir):
    """One output per model, each at its own exact-F1 cut-off from the OOF scores."""
    cuts = V.best_f1_exact(_scores(spark, sf_dir), "p", "label", keys=["model"]).select("model", "best_threshold")
    test = _pair(spark, sf_dir)[1].select("row_id")
    models = F.explode(F.array(*[F.lit(m) for m in MODELS])).alias("model")
    long = test.select("row_id", models).withColumn(
        "p", md5_fraction(F.concat_ws(":", F.col("model"), F.col("row_id").cast("string"))))
    labelled = long.join(F.broadcast(cuts), "model").select(
        "row_id", "model", (F.col("p") >= F.col("best_threshold")).cast("int").alias("churn"))
    path = S.write_csv(labelled, scratch_path(spark, "s6"), partition_by=["model"])
    return spark.read.option("header", True).schema("row_id long, churn int, model string").csv(path)


@query("s7_run_log")
def q_s7(spark, sf_dir):
    train, test = _pair(spark, sf_dir)
    rate = train.agg(F.avg("churn")).first()[0]
    t = S.append_metrics(spark, scratch_path(spark, "s7"), "r1",
                         {"load/train_rows": train.count(), "load/test_rows": test.count(),
                          "load/churn_rate": rate})
    return t.select("run", "stage", "metric", "value")


@query("s8_output_check")
def q_s8(spark, sf_dir):
    sub = S.hard_labels(_test_probs(spark, sf_dir), 0.5)
    n = _pair(spark, sf_dir)[1].count()
    return S.output_check(sub, n)


# ==================================================================== E: profiling
@query("e1_shape")
def q_e1(spark, sf_dir):
    train, test = _pair(spark, sf_dir)
    return E.shape(train, "train").unionByName(E.shape(test, "test"))


@query("e2_class_counts")
def q_e2(spark, sf_dir):
    return E.class_counts(_train(spark, sf_dir))


@query("e3_churn_rate")
def q_e3(spark, sf_dir):
    return E.churn_rate(_train(spark, sf_dir))


@query("e4_null_counts")
def q_e4(spark, sf_dir):
    return E.null_counts(_train(spark, sf_dir))


@query("e5_label_correlation")
def q_e5(spark, sf_dir):
    return E.label_correlations(C.sweep_inf(_train(spark, sf_dir)))


@query("e6_nonfinite_audit")
def q_e6(spark, sf_dir):
    return E.nonfinite_audit(_train(spark, sf_dir))


@query("e7_column_list")
def q_e7(spark, sf_dir):
    return E.column_list(_train(spark, sf_dir))


@query("e8_preview")
def q_e8(spark, sf_dir):
    return E.preview(_train(spark, sf_dir), 5)


@query("e9_distinct_values")
def q_e9(spark, sf_dir):
    train, test = _pair(spark, sf_dir)
    return E.distinct_counts(train.select(*CATS).unionByName(test.select(*CATS)))


@query("e10_prediction_summary")
def q_e10(spark, sf_dir):
    return E.prediction_summary(S.hard_labels(_test_probs(spark, sf_dir), 0.5), _train(spark, sf_dir))


# ==================================================================== C: cleaning
@query("c1_sweep_inf")
def q_c1(spark, sf_dir):
    return C.sweep_inf(_train(spark, sf_dir))


@query("c2_negatives_to_null")
def q_c2(spark, sf_dir):
    return C.negatives_to_null(C.sweep_inf(_train(spark, sf_dir)))


@query("c3_winsorize")
def q_c3(spark, sf_dir):
    train, test = _pair(spark, sf_dir)
    return C.winsorize(C.sweep_inf(test), C.sweep_inf(train))


@query("c4_clip_lower")
def q_c4(spark, sf_dir):
    return C.clip_lower_cols(_train(spark, sf_dir), {"customer_tenure_days": 1.0, "calls_made": 0.0,
                                                      "data_used": 0.0, "estimated_salary": 0.0})


@query("c5_fill_constant")
def q_c5(spark, sf_dir):
    return C.fill_constant(C.sweep_inf(_train(spark, sf_dir)), numeric=0, text="0", exclude=["row_id", "churn"])


@query("c6_median_fill_self")
def q_c6(spark, sf_dir):
    return C.fill_median(C.sweep_inf(_train(spark, sf_dir)), exclude=["row_id", "churn"])


def _scoped(scope):
    def fn(spark, sf_dir):
        train, test = _pair(spark, sf_dir)
        tr, te = C.median_fill_scoped(C.sweep_inf(train).drop("churn"), C.sweep_inf(test), scope,
                                      exclude=["row_id", "churn", "age", "num_dependents"])
        return tr.withColumn("is_train", F.lit(True)).unionByName(te.withColumn("is_train", F.lit(False)))
    return fn


QUERIES["c7_median_fill_train"] = _scoped("train")
QUERIES["c8_median_fill_union"] = _scoped("union")


@query("c10_safe_divide")
def q_c10(spark, sf_dir):
    return C.safe_divide(_train(spark, sf_dir).select("row_id", "estimated_salary", "data_used"),
                         "salary_data_ratio", "estimated_salary", "data_used", 0.0)


@query("c11_parse_dates")
def q_c11(spark, sf_dir):
    return C.parse_dates(_train(spark, sf_dir).select("row_id", "date_of_registration"),
                         ["date_of_registration"])


@query("c12_drop_columns")
def q_c12(spark, sf_dir):
    return C.drop_columns(_train(spark, sf_dir), ["churn", "date_of_registration", "row_id", "not_there"])


@query("c13_common_columns")
def q_c13(spark, sf_dir):
    train, test = _pair(spark, sf_dir)
    tr, _ = C.common_columns(recipes.full(train).drop(*CATS, "row_id"), recipes.full(test).drop(*CATS, "row_id"),
                             cast_float=True)
    return tr


@query("c13_common_columns_tables")
def q_c13_tables(spark, sf_dir):
    train, test = _pair(spark, sf_dir)
    return _flagged(*C.common_columns(recipes.full(train).drop(*CATS, "row_id"), recipes.full(test).drop(*CATS, "row_id"),
                                      cast_float=True))


@query("c14_split_back")
def q_c14(spark, sf_dir):
    _, test = C.split_train_test(recipes.union(customer_mart(spark, sf_dir)))
    return test.drop("churn")


@query("c15_column_kinds")
def q_c15(spark, sf_dir):
    train = _train(spark, sf_dir)
    num = C.numeric_columns(train, ["row_id", "churn"])
    cat = C.categorical_columns(train)
    kind = F.when(F.col("column_name").isin(num), "numeric").otherwise("categorical")
    return E.column_list(train.select(*num, *cat)).select("column_name", kind.alias("kind"), "n_present", "n_distinct")


# ==================================================================== R: relational core
@query("r1_union_all")
def q_r1(spark, sf_dir):
    train, test = _pair(spark, sf_dir)
    return (train.drop("churn").withColumn("is_train", F.lit(True))
            .unionByName(test.withColumn("is_train", F.lit(False)), allowMissingColumns=True))


@query("r2_lookup_join")
def q_r2(spark, sf_dir):
    train, test = _pair(spark, sf_dir)
    stats = train.groupBy("city").agg(F.avg("churn").alias("city_rate"))
    g = train.agg(F.avg("churn")).first()[0]
    out = N.lookup_join(test.select("row_id", "city"), stats, ["city"])
    return out.withColumn("city_rate", F.coalesce("city_rate", F.lit(g)))


@query("r3_group_mean_count")
def q_r3(spark, sf_dir):
    return _train(spark, sf_dir).groupBy("state").agg(F.avg("churn").alias("mean_churn"),
                                                      F.count(F.lit(1)).alias("n"))


@query("r4_fold_writeback")
def q_r4(spark, sf_dir):
    sc = _scores(spark, sf_dir)
    parts = [sc.where(F.col("fold") == f).withColumn("oof", F.col("p")) for f in range(5)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("model", "row_id", "fold", "label", "oof")


@query("r5_column_bind")
def q_r5(spark, sf_dir):
    return _wide_scores(spark, sf_dir)


@query("r6_top_k")
def q_r6(spark, sf_dir):
    return (_train(spark, sf_dir).groupBy("city").agg(F.avg("churn").alias("churn_rate"),
                                                      F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("churn_rate").desc(), F.col("city")).limit(10))


@query("r7_composite_key")
def q_r7(spark, sf_dir):
    df = _train(spark, sf_dir).select("row_id", *CATS)
    for a, b in (("telecom_partner", "city"), ("state", "city"), ("telecom_partner", "state")):
        df = N.combo_key(df, a, b)
    return df.drop(*CATS)


@query("r8_filter_fold")
def q_r8(spark, sf_dir):
    return _scores(spark, sf_dir).where((F.col("fold") != 2) & (F.col("label") == 1) & (F.col("model") == "gbt"))


# ==================================================================== N: encoders
@query("n1_ordinal_union")
def q_n1(spark, sf_dir):
    train, test = _pair(spark, sf_dir)
    tr, _ = N.ordinal_encode(train.select("row_id", *CATS), test.select("row_id", *CATS), CATS, "union", "_le")
    return tr


@query("n2_ordinal_self")
def q_n2(spark, sf_dir):
    train, test = _pair(spark, sf_dir)
    _, te = N.ordinal_encode(train.select("row_id", *CATS), test.select("row_id", *CATS), CATS, "self")
    return te


def _ordinal_tables(scope, suffix=""):
    def fn(spark, sf_dir):
        train, test = _pair(spark, sf_dir)
        return _flagged(*N.ordinal_encode(train.select("row_id", *CATS), test.select("row_id", *CATS), CATS, scope, suffix))
    return fn


QUERIES["n1_ordinal_union_tables"] = _ordinal_tables("union", "_le")
QUERIES["n2_ordinal_self_tables"] = _ordinal_tables("self")


@query("n3_frequency")
def q_n3(spark, sf_dir):
    train, test = _pair(spark, sf_dir)
    return N.frequency_encode(test.select("row_id", *CATS), train, CATS)


def _te_train(spark, sf_dir, cols, prior="other_folds", unseen="prior"):
    train = _train(spark, sf_dir)
    df = train.select("row_id", "churn", *CATS)
    for a, b in (("telecom_partner", "city"), ("state", "city"), ("telecom_partner", "state")):
        df = N.combo_key(df, a, b)
    df = K.stratified_folds(df, 5, 99)
    return N.target_encode_oof(df, cols, "fold", prior=prior, unseen=unseen).drop(*CATS)


@query("n4_target_oof")
def q_n4(spark, sf_dir):
    return _te_train(spark, sf_dir, CATS).select("row_id", "fold", *[c + "_te" for c in CATS])


@query("n4_target_oof_reference")
def q_n4r(spark, sf_dir):
    """The reference's variant: prior from all train rows, unseen → 0."""
    return _te_train(spark, sf_dir, CATS, "full", "zero").select("row_id", "fold", *[c + "_te" for c in CATS])


@query("n5_target_test")
def q_n5(spark, sf_dir):
    train, test = _pair(spark, sf_dir)
    return N.target_encode_fit_apply(train, test.select("row_id", *CATS), CATS).drop(*CATS)


@query("n6_pair_target")
def q_n6(spark, sf_dir):
    pairs = ["telecom_partner_city", "state_city", "telecom_partner_state"]
    return _te_train(spark, sf_dir, pairs).select("row_id", "fold", *[c + "_te" for c in pairs])


@query("n8_ordered_targets")
def q_n8_ordered(spark, sf_dir):
    """Train rows by the labels before them, test rows by all labels of train."""
    train, test = _pair(spark, sf_dir)
    tr = N.ordered_target_encode(train.select("row_id", "churn", *CATS), CATS).drop("churn", *CATS)
    te = N.ordered_target_apply(train, test.select("row_id", *CATS), CATS).drop(*CATS)
    return _flagged(tr, te)


@query("n7_one_hot")
def q_n7(spark, sf_dir):
    return N.one_hot_wide(_train(spark, sf_dir).select("row_id", "telecom_partner", "gender"),
                          ["telecom_partner", "gender"])


@query("n7_one_hot_tables")
def q_n7_tables(spark, sf_dir):
    """All string columns of both tables as sparse vectors over the values of train ∪ test."""
    train, test = _pair(spark, sf_dir)
    both = _flagged(train.select("row_id", *CATS), test.select("row_id", *CATS))
    return N.one_hot_vector(both, CATS).transform(both).drop(*CATS, *[f"{c}_idx" for c in CATS])


@query("n9_standardize")
def q_n9(spark, sf_dir):
    train, test = _pair(spark, sf_dir)
    cols = C.numeric_columns(test, ["row_id"])
    train, test = C.sweep_inf(train), C.sweep_inf(test)
    params = N.fit_standardize(train, cols)
    return N.apply_standardize(test.select("row_id", *cols), params)


# ==================================================================== K: folds and weights
@query("k1_stratified_folds")
def q_k1(spark, sf_dir):
    return K.stratified_folds(_train(spark, sf_dir).select("row_id", "churn"), 5, 42)


@query("k1_fold_balance")
def q_k1b(spark, sf_dir):
    f = K.stratified_folds(_train(spark, sf_dir).select("row_id", "churn"), 5, 42)
    return f.groupBy("fold", "churn").agg(F.count(F.lit(1)).alias("n"))


@query("k2_positive_weight")
def q_k2(spark, sf_dir):
    train = _train(spark, sf_dir)
    neg, pos = K.class_counts(train)
    return spark.createDataFrame([(neg, pos, K.positive_weight(train))], "neg long, pos long, pos_weight double")


@query("k3_balanced_weights")
def q_k3(spark, sf_dir):
    w = K.with_class_weights(_train(spark, sf_dir).select("row_id", "churn"), scheme="balanced")
    return w.groupBy("churn").agg(F.first("weight").alias("weight"), F.count(F.lit(1)).alias("n"))


# ==================================================================== V: evaluation
@query("v1_f1_at_half")
def q_v1(spark, sf_dir):
    return V.f1_at(_scores(spark, sf_dir), 0.5, "p", "label", keys=["model"])


@query("v2_best_threshold_grid")
def q_v2(spark, sf_dir):
    return V.best_threshold(_scores(spark, sf_dir), V.grid("full"), "p", "label", keys=["model"])


@query("v2_best_threshold_argmax")
def q_v2a(spark, sf_dir):
    return V.best_threshold(_scores(spark, sf_dir), V.grid("light"), "p", "label", keys=["model"], tie="argmax")


@query("v3_best_f1_exact")
def q_v3(spark, sf_dir):
    return V.best_f1_exact(_scores(spark, sf_dir), "p", "label", keys=["model"])


@query("v4_fold_best_f1")
def q_v4(spark, sf_dir):
    return V.best_threshold(_scores(spark, sf_dir), V.grid("fold"), "p", "label",
                            keys=["model", "fold"], default=None).select("model", "fold", "best_f1")


@query("v5_fold_summary")
def q_v5(spark, sf_dir):
    per = V.best_threshold(_scores(spark, sf_dir), V.grid("fold"), "p", "label", keys=["model", "fold"])
    return V.fold_summary(per.withColumnRenamed("best_f1", "f1"), "f1", keys=["model"])


@query("v6_roc_auc")
def q_v6(spark, sf_dir):
    return V.roc_auc(_scores(spark, sf_dir), "p", "label", keys=["model"])


@query("v6_roc_auc_by_fold")
def q_v6f(spark, sf_dir):
    return V.roc_auc(_scores(spark, sf_dir), "p", "label", keys=["model", "fold"])


@query("v7_classification_report")
def q_v7(spark, sf_dir):
    return V.classification_report(_scores(spark, sf_dir), 0.45, "p", "label", keys=["model"])


@query("v8_confusion_matrix")
def q_v8(spark, sf_dir):
    return V.confusion_matrix(_scores(spark, sf_dir), 0.45, "p", "label", keys=["model"])


@query("v9_precision_recall_plus_one")
def q_v9(spark, sf_dir):
    return V.best_threshold(_scores(spark, sf_dir), V.grid("v2"), "p", "label", keys=["model"])


@query("v10_threshold_curve")
def q_v10(spark, sf_dir):
    return V.grid_curve(_scores(spark, sf_dir), V.grid("light"), "p", "label", keys=["model"])


@query("v11_trial_best_highest")
def q_v11(spark, sf_dir):
    return V.best_threshold(_scores(spark, sf_dir), V.grid("trial"), "p", "label",
                            keys=["model", "fold"], tie="highest")


# ==================================================================== B: blending
def _blend_eval(df):
    return V.best_threshold(df, V.grid("full"), "p", "label")


@query("b1_mean_blend")
def q_b1(spark, sf_dir):
    return _blend_eval(B.mean_blend(_wide_scores(spark, sf_dir), MODELS))


@query("b2_fixed_blend")
def q_b2(spark, sf_dir):
    return _blend_eval(B.fixed_blend(_wide_scores(spark, sf_dir), MODELS))


@query("b3_weight_grid_search")
def q_b3(spark, sf_dir):
    return B.grid_search(_wide_scores(spark, sf_dir), MODELS)


@query("b4_simplex_exact_search")
def q_b4(spark, sf_dir):
    return B.exact_search(_wide_scores(spark, sf_dir), MODELS)


@query("b6_model_diagnostics")
def q_b6(spark, sf_dir):
    return B.model_diagnostics(_scores(spark, sf_dir))


# ==================================================================== ML, resampling, imputation (rows-only)
from attrition.operators import resample as RS  # noqa: E402
from attrition.operators import boosting as BO  # noqa: E402
from attrition.operators import train as M  # noqa: E402
from attrition.operators.search import parzen_search  # noqa: E402
from attrition.plans import oof as OOF  # noqa: E402

_PREPARED: dict = {}
_FITS: dict = {}


def _prepared(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir, input_version(spark, sf_dir))
    if key not in _PREPARED:
        _PREPARED[key] = OOF.prepare(spark, sf_dir, "full", weights=3.0)
    return _PREPARED[key]


def _boosted(spark, sf_dir, recipe="full", kinds=("xgb",), folds=range(5)):
    """The members' models on the prepared table, fitted once a session for the same data."""
    prep = _prepared(spark, sf_dir)
    members = {kind: M.boost_member(kind, recipe) for kind in kinds}
    key = (id(prep), repr(members), tuple(folds))
    if key not in _FITS:
        _FITS[key] = BO.fit(prep.train, members, folds, len(prep.feature_cols), OOF.nominal_features(prep))
    return prep, _FITS[key]


def _boosted_oof(*kinds):
    def fn(spark, sf_dir):
        prep, fitted = _boosted(spark, sf_dir, kinds=kinds)
        return reduce(DataFrame.unionByName, [BO.oof_scores(fitted, prep.train, kind).withColumn("model", F.lit(kind)) for kind in kinds])
    return fn


def _member_oof(kind):
    def fn(spark, sf_dir):
        prep = _prepared(spark, sf_dir)
        bins = max([32, *prep.cardinality.values()])
        oof, _ = M.oof_fit(prep.train, M.make_member(kind, "full", 42, "weight", None, bins), 5)
        return oof.withColumn("model", F.lit(kind))
    return fn


QUERIES["m1_gbt_oof"] = _boosted_oof("xgb")
QUERIES["m2_forest_oof"] = _member_oof("lgb")
QUERIES["m2_leafwise_oof"] = _boosted_oof("lgb")
QUERIES["m3_nominal_gbt_oof"] = _boosted_oof("cat")
QUERIES["m3_linear_oof"] = _member_oof("linear")
QUERIES["m6_oof_score_table"] = _boosted_oof("xgb", "lgb", "cat")


@query("m4_early_stopping")
def q_m4(spark, sf_dir):
    _, fitted = _boosted(spark, sf_dir, kinds=("lgb", "cat"))
    rows = [(member, f, M.boost_member(member, "full").trees, n) for (member, f), n in fitted.kept.items()]
    return spark.createDataFrame(rows, "model string, fold int, max_trees int, trees_kept int")


@query("m5_f1_early_stopping")
def q_m5(spark, sf_dir):
    """Every round of every fold: F1 at the best cut-off, and whether the model keeps the tree."""
    from dataclasses import replace
    prep = _prepared(spark, sf_dir)
    member = replace(M.boost_member("xgb", "full"), patience=M.EARLY_STOP_ROUNDS["f1"], metric="f1")
    fitted = BO.fit(prep.train, {"xgb": member}, range(5), len(prep.feature_cols), OOF.nominal_features(prep))
    rows = [(f, n, cut, f1, n <= fitted.kept["xgb", f]) for _, f, n, f1, cut in fitted.history]      # one row a round and fold
    return spark.createDataFrame(rows, "fold int, n_trees int, best_threshold double, best_f1 double, kept boolean")


@query("m7_test_fold_mean")
def q_m7(spark, sf_dir):
    prep, fitted = _boosted(spark, sf_dir)
    return BO.mean_scores(fitted, prep.test, "xgb")


@query("m8_refit_full_train")
def q_m8(spark, sf_dir):
    prep, fitted = _boosted(spark, sf_dir, folds=(-1,))
    return BO.mean_scores(fitted, prep.test, "xgb")


@query("m9_feature_importance")
def q_m9(spark, sf_dir):
    prep, fitted = _boosted(spark, sf_dir)
    return BO.importance_table(fitted, prep.feature_cols, spark, 20)


@query("m10_random_search")
def q_m10(spark, sf_dir):
    prep = _prepared(spark, sf_dir)
    data = K.stratified_folds(prep.train.drop("fold").withColumnRenamed("label", "churn"), 3, 42) \
        .withColumnRenamed("churn", "label")
    rows = parzen_search(data, "cat", M.boost_member("cat", "full"), len(prep.feature_cols), OOF.nominal_features(prep))
    return spark.createDataFrame([(i, r["rate"], r["depth"], r["trees"], r["l2"], r["bagging"], r["trees_kept"], r["mean_fold_f1"]) for i, r in enumerate(rows)],
                                 "trial int, step_size double, max_depth int, max_iter int, l2 double, bagging double, trees_kept double, mean_fold_f1 double")


@query("m12_hard_labels")
def q_m12(spark, sf_dir):
    prep, fitted = _boosted(spark, sf_dir)
    oof = BO.oof_scores(fitted, prep.train, "xgb")
    t = V.best_threshold(oof, V.grid("full"), "p", "label").first()["best_threshold"]
    scored = S.dense_ids(BO.mean_scores(fitted, prep.test, "xgb"), ["row_id"], base=1)
    return S.hard_labels(scored, t)


@query("n8_nominal_features")
def q_n8(spark, sf_dir):
    """Nominal metadata of every feature beside the codes that the rows hold."""
    from pyspark.ml.functions import vector_to_array
    prep = _prepared(spark, sf_dir)
    attrs = prep.train.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    rows = []
    for kind, items in attrs.items():
        for a in items:
            rows.append((int(a["idx"]), a["name"], kind, int(a.get("num_vals", 0) or 0)))
    named = spark.createDataFrame(sorted(rows), "idx int, feature string, kind string, num_vals int")
    x = F.col("x")
    seen = (prep.train.select(F.posexplode(vector_to_array("features")).alias("idx", "x")).groupBy("idx")
            .agg(F.count_if(~F.isnan(x)).alias("n_present"), F.min(F.when(~F.isnan(x), x)).alias("least"),
                 F.max(F.when(~F.isnan(x), x)).alias("most")))
    return named.join(seen, "idx", "left")


@query("n10_feature_vector")
def q_n10(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array
    prep = _prepared(spark, sf_dir)
    return prep.train.select("row_id", "label", vector_to_array("features").alias("features"))


def _numeric_train(spark, sf_dir):
    cols = ["age", "num_dependents", "calls_made", "sms_sent", "data_used", "customer_tenure_days",
            "activity_score", "estimated_salary"]
    tr = _train(spark, sf_dir).select("row_id", "churn", "city", *cols)
    return C.fill_median(C.sweep_inf(tr), exclude=["row_id", "churn"]), cols


@query("k4_smote")
def q_k4(spark, sf_dir):
    df, cols = _numeric_train(spark, sf_dir)
    return RS.smote(df, cols + ["city"], label="churn", k=5, seed=42, categorical=["city"])


@query("k5_smote_tomek")
def q_k5(spark, sf_dir):
    df, cols = _numeric_train(spark, sf_dir)
    return RS.smote_tomek(df, cols, label="churn", k=5, seed=42)


@query("c9_iterative_impute")
def q_c9(spark, sf_dir):
    train, test = _pair(spark, sf_dir)
    tr, te = recipes.light(C.sweep_inf(train)), recipes.light(C.sweep_inf(test))
    num = [c for c in C.numeric_columns(tr, ["row_id", "churn"]) if c in te.columns]
    tr = C.winsorize(tr, tr, num)
    te = C.winsorize(te, tr, num)
    tr, te, _ = C.iterative_impute(tr, te, num)
    return _flagged(tr, te)


@query("pipeline_oof_submission")
def q_pipeline(spark, sf_dir):
    return OOF.run_flow(spark, sf_dir, "full")["submission"]


@query("streaming_score_new_customers")
def q_stream(spark, sf_dir):
    from attrition.streaming.scoring import fit_scorer, score_stream
    train, test = _pair(spark, sf_dir)
    src = scratch_path(spark, "arrivals")
    test.repartition(4).write.parquet(src)           # new customers arriving as files
    scorer = fit_scorer(train, test)
    name = "scored_" + src.rsplit("-", 1)[-1]
    return score_stream(spark, src, test.schema, scorer, name)


# ==================================================================== B5 and other driver tables
@query("b5_dirichlet_exact_search")
def q_b5(spark, sf_dir):
    """> 3 members: 4000 seeded Dirichlet weight draws, exact PR-curve F1."""
    wide = _wide_scores(spark, sf_dir)
    u = md5_fraction(F.concat_ws(":", F.lit("mix"), F.col("row_id").cast("string")))
    wide = wide.withColumn("mix", F.lit(0.5) * u + F.lit(0.5) * F.col("label"))
    cols = MODELS + ["mix"]
    return B.exact_search(wide, cols, "label", B.dirichlet_candidates(4))


def _docs(spark, sf_dir):
    from attrition.sources.tables import read_table
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "lang", "source"])
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
    return docs, labels


@query("n5_target_documents")
def q_n5_docs(spark, sf_dir):
    """Target means of document source/lang against labels.quality, fitted on the
    labelled documents, applied to the unlabelled ones (unseen → prior)."""
    docs, labels = _docs(spark, sf_dir)
    labelled = docs.join(labels.select("doc_id", "quality"), "doc_id")
    unlabelled = docs.join(labels.select("doc_id"), "doc_id", "left_anti")
    return N.target_encode_fit_apply(labelled, unlabelled, ["source", "lang"], label="quality").drop("source", "lang")


@query("e2_class_counts_labels")
def q_e2_labels(spark, sf_dir):
    return E.class_counts(_docs(spark, sf_dir)[1], "toxic")


@query("e4_null_counts_events")
def q_e4_events(spark, sf_dir):
    from attrition.sources.tables import read_table
    return E.null_counts(read_table(spark, sf_dir, "events"))


@query("k1_stratified_folds_labels")
def q_k1_labels(spark, sf_dir):
    labels = _docs(spark, sf_dir)[1]
    return K.stratified_folds(labels.select("doc_id", "quality"), 5, 42, label="quality", id_col="doc_id")
