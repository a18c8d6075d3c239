"""Members and their presets.

The flows' members are histogram boosters (``boosting.py``) with the reference's
presets: ``xgb`` level-wise, ``lgb`` leaf-wise, ``cat`` on nominal features
(``boost_member``).  MLlib learners remain as members of their own: random forest,
GBT, and logistic regression on standardised features (``make_member``,
``oof_fit``), one distributed MLlib job a fold.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import Sequence

import numpy as np
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.operators import boosting as BO
from attrition.operators import evaluate as V
from attrition.session import cut_lineage, drop_table, write_table

# Reference presets as (max depth, learning rate, trees) and
# early-stopping rounds per recipe.
PRESETS = {
    "full": {"xgb": (7, 0.05, 700), "lgb": (8, 0.05, 700), "cat": (7, 0.05, 600)},
    "wide": {"xgb": (7, 0.05, 800), "lgb": (8, 0.05, 800), "cat": (8, 0.05, 800)},
    "v2": {"xgb": (6, 0.08, 500), "lgb": (6, 0.08, 500), "cat": (6, 0.08, 500)},
    "fast": {"xgb": (7, 0.05, 600), "lgb": (8, 0.05, 600), "cat": (8, 0.05, 600)},
    "f1": {"xgb": (6, 0.03, 3000), "lgb": (6, 0.03, 3000), "cat": (6, 0.03, 3000)},
    "simple": {"cat": (6, 0.1, 300)},
    "union": {"cat": (8, 0.03, 3000)},
}
# Regularisation and sampling of the boosted members, by kind, then by recipe where it differs.
TERMS = {
    "xgb": {"rows": 0.8, "columns": 0.8, "l1": 0.5, "l2": 1.0, "min_weight": 3, "min_gain": 0.1},
    "lgb": {"rows": 0.8, "columns": 0.8, "l1": 0.3, "l2": 1.0, "min_rows": 30, "leaves": 127},
    "cat": {"l2": 3.0, "bagging": 0.5, "nominal": True},
    "wide": {"xgb": {"l1": 1.0, "min_weight": 1, "min_gain": 0.0}, "lgb": {"l1": 0.5, "l2": 0.5, "min_rows": 20}},
    "f1": {"xgb": {"rows": 0.7, "columns": 0.7, "l1": 1.0, "l2": 10.0},
           "lgb": {"rows": 0.7, "columns": 0.7, "l1": 1.0, "l2": 10.0, "min_rows": 50, "leaves": 31},
           "cat": {"rows": 0.7, "columns": 0.7, "l2": 10.0, "min_rows": 50, "bagging": 1.0}},
}
BOOSTED = ("xgb", "lgb", "cat")
EARLY_STOP_ROUNDS = {"full": 80, "wide": 100, "v2": 80, "fast": 100, "f1": 300, "simple": 50}
# Search ranges (M10): learning rate (log), depth, trees, bins.
SEARCH_SPACE = {"stepSize": (0.01, 0.3), "maxDepth": (4, 10), "maxIter": (200, 1000), "maxBins": (32, 64, 128)}


# ---------------------------------------------------------------- N8 / N10
def with_nominal(df: DataFrame, col: str, n_values: int) -> DataFrame:
    """Mark an integer code column as categorical (nominal, ``n_values`` levels)
    so MLlib trees split on category sets; VectorAssembler keeps the metadata."""
    meta = {"ml_attr": {"type": "nominal", "name": col, "num_vals": int(n_values)}}
    return df.withColumn(col, F.col(col).cast("double").alias(col, metadata=meta))


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features", handle_invalid: str = "keep") -> DataFrame:
    """Feature vector; ``keep`` passes NULL as NaN (trees route it), ``error`` fails."""
    casted = df.select(*[F.col(c) if c not in cols else F.col(c).cast("double").alias(c, metadata=df.schema[c].metadata)
                         for c in df.columns])
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid).transform(casted)


def p1(prob_col: str = "probability"):
    """Probability of the positive class."""
    return vector_to_array(F.col(prob_col)).getItem(1)


# ---------------------------------------------------------------- M1–M4, M11
def make_member(kind: str, recipe: str = "full", seed: int = 42, weight_col: str | None = "weight",
                max_iter: int | None = None, max_bins: int = 32, validation_col: str | None = None,
                label: str = "label"):
    """An unfitted member with the recipe's preset (``max_iter`` overrides the tree count)."""
    d, lr, n = PRESETS.get(recipe, PRESETS["full"]).get(kind, (6, 0.1, 100))
    n = max_iter or n
    common = dict(featuresCol="features", labelCol=label, seed=seed)
    if kind in ("xgb", "cat"):
        m = GBTClassifier(maxDepth=min(d, 30), stepSize=lr, maxIter=n, subsamplingRate=0.8 if kind == "xgb" else 1.0,
                          featureSubsetStrategy="all", maxBins=max_bins, **common)
        if validation_col:                                      # M4: early stopping on the held-out fold
            m.setValidationIndicatorCol(validation_col)
            m.set(m.validationTol, 1e-4)
    elif kind == "lgb":
        m = RandomForestClassifier(maxDepth=min(d, 30), numTrees=n, subsamplingRate=0.8,
                                   featureSubsetStrategy="sqrt", maxBins=max_bins, **common)
        # rows keep their node of each tree, or every pass walks 700 trees from the root; a fit
        # has few passes, so its state needs no checkpoint
        m.setCacheNodeIds(True).setCheckpointInterval(-1)
    elif kind == "linear":
        m = LogisticRegression(maxIter=max(n, 10), regParam=0.01, elasticNetParam=0.0,
                               featuresCol="features", labelCol=label)
    else:
        raise ValueError(kind)
    if weight_col:
        m.setWeightCol(weight_col)
    return m


def boost_member(kind: str, recipe: str = "full", seed: int = 42, max_iter: int | None = None) -> BO.Boost:
    """A boosted member with the recipe's preset.  ``lgb`` and ``cat`` stop
    early; so does ``xgb`` in the f1 recipe, whose members stop on F1."""
    depth, rate, trees = PRESETS.get(recipe, PRESETS["full"]).get(kind, (6, 0.1, 100))
    patience = EARLY_STOP_ROUNDS.get(recipe, EARLY_STOP_ROUNDS["full"]) if kind != "xgb" or recipe == "f1" else 0
    return BO.Boost(depth=depth, rate=rate, trees=max_iter or trees, patience=patience, metric="f1" if recipe == "f1" else "logloss", seed=seed,
                    **{**TERMS[kind], **TERMS.get(recipe, {}).get(kind, {})})


# ---------------------------------------------------------------- M6 / M7 / M9
def resample_training(train: DataFrame, feature_names: Sequence[str], nominal: dict | None = None,
                      kind: str = "smote", seed: int = 42, id_col: str = "row_id") -> DataFrame:
    """K4/K5 on an assembled training set: the vector is unpacked to columns,
    resampled (category codes copied from the base row), re-assembled with the
    nominal metadata, and weighted 1.0 (balanced classes after resampling)."""
    from attrition.operators import resample as RS
    nominal = nominal or {}
    cols = [f"_f{i}" for i in range(len(feature_names))]
    arr = vector_to_array(F.col("features"))
    flat = train.select(id_col, F.col("label").cast("int").alias("label"),
                        *[arr.getItem(i).alias(c) for i, c in enumerate(cols)])
    cat = [c for c, name in zip(cols, feature_names) if name in nominal]
    if kind == "smote":
        out = RS.smote(flat, cols, label="label", id_col=id_col, k=5, seed=seed, categorical=cat)
    else:
        out = RS.smote_tomek(flat, cols, label="label", id_col=id_col, k=5, seed=seed, categorical=cat)
    for c, name in zip(cols, feature_names):
        if name in nominal:
            out = with_nominal(out, c, nominal[name])
    out = assemble(out.withColumn("label", F.col("label").cast("double")), cols)
    return out.select(id_col, "label", F.lit(1.0).alias("weight"), "features")


def oof_fit(df: DataFrame, estimator, k: int, fold_col: str = "fold", label: str = "label",
            id_col: str = "row_id", parallelism: int = 1, early_stop: bool = False,
            resample: str | None = None, feature_names: Sequence[str] = (), nominal: dict | None = None,
            seed: int = 42):
    """M6: fit on k−1 folds, score the held-out fold; returns (oof scores, models).

    With ``early_stop`` the held-out fold doubles as the validation set of the
    GBT (M4), exactly as the reference passes ``eval_set=(X_val, y_val)``.
    ``resample`` (``smote`` / ``smote_tomek``) resamples the training folds only
    (K4/K5), never the held-out fold.
    """
    def fit_one(f):
        data = df.where(F.col(fold_col) != f)
        if resample:
            data = resample_training(data, feature_names, nominal, resample, seed + f, id_col)
        est = estimator.copy()
        if early_stop and est.hasParam("validationIndicatorCol"):   # members without it fit as they are
            held = df.where(F.col(fold_col) == f)
            both = [c for c in data.columns if c in held.columns]
            data = (data.select(*both).withColumn("_is_val", F.lit(False))
                    .unionByName(held.select(*both).withColumn("_is_val", F.lit(True))))
            est.setValidationIndicatorCol("_is_val")
            est.set(est.validationTol, 1e-4)
        return est.fit(data)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        models = list(pool.map(fit_one, range(k)))
    parts = [models[f].transform(df.where(F.col(fold_col) == f)).select(
        id_col, fold_col, F.col(label).cast("int").alias("label"), p1().alias("p")) for f in range(k)]
    oof = parts[0]
    for p in parts[1:]:
        oof = oof.unionByName(p)                                 # R4: every row in exactly one fold
    return oof, models


def fold_mean_scores(test: DataFrame, models: Sequence[Model], id_col: str = "row_id") -> DataFrame:
    """M7: test score = mean of the fold models' probabilities, one pass over test."""
    cur = test
    names = []
    for i, m in enumerate(models):
        out = m.copy()
        for param, val in (("probabilityCol", f"_prob{i}"), ("rawPredictionCol", f"_raw{i}"),
                           ("predictionCol", f"_pred{i}")):
            if out.hasParam(param):
                out.set(out.getParam(param), val)
        cur = out.transform(cur)
        names.append(f"_p{i}")
        cur = cur.withColumn(f"_p{i}", p1(f"_prob{i}")).drop(f"_prob{i}", f"_raw{i}", f"_pred{i}")
    acc = None
    for n in names:
        acc = F.col(n) if acc is None else acc + F.col(n)
    return cur.select(id_col, (acc / len(names)).alias("p"))


def importances(models: Sequence[Model], feature_names: Sequence[str], top: int = 20) -> DataFrame:
    """M9: mean feature importance over models, top ``top`` (the vector has one
    entry per feature – bounded by the feature count, not by rows)."""
    mats = np.array([m.featureImportances.toArray() for m in models if hasattr(m, "featureImportances")])
    mean = mats.mean(axis=0)
    rows = sorted(zip(feature_names, mean.tolist()), key=lambda x: (-x[1], x[0]))
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), F.col("feature")).limit(top)


# ---------------------------------------------------------------- M10 search
class BestF1Evaluator(Evaluator):
    """Mean-fold objective of the reference: F1 at the best cut-off of a grid."""

    grid_name = Param(Params._dummy(), "grid_name", "cut-off grid name")

    def __init__(self, grid_name: str = "trial", label: str = "label"):
        super().__init__()
        self._set(grid_name=grid_name)
        self._label = label

    def _evaluate(self, dataset: DataFrame) -> float:
        scored = dataset.select(F.col(self._label).cast("int").alias("label"), p1().alias("p"))
        row = V.best_threshold(scored, V.grid(self.getOrDefault(self.grid_name)), "p", "label",
                               tie="highest").first()
        return float(row["best_f1"]) if row else 0.0

    def isLargerBetter(self) -> bool:
        return True


def random_param_maps(estimator, trials: int, seed: int = 42, max_iter_cap: int | None = None,
                      min_bins: int = 32) -> list[dict]:
    """Seeded random draws from the reference's search ranges (log-uniform step)."""
    rng = np.random.default_rng(seed)
    maps = []
    lo, hi = SEARCH_SPACE["stepSize"]
    for _ in range(trials):
        step = float(np.exp(rng.uniform(np.log(lo), np.log(hi))))
        depth = int(rng.integers(SEARCH_SPACE["maxDepth"][0], SEARCH_SPACE["maxDepth"][1] + 1))
        iters = int(rng.integers(SEARCH_SPACE["maxIter"][0], SEARCH_SPACE["maxIter"][1] + 1))
        bins = int(rng.choice(SEARCH_SPACE["maxBins"]))
        if max_iter_cap:
            iters = min(iters, max_iter_cap)
        drawn = {"stepSize": step, "maxDepth": depth, "maxIter": iters, "numTrees": iters, "maxBins": max(bins, min_bins)}
        maps.append({estimator.getParam(name): value for name, value in drawn.items() if estimator.hasParam(name)})
    return maps


def random_search(df: DataFrame, estimator, trials: int = 40, k_fold_col: str = "fold", seed: int = 42,
                  parallelism: int = 2, max_iter_cap: int | None = None, min_bins: int = 32, label: str = "label"):
    """M10 (+ M8 refit): ``CrossValidator`` over seeded random parameter maps with
    the best-cut-off F1 evaluator; the best map is refit on all rows."""
    from pyspark.ml.tuning import CrossValidator
    maps = random_param_maps(estimator, trials, seed, max_iter_cap, min_bins)
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=BestF1Evaluator(label=label),
                        foldCol=k_fold_col, parallelism=parallelism, seed=seed)
    model = cv.fit(df)
    return model, maps


# ---------------------------------------------------------------- M5 early stop on F1
PREFIX_TREES = 25       # trees scored in one job


def best_prefix_by_f1(model, val: DataFrame, g: Sequence[float] | None = None, id_col: str = "row_id",
                      label: str = "label") -> DataFrame:
    """M5: F1-driven early stopping for a fitted GBT.

    The margin of the first k trees is Σ_{i<k} w_i·tree_i(x).  Trees are taken in
    blocks of ``PREFIX_TREES``: a block's table holds each row's margins after each
    of its trees, p = 1/(1+exp(−2·margin)), and the grid F1 of the block's prefixes
    comes from one grouped aggregate.  A block starts from the last margin of the
    one before, whose table then goes.  Returns ``(n_trees, best_threshold,
    best_f1)`` rows sorted by F1, fewest trees first.
    """
    g = list(g or V.grid("trial"))
    features = model.getFeaturesCol()
    cur = val.select(id_col, F.col(label).cast("int").alias("label"), features, F.lit(0.0).alias("margin"))
    found, before = [], None
    pairs = list(zip(model.trees, model.treeWeights))
    for lo in range(0, len(pairs), PREFIX_TREES):
        for i, (t, _) in enumerate(pairs[lo:lo + PREFIX_TREES]):
            tm = t.copy()
            tm.set(tm.getParam("predictionCol"), f"_t{i}")
            tm.set(tm.getParam("featuresCol"), features)
            cur = tm.transform(cur)
        acc, margins = F.col("margin"), []
        for i, (_, w) in enumerate(pairs[lo:lo + PREFIX_TREES]):
            acc = acc + F.col(f"_t{i}") * F.lit(float(w))
            margins.append(acc)
        block = write_table(cur.select(id_col, "label", features, F.array(*margins).alias("margins")), "prefix")
        pref = (block.select("label", F.posexplode("margins").alias("k", "margin"))
                .select("label", (F.col("k") + lo + 1).alias("n_trees"), (1.0 / (1.0 + F.exp(-2.0 * F.col("margin")))).alias("p")))
        found.append(cut_lineage(V.best_threshold(pref, g, "p", "label", keys=["n_trees"], tie="lowest")
                                 .select("n_trees", "best_threshold", "best_f1")))
        if before is not None:
            drop_table(before)
        before = block
        cur = block.select(id_col, "label", features, F.element_at("margins", -1).alias("margin"))
    best = found[0]
    for x in found[1:]:
        best = best.unionByName(x)
    drop_table(before)
    return best.orderBy(F.col("best_f1").desc(), "n_trees")
