"""End-to-end out-of-fold pipeline (the reference's main flow, re-expressed).

mart → recipe features (fit scope self) → ordinal codes on train ∪ test (N1)
→ common columns (C13) → median imputer fitted on train (C7) → stratified
folds (K1) → class weights (K3) → feature vector (N10, nominal codes N8)
→ all boosted members on all folds in one fit (M1–M5), OOF scores (M6) and
  fold-mean test scores (M7) in one pass
→ long score table → blend-weight search (B3) → best cut-off (V2), AUC (V6),
report (V7) → test labels (M12) → output check (S8) → run log (S7).

The prepared feature table is checkpointed once (reliable, in the shared
checkpoint folder) before the fold loop, so k × members fits read it
instead of recomputing the mart joins.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.operators.clean import sweep_inf
from attrition.operators import blend as B
from attrition.operators import boosting as BO
from attrition.operators import evaluate as V
from attrition.operators import train as M
from attrition.operators.clean import median_fill_scoped
from attrition.operators.encode import ordinal_encode
from attrition.operators.folds import stratified_folds, with_class_weights
from attrition.operators.stats import fit_stats
from attrition.plans import recipes
from attrition.session import cut_lineage
from attrition.sources import io as S
from attrition.sources.mart import CATEGORICALS, customer_mart, train_test


@dataclass
class Prepared:
    train: DataFrame            # row_id, label, fold, weight, features, codes …
    test: DataFrame             # row_id, features
    feature_cols: list
    cardinality: dict = field(default_factory=dict)


def _target_encodings(ftr: DataFrame, fte: DataFrame, k: int):
    """f1 flow: frequency codes (N3) and smoothed target means of the four
    categories and three pairs – out of fold on train (N4/N6, folds seeded 99),
    from all train rows on test (N5)."""
    from attrition.operators.encode import (combo_key, frequency_encode, target_encode_fit_apply,
                                            target_encode_oof)
    pairs = [("telecom_partner", "city"), ("state", "city"), ("telecom_partner", "state")]
    for a, b in pairs:
        ftr, fte = combo_key(ftr, a, b), combo_key(fte, a, b)
    keys = CATEGORICALS + [f"{a}_{b}" for a, b in pairs]
    tr_f = frequency_encode(ftr, ftr, CATEGORICALS)
    te_f = frequency_encode(fte, ftr, CATEGORICALS)
    tr = target_encode_oof(stratified_folds(tr_f, k, 99).withColumnRenamed("fold", "_te_fold"), keys,
                           fold_col="_te_fold").drop("_te_fold")
    te = target_encode_fit_apply(tr_f, te_f, keys)
    combos = [f"{a}_{b}" for a, b in pairs]
    return tr.drop(*combos), te.drop(*combos)


def prepare(spark: SparkSession, sf_dir: str, recipe: str = "full", k: int = 5, seed: int = 42,
            weights: str | float = "balanced", impute: str = "median", scale: bool = False,
            target_encodings: bool = False) -> Prepared:
    """Feature table for one flow.  ``impute``: ``median`` (C7, fitted on train)
    or ``iterative`` (C3 winsorising + C9, fitted on train); ``scale``: N9;
    ``target_encodings``: N3 frequency + N4/N5/N6 target means (the f1 flow)."""
    # many fit passes follow: build the joins once; C1 first, no flow trains on ±inf
    mart = cut_lineage(sweep_inf(customer_mart(spark, sf_dir)))
    if recipe == "union":                                                   # R1 → cleaning → C14
        combined = recipes.union(mart)
        ftr = combined.filter(F.col("is_train")).drop("is_train")
        fte = combined.filter(~F.col("is_train")).drop("is_train", "churn")
    else:
        train, test = train_test(mart)
        make = recipes.RECIPES[recipe]
        ftr, fte = make(train), make(test)
    if target_encodings:
        ftr, fte = _target_encodings(ftr, fte, k)
    ftr, fte = ordinal_encode(ftr, fte, CATEGORICALS, "union")              # N1
    drop = {"row_id", "churn", "date_of_registration"}
    feats = [c for c in ftr.columns if c not in drop and c in set(fte.columns)]   # C13
    if impute == "iterative":
        from attrition.operators.clean import iterative_impute, winsorize
        num = [c for c in feats if c not in CATEGORICALS]
        fte, ftr = winsorize(fte, ftr, num), winsorize(ftr, ftr, num)     # C3 (train quantiles)
        ftr, fte, _ = iterative_impute(ftr, fte, num, max_iter=10)         # C9
    ftr, fte = median_fill_scoped(ftr, fte, "train", cols=feats)           # C7 (no-op after C9)
    if scale:                                                               # N9
        from attrition.operators.encode import apply_standardize, fit_standardize
        params = fit_standardize(ftr, [c for c in feats if c not in CATEGORICALS])
        ftr, fte = apply_standardize(ftr, params), apply_standardize(fte, params)
    ftr = stratified_folds(ftr, k, seed)                                    # K1
    ftr = with_class_weights(ftr, scheme=weights)                           # K2/K3
    names = [c for c in NOMINAL if c in feats]
    card = fit_stats(ftr.select(*names).unionByName(fte.select(*names)), [("max", c) for c in names])
    nominal = {c: int(card[("max", c)] or 0) + 1 for c in names}
    for c, n in nominal.items():                                            # N8
        ftr = M.with_nominal(ftr, c, n)
        fte = M.with_nominal(fte, c, n)
    ftr = M.assemble(ftr.withColumn("label", F.col("churn").cast("double")), feats)   # N10
    fte = M.assemble(fte, feats)
    tr = cut_lineage(ftr.select("row_id", "label", "fold", "weight", "features"))
    te = cut_lineage(fte.select("row_id", "features"))
    return Prepared(tr, te, feats, nominal)


# Nominal in every recipe, whatever the number of rows; city keeps the ordered codes
# that label encoding gives.  MLlib needs a bin for each value of a nominal category.
NOMINAL = ("telecom_partner", "gender", "state")
MAX_BINS = 32

# Flows of the reference scripts: recipe, members, blend rule, cut-off grid and
# preprocessing options (see README).
FLOWS = {
    "simple": dict(recipe="simple", members=("cat",), blend="single", grid="wide"),
    "fast": dict(recipe="fast", members=("xgb", "lgb", "cat"), blend="mean", grid="wide"),
    "wide": dict(recipe="wide", members=("xgb", "lgb", "cat"), blend="mean", grid="wide", scale=True,
                 resample="smote", resample_members=("lgb", "cat")),
    "v2": dict(recipe="v2", members=("xgb", "lgb", "cat"), blend="fixed", grid="v2", scale=True),
    "full": dict(recipe="full", members=("xgb", "lgb", "cat"), blend="grid", grid="full", weights=3.0),
    "f1": dict(recipe="f1", members=("cat", "lgb", "xgb"), blend="exact", grid=None, target_encodings=True),
    "union": dict(recipe="union", members=("cat",), blend="single", grid="union"),
    "light": dict(recipe="light", members=("cat",), blend="single", grid="light", impute="iterative"),
    "raw": dict(recipe="raw", members=("cat",), blend="single", grid="light", refit=True),
}


def nominal_features(prep: Prepared) -> dict[int, int]:
    """Place and number of values of each nominal feature."""
    return {prep.feature_cols.index(c): n for c, n in prep.cardinality.items()}


def fit_members(prep: Prepared, members: dict, k: int) -> BO.Fitted:
    """Boosted members on every fold's training rows."""
    return BO.fit(prep.train, members, range(k), len(prep.feature_cols), nominal_features(prep))


def fit_resampled(prep: Prepared, members: dict, k: int, kind: str, seed: int) -> BO.Fitted:
    """As ``fit_members``, each fold's training rows resampled (K4/K5); held-out rows are not."""
    nobody = k
    rows = prep.train.select("row_id", "label", "fold", F.lit(1.0).alias("weight"), "features", F.lit(nobody).alias("only"))
    for f in range(k):
        made = M.resample_training(prep.train.where(F.col("fold") != f), prep.feature_cols, prep.cardinality, kind, seed + f)
        rows = rows.unionByName(made.select("row_id", "label", F.lit(-1).alias("fold"), "weight", "features", F.lit(f).alias("only")))
    return BO.fit(rows, members, range(k), len(prep.feature_cols), nominal_features(prep), only="only")


def run_flow(spark: SparkSession, sf_dir: str, flow: str = "full", **kw) -> dict:
    """Run one of the reference's flows end to end (``FLOWS``)."""
    return run(spark, sf_dir, **{**FLOWS[flow], **kw})


def run(spark: SparkSession, sf_dir: str, recipe: str = "full", members=("xgb", "lgb", "cat"), k: int = 5,
        max_iter: int | None = None, seed: int = 42,
        timings: dict | None = None, output_dir: str | None = None, blend: str = "grid",
        grid: str | None = "full", impute: str = "median", scale: bool = False,
        target_encodings: bool = False, resample: str | None = None,
        resample_members: tuple = ("lgb", "cat"), early_stop: bool = True, max_bins: int = MAX_BINS,
        weights: str | float = "balanced", refit: bool = False) -> dict:
    """``max_iter``: trees a member (None: the recipe's preset).  ``early_stop``: M4/M5 on
    the held-out fold, with the recipe's patience and metric, for the members that the
    recipe stops.  ``max_bins``: MLlib's bins a feature (``linear`` and other MLlib
    members).  ``refit`` (M8): test scores from models on all rows, with the mean number
    of trees kept, instead of the fold models' mean.
    ``output_dir``: also write the submission (S4), the blended probabilities
    (S5), one labelled file per member at its own exact-F1 cut-off (S6) and
    append the run metrics (S7)."""
    t = timings if timings is not None else {}
    t0 = time.time()
    prep = prepare(spark, sf_dir, recipe, k, seed, weights=weights, impute=impute, scale=scale,
                   target_encodings=target_encodings)
    t["prepare"] = time.time() - t0
    boosts = {kind: M.boost_member(kind, recipe, seed, max_iter) for kind in members if kind in M.BOOSTED}
    if not early_stop:
        boosts = {kind: replace(b, patience=0) for kind, b in boosts.items()}
    sampled = {kind: b for kind, b in boosts.items() if resample and kind in resample_members}
    fits = {}
    for own, fit in (({kind: b for kind, b in boosts.items() if kind not in sampled}, lambda own: fit_members(prep, own, k)),
                     (sampled, lambda own: fit_resampled(prep, own, k, resample, seed))):
        if own:
            t1 = time.time()
            fitted = fit(own)
            fits.update(dict.fromkeys(own, fitted))
            t["fit_" + "_".join(own)] = time.time() - t1
    oofs, tests = [], []
    for kind in members:
        if kind in fits:
            oof, test = BO.oof_scores(fits[kind], prep.train, kind), BO.mean_scores(fits[kind], prep.test, kind)
            if refit:
                trees = round(sum(fits[kind].kept[kind, f] for f in range(k)) / k)
                whole = BO.fit(prep.train, {kind: replace(boosts[kind], trees=max(1, trees), patience=0)}, [-1], len(prep.feature_cols), nominal_features(prep))
                test = BO.mean_scores(whole, prep.test, kind)
        else:
            t1 = time.time()
            oof, models = M.oof_fit(prep.train, M.make_member(kind, recipe, seed, "weight", max_iter, max_bins), k,
                                    resample=resample if kind in resample_members else None,
                                    feature_names=prep.feature_cols, nominal=prep.cardinality, seed=seed)
            test = M.fold_mean_scores(prep.test, models)
            t[f"fit_{kind}"] = time.time() - t1
        tests.append(test.withColumn("model", F.lit(kind)))
        oofs.append(oof.withColumn("model", F.lit(kind)))
    t1 = time.time()
    long = oofs[0]
    for o in oofs[1:]:
        long = long.unionByName(o)
    long = cut_lineage(long)
    folds = (V.best_threshold(long, V.grid("fold"), "p", "label", keys=["model", "fold"]).select("model", "fold", "best_threshold", "best_f1")
             .join(V.roc_auc(long, "p", "label", keys=["model", "fold"]).select("model", "fold", "auc"), ["model", "fold"], "left"))
    wide = B.pivot_scores(long, list(members))
    names = list(members)
    if blend == "fixed" and len(names) != len(B.V2_WEIGHTS):
        raise ValueError(f"the fixed blend has {len(B.V2_WEIGHTS)} weights, not {len(names)}")
    if blend == "grid" and len(names) > 1:                                 # B3
        cands = None if len(names) == 3 else B.simplex_candidates(len(names))
        row = B.grid_search(wide, names, V.grid(grid or "full"), cands=cands).first()
        w = [row[f"w{i + 1}"] for i in range(len(names))]
    elif blend == "exact":                                                  # B4 / B5
        row = B.exact_search(wide, names, "label").first()
        w = [row[f"w{i + 1}"] for i in range(len(names))]
    elif blend == "fixed":                                                  # B2
        w = [x / sum(B.V2_WEIGHTS) for x in B.V2_WEIGHTS]
    else:                                                                   # B1 / single member
        w = [1.0 / len(names)] * len(names)
    blended = wide.withColumn("p", B.weighted(names, w))
    if grid is None:                                                        # V3: exact cut-off
        best = V.best_f1_exact(blended, "p", "label").first()
    else:                                                                   # V2 (+ V9 columns)
        best = V.best_threshold(blended, V.grid(grid), "p", "label").first()
    threshold = float(best["best_threshold"])
    auc = V.roc_auc(blended, "p", "label").first()["auc"]
    report = V.classification_report(blended, threshold, "p", "label")
    t["blend_eval"] = time.time() - t1

    t1 = time.time()
    test_long = tests[0]
    for x in tests[1:]:
        test_long = test_long.unionByName(x)
    test_wide = test_long.groupBy("row_id").pivot("model", list(members)).agg(F.first("p"))
    test_p = test_wide.withColumn("p", B.weighted(list(members), w))
    ided = S.dense_ids(test_p, ["row_id"], base=1)
    submission = S.hard_labels(ided, threshold)                              # M12
    check = S.output_check(submission, prep.test.count())                    # S8
    t["predict"] = time.time() - t1
    if output_dir:
        import os
        S.write_csv(submission, os.path.join(output_dir, "submission"))
        S.write_csv(ided.select("id", F.col("p").alias("churn")), os.path.join(output_dir, "submission_proba"))
        cuts = V.best_f1_exact(long, "p", "label", keys=["model"]).select("model", "best_threshold")
        per_model = (test_long.join(F.broadcast(cuts), "model")            # ≤ members rows
                     .join(ided.select("row_id", "id"), "row_id")
                     .select("id", (F.col("p") >= F.col("best_threshold")).cast("int").alias("churn"), "model"))
        S.write_csv(per_model, os.path.join(output_dir, "per_model"), partition_by=["model"])
        per_fold = folds.collect()                                          # members × folds rows
        S.append_metrics(spark, os.path.join(output_dir, "run_metrics"), f"{recipe}-{seed}",
                         {**{f"time/{k}": v for k, v in t.items()}, "eval/best_f1": float(best["best_f1"]),
                          "eval/threshold": threshold, "eval/auc": float(auc or 0.0),
                          **{f"blend/w{i + 1}": x for i, x in enumerate(w)},
                          **{f"fold/{r['model']}/{r['fold']}/{m}": float(r[m] or 0.0) for r in per_fold for m in ("best_f1", "auc")}})
    return {"oof": long, "weights": w, "threshold": threshold, "best_f1": float(best["best_f1"]),
            "auc": auc, "report": report, "folds": folds, "kept": {n: x for f in fits.values() for n, x in f.kept.items()},
            "submission": submission, "check": check, "prepared": prep}
