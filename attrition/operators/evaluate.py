"""Evaluation of scores.

Input is a score table with a probability column ``p`` and a 0/1 label,
optionally keyed (fold, model, weight candidate …).  Nothing iterates over
cut-offs: a cut-off grid is one grouped aggregate over the grid index of each
score, the exact PR-curve maximum and AUC are running sums over distinct
scores (operators/ordered.py).

F1 of the positive class is 2·tp / (2·tp + fp + fn), 0 when undefined
(sklearn ``zero_division=0``).  A row is predicted positive when p ≥ t.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from attrition.operators.ordered import running_sums
from attrition.sources.tables import join_null_safe

# Cut-off grids of the reference (numpy.arange(lo, hi, step)).
GRIDS = {
    "full": (0.25, 0.76, 0.005),      # 102 points
    "wide": (0.15, 0.85, 0.01),       # 70 points
    "union": (0.20, 0.81, 0.01),      # 62 points
    "light": (0.10, 0.91, 0.01),      # 81 points
    "v2": (0.10, 0.90, 0.005),        # 160 points
    "fold": (0.2, 0.8, 0.05),         # 13 points
    "trial": (0.1, 0.91, 0.05),       # 17 points
}


def grid(name_or_spec) -> list[float]:
    lo, hi, step = GRIDS[name_or_spec] if isinstance(name_or_spec, str) else name_or_spec
    return [float(x) for x in np.arange(lo, hi, step)]


def f1_col(tp: Column, fp: Column, fn: Column) -> Column:
    den = tp * 2 + fp + fn
    return F.when((tp > 0) & (den > 0), (tp * 2).cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def _lab(label: str) -> Column:
    return F.col(label).cast("int")


# ---------------------------------------------------------------- V1 / V7 / V8 / V9
def confusion_cells(df: DataFrame, threshold: float | None = None, p_col: str = "p", label: str = "churn",
                    pred_col: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn (one aggregate) from a cut-off or an existing 0/1 prediction column."""
    y = _lab(label)
    yhat = (F.col(pred_col).cast("int") if pred_col
            else F.coalesce((F.col(p_col) >= F.lit(threshold)).cast("int"), F.lit(0)))
    return df.groupBy(*keys).agg(
        F.sum(((y == 1) & (yhat == 1)).cast("long")).alias("tp"),
        F.sum(((y == 0) & (yhat == 1)).cast("long")).alias("fp"),
        F.sum(((y == 1) & (yhat == 0)).cast("long")).alias("fn"),
        F.sum(((y == 0) & (yhat == 0)).cast("long")).alias("tn"))


def f1_at(df: DataFrame, threshold: float = 0.5, p_col: str = "p", label: str = "churn",
          keys: Sequence[str] = ()) -> DataFrame:
    """V1 (and V4 with keys=[fold]): F1, precision, recall at one cut-off."""
    c = confusion_cells(df, threshold, p_col, label, keys=keys)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return c.select(*keys, "tp", "fp", "fn", "tn",
                    F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("precision"),
                    F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)).alias("recall"),
                    f1_col(tp, fp, fn).alias("f1"))


def classification_report(df: DataFrame, threshold: float | None = None, p_col: str = "p",
                          label: str = "churn", pred_col: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """V7: per class precision/recall/F1/support, accuracy, macro and weighted averages."""
    c = confusion_cells(df, threshold, p_col, label, pred_col, keys)
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))

    def z(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))
    p1, r1, p0, r0 = z(tp, tp + fp), z(tp, tp + fn), z(tn, tn + fn), z(tn, tn + fp)
    f1_1, f1_0 = z(2 * p1 * r1, p1 + r1), z(2 * p0 * r0, p0 + r0)
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class_label"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1_score"), s.cast("long").alias("support"))
    rows = F.array(
        row("0", p0, r0, f1_0, s0), row("1", p1, r1, f1_1, s1),
        row("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), z(tp + tn, n), n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, n),
        row("weighted avg", z(p0 * s0 + p1 * s1, n), z(r0 * s0 + r1 * s1, n), z(f1_0 * s0 + f1_1 * s1, n), n))
    return c.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*")


def confusion_matrix(df: DataFrame, threshold: float | None = None, p_col: str = "p", label: str = "churn",
                     pred_col: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """V8: the four cells as (actual, predicted, n), zeros included."""
    c = confusion_cells(df, threshold, p_col, label, pred_col, keys)
    cells = F.array(*[F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(n).alias("n"))
                      for a, b, n in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))])
    return c.select(*keys, F.explode(cells).alias("r")).select(*keys, "r.*")


# ---------------------------------------------------------------- V2 / V4 / V9 / V10 / V11 grids
def grid_index(p: Column, g: Sequence[float]) -> Column:
    """Number of grid points ≤ p, exact against the literal grid, O(1) per row.

    An arithmetic guess floor((p − g0)/step) is corrected by one comparison
    each side with the literal neighbours; NULL p counts as 0 (never positive).
    """
    m = len(g)
    arr = F.array(*[F.lit(float(x)) for x in g])
    if m == 1:
        return F.coalesce((p >= F.lit(g[0])).cast("int"), F.lit(0))
    step = (g[-1] - g[0]) / (m - 1)
    i0 = F.floor((p - F.lit(g[0])) / F.lit(step)).cast("int")
    i0 = F.least(F.greatest(i0, F.lit(-1)), F.lit(m - 1))
    at_i0 = F.when(i0 >= 0, F.try_element_at(arr, F.greatest(i0 + 1, F.lit(1))))   # g[i0], NULL when i0 = -1
    at_i1 = F.try_element_at(arr, i0 + 2)          # g[i0+1], NULL past the end
    b = (i0 + 1
         - F.coalesce((p < at_i0).cast("int"), F.lit(0))
         + F.coalesce((p >= at_i1).cast("int"), F.lit(0)))
    return F.coalesce(F.least(F.greatest(b, F.lit(0)), F.lit(m)), F.lit(0))


def grid_curve(df: DataFrame, g: Sequence[float], p_col: str = "p", label: str = "churn",
               keys: Sequence[str] = ()) -> DataFrame:
    """(keys, t_index, threshold, tp, fp, fn, precision, recall, f1) for every grid point.

    One aggregate of (keys, grid index) → ≤ (len(g)+1) rows per key; suffix
    sums over that small table give the counts at every cut-off.
    """
    keys = list(keys)
    m = len(g)
    y = _lab(label)
    counts = (df.select(*keys, grid_index(F.col(p_col), g).alias("b"), y.alias("_y"))
              .groupBy(*keys, "b").agg(F.sum("_y").cast("long").alias("pos"),
                                       F.sum(1 - F.col("_y")).cast("long").alias("neg")))
    totals = counts.groupBy(*keys).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    lattice = totals.select(*keys, "P", F.explode(F.sequence(F.lit(1), F.lit(m))).alias("b"))
    w = Window.partitionBy(*keys).orderBy(F.col("b").desc()).rowsBetween(Window.unboundedPreceding, 0)
    arr = F.array(*[F.lit(float(x)) for x in g])
    cur = (lattice.join(counts, [*keys, "b"], "left")
           .select(*keys, "P", "b", F.coalesce("pos", F.lit(0)).alias("pos"), F.coalesce("neg", F.lit(0)).alias("neg"))
           .select(*keys, "P", "b", F.sum("pos").over(w).alias("tp"), F.sum("neg").over(w).alias("fp")))
    tp, fp = F.col("tp"), F.col("fp")
    fn = F.col("P") - tp
    return cur.select(*keys, (F.col("b") - 1).alias("t_index"),
                      F.element_at(arr, F.col("b")).alias("threshold"),
                      tp.cast("long").alias("tp"), fp.cast("long").alias("fp"), fn.cast("long").alias("fn"),
                      F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("precision"),
                      F.coalesce(F.try_divide(tp, F.col("P")), F.lit(0.0)).alias("recall"),
                      f1_col(tp, fp, fn).alias("f1"))


def best_threshold(df: DataFrame, g: Sequence[float], p_col: str = "p", label: str = "churn",
                   keys: Sequence[str] = (), tie: str = "lowest", default: float | None = 0.5) -> DataFrame:
    """V2 (tie ``lowest``: strict ``>`` scan, ``default`` when no F1 beats 0),
    ``argmax`` (lowest, first grid point when all F1 are 0) and V11 (``highest``).

    Also returns V9: precision and recall with +1 in the denominators.
    """
    curve = grid_curve(df, g, p_col, label, keys)
    order = F.struct(F.col("f1"), -F.col("threshold")) if tie in ("lowest", "argmax") \
        else F.struct(F.col("f1"), F.col("threshold"))
    best = curve.groupBy(*keys).agg(
        F.max("f1").alias("best_f1"),
        F.max_by(F.struct("threshold", "tp", "fp", "fn"), order).alias("b"))
    thr = F.col("b.threshold")
    if tie == "lowest" and default is not None:
        thr = F.when(F.col("best_f1") > 0, thr).otherwise(F.lit(float(default)))
    tp, fp, pp = F.col("b.tp"), F.col("b.fp"), F.col("b.tp") + F.col("b.fn")
    return best.select(*keys, thr.alias("best_threshold"), "best_f1",
                       (tp / (tp + fp + 1)).alias("precision_p1"), (tp / (pp + 1)).alias("recall_p1"))


# ---------------------------------------------------------------- V3 / V6 exact over distinct scores
def _score_counts(df: DataFrame, p_col: str, label: str, keys: Sequence[str]) -> DataFrame:
    y = _lab(label)
    return (df.where(F.col(p_col).isNotNull())
            .groupBy(*keys, F.col(p_col).alias("score"))
            .agg(F.sum(y).cast("long").alias("pos"), F.sum(1 - y).cast("long").alias("neg")))


def _curve_exact(df: DataFrame, p_col: str, label: str, keys: Sequence[str]) -> DataFrame:
    keys = list(keys)
    counts = _score_counts(df, p_col, label, keys)
    cum = running_sums(counts, ["score"], ["pos", "neg"], keys)
    if not keys:  # one total: literals, no join
        t = counts.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
        return cum.withColumn("P", F.lit(int(t["P"] or 0))).withColumn("N", F.lit(int(t["N"] or 0)))
    totals = counts.groupBy(*keys).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return join_null_safe(cum, totals, keys)


def best_f1_exact(df: DataFrame, p_col: str = "p", label: str = "churn", keys: Sequence[str] = ()) -> DataFrame:
    """V3: exact best F1 over all distinct scores (PR curve), lowest score on ties."""
    keys = list(keys)
    cum = _curve_exact(df, p_col, label, keys)
    tp = F.col("P") - F.col("cum_pos") + F.col("pos")
    fp = F.col("N") - F.col("cum_neg") + F.col("neg")
    fn = F.col("P") - tp
    pts = cum.select(*keys, "score", f1_col(tp, fp, fn).alias("f1"))
    return pts.groupBy(*keys).agg(
        F.max("f1").alias("best_f1"),
        F.max_by(F.col("score"), F.struct(F.col("f1"), -F.col("score"))).alias("best_threshold"))


def roc_auc(df: DataFrame, p_col: str = "p", label: str = "churn", keys: Sequence[str] = ()) -> DataFrame:
    """V6: tie-aware AUC = Σ pos·(neg below + neg tied / 2) / (P·N)."""
    keys = list(keys)
    cum = _curve_exact(df, p_col, label, keys)
    contrib = F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.col("neg") / 2.0)
    return cum.groupBy(*keys).agg(
        F.try_divide(F.sum(contrib), F.first("P").cast("double") * F.first("N").cast("double")).alias("auc"))


# ---------------------------------------------------------------- V5
def fold_summary(per_fold: DataFrame, metric: str = "f1", keys: Sequence[str] = ()) -> DataFrame:
    """V5: mean and population std of a per-fold metric."""
    return per_fold.groupBy(*keys).agg(F.avg(metric).alias(f"mean_{metric}"),
                                       F.stddev_pop(metric).alias(f"std_{metric}"),
                                       F.count(F.lit(1)).alias("n_folds"))
