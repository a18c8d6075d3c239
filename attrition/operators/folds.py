"""Stratified folds and class weights.

K1: rows of each class are ordered by md5(seed:row_id) (ties by row_id) and
dealt round-robin into k folds: fold = (position within class) mod k.  Class
counts per fold therefore differ by at most one, every row is in exactly one
fold, and the assignment is reproducible from ``seed`` alone.  Positions are
computed with range-partitioned running counts (operators/ordered.py), so the
two label groups are not two giant single-task windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.operators.ordered import rank_within


def fold_hash(seed: int, id_col: str = "row_id"):
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))


def stratified_folds(df: DataFrame, k: int = 5, seed: int = 42, label: str = "churn",
                     id_col: str = "row_id", out: str = "fold") -> DataFrame:
    """K1: add ``fold`` ∈ [0, k).  Rows with a NULL label are a class of their own,
    so every row has a fold."""
    keyed = (df.withColumn("_h", fold_hash(seed, id_col))
             .withColumn("_class", F.coalesce(F.col(label).cast("string"), F.lit("null"))))
    ranked = rank_within(keyed, ["_h", id_col], ["_class"])
    return ranked.withColumn(out, (F.col("_pos") % k).cast("int")).drop("_h", "_class", "_pos")


def class_counts(df: DataFrame, label: str = "churn") -> tuple[int, int]:
    row = df.agg(F.count(F.when(F.col(label) == 0, 1)).alias("neg"),
                 F.count(F.when(F.col(label) == 1, 1)).alias("pos")).first()
    return int(row["neg"]), int(row["pos"])


def positive_weight(df: DataFrame, label: str = "churn") -> float:
    """K2: scale_pos_weight = negatives / positives."""
    neg, pos = class_counts(df, label)
    return neg / pos if pos else 1.0


def with_class_weights(df: DataFrame, label: str = "churn", scheme: str | float = "balanced",
                       out: str = "weight") -> DataFrame:
    """K2/K3 as a ``weightCol``.

    ``balanced``: n / (2·n_c) per class (sklearn/LightGBM/CatBoost "Balanced");
    ``pos_ratio``: 1 for negatives, neg/pos for positives (XGBoost scale_pos_weight).
    Both give the same neg:pos ratio.  Counts come from one aggregate.  A number is the
    weight of positives itself.
    """
    if not isinstance(scheme, str):
        return df.withColumn(out, F.when(F.col(label) == 1, F.lit(float(scheme))).otherwise(F.lit(1.0)))
    neg, pos = class_counts(df, label)
    n = neg + pos
    if scheme == "balanced":
        w0 = n / (2.0 * neg) if neg else 1.0
        w1 = n / (2.0 * pos) if pos else 1.0
    elif scheme == "pos_ratio":
        w0, w1 = 1.0, (neg / pos if pos else 1.0)
    else:
        raise ValueError(scheme)
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(w1)).otherwise(F.lit(w0)))
