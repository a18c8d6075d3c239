"""Deterministic score table for checking evaluation and blending operators.

The evaluation and blend operators consume a long score table
``row_id, fold, label, model, p``.  Real model scores (plans/oof.py) cannot be
reproduced by an SQL oracle, so the registered V/B queries use scores derived
deterministically from the train rows: a 32-bit md5 fraction per (model, row)
mixed with the label, and a second member rounded to 2 decimals so ties and
scores that sit exactly on grid points are exercised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.operators.folds import stratified_folds

# Fixed values of the synthetic score table.
MODELS = ["gbt", "forest", "linear"]


def md5_fraction(key) -> "F.Column":
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long").cast("double") / F.lit(4294967296.0)


def pseudo_scores(train: DataFrame, k: int = 5, seed: int = 42, label: str = "churn") -> DataFrame:
    folded = stratified_folds(train.select("row_id", label), k, seed, label)
    models = F.explode(F.array(*[F.lit(m) for m in MODELS])).alias("model")
    base = folded.select("row_id", "fold", F.col(label).alias("label"), models)
    u = md5_fraction(F.concat_ws(":", F.col("model"), F.col("row_id").cast("string")))
    y = F.col("label")
    p = (F.when(F.col("model") == "linear", F.floor((F.lit(0.6) * u + F.lit(0.4) * y) * 100) / 100)
         .otherwise(F.lit(0.7) * u + F.lit(0.3) * y))
    return base.select("row_id", "fold", "label", "model", p.cast("double").alias("p"))
