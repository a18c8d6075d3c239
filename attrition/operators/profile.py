"""Profiling.  Each is one aggregate pass; results that
are "one value per column" are produced by ``stack`` (unpivot) of that one row.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from attrition.operators.stats import categorical_columns, numeric_columns


def _unpivot(row_df: DataFrame, names: Sequence[str], key: str, value: str) -> DataFrame:
    """One-row frame with one column per name → (key, value) rows."""
    return row_df.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias(key), F.col(f"`{n}`").alias(value)) for n in names])).alias("kv")
    ).select(f"kv.{key}", f"kv.{value}")


def shape(df: DataFrame, name: str) -> DataFrame:
    """Row and column count of a table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_cols"))


def class_counts(df: DataFrame, label: str = "churn") -> DataFrame:
    """E2 + E3: count and share per class (``value_counts`` / ``normalize=True``)."""
    # the window runs over the ≤ (number of classes) rows left after the aggregate
    total = F.sum("n").over(Window.partitionBy())
    return (df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
            .select(label, "n", (F.col("n") / total).alias("share")))


def churn_rate(df: DataFrame, label: str = "churn") -> DataFrame:
    """Positive rate."""
    return df.agg(F.avg(F.col(label).cast("double")).alias("churn_rate"),
                  F.count(F.lit(1)).alias("n_rows"))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULL count per column, only columns with at least one NULL."""
    cols = list(cols) if cols is not None else df.columns
    row = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    return _unpivot(row, cols, "column_name", "n_null").where(F.col("n_null") > 0)


def label_correlations(df: DataFrame, label: str = "churn", top: int = 10) -> DataFrame:
    """E5: Pearson correlation of every numeric column with the label, top ``top``.

    Pairwise-complete like pandas; a constant column gives NULL instead of
    the ANSI divide-by-zero of ``corr``.  The label itself is included (1.0).
    """
    cols = numeric_columns(df, ("row_id",))
    y = F.col(label).cast("double")
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        yy = F.when(x.isNotNull(), y)
        aggs.append(F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(yy)).alias(c))
    row = df.agg(*aggs)
    return (_unpivot(row, cols, "column_name", "corr")
            .orderBy(F.col("corr").desc_nulls_last(), F.col("column_name")).limit(top))


def nonfinite_audit(df: DataFrame) -> DataFrame:
    """Count of ±inf and NaN per floating column."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    aggs = []
    for c in cols:
        x = F.col(c)
        aggs += [F.count(F.when(F.abs(x) == F.lit(float("inf")), 1)).alias(f"{c}__inf"),
                 F.count(F.when(F.isnan(x), 1)).alias(f"{c}__nan")]
    row = df.agg(*aggs)
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__inf").alias("n_inf"), F.col(f"{c}__nan").alias("n_nan"))
        for c in cols])).alias("r")).select("r.*")


def column_list(df: DataFrame) -> DataFrame:
    """Ordinal, name and type of every column, with the number of values that are present
    and of distinct ones.  A value is counted once a task before the shuffle, so a hot one
    is one row; an empty table has zeros."""
    fields = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    facts = ("ordinal", "column_name", "data_type")
    values = df.select(F.explode(F.array(*[
        F.struct(*[F.lit(x).alias(k) for k, x in zip(facts, f)], F.col(f"`{f[1]}`").cast("string").alias("v"))
        for f in fields])).alias("r")).select("r.*").where(F.col("v").isNotNull())
    counted = (values.groupBy(*facts, "v").agg(F.count(F.lit(1)).alias("n"))
               .groupBy(*facts).agg(F.sum("n").alias("n_present"), F.count(F.lit(1)).alias("n_distinct")))
    named = df.sparkSession.createDataFrame(fields, "ordinal int, column_name string, data_type string")
    return named.join(counted, list(facts), "left").fillna(0, ["n_present", "n_distinct"])


def preview(df: DataFrame, n: int = 5, order: str = "row_id") -> DataFrame:
    """First ``n`` rows by ``order`` (TakeOrderedAndProject, no full sort)."""
    return df.orderBy(order).limit(n)


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False,
                    missing_token: str = "nan") -> DataFrame:
    """Distinct values per categorical column; a missing value counts as the
    token "nan" (the reference encodes ``astype(str)``)."""
    cols = list(cols) if cols is not None else categorical_columns(df)
    fn = F.approx_count_distinct if approx else F.count_distinct
    row = df.agg(*[fn(F.coalesce(F.col(c).cast("string"), F.lit(missing_token))).alias(c) for c in cols])
    return _unpivot(row, cols, "column_name", "n_distinct")


def prediction_summary(pred: DataFrame, train: DataFrame, pred_col: str = "churn",
                       label: str = "churn") -> DataFrame:
    """Predicted class counts and predicted rate next to the train rate."""
    train_rate = train.agg(F.avg(F.col(label).cast("double"))).first()[0]
    return pred.agg(F.count(F.lit(1)).alias("n_pred"),
                    F.sum(F.col(pred_col)).cast("long").alias("n_pred_pos"),
                    F.avg(F.col(pred_col).cast("double")).alias("pred_rate"),
                    F.lit(train_rate).cast("double").alias("train_rate"))
