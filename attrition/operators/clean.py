"""Cleaning, projection and filter operators.

All of them are single projections or filters except the fitted ones
(C3 winsorising, C6–C8 median fills in ``stats``, C9 imputation in ``impute``),
which take their statistics in one aggregate first.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.functions.nullsafe import clip as clip_expr
from attrition.functions.nullsafe import clip_lower, nan_to_null, neg_to_null, safe_div_fill
from attrition.operators.impute import IterativeImputer, iterative_impute
from attrition.operators.stats import (apply_fills, categorical_columns, fill_median, fit_stats,
                                       numeric_columns, present)

# The eight usage columns the reference sets to missing when negative.
NEGATIVE_INVALID = ["calls_made", "sms_sent", "data_used", "calls_per_day", "sms_per_day",
                    "data_per_day", "salary_data_ratio", "activity_score"]

__all__ = [
    "sweep_inf", "negatives_to_null", "winsorize", "clip_lower_cols", "fill_constant", "fill_median",
    "safe_divide", "parse_dates", "drop_columns", "common_columns", "split_train_test",
    "numeric_columns", "categorical_columns", "present", "NEGATIVE_INVALID", "IterativeImputer", "iterative_impute",
]


def _floating(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]


def sweep_inf(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """±inf and NaN → NULL in the named (default: all floating) columns."""
    target = set(_floating(df) if cols is None else present(df, cols))
    return df.select(*[(nan_to_null(c).alias(c) if c in target else F.col(c)) for c in df.columns])


def negatives_to_null(df: DataFrame, cols: Sequence[str] = NEGATIVE_INVALID) -> DataFrame:
    """Negative values → NULL (only columns that are present)."""
    target = set(present(df, cols))
    return df.select(*[(neg_to_null(c).alias(c) if c in target else F.col(c)) for c in df.columns])


def winsorize(df: DataFrame, fit: DataFrame | None = None, cols: Sequence[str] | None = None,
              lo: float = 0.0001, hi: float = 0.9999, approx: bool = False) -> DataFrame:
    """Clip each column to quantiles ``lo``/``hi`` fitted on ``fit`` (default: df).

    All 2·k quantiles come from one aggregate; the clip is a projection.
    """
    fit = fit if fit is not None else df
    cols = list(cols) if cols is not None else numeric_columns(df, ("row_id", "churn"))
    cols = [c for c in cols if c in fit.columns]
    st = fit_stats(fit, [("quantile", c, q) for c in cols for q in (lo, hi)], approx)
    bounds = {c: (st[("quantile", c, lo)], st[("quantile", c, hi)]) for c in cols}
    out = []
    for c in df.columns:
        if c in bounds and bounds[c][0] is not None:
            out.append(clip_expr(F.col(c), F.lit(bounds[c][0]), F.lit(bounds[c][1])).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def clip_lower_cols(df: DataFrame, bounds: dict) -> DataFrame:
    """C4: ``clip(lower=b)`` per column; NULL stays NULL."""
    return df.select(*[(clip_lower(c, bounds[c]).alias(c) if c in bounds else F.col(c)) for c in df.columns])


def fill_constant(df: DataFrame, numeric=None, text=None, cols: Sequence[str] | None = None,
                  exclude: Iterable[str] = ()) -> DataFrame:
    """Constant fill – ``numeric`` for numeric columns, ``text`` for string columns.

    ``fillna(0)`` on a mixed table (numeric=0, text="0") also turns a missing
    category into the category "0", as the reference does.
    """
    ex = set(exclude)
    names = set(cols) if cols is not None else set(df.columns)
    out = []
    for f in df.schema.fields:
        c = f.name
        if c in names and c not in ex:
            if isinstance(f.dataType, T.StringType) and text is not None:
                out.append(F.coalesce(F.col(c), F.lit(str(text))).alias(c))
                continue
            if isinstance(f.dataType, (T.NumericType,)) and numeric is not None:
                out.append(F.coalesce(F.col(c), F.lit(numeric).cast(f.dataType)).alias(c))
                continue
        out.append(F.col(c))
    return df.select(*out)


def safe_divide(df: DataFrame, out: str, a: str, b: str, fill: float = 0.0) -> DataFrame:
    """``out = a / b`` with inf/NaN/NULL → ``fill``."""
    return df.withColumn(out, safe_div_fill(a, b, fill))


def parse_dates(df: DataFrame, cols: Sequence[str], strict: bool = False) -> DataFrame:
    """C11: text → timestamp; lenient gives NULL on junk, strict raises (ANSI)."""
    conv = F.to_timestamp if strict else F.try_to_timestamp
    target = set(present(df, cols))
    return df.select(*[(conv(F.col(c)).alias(c) if c in target else F.col(c)) for c in df.columns])


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """C12."""
    return df.drop(*present(df, cols))


def common_columns(train: DataFrame, test: DataFrame, cast_float: bool = False):
    """Keep the columns both tables have, in train order (optionally as float)."""
    common = [c for c in train.columns if c in set(test.columns)]

    def proj(df):
        return df.select(*[(F.col(c).cast("float").alias(c) if cast_float else F.col(c)) for c in common])
    return proj(train), proj(test)


def split_train_test(combined: DataFrame, flag_col: str = "is_train"):
    """C14: split a union back by its flag column (not by position)."""
    return (combined.filter(F.col(flag_col)).drop(flag_col),
            combined.filter(~F.col(flag_col)).drop(flag_col))


def median_fill_scoped(train: DataFrame, test: DataFrame, scope: str = "train",
                       cols: Sequence[str] | None = None, exclude=("row_id", "churn")):
    """C6/C7/C8 on a train/test pair: ``self`` fits each table on itself,
    ``train`` fits on train and applies to both, ``union`` fits on train ∪ test."""
    cols = list(cols) if cols is not None else [c for c in numeric_columns(train, exclude) if c in test.columns]
    if scope == "self":
        return fill_median(train, cols), fill_median(test, cols)
    fit = train.select(cols) if scope == "train" else train.select(cols).unionByName(test.select(cols))
    st = fit_stats(fit, [("median", c) for c in cols])
    fills = {c: st[("median", c)] for c in cols}
    return apply_fills(train, fills), apply_fills(test, fills)
