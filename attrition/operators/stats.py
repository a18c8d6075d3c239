"""Fitted statistics: every statistic a stage needs is taken in ONE aggregate.

``fit_stats`` turns a list of requests into a single ``agg`` (partial
aggregation map-side, one small row back to the driver).  Quantiles are exact
with linear interpolation (pandas ``quantile``/``median``), from distributed
running counts at every size; ``approx=True`` asks for ``percentile_approx``.

Fit scopes (SURVEY §1.1-13): statistics are fitted on the table itself
(``self``), on the labelled table (``train``) or on both (``union``).
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Columns of numeric type (pandas ``select_dtypes(include=number)``)."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in ex]


def categorical_columns(df: DataFrame, exclude: Iterable[str] = (), include_bool: bool = False) -> list[str]:
    """String (and optionally boolean) columns."""
    ex = set(exclude)
    kinds = (T.StringType, T.BooleanType) if include_bool else (T.StringType,)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in ex]


def present(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """Keep the wanted columns that exist, in the wanted order."""
    have = set(df.columns)
    return [c for c in wanted if c in have]


def _expr(kind: str, c: str, arg=None, accuracy: int = 100_000):
    x = F.col(c)
    if kind in ("median", "quantile"):          # only with approx=True
        return F.percentile_approx(x, 0.5 if kind == "median" else float(arg), accuracy).cast("double")
    if kind == "mean":
        return F.avg(x)
    if kind == "std_samp":
        return F.stddev_samp(x)
    if kind == "std_pop":
        return F.stddev_pop(x)
    if kind == "min":
        return F.min(x)
    if kind == "max":
        return F.max(x)
    if kind == "nulls":
        return F.count(F.when(x.isNull(), F.lit(1)))
    if kind == "count":
        return F.count(x)
    if kind == "sum":
        return F.sum(x)
    raise ValueError(kind)


def fit_stats(df: DataFrame, requests: Sequence[tuple], approx: bool = False) -> dict:
    """One aggregate for all requests; returns ``{request: value}``.

    A request is ``(kind, column)`` or ``("quantile", column, q)``.  Exact
    quantiles come from one distributed ranked pass for all columns
    (``ordered.exact_quantiles``): a global ``percentile`` would merge every
    distinct value in one task.
    """
    reqs = list(dict.fromkeys(tuple(r) for r in requests))
    if not reqs:
        return {}
    out: dict = {}
    qreqs = [] if approx else [r for r in reqs if r[0] in ("median", "quantile")]
    if qreqs:
        from attrition.operators.ordered import exact_quantiles
        cols = list(dict.fromkeys(r[1] for r in qreqs))
        probs = sorted({0.5 if r[0] == "median" else float(r[2]) for r in qreqs})
        qs = exact_quantiles(df, cols, probs)
        for r in qreqs:
            out[r] = qs[(r[1], 0.5 if r[0] == "median" else float(r[2]))]
        reqs = [r for r in reqs if r not in out]
        if not reqs:
            return out
    exprs = [_expr(r[0], r[1], r[2] if len(r) > 2 else None).alias(f"s{i}") for i, r in enumerate(reqs)]
    row = df.agg(*exprs).first()
    out.update({r: row[f"s{i}"] for i, r in enumerate(reqs)})
    return out


def null_counts(df: DataFrame, cols: Sequence[str]) -> dict:
    st = fit_stats(df, [("nulls", c) for c in cols])
    return {c: st[("nulls", c)] for c in cols}


def scope_frame(train: DataFrame, test: DataFrame | None, scope: str, which: str) -> DataFrame:
    """The frame a statistic is fitted on, for table ``which`` in {train, test}."""
    if scope == "self":
        return train if which == "train" else test
    if scope == "train":
        return train
    if scope == "union":
        cols = [c for c in train.columns if test is None or c in test.columns]
        return train.select(cols) if test is None else train.select(cols).unionByName(test.select(cols))
    raise ValueError(scope)


def fill_median(df: DataFrame, cols: Sequence[str] | None = None, fit: DataFrame | None = None,
                exclude: Iterable[str] = ("row_id",), approx: bool = False) -> DataFrame:
    """Fill NULL with the median of ``fit`` (default: ``df`` itself).

    Two narrow passes: null counts first, medians only for columns that have
    NULLs.  A column whose median is undefined (all NULL) stays NULL.
    """
    cols = list(cols) if cols is not None else numeric_columns(df, exclude)
    if not cols:
        return df
    need = [c for c, n in null_counts(df, cols).items() if n]
    if not need:
        return df
    st = fit_stats(fit if fit is not None else df, [("median", c) for c in need], approx)
    return apply_fills(df, {c: st[("median", c)] for c in need})


def fit_medians(fit: DataFrame, cols: Sequence[str], approx: bool = False) -> dict:
    st = fit_stats(fit, [("median", c) for c in cols], approx)
    return {c: st[("median", c)] for c in cols}


def _filled(df: DataFrame, c: str, v) -> "F.Column":
    dt = df.schema[c].dataType
    if isinstance(dt, (T.StringType, T.BooleanType)):
        return F.coalesce(F.col(c), F.lit(v).cast(dt))
    # pandas holds a numeric column with NaN as float64: filled columns are double
    return F.coalesce(F.col(c).cast("double"), F.lit(float(v)))


def apply_fills(df: DataFrame, fills: dict) -> DataFrame:
    """Apply a fitted ``{column: value}`` map (imputer transform)."""
    return df.select(*[
        (_filled(df, c, fills[c]).alias(c) if fills.get(c) is not None else F.col(c))
        for c in df.columns
    ])
