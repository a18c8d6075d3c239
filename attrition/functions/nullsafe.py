"""Null-safe Column helpers that reproduce pandas semantics on Spark.

Missing is always SQL NULL (never NaN); every helper keeps NULL as NULL the
way pandas keeps NaN, and flags turn a missing comparison into 0 like
``(series > x).astype(int)`` does.
"""

from __future__ import annotations

from typing import Union

from pyspark.sql import Column
from pyspark.sql import functions as F

ColLike = Union[Column, str]

INF = float("inf")


def col(c: ColLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: ColLike) -> Column:
    """NaN, +inf and -inf become NULL (pandas ``replace([inf, -inf], nan)``)."""
    c = col(c)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(INF)), F.lit(None)).otherwise(c)


def neg_to_null(c: ColLike) -> Column:
    c = col(c)
    return F.when(c < 0, F.lit(None)).otherwise(c)


def clip_lower(c: ColLike, lo: float) -> Column:
    """``Series.clip(lower=lo)``: NULL stays NULL (unlike ``greatest``)."""
    c = col(c)
    return F.when(c < lo, F.lit(lo)).otherwise(c)


def clip(c: ColLike, lo, hi) -> Column:
    c = col(c)
    return F.when(c < lo, F.lit(lo)).when(c > hi, F.lit(hi)).otherwise(c)


def sdiv(a: ColLike, b: ColLike) -> Column:
    """Division with NULL for a zero or missing divisor (pandas inf/NaN, then swept to NaN)."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def safe_div_fill(a: ColLike, b: ColLike, fill: float = 0.0) -> Column:
    """a/b with inf/NaN/NULL replaced by ``fill``."""
    return F.coalesce(sdiv(a, b), F.lit(float(fill)))


def flag(cond: Column) -> Column:
    """``(cond).astype(int)`` where a missing operand gives 0."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def log1p_clip0(c: ColLike) -> Column:
    """``np.log1p(x.clip(lower=0))``."""
    return F.log1p(clip_lower(c, 0.0))


def sq(c: ColLike) -> Column:
    c = col(c)
    return c * c


def right_closed_bins(c: ColLike, edges) -> Column:
    """``pd.cut(x, bins=edges, labels=False)``: bin i holds (edges[i], edges[i+1]].

    Values at or below the first edge, above the last edge, or missing give NULL.
    """
    c = col(c)
    expr = None
    for i in range(len(edges) - 1):
        cond = (c > F.lit(edges[i])) & (c <= F.lit(edges[i + 1]))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(None).cast("int"))
