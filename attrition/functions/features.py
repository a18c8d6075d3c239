"""Derived customer features as Column expressions.

Every builder returns ``[(name, Column), ...]`` so a recipe can lay many of
them into one wide ``select`` (one projection, inside whole-stage codegen).
Builders marked *fitted* take statistics fitted beforehand by
``operators.stats.fit_stats`` (one aggregate per stage).

``t`` below is the tenure clipped at 1 day (C4) unless a builder says "raw".
All divisions are ``try_divide`` (NULL on a zero divisor), the Spark form of
pandas' inf/NaN that the recipes later sweep to NaN.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from attrition.functions.nullsafe import (clip_lower, col, flag, log1p_clip0, right_closed_bins,
                                          safe_div_fill, sdiv, sq)

# Fixed values used by the recipes (reference constants).
AGE_EDGES_FULL = [0, 18, 25, 35, 45, 55, 65, 120]
AGE_EDGES_WIDE = [0, 25, 35, 50, 65, 120]
AGE_EDGES_V2 = [0, 20, 30, 40, 50, 60, 100]
AS_OF_F1 = "2026-06-17"

CALLS, SMS, DATA = "calls_made", "sms_sent", "data_used"
CPD, SPD, DPD = "calls_per_day", "sms_per_day", "data_per_day"
SAL, ACT, AGE, DEPS, TEN = "estimated_salary", "activity_score", "age", "num_dependents", "customer_tenure_days"


def c(name: str) -> Column:
    return F.col(name)


def tenure_clipped() -> Column:
    return clip_lower(TEN, 1.0)


# ---------------------------------------------------------------- dates
def parse_date(column: str = "date_of_registration", strict: bool = False) -> Column:
    """C11: lenient (junk → NULL) or strict (junk raises) date parse."""
    x = F.col(column)
    return F.to_date(F.to_timestamp(x)) if strict else F.to_date(F.try_to_timestamp(x))


def date_parts(d: Column, names: dict) -> list[tuple[str, Column]]:
    """F1–F8. ``names`` maps part → output name; parts: year month day quarter
    weekday dayofyear weekofyear weekend."""
    make = {
        "year": lambda: F.year(d),                                   # F1
        "month": lambda: F.month(d),                                 # F2
        "day": lambda: F.dayofmonth(d),                              # F3
        "quarter": lambda: F.quarter(d),                             # F4
        "weekday": lambda: F.weekday(d),                             # F5 Monday = 0
        "dayofyear": lambda: F.dayofyear(d),                         # F6
        "weekofyear": lambda: F.weekofyear(d),                       # F7 ISO week
        "weekend": lambda: flag(F.weekday(d) >= 5),                  # F8 missing → 0
    }
    return [(out, make[part]()) for part, out in names.items()]


def days_from_min(d: Column, min_date) -> Column:
    """F9 (fitted): days since the earliest date of the fit table."""
    return F.datediff(d, F.lit(min_date).cast("date")) if min_date is not None else F.lit(None).cast("int")


def days_since(d: Column, as_of: str) -> Column:
    """days from ``d`` to a fixed ``as_of`` date."""
    return F.datediff(F.to_date(F.lit(as_of)), d)


# ---------------------------------------------------------------- usage
def total_usage() -> Column:                                        # F11
    return c(CALLS) + c(SMS) + c(DATA)


def shares(total: Column, names=("call_share", "sms_share", "data_share")):   # F12–F14
    return [(n, sdiv(c(x), total + 1)) for n, x in zip(names, (CALLS, SMS, DATA))]


def daily_sum() -> Column:                                          # F21
    return c(CPD) + c(SPD) + c(DPD)


def engagement_variance() -> Column:                                # F22
    return F.abs(c(CPD) - c(SPD) - c(DPD))


def consistency(t: Column):                                         # F24
    return [
        ("call_consistency", sdiv(c(CPD), sdiv(c(CALLS), t) + 1e-6)),
        ("sms_consistency", sdiv(c(SPD), sdiv(c(SMS), t) + 1e-6)),
        ("data_consistency", sdiv(c(DPD), sdiv(c(DATA), t) + 1e-6)),
    ]


def zscore(x: str, mean, std) -> Column:                            # F26 (fitted)
    """(x − mean) / (std_samp + 1); an undefined std (n < 2) gives NULL."""
    if mean is None or std is None:
        return F.lit(None).cast("double")
    return sdiv(c(x) - F.lit(float(mean)), F.lit(float(std) + 1.0))


def above(x: Column, q) -> Column:                                  # F27/F28/F50 (fitted)
    return flag(x > F.lit(q)) if q is not None else F.lit(0)


def below(x: Column, q) -> Column:
    return flag(x < F.lit(q)) if q is not None else F.lit(0)


# ---------------------------------------------------------------- tenure flags
def between(t: Column, lo, hi) -> Column:
    return flag((t >= lo) & (t < hi))


# ---------------------------------------------------------------- logs, bins
def shift_log(x: str, min_value) -> Column:
    """F59 (fitted): log1p(x + shift), shift = |min| + 1 when min ≤ 0, else 0."""
    if min_value is None:
        return F.lit(None).cast("double")
    shift = abs(float(min_value)) + 1.0 if float(min_value) <= 0 else 0.0
    return F.log1p(c(x) + F.lit(shift))


def equal_width_edges(mn, mx, bins: int = 10) -> list[float] | None:
    """Edges of ``pd.cut(x, bins=10)``: linspace(min, max, 11), first edge lowered
    by 0.1 % of the range; a constant column is widened by 0.1 % each side."""
    if mn is None or mx is None:
        return None
    mn, mx = float(mn), float(mx)
    if mn == mx:
        mn -= 0.001 * abs(mn) if mn != 0 else 0.001
        mx += 0.001 * abs(mx) if mx != 0 else 0.001
        edges = np.linspace(mn, mx, bins + 1)
    else:
        edges = np.linspace(mn, mx, bins + 1)
        edges[0] -= (mx - mn) * 0.001
    return [float(e) for e in edges]


def equal_width_bin(x: str, edges: Sequence[float] | None) -> Column:
    """F62 (fitted): (number of edges strictly below x) − 1 on right-closed bins;
    values outside (edges[0], edges[-1]] or missing give NULL."""
    if edges is None:
        return F.lit(None).cast("int")
    v = c(x)
    n_below = sum((v > F.lit(e)).cast("int") for e in edges)
    return F.when((n_below >= 1) & (n_below <= len(edges) - 1), n_below - 1).cast("int")


def age_group(edges) -> Column:                                     # F53
    return right_closed_bins(AGE, edges)


__all__ = [
    "AGE_EDGES_FULL", "AGE_EDGES_WIDE", "AGE_EDGES_V2", "AS_OF_F1", "above", "age_group", "below",
    "between", "c", "clip_lower", "col", "consistency", "daily_sum", "date_parts", "days_from_min",
    "days_since", "engagement_variance", "equal_width_bin", "equal_width_edges", "flag",
    "log1p_clip0", "parse_date", "safe_div_fill", "sdiv", "shares", "shift_log", "sq",
    "tenure_clipped", "total_usage", "zscore",
]
