"""The nine feature recipes of the reference, each as a few wide projections.

| recipe | reference script role                        | width (+row_id, label) |
|--------|----------------------------------------------|------------------------|
| simple | 1-model baseline                             | 27                     |
| fast   | 3 models, plain mean                          | 46                     |
| wide   | 3 models, optional resampling, scaling        | 50                     |
| v2     | 3 models, 2:1.5:2 blend                       | 46                     |
| full   | tuning + blend grid                           | 61                     |
| f1     | OOF target encoding, weight+cut-off search    | 66 before encodings    |
| union  | train ∪ test cleaning                         | 24                     |
| light  | iterative imputation                          | 19                     |
| raw    | raw columns                                   | 17                     |

Every recipe works on one table at a time (fit scope ``self``, as the
reference does) and passes ``row_id`` and the label through untouched.
Statistics a recipe needs are fitted in one aggregate per stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.functions import features as X
from attrition.functions.features import (ACT, AGE, CALLS, CPD, DATA, DEPS, DPD, SAL, SMS, SPD, TEN, c)
from attrition.functions.nullsafe import flag, log1p_clip0, safe_div_fill, sdiv, sq
from attrition.operators.clean import fill_constant, negatives_to_null, sweep_inf
from attrition.operators.stats import fill_median, fit_stats

PASS = ("row_id", "churn", "is_train")
DATE = "date_of_registration"


def _keep(df: DataFrame, drop=(DATE,)):
    return [x for x in df.columns if x not in drop]


def _project(df: DataFrame, new: list[tuple[str, Column]], drop=(DATE,)) -> DataFrame:
    return df.select(*_keep(df, drop), *[e.alias(n) for n, e in new])


def _final_fill(df: DataFrame) -> DataFrame:
    """``replace([inf,-inf], nan)`` then median fill of every numeric column with NULLs."""
    return fill_median(sweep_inf(df), exclude=PASS)


# --------------------------------------------------------------------------- simple
def simple(df: DataFrame) -> DataFrame:
    df = sweep_inf(df)
    d, t = X.parse_date(), X.tenure_clipped()
    new = X.date_parts(d, {"year": "reg_year", "month": "reg_month"})
    new += [
        ("is_new", flag(t < 90)),
        ("is_risky", X.between(t, 30, 180)),
        ("total_usage", X.total_usage()),
        ("daily_engage", X.daily_sum()),
        ("tenure_x_activity", t * c(ACT)),
        ("age_x_usage", c(AGE) * X.daily_sum()),
        ("log_estimated_salary", log1p_clip0(SAL)),
        ("log_calls_made", log1p_clip0(CALLS)),
        ("log_customer_tenure_days", log1p_clip0(TEN)),
    ]
    return _project(df, new)


# --------------------------------------------------------------------------- fast / wide
def _fast_like(df: DataFrame, wide: bool) -> DataFrame:
    df = sweep_inf(df)
    d, t = X.parse_date(), X.tenure_clipped()
    tot = X.total_usage()
    reqs = [("quantile", "_tot", 0.66), ("quantile", ACT, 0.33)]
    if wide:
        reqs += [("min", "_d"), ("quantile", SAL, 0.75)]
    st = fit_stats(df.select(tot.alias("_tot"), d.alias("_d"), c(ACT), c(SAL)), reqs)

    parts = {"year": "reg_year", "month": "reg_month", "quarter": "reg_quarter",
             "weekday": "reg_dayofweek", "weekend": "reg_is_weekend"}
    new = X.date_parts(d, parts)
    if wide:
        new.append(("reg_days_from_min", X.days_from_min(d, st[("min", "_d")])))
    new += [
        ("is_new_customer", flag(t < 90)),
        ("is_churn_risky", X.between(t, 30, 180)),
        ("is_loyal", flag(t >= 365)),
        ("total_usage", tot),
        *X.shares(tot),
        ("daily_engagement", X.daily_sum()),
        ("data_per_call", sdiv(c(DPD), c(CPD) + 1)),
        ("call_intensity", c(CPD) * c(CALLS)),
        ("income_per_usage", sdiv(c(SAL), tot + 1)),
        ("income_per_tenure", sdiv(c(SAL), t + 1)),
    ]
    if wide:
        new.append(("activity_vs_salary", sdiv(c(ACT), c(SAL) + 1)))
    low_eng = X.below(c(ACT), st[("quantile", ACT, 0.33)])
    new += [
        ("age_group", X.age_group(X.AGE_EDGES_WIDE)),
        ("age_tenure_score", c(AGE) * t / 100),
        ("high_usage", X.above(tot, st[("quantile", "_tot", 0.66)])),
        ("low_engagement", low_eng),
    ]
    if wide:
        new.append(("inactive_high_value",
                    (low_eng * X.above(c(SAL), st[("quantile", SAL, 0.75)])).cast("int")))
    new += [
        ("tenure_x_activity", t * c(ACT)),
        ("age_x_usage", c(AGE) * X.daily_sum()),
    ]
    if wide:
        new.append(("salary_x_activity", c(SAL) * c(ACT) / 1e6))
    new += [(f"log_{x}", log1p_clip0(x)) for x in (SAL, CALLS, DATA, TEN)]
    new += [("tenure_sq", sq(t)), ("activity_sq", sq(ACT)), ("age_sq", sq(AGE))]
    return _final_fill(_project(df, new))


def fast(df: DataFrame) -> DataFrame:
    return _fast_like(df, wide=False)


def wide(df: DataFrame) -> DataFrame:
    return _fast_like(df, wide=True)


# --------------------------------------------------------------------------- v2
def v2(df: DataFrame, as_of: str = "2000-08-01") -> DataFrame:
    """``as_of`` replaces the reference's wall-clock "now" (F10) for determinism."""
    df = sweep_inf(df)
    d, t = X.parse_date(), X.tenure_clipped()
    st = fit_stats(df, [("quantile", ACT, 0.25), ("quantile", ACT, 0.75)]
                   + [(k, x) for x in (CALLS, SMS, DATA) for k in ("mean", "std_samp")])
    tot = X.total_usage()
    new = X.date_parts(d, {"year": "reg_year", "month": "reg_month", "day": "reg_day_of_month",
                           "quarter": "reg_quarter"})
    new += [
        ("days_since_reg", X.days_since(d, as_of)),
        ("is_new_customer", flag(t < 30)),
        ("is_churning_risk", X.between(t, 30, 180)),
        ("is_loyal_customer", flag(t > 365)),
        ("tenure_months", t / 30),
        ("total_usage", tot),
        *X.shares(tot, ("call_ratio", "sms_ratio", "data_ratio")),
        ("daily_total", X.daily_sum()),
        ("engagement_variance", X.engagement_variance()),
        ("usage_consistency", sdiv(X.daily_sum(), sdiv(tot, t + 1) + 1)),
        ("age_group", X.age_group(X.AGE_EDGES_V2)),
        ("expense_per_minute_talk", sdiv(c(SAL), c(CALLS) * 2 + 1)),
        ("expense_per_sms", sdiv(c(SAL), c(SMS) + 1)),
        ("expense_per_gb_data", sdiv(c(SAL), c(DATA) + 1)),
        ("low_activity", X.below(c(ACT), st[("quantile", ACT, 0.25)])),
        ("high_activity", X.above(c(ACT), st[("quantile", ACT, 0.75)])),
        ("age_activity_interaction", c(AGE) * c(ACT) / 1000),
        ("tenure_activity_interaction", t * c(ACT) / 1000),
    ]
    for x in (CALLS, SMS, DATA):
        new.append((f"{x}_zscore", X.zscore(x, st[("mean", x)], st[("std_samp", x)])))
        new.append((f"log_{x}", F.log1p(c(x))))
    return _final_fill(_project(df, new))


# --------------------------------------------------------------------------- full
def full(df: DataFrame) -> DataFrame:
    df = fill_median(sweep_inf(df, ["salary_data_ratio"]), exclude=PASS)
    d, t = X.parse_date(), X.tenure_clipped()
    st = fit_stats(df.select(d.alias("_d"), c(DPD), c(CPD), c(ACT)),
                   [("min", "_d"), ("quantile", DPD, 0.75), ("quantile", CPD, 0.75),
                    ("quantile", ACT, 0.25), ("quantile", ACT, 0.1)])
    tot = X.total_usage()
    years = t / 365
    new = X.date_parts(d, {"year": "reg_year", "month": "reg_month", "quarter": "reg_quarter",
                           "weekday": "reg_dayofweek", "dayofyear": "reg_dayofyear",
                           "weekofyear": "reg_weekofyear", "weekend": "reg_is_weekend"})
    new += [
        ("reg_days_from_min", X.days_from_min(d, st[("min", "_d")])),
        ("total_usage", tot),
        *X.shares(tot),
        ("calls_x_sms", c(CALLS) * c(SMS)),
        ("calls_x_data", c(CALLS) * c(DATA)),
        *X.consistency(t),
        ("tenure_months", t / 30),
        ("tenure_years", years),
        ("is_new_customer", flag(t < 90)),
        ("is_mid_tenure", X.between(t, 90, 365)),
        ("is_long_term", flag(t >= 365)),
        ("is_very_long_term", flag(t >= 730)),
        ("income_per_dependent", sdiv(c(SAL), c(DEPS) + 1)),
        ("income_per_tenure_yr", sdiv(c(SAL), years + 0.1)),
        ("income_x_activity", c(SAL) * c(ACT)),
        ("activity_per_tenure", sdiv(c(ACT), t + 1)),
        ("activity_per_call", sdiv(c(ACT), c(CALLS) + 1)),
        ("activity_per_sms", sdiv(c(ACT), c(SMS) + 1)),
        ("activity_x_tenure", c(ACT) * t),
        ("age_group", X.age_group(X.AGE_EDGES_FULL)),
        ("age_x_tenure", c(AGE) * t),
        ("age_x_activity", c(AGE) * c(ACT)),
        ("high_data_user", X.above(c(DPD), st[("quantile", DPD, 0.75)])),
        ("high_call_user", X.above(c(CPD), st[("quantile", CPD, 0.75)])),
        ("low_activity", X.below(c(ACT), st[("quantile", ACT, 0.25)])),
        ("very_low_activity", X.below(c(ACT), st[("quantile", ACT, 0.1)])),
        ("negative_activity", flag(c(ACT) < 0)),
    ]
    new += [(f"log_{x}", log1p_clip0(x)) for x in (SAL, CALLS, DATA, TEN)]
    new += [("salary_sq", sq(SAL)), ("tenure_sq", sq(t)), ("activity_sq", sq(ACT))]
    return _final_fill(_project(df, new))


# --------------------------------------------------------------------------- f1
F1_LOG_COLUMNS = [SAL, DATA, ACT, TEN, CALLS, SMS]
F1_BIN_COLUMNS = [(AGE, "age_bin"), (SAL, "salary_bin"), (TEN, "tenure_bin"), (DATA, "data_bin")]


def f1(df: DataFrame, strict_dates: bool = False) -> DataFrame:
    """Feature part of the OOF-target-encoding recipe (encodings: ``encode``).

    The reference parses the date strictly; ``strict_dates=True`` keeps that
    (junk raises), the default is lenient so one bad row cannot fail a job.
    """
    df = fill_median(df, [SAL, SMS, DATA])
    df = df.withColumn("salary_data_ratio", safe_div_fill(SAL, DATA, 0.0))
    d, raw = X.parse_date(strict=strict_dates), c(TEN)
    st = fit_stats(df, [("min", x) for x in F1_LOG_COLUMNS]
                   + [(k, x) for x, _ in F1_BIN_COLUMNS for k in ("min", "max")])
    comm = c(CALLS) + c(SMS)

    def z(a, b):
        return safe_div_fill(a, b, 0.0)

    new = X.date_parts(d, {"year": "reg_year", "month": "reg_month", "weekday": "reg_day_of_week",
                           "quarter": "reg_quarter", "weekend": "reg_is_weekend",
                           "dayofyear": "reg_day_of_year", "weekofyear": "reg_week_of_year"})
    new += [
        ("days_since_registration", X.days_since(d, X.AS_OF_F1)),
        ("total_comm", comm),
        ("calls_sms_ratio", z(c(CALLS), c(SMS) + 1)),
        ("sms_calls_ratio", z(c(SMS), c(CALLS) + 1)),
        ("comm_per_day", z(comm, raw + 1)),
        ("calls_pct", z(c(CALLS), comm + 1)),
        ("sms_pct", z(c(SMS), comm + 1)),
        ("data_per_tenure", z(c(DATA), raw + 1)),
        ("data_calls_ratio", z(c(DATA), c(CALLS) + 1)),
        ("salary_per_dependent", z(c(SAL), c(DEPS) + 1)),
        ("salary_comm_ratio", z(c(SAL), comm + 1)),
        ("salary_per_tenure", z(c(SAL), raw + 1)),
        ("activity_per_tenure", z(c(ACT), raw + 1)),
        ("activity_per_call", z(c(ACT), c(CALLS) + 1)),
        ("activity_salary_ratio", z(c(ACT), c(SAL) + 1)),
        ("activity_data_ratio", z(c(ACT), c(DATA) + 1)),
        ("is_senior", flag(c(AGE) >= 60)),
        ("is_young", flag(c(AGE) <= 25)),
        ("is_middle_aged", flag((c(AGE) > 35) & (c(AGE) <= 55))),
        ("tenure_years", raw / 365.25),
        ("is_new_customer", flag(raw <= 365)),
        ("is_long_term", flag(raw >= 1460)),
        ("age_x_tenure", c(AGE) * raw),
        ("salary_x_data", c(SAL) * c(DATA)),
        ("calls_x_sms", c(CALLS) * c(SMS)),
        ("deps_x_salary", c(DEPS) * c(SAL)),
        ("age_x_salary", c(AGE) * c(SAL)),
        ("age_x_activity", c(AGE) * c(ACT)),
        ("tenure_x_activity", raw * c(ACT)),
    ]
    new += [(f"{x}_log", X.shift_log(x, st[("min", x)])) for x in F1_LOG_COLUMNS]
    new += [("age_sq", sq(AGE)), ("tenure_sq", sq(raw)), ("salary_sq", sq(SAL))]
    new += [(name, X.equal_width_bin(x, X.equal_width_edges(st[("min", x)], st[("max", x)])))
            for x, name in F1_BIN_COLUMNS]
    out = sweep_inf(_project(df, new))
    return fill_constant(out, numeric=0, text="0", exclude=PASS)


# --------------------------------------------------------------------------- union
def union(mart: DataFrame) -> DataFrame:
    """Cleaning on train ∪ test (R1 → C1, C2, dates, ratios, C8 union median, C5 "Missing").

    Input is the combined table with ``is_train``; split back with C14.
    """
    df = negatives_to_null(sweep_inf(mart))
    d = X.parse_date()
    new = X.date_parts(d, {"year": "registration_year", "month": "registration_month",
                           "day": "registration_day", "weekday": "registration_weekday"})
    new += [
        ("engagement_ratio", X.daily_sum()),
        ("salary_per_call", sdiv(c(SAL), c(CALLS) + 1)),
        ("salary_per_sms", sdiv(c(SAL), c(SMS) + 1)),
        ("salary_per_data", sdiv(c(SAL), c(DATA) + 1)),
    ]
    out = fill_median(_project(df, new), exclude=PASS)
    return fill_constant(out, text="Missing", cols=["telecom_partner", "gender", "state", "city"])


# --------------------------------------------------------------------------- light / raw
def light(df: DataFrame) -> DataFrame:
    """Features before iterative imputation: tenure in months (÷30.44), registration year/month."""
    d = X.parse_date()
    new = [("tenure_months", c(TEN) / 30.44)]
    new += X.date_parts(d, {"year": "reg_year", "month": "reg_month"})
    return _project(df, new)


def raw(df: DataFrame) -> DataFrame:
    """Raw columns only."""
    return df


RECIPES = {"simple": simple, "fast": fast, "wide": wide, "v2": v2, "full": full, "f1": f1,
           "union": union, "light": light, "raw": raw}

# Recipes whose engineered table is taken as is; others need the
# encoders (plans/oof.py) before training.
