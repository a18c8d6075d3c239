"""Category encoders and scaling.

Category statistics are small per key but the number of keys is not bounded
in general.  They are written once, so that Spark knows their bytes, and joined
without a hint: Spark broadcasts them below its byte threshold and otherwise
shuffles, where AQE splits a key that holds a large share of the rows.
Fitting never collects category values on the driver.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.operators.folds import fold_hash
from attrition.operators.ordered import rank_within, running_sums
from attrition.operators.stats import fit_stats
from attrition.session import cut_lineage

MISSING = "nan"           # pandas astype(str) of a missing value
SMOOTHING = 20            # reference smoothing weight m


def as_key(c: str, missing: str = MISSING):
    return F.coalesce(F.col(c).cast("string"), F.lit(missing))


def lookup_join(df: DataFrame, stats: DataFrame, on: Sequence[str]) -> DataFrame:
    """R2: left join of a per-key statistics table."""
    return df.join(stats, list(on), "left")


def combo_key(df: DataFrame, a: str, b: str, out: str | None = None, sep: str = "_") -> DataFrame:
    """Composite key ``a_b`` of the string forms (missing → "nan")."""
    return df.withColumn(out or f"{a}_{b}", F.concat_ws(sep, as_key(a), as_key(b)))


# ---------------------------------------------------------------- N1 / N2 ordinal codes
def fit_ordinal(fit: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Codes of the sorted distinct string values (code-point order), one table
    ``(column_name, value, code)`` for all columns; missing is the value "nan"."""
    cols = list(cols)
    stacked = fit.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), as_key(c).alias("value")) for c in cols])).alias("kv"))
    distinct = stacked.select("kv.column_name", "kv.value").distinct()   # one scan of the data
    codes = rank_within(distinct, ["value"], ["column_name"], out="code").withColumn("code", F.col("code").cast("int"))
    return cut_lineage(codes)   # one row per distinct value; every lookup below reads it


def apply_ordinal(df: DataFrame, codes: DataFrame, cols: Sequence[str], suffix: str = "",
                  unseen: int | None = None) -> DataFrame:
    """Replace (or add ``<col><suffix>``) codes; an unseen value gives ``unseen`` (NULL)."""
    out = df
    for c in cols:
        name = c + suffix
        m = codes.where(F.col("column_name") == c).select(F.col("value").alias("_v"), F.col("code").alias("_code"))
        out = out.withColumn("_v", as_key(c)).join(m, ["_v"], "left")
        val = F.col("_code") if unseen is None else F.coalesce(F.col("_code"), F.lit(unseen))
        out = out.withColumn(name, val).drop("_v", "_code")
    return out


def ordinal_encode(train: DataFrame, test: DataFrame | None, cols: Sequence[str], scope: str = "union",
                   suffix: str = ""):
    """N1 (scope union: fitted on train ∪ test) and N2 (scope self)."""
    if scope == "union" and test is not None:
        fit = train.select(*cols).unionByName(test.select(*cols))
        codes = fit_ordinal(fit, cols)
        return apply_ordinal(train, codes, cols, suffix), apply_ordinal(test, codes, cols, suffix)
    tr = apply_ordinal(train, fit_ordinal(train, cols), cols, suffix)
    te = apply_ordinal(test, fit_ordinal(test, cols), cols, suffix) if test is not None else None
    return tr, te


# ---------------------------------------------------------------- shared: one stacked pass
def _stacked(df: DataFrame, cols: Sequence[str], extra: Sequence[tuple] = (), missing: str | None = MISSING) -> DataFrame:
    """(column_name, k, *extra) rows for every input row and column, generated in-task.
    ``extra`` is a list of (name, Column) carried along."""
    key = (lambda c: as_key(c, missing)) if missing is not None else (lambda c: F.col(c).cast("string"))
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), key(c).alias("k")) for c in cols]))
    return (df.select(*[e.alias(n) for n, e in extra], kv.alias("kv"))
            .select("kv.column_name", "kv.k", *[n for n, _ in extra]))


def _lookup(out: DataFrame, stats: DataFrame, c: str, on_extra: Sequence[str], missing: str | None = MISSING) -> DataFrame:
    m = stats.where(F.col("column_name") == c).drop("column_name")
    key = as_key(c, missing) if missing is not None else F.col(c).cast("string")
    return out.withColumn("k", key).join(m, ["k", *on_extra], "left").drop("k")


# ---------------------------------------------------------------- N3 frequency
def frequency_encode(df: DataFrame, fit: DataFrame, cols: Sequence[str], suffix: str = "_freq",
                     default: float = 0.0) -> DataFrame:
    """Share of each value among the non-missing values of ``fit``;
    unseen or missing → ``default``.  One stacked aggregate for all columns."""
    nn = fit_stats(fit, [("count", c) for c in cols])
    counts = (_stacked(fit, cols, missing=None).where(F.col("k").isNotNull())
              .groupBy("column_name", "k").agg(F.count(F.lit(1)).alias("_n")))
    totals = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(float(nn[("count", c)] or 1)))])
    stats = cut_lineage(counts.select("column_name", "k", (F.col("_n") / totals[F.col("column_name")]).alias("_share")))
    out = df
    for c in cols:
        out = _lookup(out, stats, c, [], missing=None)
        out = out.withColumn(c + suffix, F.coalesce(F.col("_share"), F.lit(default))).drop("_share")
    return out


# ---------------------------------------------------------------- N4 / N5 target means
def target_encode_oof(df: DataFrame, cols: Sequence[str], fold_col: str = "fold", label: str = "churn",
                      m: float = SMOOTHING, prior: str = "other_folds", unseen: str = "prior",
                      suffix: str = "_te") -> DataFrame:
    """Leave-one-fold-out smoothed target mean, with no loop over folds.

    For a row in fold f:  s = Σy over key minus Σy over (key, f),  n likewise;
    value = (s + g·m) / (n + m).  ``prior``: ``other_folds`` (g from the other
    folds, leak-free) or ``full`` (g from all train rows, as the reference).
    ``unseen`` (n = 0): ``prior`` → g (default) or ``zero`` → 0 (the reference's
    map-miss followed by fillna(0)).

    ONE scan for all columns: rows are stacked to (column, key, fold, y) in-task
    and aggregated map-side per (column, key, fold); per-key totals are a window
    over the ≤ k fold rows of each key.  A key holding a third of all rows is
    one aggregate row per fold, never one task's worth of rows.
    """
    from pyspark.sql.window import Window
    y = F.col(label).cast("double")
    fold_stats = df.groupBy(fold_col).agg(F.sum(y).alias("_fs"), F.count(F.lit(1)).alias("_fn"))
    tot = fit_stats(df, [("sum", label), ("count", label)])
    s_all, n_all = float(tot[("sum", label)] or 0.0), float(tot[("count", label)] or 0)
    kf = (_stacked(df, cols, [(fold_col, F.col(fold_col)), ("_y", y)])
          .groupBy("column_name", "k", fold_col).agg(F.sum("_y").alias("_kfs"), F.count(F.lit(1)).alias("_kfn")))
    w = Window.partitionBy("column_name", "k")
    stats = cut_lineage(kf.withColumn("_ks", F.sum("_kfs").over(w)).withColumn("_kn", F.sum("_kfn").over(w)))
    out = df.join(F.broadcast(fold_stats), fold_col, "left")  # ≤ k rows
    if prior == "full":
        g = F.lit(s_all / n_all if n_all else 0.0)
    else:
        g = F.try_divide(F.lit(s_all) - F.col("_fs"), F.lit(n_all) - F.col("_fn"))
    for c in cols:
        out = _lookup(out, stats, c, [fold_col])
        n = F.col("_kn") - F.col("_kfn")
        s = F.col("_ks") - F.col("_kfs")
        enc = (s + g * m) / (n + m)
        miss = g if unseen == "prior" else F.lit(0.0)
        out = out.withColumn(c + suffix, F.when(n > 0, enc).otherwise(miss).cast("double")) \
                 .drop("_ks", "_kn", "_kfs", "_kfn")
    return out.drop("_fs", "_fn")


def target_encode_fit_apply(train: DataFrame, test: DataFrame, cols: Sequence[str], label: str = "churn",
                            m: float = SMOOTHING, suffix: str = "_te") -> DataFrame:
    """Smoothed target mean from all train rows applied to ``test``; unseen → g.
    One stacked aggregate over train for all columns."""
    y = F.col(label).cast("double")
    tot = fit_stats(train, [("sum", label), ("count", label)])
    n_all = float(tot[("count", label)] or 0)
    g = float(tot[("sum", label)] or 0.0) / n_all if n_all else 0.0
    stats = cut_lineage(
        _stacked(train, cols, [("_y", y)]).groupBy("column_name", "k").agg(
            ((F.sum("_y") + F.lit(g * m)) / (F.count(F.lit(1)) + F.lit(m))).alias("_enc")))
    out = test
    for c in cols:
        out = _lookup(out, stats, c, [])
        out = out.withColumn(c + suffix, F.coalesce(F.col("_enc"), F.lit(g))).drop("_enc")
    return out


# ---------------------------------------------------------------- N8 ordered target statistics
def ordered_target_encode(df: DataFrame, cols: Sequence[str], label: str = "churn", id_col: str = "row_id", seed: int = 42,
                          weight: float = 1.0, prior: float = 0.5, suffix: str = "_ots") -> DataFrame:
    """Categories of any arity as numbers, without a row's own label.

    Rows stand in a seeded order (md5 of seed and id).  A row's value for a category is the
    smoothed mean label of the rows before it that share the category:
    ``(Σy + prior·weight) / (n + weight)``; the first one gets ``prior``, a constant, so that no
    label leaks through it.  A missing category is a category of its own; a NULL label
    counts nowhere.  ``id_col`` must be unique and not NULL.

    All columns at once: rows are stacked to (column, key, order, y), and running sums over
    range partitions spread a hot category over several tasks.
    """
    y = F.col(label).cast("double")
    stacked = _stacked(df, cols, [("_id", F.col(id_col)), ("_h", fold_hash(seed, id_col)), ("_y", F.coalesce(y, F.lit(0.0))),
                                  ("_n", y.isNotNull().cast("int"))])
    sums = running_sums(stacked, ["_h", "_id"], ["_y", "_n"], ["column_name", "k"])
    value = (F.col("cum__y") - F.col("_y") + F.lit(prior * weight)) / (F.col("cum__n") - F.col("_n") + F.lit(float(weight)))
    wide = sums.groupBy(F.col("_id").alias(id_col)).agg(*[F.max(F.when(F.col("column_name") == c, value)).alias(c + suffix) for c in cols])
    return df.join(wide, id_col, "left")


def ordered_target_apply(train: DataFrame, test: DataFrame, cols: Sequence[str], label: str = "churn", weight: float = 1.0,
                         prior: float = 0.5, suffix: str = "_ots") -> DataFrame:
    """N8 for rows without a label: the same mean over all rows of ``train``; an unseen
    category gets ``prior``."""
    stats = cut_lineage(
        _stacked(train, cols, [("_y", F.col(label).cast("double"))]).groupBy("column_name", "k").agg(
            ((F.coalesce(F.sum("_y"), F.lit(0.0)) + F.lit(prior * weight)) / (F.count("_y") + F.lit(float(weight)))).alias("_enc")))
    out = test
    for c in cols:
        out = _lookup(out, stats, c, [])
        out = out.withColumn(c + suffix, F.coalesce(F.col("_enc"), F.lit(prior))).drop("_enc")
    return out


# ---------------------------------------------------------------- N7 one-hot, N9 scaling
def one_hot_wide(df: DataFrame, cols: Sequence[str], max_values: int = 1000, drop: bool = True) -> DataFrame:
    """N7 (``pd.get_dummies``): one 0/1 column ``<col>_<value>`` per value.

    Column names must be known to build a wide table, so the distinct values
    are read – after a bounded check of their number (``max_values`` per
    column); wider columns belong in ``one_hot_vector``.
    """
    out = df
    for c in cols:
        vals = df.select(c).where(F.col(c).isNotNull()).distinct().limit(max_values + 1).collect()
        if len(vals) > max_values:
            raise ValueError(f"{c}: more than {max_values} values; use one_hot_vector")
        names = sorted(v[0] for v in vals)
        out = out.select(*out.columns, *[(F.col(c) == F.lit(v)).cast("int").alias(f"{c}_{v}") for v in names])
        if drop:
            out = out.drop(c)
    return out


def one_hot_vector(df: DataFrame, cols: Sequence[str], suffix: str = "_ohe"):
    """N7 for any width: StringIndexer + OneHotEncoder(dropLast=False) → sparse vectors."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep",
                         stringOrderType="alphabetAsc") for c in cols]
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in cols], outputCols=[c + suffix for c in cols],
                        dropLast=False)
    return Pipeline(stages=idx + [ohe]).fit(df)


def fit_standardize(fit: DataFrame, cols: Sequence[str]) -> dict:
    """N9 fit: mean and population std per column in one aggregate (std 0 → 1)."""
    st = fit_stats(fit, [(k, c) for c in cols for k in ("mean", "std_pop")])
    out = {}
    for c in cols:
        sd = st[("std_pop", c)]
        out[c] = (st[("mean", c)], sd if sd not in (None, 0.0) else 1.0)
    return out


def apply_standardize(df: DataFrame, params: dict) -> DataFrame:
    """N9 transform: (x − mean) / std as one projection."""
    return df.select(*[
        ((F.col(c) - F.lit(params[c][0])) / F.lit(params[c][1])).alias(c)
        if c in params and params[c][0] is not None else F.col(c)
        for c in df.columns])
