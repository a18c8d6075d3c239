"""Hand-made edge rows (FIXTURES.md §3) with exact expected output."""
import math

from pyspark.sql import functions as F

from attrition.functions import features as X
from attrition.functions.nullsafe import flag, log1p_clip0, sdiv
from attrition.operators import clean as C
from attrition.operators import evaluate as V
from attrition.operators import profile as E
from attrition.operators.stats import fill_median
from attrition.sources import io as S


def test_infinity_and_nan_become_null_then_median(spark):
    df = spark.createDataFrame([(1, math.inf), (2, -math.inf), (3, math.nan), (4, 1.0), (5, 3.0)], "id int, x double")
    out = fill_median(C.sweep_inf(df), exclude=["id"]).orderBy("id").collect()
    assert [r.x for r in out] == [2.0, 2.0, 2.0, 1.0, 3.0]


def test_zero_divisor_and_negative_usage(spark):
    df = spark.createDataFrame([(10.0, -1.0, -3.0)], "s double, d double, calls double")
    r = df.select(sdiv("s", F.col("d") + 1).alias("ratio"), log1p_clip0("calls").alias("lg"),
                  X.safe_div_fill("s", F.col("d") + 1, 0.0).alias("filled")).first()
    assert r.ratio is None and r.lg == 0.0 and r.filled == 0.0
    neg = C.negatives_to_null(df.withColumnRenamed("calls", "calls_made")).first()
    assert neg.calls_made is None


def test_tenure_flags(spark):
    vals = [0, 1, 29, 30, 89, 90, 179, 180, 364, 365, 366, 729, 730, 1459, 1460, None]
    df = spark.createDataFrame([(v if v is None else float(v),) for v in vals], "customer_tenure_days double")
    t = X.tenure_clipped()
    rows = df.select(flag(t < 90).alias("new"), X.between(t, 30, 180).alias("risky"),
                     X.between(t, 90, 365).alias("mid"), flag(t >= 365).alias("long"),
                     flag(t >= 730).alias("vlong"), flag(F.col("customer_tenure_days") >= 1460).alias("f1long")).collect()
    got = [(r.new, r.risky, r.mid, r.long, r.vlong, r.f1long) for r in rows]
    assert got[0] == (1, 0, 0, 0, 0, 0)            # 0 → clipped to 1
    assert got[3] == (1, 1, 0, 0, 0, 0)            # 30
    assert got[5] == (0, 1, 1, 0, 0, 0)            # 90
    assert got[9] == (0, 0, 0, 1, 0, 0)            # 365
    assert got[12] == (0, 0, 0, 1, 1, 0)           # 730
    assert got[14] == (0, 0, 0, 1, 1, 1)           # 1460
    assert got[15] == (0, 0, 0, 0, 0, 0)           # NULL → all flags 0


def test_age_groups_right_closed(spark):
    ages = [0, 18, 19, 25, 26, 35, 60, 65, 120, 121]
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    got = [r.g for r in df.select(X.age_group(X.AGE_EDGES_FULL).alias("g")).collect()]
    assert got == [None, 0, 1, 1, 2, 2, 5, 5, 6, None]


def test_dates(spark):
    df = spark.createDataFrame([("2023-01-01",), ("2024-02-29",), ("not-a-date",), ("",)], "date_of_registration string")
    d = X.parse_date()
    rows = df.select(*[e.alias(n) for n, e in X.date_parts(d, {"weekday": "wd", "weekofyear": "wk", "weekend": "we",
                                                                 "dayofyear": "doy"})]).collect()
    assert (rows[0].wd, rows[0].wk, rows[0].we) == (6, 52, 1)
    assert rows[1].doy == 60
    assert (rows[2].wd, rows[2].we) == (None, 0) and (rows[3].wd, rows[3].we) == (None, 0)


def test_all_null_and_constant_columns(spark):
    df = spark.createDataFrame([(1, None, 5.0, 0), (2, None, 5.0, 1), (3, None, 5.0, 1)],
                               "id int, a double, c double, churn int")
    filled = fill_median(df, exclude=["id", "churn"]).collect()
    assert all(r.a is None for r in filled)
    corr = {r.column_name: r.corr for r in E.label_correlations(df.drop("a")).collect()}
    assert corr["c"] is None and corr["churn"] == 1.0
    edges = X.equal_width_edges(5.0, 5.0)
    bins = {r.b for r in df.select(X.equal_width_bin("c", edges).alias("b")).collect()}
    assert len(bins) == 1


def test_score_ties_and_grid_points(spark):
    # p exactly on grid points and ties; >= is inclusive
    rows = [(0.5, 1), (0.25, 1), (0.25, 0), (0.25, 0), (0.1, 0)]   # F1 = 2/3 at both cut-offs
    df = spark.createDataFrame(rows, "p double, label int")
    g = [0.25, 0.5]
    curve = {r.threshold: (r.tp, r.fp, r.f1) for r in V.grid_curve(df, g, "p", "label").collect()}
    assert curve[0.25][:2] == (2, 2) and curve[0.5][:2] == (1, 0) and curve[0.25][2] == curve[0.5][2]
    best = V.best_threshold(df, g, "p", "label").first()
    assert best.best_threshold == 0.25                # equal F1 → lowest cut-off
    hi = V.best_threshold(df, g, "p", "label", tie="highest").first()
    assert hi.best_threshold == 0.5
    zero = spark.createDataFrame([(0.9, 0), (0.1, 0)], "p double, label int")
    z = V.best_threshold(zero, g, "p", "label").first()
    assert (z.best_threshold, z.best_f1) == (0.5, 0.0)
    ex = V.best_f1_exact(df, "p", "label").first()
    assert ex.best_threshold == 0.25


def test_output_check_fails_on_bad_ids(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (None, 1), (5, 2)], "id long, churn int")
    res = {r.rule: r.passed for r in S.output_check(df, 4).collect()}
    assert res["columns"] and res["row_count"]
    assert not res["unique_ids"] and not res["no_nulls"] and not res["label_domain"] and not res["id_range"]


def test_csv_tokens_and_latin1(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_bytes("id,city,x\n1,M\xfcnchen,inf\n2,NA,-inf\n3,Paris,nan\n".encode("latin-1"))
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("city", T.StringType()),
                           T.StructField("x", T.DoubleType())])
    rows = S.load_csv(spark, str(p), schema).orderBy("id").collect()
    assert rows[0].city == "München" and rows[0].x == math.inf
    assert rows[1].city is None and rows[1].x == -math.inf
    assert math.isnan(rows[2].x)
