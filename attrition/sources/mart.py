"""Customer mart: one usage row per customer, built from the star schema.

The reference works on a customer-usage table with 17 feature columns and a
0/1 ``churn`` label.  The driver tables have no such table, so it is derived
here (definition in FIXTURES.md §2): features from orders placed before a
cut-off date, ``churn = 1`` when the customer places no order on or after it.

Plan shape (what ``explain`` shows):
  lineitem --partial agg by l_orderkey--> shuffle(l_orderkey)
  orders   ------------------------------> shuffle(o_orderkey)   join (co-partitioned)
           --partial agg by o_custkey--> shuffle(o_custkey) --> join customer
           (shuffle c_custkey only) --> nation (broadcast by Spark from its bytes).
Every aggregate is algebraic, so a customer holding a third of all orders is
combined map-side and never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.functions.nullsafe import INF, sdiv
from attrition.sources.tables import input_version, read_table

# Fixed values of the synthetic mart (FIXTURES.md §2).
CUTOFF = "2000-08-01"
TENURE_MODULO = 1100
PRICE_CENTER_CENTS = 25_000_000      # 250000.00 in cents
ACTIVITY_SCALE_CENTS = 100_000       # 1000.00 in cents

MART_COLUMNS = [
    "row_id", "telecom_partner", "gender", "age", "state", "city",
    "date_of_registration", "num_dependents", "estimated_salary", "calls_made",
    "sms_sent", "data_used", "customer_tenure_days", "calls_per_day", "sms_per_day",
    "data_per_day", "salary_data_ratio", "activity_score", "churn", "is_train",
]
FEATURE_COLUMNS = MART_COLUMNS[1:18]   # the 17 reference feature columns
CATEGORICALS = ["telecom_partner", "gender", "state", "city"]


def order_usage(spark: SparkSession, sf_dir: str, cutoff: str = CUTOFF) -> DataFrame:
    """Per-customer usage aggregates from orders and lineitem."""
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])
    lines = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_quantity", "l_returnflag"])
    cut = F.to_timestamp(F.lit(cutoff))

    per_order = lines.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.when(F.col("l_returnflag") == "R", -F.col("l_quantity"))
              .otherwise(F.col("l_quantity"))).alias("qty"),
    )
    before = F.col("o_orderdate") < cut
    joined = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
    return (
        joined.groupBy("o_custkey").agg(
            F.count(F.when(before, F.lit(1))).alias("n_orders"),
            F.sum(F.when(before, F.coalesce(F.col("n_lines"), F.lit(0)))).alias("n_lines"),
            F.sum(F.when(before, F.col("qty"))).alias("qty"),
            F.min(F.when(before, F.col("o_orderdate"))).alias("first_order"),
            F.sum(F.when(before, F.round(F.col("o_totalprice") * 100).cast("long"))).alias("cents"),
            F.max(F.when(F.col("o_orderdate") >= cut, F.lit(1)).otherwise(F.lit(0))).alias("active_after"),
        )
        .filter(F.col("n_orders") > 0)
    )


def customer_mart(spark: SparkSession, sf_dir: str, cutoff: str = CUTOFF) -> DataFrame:
    usage = order_usage(spark, sf_dir, cutoff)
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])

    k = F.col("c_custkey")
    tenure = (F.datediff(F.to_date(F.lit(cutoff)), F.to_date("first_order")) % TENURE_MODULO).cast("double")
    salary = F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.lit(20000.0) + F.col("c_acctbal") * 10)
    calls = F.col("n_orders").cast("double")
    sms = F.col("n_lines").cast("double")
    data = F.col("qty").cast("double")

    base = (
        usage.join(cust, usage.o_custkey == cust.c_custkey)
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            k.alias("row_id"),
            F.col("c_mktsegment").alias("telecom_partner"),
            F.when(k % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
            (F.lit(18) + (k * 7) % 63).cast("int").alias("age"),
            F.col("n_name").alias("state"),
            F.concat(F.col("n_name"), F.lit("-"), (k % 10).cast("string")).alias("city"),
            F.date_format("first_order", "yyyy-MM-dd").alias("date_of_registration"),
            (k % 5).cast("int").alias("num_dependents"),
            salary.alias("estimated_salary"),
            calls.alias("calls_made"),
            sms.alias("sms_sent"),
            data.alias("data_used"),
            tenure.alias("customer_tenure_days"),
            ((F.col("cents") - F.col("n_orders") * PRICE_CENTER_CENTS).cast("double")
             / (F.col("n_orders") * ACTIVITY_SCALE_CENTS).cast("double")).alias("activity_score"),
            F.when(F.col("active_after") == 1, F.lit(0)).otherwise(F.lit(1)).alias("churn"),
            (k % 10 != 0).alias("is_train"),
        )
    )
    return base.select(
        *MART_COLUMNS[:13],
        sdiv("calls_made", "customer_tenure_days").alias("calls_per_day"),
        sdiv("sms_sent", "customer_tenure_days").alias("sms_per_day"),
        sdiv("data_used", "customer_tenure_days").alias("data_per_day"),
        F.when(F.col("data_used") == 0,
               F.when(F.col("estimated_salary").isNotNull(), F.lit(INF)))
        .otherwise(sdiv("estimated_salary", "data_used")).alias("salary_data_ratio"),
        "activity_score", "churn", "is_train",
    )


_MATERIALIZED: dict = {}


def materialized_mart(spark: SparkSession, sf_dir: str, cutoff: str = CUTOFF) -> DataFrame:
    """The mart checkpointed once per session and input folder.

    Operators that fit statistics make several passes over their input; with
    the mart in the shared checkpoint folder those passes read a small table
    instead of re-running the lineitem/orders joins (and survive executor loss).
    """
    from attrition.session import cut_lineage
    key = (id(spark.sparkContext), spark.sparkContext.applicationId, sf_dir, input_version(spark, sf_dir), cutoff)
    if key not in _MATERIALIZED:
        _MATERIALIZED[key] = cut_lineage(customer_mart(spark, sf_dir, cutoff))
    return _MATERIALIZED[key]


def train_test(mart: DataFrame):
    """Split the mart into the labelled and the unlabelled table (C14)."""
    train = mart.filter(F.col("is_train")).drop("is_train")
    test = mart.filter(~F.col("is_train")).drop("is_train", "churn")
    return train, test
