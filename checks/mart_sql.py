"""DuckDB text of the customer mart (FIXTURES.md §2), used as a CTE by every oracle."""

MART_CTE = """
per_order AS (
  SELECT l_orderkey, count(*) AS n_lines,
         sum(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END) AS qty
  FROM lineitem GROUP BY l_orderkey
),
usage AS (
  SELECT o.o_custkey,
         count(CASE WHEN o.o_orderdate < TIMESTAMP '2000-08-01' THEN 1 END) AS n_orders,
         sum(CASE WHEN o.o_orderdate < TIMESTAMP '2000-08-01' THEN coalesce(p.n_lines, 0) END) AS n_lines,
         sum(CASE WHEN o.o_orderdate < TIMESTAMP '2000-08-01' THEN p.qty END) AS qty,
         min(CASE WHEN o.o_orderdate < TIMESTAMP '2000-08-01' THEN o.o_orderdate END) AS first_order,
         sum(CASE WHEN o.o_orderdate < TIMESTAMP '2000-08-01' THEN CAST(round(o.o_totalprice * 100) AS BIGINT) END) AS cents,
         max(CASE WHEN o.o_orderdate >= TIMESTAMP '2000-08-01' THEN 1 ELSE 0 END) AS active_after
  FROM orders o LEFT JOIN per_order p ON o.o_orderkey = p.l_orderkey
  GROUP BY o.o_custkey
  HAVING count(CASE WHEN o.o_orderdate < TIMESTAMP '2000-08-01' THEN 1 END) > 0
),
base AS (
  SELECT c.c_custkey AS row_id,
         c.c_mktsegment AS telecom_partner,
         CASE WHEN c.c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CAST(18 + (c.c_custkey * 7) % 63 AS INTEGER) AS age,
         n.n_name AS state,
         n.n_name || '-' || CAST(c.c_custkey % 10 AS VARCHAR) AS city,
         strftime(u.first_order, '%Y-%m-%d') AS date_of_registration,
         CAST(c.c_custkey % 5 AS INTEGER) AS num_dependents,
         CASE WHEN c.c_acctbal < 0 THEN NULL ELSE 20000.0 + c.c_acctbal * 10 END AS estimated_salary,
         CAST(u.n_orders AS DOUBLE) AS calls_made,
         CAST(u.n_lines AS DOUBLE) AS sms_sent,
         CAST(u.qty AS DOUBLE) AS data_used,
         CAST(datediff('day', CAST(u.first_order AS DATE), DATE '2000-08-01') % 1100 AS DOUBLE) AS customer_tenure_days,
         CAST(u.cents - u.n_orders * 25000000 AS DOUBLE) / CAST(u.n_orders * 100000 AS DOUBLE) AS activity_score,
         CASE WHEN u.active_after = 1 THEN 0 ELSE 1 END AS churn,
         (c.c_custkey % 10 <> 0) AS is_train
  FROM usage u JOIN customer c ON u.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
mart AS (
  SELECT row_id, telecom_partner, gender, age, state, city, date_of_registration,
         num_dependents, estimated_salary, calls_made, sms_sent, data_used,
         customer_tenure_days,
         calls_made / nullif(customer_tenure_days, 0) AS calls_per_day,
         sms_sent / nullif(customer_tenure_days, 0) AS sms_per_day,
         data_used / nullif(customer_tenure_days, 0) AS data_per_day,
         CASE WHEN data_used = 0 THEN (CASE WHEN estimated_salary IS NOT NULL THEN CAST('inf' AS DOUBLE) END)
              ELSE estimated_salary / nullif(data_used, 0) END AS salary_data_ratio,
         activity_score, churn, is_train
  FROM base
)"""


def with_mart(body: str, extra_ctes: str = "") -> str:
    """Prefix a query with the mart CTE (and optional further CTEs)."""
    ctes = MART_CTE + ("," + extra_ctes if extra_ctes else "")
    return "WITH " + ctes + "\n" + body
