"""The same computations stated as ANSI SQL (DuckDB dialect) over the driver
tables, used as an independent oracle for every registered query.

Each query is ``WITH <needed CTEs> <body>``; CTEs are pulled in through their
declared dependencies. Rounding, exact sums and averages are written with the
same arithmetic as ``towerlens.functions`` so both engines give identical
doubles.
"""

from __future__ import annotations

# Fixed values of the specification, stated here again so that a wrong constant in the code under test cannot pass.
DEFAULT_AS_OF = "2026-05-26"
MAX_CALL_SECONDS = 86400
TENURE_EDGES = [-1, 6, 12, 24, 48, 100]
TENURE_LABELS = ["0-6mo", "6-12mo", "1-2yr", "2-4yr", "4yr+"]
ENGAGEMENT_SQL_EDGES = [25, 50, 75]
ENGAGEMENT_SQL_LABELS = ["1_Low (0-25)", "2_Mid-Low (25-50)", "3_Mid-High (50-75)", "4_High (75-100)"]
ENGAGEMENT_DASH_EDGES = [-1, 25, 50, 75, 101]
ENGAGEMENT_DASH_LABELS = ["Low (0-25)", "Mid-Low (25-50)", "Mid-High (50-75)", "High (75-100)"]
MONTH_TO_MONTH = "Month-to-month"
AT_RISK_MIN_MONTHLY = 70
HIGH_RISK_MIN_CUSTOMERS = 50


# ----------------------------------------------------------------- helpers
def dbl(v) -> str:
    return f"CAST({v} AS DOUBLE)"


def re_(x: str, n: int) -> str:
    """round half even on the scaled double (== Spark rint form)."""
    s = dbl(10 ** n)
    return f"(round_even(({x}) * {s}, 0) / {s})"


def ru(x: str, n: int) -> str:
    """SQL ROUND, half away from zero, via floor."""
    s = dbl(10 ** n)
    return (f"(CASE WHEN ({x}) >= 0 THEN floor(({x}) * {s} + {dbl(0.5)}) / {s} "
            f"ELSE -floor(-({x}) * {s} + {dbl(0.5)}) / {s} END)")


def sumx(x: str) -> str:
    head = f"CAST({x} AS DECIMAL(38,9))"
    return f"(CAST(SUM({head}) AS DOUBLE) + SUM(CAST({x} AS DOUBLE) - CAST({head} AS DOUBLE)))"


def avgx(x: str) -> str:
    return f"({sumx(x)} / COUNT({x}))"


def pct(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / ({den}) * 100)"


def right_bins(x: str, edges, labels) -> str:
    arms = " ".join(f"WHEN {x} > {lo} AND {x} <= {hi} THEN '{lab}'"
                    for lo, hi, lab in zip(edges[:-1], edges[1:], labels))
    return f"(CASE {arms} ELSE NULL END)"


def left_case(x: str, edges, labels) -> str:
    arms = " ".join(f"WHEN {x} < {hi} THEN '{lab}'" for hi, lab in zip(edges, labels[:-1]))
    return f"(CASE {arms} ELSE '{labels[-1]}' END)"


def keep_first(src: str, key: str, order: list[str], drop: list[str] | None = None) -> str:
    order_sql = ", ".join(f"{c} ASC NULLS FIRST" for c in order)
    excl = ", ".join(["_rn"] + (drop or []))
    return (f"SELECT * EXCLUDE ({excl}) FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {key} ORDER BY {order_sql}) AS _rn FROM {src}) WHERE _rn = 1")


def svc(mod: int) -> str:
    return (f"CASE WHEN InternetService = 'No' THEN 'No internet service' "
            f"WHEN c_custkey % {mod} = 1 THEN 'Yes' ELSE 'No' END")


MONTHLY_DEC = ("CAST(CAST(CAST(floor(c_acctbal + 1000) AS BIGINT) AS DECIMAL(10,0)) "
               "* CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(8,2))")

# ------------------------------------------------------------------ CTEs
# name -> (sql, dependencies)
CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, deps: list[str], sql: str) -> None:
    CTES[name] = (sql, deps)


cte("cust_base", [], f"""
SELECT c_custkey, c_nationkey, c_mktsegment, {MONTHLY_DEC} AS m_dec, copy,
  CAST(CASE WHEN copy = 1 THEN 0 ELSE c_custkey * 7 % 76 END AS INTEGER) AS tenure,
  CASE c_nationkey % 3 WHEN 0 THEN 'DSL' WHEN 1 THEN 'Fiber optic' ELSE 'No' END AS InternetService,
  CASE WHEN c_custkey % 10 = 4 THEN 'No' ELSE 'Yes' END AS PhoneService
FROM (SELECT *, 0 AS copy FROM customer UNION ALL SELECT *, 1 AS copy FROM customer WHERE c_custkey % 60 = 8)""")

cte("customers_raw", ["cust_base"], f"""
SELECT CAST(c_custkey AS VARCHAR) AS customerID,
  CASE WHEN copy = 1 THEN 'Agender' WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  CAST(c_custkey % 6 = 0 AS INTEGER) AS SeniorCitizen,
  CASE WHEN c_custkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS Partner,
  CASE WHEN c_custkey % 45 = 11 THEN NULL WHEN c_custkey % 5 = 0 THEN 'Yes' ELSE 'No' END AS Dependents,
  tenure,
  PhoneService,
  CASE WHEN PhoneService = 'No' THEN 'No phone service' WHEN c_custkey % 4 = 1 THEN 'Yes' ELSE 'No' END AS MultipleLines,
  InternetService,
  {svc(3)} AS OnlineSecurity, {svc(4)} AS OnlineBackup, {svc(5)} AS DeviceProtection,
  {svc(7)} AS TechSupport, {svc(2)} AS StreamingTV, {svc(9)} AS StreamingMovies,
  CASE WHEN c_mktsegment IN ('BUILDING','MACHINERY') THEN 'Month-to-month'
       WHEN c_mktsegment = 'AUTOMOBILE' THEN 'One year' ELSE 'Two year' END AS Contract,
  CASE WHEN c_custkey % 8 < 5 THEN 'Yes' ELSE 'No' END AS PaperlessBilling,
  CASE c_nationkey % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
       WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END AS PaymentMethod,
  CAST(m_dec AS DOUBLE) AS MonthlyCharges,
  CASE WHEN tenure = 0 THEN ' ' WHEN c_custkey % 50 = 7 THEN 'n/a'
       ELSE CAST(CAST(m_dec * tenure AS DECIMAL(12,2)) AS VARCHAR) END AS TotalCharges,
  CASE WHEN c_custkey * 31 % 100 < (CASE WHEN c_mktsegment IN ('BUILDING','MACHINERY') THEN 43
       WHEN c_mktsegment = 'AUTOMOBILE' THEN 11 ELSE 3 END) THEN 'Yes' ELSE 'No' END AS Churn,
  CAST(c_custkey * 2 + copy AS BIGINT) AS file_row
FROM cust_base""")

cte("cdrs_raw", [], f"""
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS call_id,
  CASE WHEN l_orderkey % 4000 = 1 AND l_linenumber = 1 THEN 'U' ELSE '' END ||
    CAST(CASE WHEN o_custkey % 40 = 3 THEN o_custkey + 1 ELSE o_custkey END AS VARCHAR) AS customer_id,
  CASE WHEN l_partkey % 250 = 3 THEN 'bad-ts'
       ELSE substring(CAST(l_shipdate AS VARCHAR), 1, 10) || 'T' ||
            CASE WHEN l_linenumber < 4 THEN '0' ELSE '1' END || CAST(l_linenumber AS VARCHAR) || ':30:00' END AS timestamp,
  CASE l_returnflag WHEN 'A' THEN 'VOICE' WHEN 'N' THEN 'DATA' ELSE 'SMS' END AS call_type,
  CASE WHEN l_partkey % 500 = 0 THEN 90000 ELSE CAST(l_quantity AS INTEGER) * 60 END AS duration_seconds,
  CASE WHEN l_returnflag = 'N' THEN CAST(floor(l_extendedprice * 1000) AS BIGINT) ELSE CAST(0 AS BIGINT) END AS bytes_transferred,
  CASE WHEN l_suppkey % 10 = 9 THEN 'X' ELSE '' END || CAST(l_suppkey AS VARCHAR) AS cell_tower_id,
  CASE WHEN l_partkey % 70 = 9 THEN NULL WHEN l_partkey % 20 = 1 THEN 'DROPPED' WHEN l_partkey % 33 = 2 THEN 'FAILED' ELSE 'COMPLETED' END AS call_status,
  CAST(CAST(CAST(floor(l_extendedprice) AS BIGINT) AS DECIMAL(10,0)) * CAST('0.0001' AS DECIMAL(5,4)) AS DOUBLE) AS cost_usd,
  l_shipdate AS ord0, l_partkey AS ord1, l_suppkey AS ord2, l_quantity AS ord3, l_extendedprice AS ord4
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")

cte("towers_raw", [], f"""
SELECT CAST(s_suppkey AS VARCHAR) AS cell_tower_id, CASE WHEN copy = 1 THEN 'A' ELSE r_name END AS region, n_name AS city,
  {dbl(8.0)} + {dbl('s_suppkey * 13 % 2700')} / {dbl(100.0)} AS latitude,
  {dbl(68.0)} + {dbl('s_suppkey * 17 % 2900')} / {dbl(100.0)} AS longitude,
  CASE WHEN s_suppkey % 5 IN (1, 3) THEN '5G' ELSE '4G' END AS technology,
  CAST(DATE '2020-01-01' + CAST(s_suppkey * 37 % 1461 AS INTEGER) AS DATE) AS installation_date,
  CAST(CASE WHEN s_suppkey % 12 = 5 THEN NULL ELSE CASE s_suppkey % 4 WHEN 0 THEN 500 WHEN 1 THEN 1000 WHEN 2 THEN 2000 ELSE 5000 END
    END AS INTEGER) AS capacity_users,
  CAST(s_suppkey * 2 + copy AS BIGINT) AS file_row
FROM (SELECT *, 0 AS copy FROM supplier UNION ALL SELECT *, 1 AS copy FROM supplier WHERE s_suppkey % 7 = 3) JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")

# silver -------------------------------------------------------------------
cte("cust_typed", ["customers_raw"], f"""
SELECT customerID AS customer_id, gender, SeniorCitizen AS seniorcitizen, Partner AS partner,
  Dependents AS dependents, tenure, PhoneService AS phoneservice, MultipleLines AS multiplelines,
  InternetService AS internetservice, OnlineSecurity AS onlinesecurity, OnlineBackup AS onlinebackup,
  DeviceProtection AS deviceprotection, TechSupport AS techsupport, StreamingTV AS streamingtv,
  StreamingMovies AS streamingmovies, Contract AS contract, PaperlessBilling AS paperlessbilling,
  PaymentMethod AS paymentmethod, MonthlyCharges AS monthlycharges,
  COALESCE(CASE WHEN tenure = 0 THEN {dbl(0.0)} ELSE TRY_CAST(trim(TotalCharges) AS DOUBLE) END,
           CAST(MonthlyCharges AS DOUBLE)) AS totalcharges,
  Churn AS churn,
  COALESCE(CAST(Churn = 'Yes' AS INTEGER), 0) AS churn_flag,
  CAST(SeniorCitizen AS INTEGER) AS is_senior_citizen, file_row
FROM customers_raw""")

cte("s_customers", ["cust_typed"], f"""
SELECT *, {right_bins('tenure', TENURE_EDGES, TENURE_LABELS)} AS tenure_cohort
FROM ({keep_first('cust_typed', 'customer_id', ['file_row'], ['file_row'])})""")

cte("cdrs_parsed", ["cdrs_raw"], """
SELECT call_id, customer_id, TRY_CAST(timestamp AS TIMESTAMP) AS timestamp, call_type,
  duration_seconds, bytes_transferred, cell_tower_id, call_status, cost_usd,
  ord0, ord1, ord2, ord3, ord4
FROM cdrs_raw""")

cte("cdrs_filtered", ["cdrs_parsed"], f"""
SELECT *, CAST(timestamp AS DATE) AS call_date, CAST(hour(timestamp) AS INTEGER) AS call_hour,
  dayname(timestamp) AS day_of_week,
  COALESCE(CAST(call_status = 'COMPLETED' AS INTEGER), 0) AS is_completed,
  COALESCE(CAST(call_status = 'DROPPED' AS INTEGER), 0) AS is_dropped,
  {re_(f"{dbl('bytes_transferred')} / {dbl(1048576)}", 3)} AS data_mb
FROM cdrs_parsed
WHERE timestamp IS NOT NULL AND duration_seconds <= {MAX_CALL_SECONDS}""")

ORD = ["ord0", "ord1", "ord2", "ord3", "ord4"]
cte("s_cdrs", ["cdrs_filtered"], keep_first("cdrs_filtered", "call_id", ORD, ORD))

TOWER_DAYS = f"datediff('day', installation_date, DATE '{DEFAULT_AS_OF}')"
cte("s_towers", ["towers_raw"], f"""
SELECT *, {re_(f"{dbl(TOWER_DAYS)} / {dbl(365.25)}", 2)} AS years_in_service
FROM ({keep_first('towers_raw', 'cell_tower_id', ['file_row'], ['file_row'])})""")

# gold -------------------------------------------------------------------
VOICE_SECONDS = "COALESCE(SUM(CASE WHEN call_type = 'VOICE' THEN duration_seconds END), 0)"
cte("activity", ["s_cdrs"], f"""
SELECT customer_id, COUNT(call_id) AS total_calls,
  {re_(f"{dbl(VOICE_SECONDS)} / {dbl(60.0)}", 2)} AS total_voice_minutes,
  COALESCE({sumx('data_mb')}, {dbl(0.0)}) AS total_data_mb,
  COUNT(CASE WHEN call_type = 'SMS' THEN 1 END) AS total_sms,
  CAST(COALESCE(SUM(is_dropped), 0) AS BIGINT) AS dropped_calls,
  AVG(duration_seconds) AS avg_call_duration_sec,
  MAX(timestamp) AS last_activity_date
FROM s_cdrs WHERE customer_id IS NOT NULL GROUP BY customer_id""")

cte("summary_base", ["s_customers", "activity"], f"""
SELECT c.*, COALESCE(a.total_calls, 0) AS total_calls,
  COALESCE(a.total_voice_minutes, {dbl(0)}) AS total_voice_minutes,
  COALESCE(a.total_data_mb, {dbl(0)}) AS total_data_mb,
  COALESCE(a.total_sms, 0) AS total_sms, COALESCE(a.dropped_calls, 0) AS dropped_calls,
  COALESCE(a.avg_call_duration_sec, {dbl(0)}) AS avg_call_duration_sec,
  a.last_activity_date
FROM s_customers c LEFT JOIN activity a ON c.customer_id = a.customer_id""")


def pct_rank_sql(col: str) -> str:
    """Average-rank percentile over the whole table (NULL -> NULL)."""
    return (f"CASE WHEN {col} IS NOT NULL THEN ({dbl(f'rank() OVER (ORDER BY {col} ASC NULLS LAST)')} "
            f"+ {dbl(f'COUNT(*) OVER (PARTITION BY {col}) - 1')} / {dbl(2)}) "
            f"/ {dbl(f'COUNT({col}) OVER ()')} END")


cte("summary_ranked", ["summary_base"], f"""
SELECT *, {pct_rank_sql('total_calls')} AS _p1, {pct_rank_sql('total_data_mb')} AS _p2,
  {pct_rank_sql('tenure')} AS _p3
FROM summary_base""")

cte("fact_customer_summary", ["summary_ranked"], f"""
SELECT * EXCLUDE (_p1, _p2, _p3),
  {re_('_p1 * 40 + _p2 * 40 + _p3 * 20', 2)} AS engagement_score,
  {re_('monthlycharges * tenure', 2)} AS estimated_clv_usd
FROM summary_ranked""")

cte("fact_daily_network_metrics", ["s_cdrs"], f"""
SELECT call_date, COUNT(call_id) AS total_calls,
  CAST(SUM(is_completed) AS BIGINT) AS completed_calls,
  CAST(SUM(is_dropped) AS BIGINT) AS dropped_calls,
  COUNT(DISTINCT customer_id) AS unique_customers_active,
  COALESCE({sumx('data_mb')}, {dbl(0)}) AS total_data_mb,
  AVG(duration_seconds) AS avg_duration_sec,
  COALESCE({sumx('cost_usd')}, {dbl(0)}) AS total_revenue_usd,
  {re_(pct('SUM(is_dropped)', 'COUNT(call_id)'), 3)} AS drop_rate_pct,
  {re_(pct('SUM(is_completed)', 'COUNT(call_id)'), 3)} AS call_success_rate_pct
FROM s_cdrs WHERE call_date IS NOT NULL GROUP BY call_date""")

cte("cdr_enriched", ["s_cdrs", "s_towers"], """
SELECT c.*, t.region, t.city, t.technology
FROM s_cdrs c LEFT JOIN (SELECT cell_tower_id, region, city, technology FROM s_towers) t
  ON c.cell_tower_id = t.cell_tower_id""")

cte("fact_regional_performance", ["cdr_enriched"], f"""
SELECT region, COUNT(call_id) AS total_calls,
  CAST(SUM(is_completed) AS BIGINT) AS completed_calls,
  CAST(SUM(is_dropped) AS BIGINT) AS dropped_calls,
  COUNT(DISTINCT customer_id) AS unique_customers,
  COALESCE({sumx('data_mb')}, {dbl(0)}) AS total_data_mb,
  COALESCE({sumx('cost_usd')}, {dbl(0)}) AS total_revenue_usd,
  COUNT(DISTINCT cell_tower_id) AS active_towers,
  {re_(pct('SUM(is_dropped)', 'COUNT(call_id)'), 3)} AS drop_rate_pct,
  {re_(f"COALESCE({sumx('cost_usd')}, {dbl(0)}) / COUNT(DISTINCT customer_id)", 2)} AS revenue_per_customer_usd
FROM cdr_enriched WHERE region IS NOT NULL GROUP BY region""")

cte("fact_churn_cohort", ["fact_customer_summary"], f"""
SELECT tenure_cohort, contract, paymentmethod,
  COUNT(customer_id) AS customer_count,
  CAST(SUM(churn_flag) AS BIGINT) AS churn_count,
  {avgx('monthlycharges')} AS avg_monthly_charges,
  {avgx('totalcharges')} AS avg_total_charges,
  {avgx('estimated_clv_usd')} AS avg_clv,
  {re_(pct('SUM(churn_flag)', 'COUNT(customer_id)'), 2)} AS churn_rate_pct
FROM fact_customer_summary
WHERE tenure_cohort IS NOT NULL AND contract IS NOT NULL AND paymentmethod IS NOT NULL
GROUP BY tenure_cohort, contract, paymentmethod""")


def with_ctes(body: str, needs: list[str]) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    parts = ",\n".join(f"{n} AS ({CTES[n][0].strip()})" for n in order)
    return f"WITH {parts}\n{body.strip()}"
