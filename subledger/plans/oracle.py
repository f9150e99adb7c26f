"""SQL oracle (DuckDB dialect) for the registered queries.

Spark models: defects are a long (row, priority, label) relation of which the
clean tables are the complement and the quarantine tables the best-ranked part;
movements come from sorted per-customer month lists; summaries are generated
from one table of metrics. All labels and notes are written out here, so that a
slip in the library's constants shows.

Bronze is derived from ``customer`` / ``orders`` with the arithmetic of
FIXTURES.md section 3 (a fixture, shared on purpose). Decimal results are cast
to DOUBLE by the registry, as the Spark queries do.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2001-06-30'"
RUN_TS = "TIMESTAMP '2001-07-01 06:00:00'"


# ---- bronze (fixture) ------------------------------------------------------

def _pad(x: str, n: int) -> str:
    return f"printf('%0{n}d', CAST({x} AS BIGINT))"


def _mixed(d: str, n: str) -> str:
    """Date text in one of four layouts."""
    y, m, dd = f"CAST(year({d}) AS VARCHAR)", _pad(f"month({d})", 2), _pad(f"day({d})", 2)
    layouts = [f"CAST({d} AS VARCHAR)"] * 3 + [
        f"{dd} || '/' || {m} || '/' || {y}", f"{m} || '/' || {dd} || '/' || {y}", f"{dd} || '-' || {m} || '-' || {y}"]
    return f"([{', '.join(layouts)}])[CAST(({n}) % 6 + 1 AS INTEGER)]"


def _pick(index: str, *values: str) -> str:
    return f"([{', '.join(repr(v) for v in values)}])[CAST({index} + 1 AS INTEGER)]"


def _start(k: str = "k") -> str:
    return f"(DATE '2000-01-01' + CAST({k} * 37 % 335 AS INTEGER))"


_PLAN = "([0, 0, 0, 0, 1, 1, 1, 2, 2, 3])[CAST(k % 10 + 1 AS INTEGER)]"
_UP = "(k % 8 = 1 AND k % 7 <> 3 AND k % 10 <> 9)"
_PLANS = (" Starter", "growth", "pro", "enterprise")


def bronze_transactions_sql(src: str) -> str:
    return f"""
SELECT 'TXN-' || {_pad('k', 9)} AS transaction_id,
  CASE WHEN k % 33 = 2 THEN NULL ELSE 'CUST-' || {_pad('o_custkey', 7)} END AS customer_id,
  {_mixed('d', 'k')} AS transaction_date,
  CASE WHEN k % 47 = 3 THEN '-' || price WHEN k % 67 = 5 THEN '0.0' WHEN k % 101 = 7 THEN NULL ELSE price END AS amount,
  CASE k % 7 WHEN 3 THEN 'eur' WHEN 4 THEN 'GBP' ELSE ' usd' END AS currency,
  {_pick('k % 4', 'card', 'bank_transfer', 'Wallet', 'crypto')} AS payment_method,
  CASE WHEN k % 97 = 1 THEN NULL WHEN k % 100 < 87 THEN 'success' WHEN k % 100 < 94 THEN 'failed'
       WHEN k % 100 < 98 THEN 'Pending' ELSE 'refunded' END AS status,
  CASE WHEN k % 50 = 0 THEN '0.12' ELSE CAST(CAST(CAST(price AS DECIMAL(12,2)) * 0.02 AS DECIMAL(12,2)) AS VARCHAR) END AS fee_usd,
  {_pick('(k % 7) % 4', 'api', 'dashboard', 'mobile', 'web')} AS channel,
  'Nation_' || (k % 25) AS country,
  {_pick('k % 5', 'subscription_payment', 'one_time_payment', 'refund_processed', 'wallet_topup', 'Transfer')} AS description,
  CAST(k * 2 + dup AS BIGINT) AS row_seq
FROM (SELECT o_orderkey AS k, o_custkey, dup, CAST(o_orderdate AS DATE) + dup AS d,
             CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS price
      FROM (SELECT *, unnest(CASE WHEN o_orderkey % 89 = 12 THEN [0, 1] ELSE [0] END) AS dup FROM {src}))"""


BRONZE = {
    "b_customers": f"""
SELECT CASE WHEN k % 211 = 17 THEN NULL ELSE 'CUST-' || {_pad('k', 7)} END AS customer_id,
  {_mixed('d', 'k + dup * 3')} AS signup_date,
  c_name AS full_name,
  CASE WHEN k % 53 = 7 THEN NULL ELSE ' User' || k || '@Company.io ' END AS email,
  'Nation_' || c_nationkey AS country,
  {_pick('k % 5', '1-10', '11-50', '51-200', '201-500', '500+')} AS company_size,
  lower(c_mktsegment) AS acquisition_channel,
  CASE WHEN k % 67 = 5 THEN NULL WHEN k % 71 = 9 THEN 'n/a' WHEN k % 73 = 11 THEN '0.30'
       ELSE CAST(CAST(c_acctbal AS DECIMAL(10,2)) AS VARCHAR) END AS cac_usd,
  {_pick('k % 7', 'FinTech', 'ecommerce', 'saas', 'healthcare', 'logistics', 'media', ' education')} AS industry,
  CAST(k * 2 + dup AS BIGINT) AS row_seq
FROM (SELECT *, c_custkey AS k, {_start('c_custkey')} + 10 * dup AS d
      FROM (SELECT *, unnest(CASE WHEN c_custkey % 97 = 13 THEN [0, 1] ELSE [0] END) AS dup FROM customer))""",
    "b_subscription_rows": f"""
SELECT k, dup, 'SUB-' || {_pad('k', 7)} || CASE dup WHEN 1 THEN '-2' ELSE '' END AS subscription_id,
  CASE WHEN k % 109 = 21 THEN NULL ELSE 'CUST-' || {_pad('k', 7)} END AS customer_id,
  CASE WHEN k % 59 = 4 THEN NULL ELSE {_pick(_PLAN, *_PLANS)} END AS plan,
  CASE WHEN k % 61 = 8 THEN '0' WHEN k % 83 = 2 THEN NULL ELSE {_pick(_PLAN, '49', '99', '199', '499')} END AS mrr_usd,
  {_mixed('d', 'k')} AS start_date,
  CASE WHEN k % 7 = 3 THEN {_mixed('(d + CAST(30 * (1 + k % 12) AS INTEGER))', 'k + 1')} END AS end_date,
  CASE k % 7 WHEN 3 THEN 'churned' ELSE 'active' END AS status,
  CASE WHEN {_UP} THEN 'True' ELSE 'False' END AS is_upgraded,
  CASE WHEN {_UP} THEN {_pick(_PLAN + ' + 1', *_PLANS)} END AS upgrade_plan,
  CASE WHEN {_UP} THEN {_mixed('(d + CAST(60 + k % 141 AS INTEGER))', 'k + 2')} END AS upgrade_date,
  CASE WHEN {_UP} THEN {_pick(_PLAN, '99.0', '199.0', '499.0')} END AS upgrade_mrr_usd,
  CASE k % 3 WHEN 0 THEN 'annual' ELSE 'monthly' END AS billing_cycle,
  CAST(k * 2 + dup AS BIGINT) AS row_seq
FROM (SELECT c_custkey AS k, {_start('c_custkey')} AS d,
             unnest(CASE WHEN c_custkey % 103 = 6 THEN [0, 1] ELSE [0] END) AS dup FROM customer)""",
    "b_subscriptions": "SELECT * EXCLUDE (k, dup) FROM b_subscription_rows",
    "b_transactions": bronze_transactions_sql("orders"),
    "b_monthly_revenue": f"""
SELECT 'REV-' || substr(subscription_id, 5) || '-' || {_pad('i', 2)} AS revenue_id, subscription_id, customer_id,
  CAST(make_date(CAST(mi // 12 AS INTEGER), CAST(mi % 12 + 1 AS INTEGER), 1) AS VARCHAR) AS month,
  CASE WHEN {_UP} AND mi >= year(u) * 12 + month(u) - 1 THEN upgrade_mrr_usd ELSE mrr_usd END AS mrr_usd,
  plan, billing_cycle, CAST((k * 2 + dup) * 100 + i AS BIGINT) AS row_seq
FROM (SELECT s.*, r.i, year({_start()}) * 12 + month({_start()}) - 1 + r.i AS mi,
             {_start()} + CAST(60 + k % 141 AS INTEGER) AS u
      FROM b_subscription_rows s CROSS JOIN range(20) r(i))
WHERE (k % 7 <> 3 OR i <= 1 + k % 12) AND mi <= {2001 * 12 + 7}""",
}


# ---- first copies ----------------------------------------------------------

def first_copies(table: str, key: str, date: str) -> str:
    """Per key the row with the smallest date text (null last), then the first arrival."""
    return f"""SELECT unnest(r) FROM (
  SELECT arg_min(b, struct_pack(n := {date} IS NULL, d := coalesce({date}, ''), s := row_seq)) AS r
  FROM {table} b GROUP BY {key})"""


DEDUP = {
    "d_customers": first_copies("b_customers", "customer_id", "signup_date"),
    "d_subscriptions": first_copies("b_subscriptions", "subscription_id", "start_date"),
    "d_transactions": first_copies("b_transactions", "transaction_id", "transaction_date"),
    "d_monthly_revenue": first_copies("b_monthly_revenue", "revenue_id", "month"),
}


# ---- typed rows, defects, silver -------------------------------------------

def D(x: str) -> str:
    """ISO text to date, null if it is none."""
    return f"CAST(try_strptime({x}, '%Y-%m-%d') AS DATE)"


def N(x: str, p: int = 38, s: int = 0) -> str:
    """Text to decimal, null if it is none."""
    return f"TRY_CAST({x} AS DECIMAL({p},{s}))"


def _money(x: str, p: int) -> str:
    return f"if({N(x)} > 0, {N(x, p, 2)}, NULL)"


def _low(x: str) -> str:
    return f"lower(trim({x}))"


def _high(x: str) -> str:
    return f"upper(trim({x}))"


def _month(d: str) -> str:
    return f"CAST(date_trunc('month', {d}) AS DATE)"


def _flag(x: str) -> str:
    return f"coalesce({x}, false)"


def ranked(source: str, cases: list[tuple[str, str]], where: str = "true") -> str:
    """Long relation (row_seq, rank, label) of the cases that hold for a row."""
    items = ", ".join(f"{{'rank': {i}, 'label': '{label}', 'holds': {cond}}}" for i, (label, cond) in enumerate(cases))
    return (f"SELECT row_seq, c.rank, c.label FROM (SELECT *, unnest([{items}]) AS c FROM {source}) "
            f"WHERE coalesce(c.holds, false) AND ({where})")


def labels(relation: str, name: str) -> str:
    return f"(SELECT row_seq, arg_min(label, rank) AS {name} FROM {relation} GROUP BY row_seq)"


_DATE, _CAC, _MRR, _AMOUNT = D("signup_date"), N("cac_usd"), N("mrr_usd"), N("amount")
CUSTOMER_DEFECTS = [
    ("null_customer_id", "customer_id IS NULL"),
    ("unparseable_date", f"{_DATE} IS NULL"),
    ("null_cac", f"{_CAC} IS NULL"),
    ("negative_cac", f"{_CAC} <= 0"),
    ("null_email", "email IS NULL"),
]
SUBSCRIPTION_DEFECTS = [
    ("null_customer_id", "customer_id IS NULL"),
    ("null_plan", "plan IS NULL"),
    ("null_mrr", f"{_MRR} IS NULL"),
    ("zero_mrr", f"{_MRR} <= 0"),
]
TRANSACTION_DEFECTS = [
    ("null_transaction_id", "transaction_id IS NULL"),
    ("null_customer_id", "customer_id IS NULL"),
    ("null_amount", f"{_AMOUNT} IS NULL"),
    ("negative_or_zero_amount", f"{_AMOUNT} <= 0"),
]
#: What keeps a row out of silver besides the quarantined defects.
SUBSCRIPTION_DROPS = [*SUBSCRIPTION_DEFECTS, ("no id", "subscription_id IS NULL")]
TRANSACTION_DROPS = [
    *TRANSACTION_DEFECTS, ("no status", "status IS NULL"),
    ("no date or later", f"coalesce({D('transaction_date')} > {AS_OF}, true)"),
]
REVENUE_DROPS = [
    ("no id", "revenue_id IS NULL"), ("no customer", "customer_id IS NULL"),
    ("no subscription", "subscription_id IS NULL"), ("no plan", "plan IS NULL"),
    ("no date or later", f"coalesce({D('month')} > {AS_OF}, true)"),
]


def silver(source: str, drops: list[tuple[str, str]], columns: dict[str, str]) -> str:
    shown = ", ".join(f"{expr} AS {name}" for name, expr in columns.items())
    return f"SELECT {shown} FROM {source} b WHERE NOT EXISTS (SELECT 1 FROM ({ranked(source, drops)}) x WHERE x.row_seq = b.row_seq)"


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def _low_all(*names: str) -> dict[str, str]:
    return {n: _low(n) for n in names}


_END, _BEGIN = D("end_date"), D("start_date")
SILVER = {
    "stg_customers": silver("d_customers", CUSTOMER_DEFECTS, {
        **_same("customer_id", "full_name", "company_size"), **_low_all("email", "acquisition_channel", "industry"),
        "country": _high("country"), "signup_date": _DATE, "signup_month": _month(_DATE), "cac_usd": _money("cac_usd", 10),
        "is_missing_email": "email IS NULL", "is_invalid_cac": _flag(f"{_CAC} <= 0"),
    }),
    "stg_subscriptions": silver("d_subscriptions", SUBSCRIPTION_DROPS, {
        **_same("subscription_id", "customer_id"), **_low_all("plan", "status", "upgrade_plan", "billing_cycle"),
        "mrr_usd": _money("mrr_usd", 10), "upgrade_mrr_usd": _money("upgrade_mrr_usd", 10),
        "start_date": _BEGIN, "end_date": _END, "upgrade_date": D("upgrade_date"),
        "is_upgraded": _flag(f"list_contains(['TRUE', '1', 'YES'], {_high('is_upgraded')})"),
        "months_active": f"CAST(date_diff('month', {_BEGIN}, coalesce({_END}, {AS_OF})) AS INTEGER)",
        "is_churned": _flag(f"{_low('status')} = 'churned'"),
        "is_zero_mrr": f"coalesce({_MRR} <= 0, mrr_usd IS NULL)", "is_missing_plan": "plan IS NULL",
    }),
    "stg_transactions": silver("d_transactions", TRANSACTION_DROPS, {
        **_same("transaction_id", "customer_id"), **_low_all("payment_method", "status", "channel", "description"),
        "currency": _high("currency"), "country": _high("country"),
        "transaction_date": D("transaction_date"), "transaction_month": _month(D("transaction_date")),
        "amount_usd": _money("amount", 12), "fee_usd": _money("fee_usd", 10),
        "is_successful": _flag(f"{_low('status')} = 'success'"),
        "is_failed": _flag(f"{_low('status')} = 'failed'"),
        "is_refunded": _flag(f"{_low('status')} = 'refunded'"),
        "is_invalid_amount": f"coalesce({_AMOUNT} <= 0, amount IS NULL)", "is_missing_customer": "customer_id IS NULL",
        "is_future_dated": _flag(f"{D('transaction_date')} > {AS_OF}"),
    }),
    "stg_monthly_revenue": silver("d_monthly_revenue", REVENUE_DROPS, {
        **_same("revenue_id", "subscription_id", "customer_id"), **_low_all("plan", "billing_cycle"),
        "revenue_month": D("month"), "revenue_month_start": _month(D("month")), "mrr_usd": _money("mrr_usd", 10),
        "revenue_year": f"CAST(year({D('month')}) AS INTEGER)", "revenue_month_num": f"CAST(month({D('month')}) AS INTEGER)",
        "is_zero_mrr": f"coalesce({_MRR} <= 0, mrr_usd IS NULL)", "is_future_dated": _flag(f"{D('month')} > {AS_OF}"),
    }),
}


# ---- quarantine ------------------------------------------------------------

def quarantine(source: str, table: str, columns: dict[str, str], defects: list[tuple[str, str]],
               second: tuple[str, list[tuple[str, str]]], action: str, run_ts: str = RUN_TS,
               where: str = "true", extra: str = "") -> str:
    """Rows with a defect that counts, its first label, and the first of a second list."""
    name, cases = second
    shown = ", ".join(f"{expr} AS {n}" for n, expr in columns.items())
    return f"""
SELECT {shown}, '{table}' AS source_table, i.issue_type, s.{name},
  {run_ts} AS flagged_at, '{action}' AS recommended_action{extra}
FROM {source} b
JOIN {labels(f'({ranked(source, defects, where)})', 'issue_type')} i ON i.row_seq = b.row_seq
LEFT JOIN {labels(f'({ranked(source, cases)})', name)} s ON s.row_seq = b.row_seq"""


_CUSTOMER_COLUMNS = {
    "row_id": "customer_id", "raw_signup_date": "signup_date", "raw_cac_usd": "cac_usd",
    **_same("email", "country", "acquisition_channel"),
}
_CUSTOMER_RAW = quarantine(
    "d_customers", "customers", _CUSTOMER_COLUMNS, CUSTOMER_DEFECTS,
    ("raw_of", [("signup_date", f"{_DATE} IS NULL"), ("cac_usd", f"{_CAC} <= 0")]), "investigate_source_system")
QUARANTINE = {
    "quarantine_customers": f"""
SELECT * EXCLUDE (raw_of),
  CASE raw_of WHEN 'signup_date' THEN raw_signup_date WHEN 'cac_usd' THEN raw_cac_usd END AS problematic_raw_value
FROM ({_CUSTOMER_RAW})""",
    "quarantine_subscriptions": quarantine(
        "d_subscriptions", "subscriptions",
        {"row_id": "subscription_id", "customer_id": "customer_id", "raw_plan": "plan", "raw_mrr_usd": "mrr_usd",
         "raw_start_date": "start_date", "status": "status"},
        SUBSCRIPTION_DEFECTS,
        ("investigation_notes", [
            ("Plan not assigned - check billing system", "plan IS NULL"),
            ("Zero MRR - check billing processor", f"{_MRR} <= 0"),
            ("Orphaned subscription - no matching customer", "customer_id IS NULL"),
        ]), "investigate_billing_system"),
}


def quarantine_transactions_sql(source: str = "d_transactions", gate: str | None = None,
                                run_ts: str = RUN_TS, extra: str = "") -> str:
    """``gate`` decides whether a row counts whose only defect is its amount's sign."""
    return quarantine(
        source, "transactions",
        {"row_id": "transaction_id", "customer_id": "customer_id", "raw_transaction_date": "transaction_date",
         "raw_amount": "amount", **_same("currency", "payment_method", "status", "channel", "country")},
        TRANSACTION_DEFECTS,
        ("investigation_notes", [
            ("Orphaned transaction - no matching customer, check payment processor logs", "customer_id IS NULL"),
            ("Invalid amount - check payment processor for correct value", f"{_AMOUNT} <= 0"),
            ("Missing transaction ID - check payment processor", "transaction_id IS NULL"),
        ]), "investigate_payment_processor", run_ts,
        f"c.label <> 'negative_or_zero_amount' OR coalesce({gate}, false)" if gate else "true", extra)


QUARANTINE["quarantine_transactions"] = quarantine_transactions_sql()


# ---- gold ------------------------------------------------------------------

def rate(condition: str) -> str:
    return f"round(CAST(count(*) FILTER ({condition}) AS DOUBLE) / nullif(count(*), 0) * 100, 2)"


#: Payment measures by name.
PAYMENT_METRICS = {
    "total_transactions": "count(*)",
    **{f"{n}_transactions": f"count(*) FILTER (is_{n})" for n in ("successful", "failed", "refunded")},
    "pending_transactions": "count(*) FILTER (status = 'pending')",
    "success_rate_pct": rate("is_successful"),
    "failure_rate_pct": rate("is_failed"),
    "volume": "coalesce(sum(amount_usd) FILTER (is_successful), 0)",
    "avg_transaction_value_usd": "round(avg(amount_usd) FILTER (is_successful), 2)",
    "total_fees_usd": "coalesce(sum(fee_usd) FILTER (is_successful AND fee_usd IS NOT NULL),"
                      " CASE WHEN count(*) FILTER (NOT is_successful) > 0 THEN 0 END)",
    "unique_paying_customers": "count(DISTINCT customer_id) FILTER (is_successful)",
    "unique_customers": "count(DISTINCT customer_id)",
}

TILE_METRICS = ("total_transactions", "successful_transactions", "failed_transactions", "refunded_transactions",
                "pending_transactions", "success_rate_pct", "failure_rate_pct", "volume:successful_volume_usd", "total_fees_usd")


def payments(key: str, *metrics: str, source: str = "stg_transactions") -> str:
    """A summary by ``key`` (or over all rows); ``metric:name`` renames."""
    named = [m.split(":") if ":" in m else (m, m) for m in metrics]
    shown = ", ".join(f"{PAYMENT_METRICS[m]} AS {name}" for m, name in named)
    return f"SELECT {key}, {shown} FROM {source} GROUP BY ALL" if key else f"SELECT {shown} FROM {source}"


GOLD = {
    "g_revenue": "SELECT * FROM stg_monthly_revenue WHERE mrr_usd IS NOT NULL",
    # one row per customer and month, with its values in order
    "g_cm": """
SELECT customer_id, revenue_month, sum(mrr_usd) AS mrr, list(mrr_usd ORDER BY mrr_usd) AS vals
FROM g_revenue GROUP BY ALL""",
    "g_steps": """
SELECT *, CAST(revenue_month + INTERVAL 1 MONTH AS DATE) AS next_month,
  lead(revenue_month) OVER w AS next_seen, lag(vals) OVER w AS vals_before,
  CAST(lag(revenue_month) OVER w + INTERVAL 1 MONTH AS DATE) = revenue_month AS follows,
  row_number() OVER w AS nth
FROM g_cm WINDOW w AS (PARTITION BY customer_id ORDER BY revenue_month)""",
    "g_mrr_by_month": """
SELECT revenue_month, plan, count(*) AS active_customers, sum(m) AS total_mrr,
  round(sum(m) / sum(n), 2) AS avg_mrr_per_customer
FROM (SELECT revenue_month, plan, customer_id, sum(mrr_usd) AS m, count(*) AS n FROM g_revenue GROUP BY ALL)
GROUP BY ALL""",
    "g_first_revenue_month": "SELECT customer_id, revenue_month AS first_month FROM g_steps WHERE nth = 1",
    "g_new_mrr": "SELECT revenue_month, sum(mrr) AS new_mrr, count(*) AS new_customers FROM g_steps WHERE nth = 1 GROUP BY ALL",
    "g_expansion_mrr": """
SELECT revenue_month, sum(list_sum(gains)) AS expansion_mrr, count(*) AS expanded_customers
FROM (SELECT revenue_month, flatten([[a - b for b in vals_before if a > b] for a in vals]) AS gains
      FROM g_steps WHERE follows)
WHERE len(gains) > 0 GROUP BY ALL""",
    "g_churned_mrr": """
SELECT next_month AS revenue_month, -sum(mrr) AS churned_mrr, count(*) AS churned_customers
FROM g_steps WHERE next_seen IS DISTINCT FROM next_month GROUP BY ALL""",
    "g_mrr_total": """
SELECT revenue_month, sum(total_mrr) AS total_mrr, sum(active_customers) AS total_active_customers
FROM g_mrr_by_month GROUP BY ALL""",
    "g_moves": """
SELECT revenue_month, coalesce(max(new_mrr), 0) AS new_mrr, coalesce(max(new_customers), 0) AS new_customers,
  coalesce(max(expansion_mrr), 0) AS expansion_mrr, coalesce(max(expanded_customers), 0) AS expanded_customers,
  coalesce(max(churned_mrr), 0) AS churned_mrr, coalesce(max(churned_customers), 0) AS churned_customers
FROM (SELECT revenue_month FROM g_mrr_total UNION ALL BY NAME FROM g_new_mrr
      UNION ALL BY NAME FROM g_expansion_mrr UNION ALL BY NAME FROM g_churned_mrr)
GROUP BY ALL""",
    "mart_mrr": """
SELECT m.*, t.total_mrr AS total_mrr_all_plans, t.total_active_customers, v.* EXCLUDE (revenue_month),
  v.new_mrr + v.expansion_mrr + v.churned_mrr AS net_new_mrr,
  round((t.total_mrr - first_value(t.total_mrr) OVER before) / nullif(first_value(t.total_mrr) OVER before, 0) * 100, 2)
    AS mrr_growth_rate_pct,
  12 * t.total_mrr AS arr
FROM g_mrr_by_month m JOIN g_mrr_total t USING (revenue_month) JOIN g_moves v USING (revenue_month)
WINDOW before AS (ORDER BY m.revenue_month, m.plan ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING)""",
    "g_avg_mrr_per_customer": """
SELECT customer_id, round(sum(list_sum(vals)) / sum(len(vals)), 2) AS avg_monthly_mrr, sum(mrr) AS total_revenue_to_date,
  count(*) AS months_with_revenue, min(revenue_month) AS first_revenue_month, max(revenue_month) AS last_revenue_month
FROM g_cm GROUP BY ALL""",
    "g_churn_by_plan": """
SELECT plan, total_customers, churned_customers,
  round(CAST(churned_customers AS DOUBLE) / total_customers, 4) AS monthly_churn_rate
FROM (SELECT plan, count(*) AS total_customers, count(*) FILTER (is_churned) AS churned_customers
      FROM stg_subscriptions GROUP BY ALL)""",
    # lifetime value before rounding, from which the other measures follow
    "g_lifetime": """
SELECT c.* EXCLUDE (full_name, email, is_missing_email, is_invalid_cac), s.* EXCLUDE (customer_id, subscription_id,
    start_date, end_date, is_upgraded, upgrade_plan, upgrade_date, upgrade_mrr_usd, is_zero_mrr, is_missing_plan),
  a.avg_monthly_mrr, a.total_revenue_to_date, a.months_with_revenue, p.monthly_churn_rate,
  CAST(a.avg_monthly_mrr AS DOUBLE) / nullif(p.monthly_churn_rate, 0) AS ltv
FROM stg_customers c LEFT JOIN stg_subscriptions s USING (customer_id)
LEFT JOIN g_avg_mrr_per_customer a USING (customer_id) LEFT JOIN g_churn_by_plan p USING (plan)""",
    "g_customer_metrics": """
SELECT * EXCLUDE (ltv, ratio), round(ltv, 2) AS projected_ltv, round(ratio, 2) AS ltv_cac_ratio,
  CASE WHEN avg_monthly_mrr > 0 THEN round(cac_usd / avg_monthly_mrr, 1) END AS cac_payback_months,
  CASE WHEN ratio >= 5 THEN 'excellent' WHEN ratio >= 3 THEN 'healthy' WHEN ratio >= 1 THEN 'marginal' ELSE 'poor' END
    AS unit_economics_health
FROM (SELECT *, ltv / CAST(nullif(cac_usd, 0) AS DOUBLE) AS ratio FROM g_lifetime)""",
    "g_tx_monthly_summary": payments(
        "transaction_month", *[m for m in PAYMENT_METRICS if m not in ("volume", "unique_customers")],
        "volume:successful_volume_usd"),
    "g_tx_payment_method_summary": payments(
        "payment_method", "total_transactions", "success_rate_pct", "failure_rate_pct", "volume:total_volume_usd",
        "avg_transaction_value_usd"),
    "g_tx_channel_summary": payments(
        "channel", "total_transactions", "success_rate_pct", "volume:total_volume_usd", "unique_customers"),
    "mart_transactions": f"""
SELECT t.* EXCLUDE (is_invalid_amount, is_missing_customer, is_future_dated),
  m.* EXCLUDE (transaction_month), p.* EXCLUDE (payment_method), c.* EXCLUDE (channel)
FROM stg_transactions t
LEFT JOIN ({payments('transaction_month', 'total_transactions:month_total_transactions',
                     'success_rate_pct:month_success_rate_pct', 'volume:month_successful_volume_usd')}) m
  ON m.transaction_month = t.transaction_month
LEFT JOIN ({payments('payment_method', 'success_rate_pct:payment_method_success_rate_pct',
                     'volume:payment_method_total_volume_usd')}) p ON p.payment_method = t.payment_method
LEFT JOIN ({payments('channel', 'success_rate_pct:channel_success_rate_pct')}) c ON c.channel = t.channel""",
}

# All named relations.
RELATIONS: dict[str, str] = {**BRONZE, **DEDUP, **SILVER, **QUARANTINE, **GOLD}


def with_relations(final_sql: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` clause holding exactly the relations ``final_sql`` needs, in order."""
    rels = {**RELATIONS, **(extra or {})}
    needed: dict[str, str] = {}

    def visit(sql: str, asking: str | None = None) -> None:
        for name in sorted(rels):
            if name != asking and name not in needed and re.search(rf"(?<![\w.]){name}(?!\w)", sql):
                visit(rels[name], name)
                needed[name] = rels[name]

    visit(final_sql)
    ctes = ",\n".join(f"{n} AS ({sql})" for n, sql in needed.items())
    return f"WITH {ctes}\n{final_sql}" if needed else final_sql
