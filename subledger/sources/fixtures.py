"""Bronze fixtures derived from the driver's TPC-H-like tables.

The reference ships a random generator, not data. To test the models on data
whose size grows with the scale factor, the four raw tables are derived from
``customer`` and ``orders`` with plain arithmetic on their keys (FIXTURES.md
section 3), which seeds the same defect kinds: duplicates, null ids, mixed date
layouts, negative/zero/sub-0.50 money, null plan/status, future dates.

Each table is one pass over its source: duplicates are produced with
``explode`` of a 1- or 2-element array (no second scan, no union), and the
monthly revenue schedule with ``explode(sequence(..))`` (no cross join).
No row of these tables is shuffled here; only source customers, one row each, are dealt
among tasks before they become schedules (``dealt``). The projections are SQL expression strings: each
``selectExpr`` is parsed JVM-side in one call, instead of one driver round
trip per expression node.
"""

from __future__ import annotations

import datetime as dt
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from subledger.params import RunParams
from subledger.sources.bronze import ROW_SEQ, LazyBronze

# Fixed values of the fixture derivation (FIXTURES.md section 3).
FIXTURE_PARAMS = RunParams(as_of=dt.date(2001, 6, 30), run_ts=dt.datetime(2001, 7, 1, 6, 0, 0))
COMPANY_SIZES = ("1-10", "11-50", "51-200", "201-500", "500+")
INDUSTRIES = ("FinTech", "ecommerce", "saas", "healthcare", "logistics", "media", " education")
PLAN_TEXT = (" Starter", "growth", "pro", "enterprise")
PLAN_MRR_TEXT = ("49", "99", "199", "499")
UPGRADE_MRR_TEXT = ("99.0", "199.0", "499.0")
PAYMENT_METHODS = ("card", "bank_transfer", "Wallet", "crypto")
CHANNELS = ("api", "dashboard", "mobile", "web")
DESCRIPTIONS = ("subscription_payment", "one_time_payment", "refund_processed", "wallet_topup", "Transfer")
EPOCH = "2000-01-01"
LAST_MONTH_INDEX = 2001 * 12 + 7  # 2001-08
SCHEDULE_MONTHS = 20
#: Most source customers of a task. One becomes up to 40 revenue rows, 14 as a rule, of 200 bytes in
#: a sort, so that a task which looks for duplicates among them holds some 60 MB.
CUSTOMERS_PER_TASK = 20_000


def _pick(values: tuple[str, ...], index: str) -> str:
    """values[index] for a 0-based integer expression."""
    arr = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({arr}), cast(({index}) + 1 AS INT))"


def _pad(x: str, n: int) -> str:
    """At least ``n`` digits; a longer number keeps them all."""
    return f"format_string('%0{n}d', cast({x} AS BIGINT))"


def mixed_date_text(d: str, n: str) -> str:
    """TXT(d, n): ISO for n%6 in 0..2, then dd/MM/yyyy, MM/dd/yyyy, dd-MM-yyyy."""
    y, m, dd = f"cast(year({d}) AS STRING)", _pad(f"month({d})", 2), _pad(f"day({d})", 2)
    return (
        f"CASE WHEN ({n}) % 6 <= 2 THEN cast({d} AS STRING) "
        f"WHEN ({n}) % 6 = 3 THEN concat_ws('/', {dd}, {m}, {y}) "
        f"WHEN ({n}) % 6 = 4 THEN concat_ws('/', {m}, {dd}, {y}) "
        f"ELSE concat_ws('-', {dd}, {m}, {y}) END"
    )


def _base_date(k: str) -> str:
    return f"date_add(DATE'{EPOCH}', cast({k} * 37 % 335 AS INT))"


def _dup(cond: str) -> str:
    return f"explode(CASE WHEN {cond} THEN array(0, 1) ELSE array(0) END) AS dup"


def _cust_id(k: str) -> str:
    return f"concat('CUST-', {_pad(k, 7)})"


PLAN_INDEX = "CASE WHEN k % 10 <= 3 THEN 0 WHEN k % 10 <= 6 THEN 1 WHEN k % 10 <= 8 THEN 2 ELSE 3 END"
CHURNED = "(k % 7 = 3)"
UPGRADED = "(k % 8 = 1 AND k % 7 <> 3 AND k % 10 <> 9)"


def bronze_customers(customer: DataFrame) -> DataFrame:
    x = customer.selectExpr("c_custkey AS k", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
                            _dup("c_custkey % 97 = 13"))
    d = f"date_add({_base_date('k')}, dup * 10)"
    return x.selectExpr(
        f"CASE WHEN k % 211 = 17 THEN NULL ELSE {_cust_id('k')} END AS customer_id",
        f"{mixed_date_text(d, 'k + dup * 3')} AS signup_date",
        "c_name AS full_name",
        "CASE WHEN k % 53 = 7 THEN NULL ELSE concat(' User', cast(k AS STRING), '@Company.io ') END AS email",
        "concat('Nation_', cast(c_nationkey AS STRING)) AS country",
        f"{_pick(COMPANY_SIZES, 'k % 5')} AS company_size",
        "lower(c_mktsegment) AS acquisition_channel",
        "CASE WHEN k % 67 = 5 THEN NULL WHEN k % 71 = 9 THEN 'n/a' WHEN k % 73 = 11 THEN '0.30' "
        "ELSE cast(cast(c_acctbal AS DECIMAL(10,2)) AS STRING) END AS cac_usd",
        f"{_pick(INDUSTRIES, 'k % 7')} AS industry",
        f"cast(k * 2 + dup AS BIGINT) AS {ROW_SEQ}",
    )


def _subscription_id(k: str, dup: str) -> str:
    """The customer's number; a second subscription of the customer ends in ``-2``."""
    return f"concat('SUB-', {_pad(k, 7)}, CASE WHEN {dup} = 1 THEN '-2' ELSE '' END)"


def _subscription_rows(customer: DataFrame) -> DataFrame:
    """Bronze subscriptions with their source key ``k`` and copy number ``dup``."""
    x = customer.selectExpr("c_custkey AS k", _dup("c_custkey % 103 = 6"))
    d = _base_date("k")
    pi = PLAN_INDEX
    return x.selectExpr(
        "k", "dup",
        f"{_subscription_id('k', 'dup')} AS subscription_id",
        f"CASE WHEN k % 109 = 21 THEN NULL ELSE {_cust_id('k')} END AS customer_id",
        f"CASE WHEN k % 59 = 4 THEN NULL ELSE {_pick(PLAN_TEXT, pi)} END AS plan",
        f"CASE WHEN k % 61 = 8 THEN '0' WHEN k % 83 = 2 THEN NULL ELSE {_pick(PLAN_MRR_TEXT, pi)} END AS mrr_usd",
        f"{mixed_date_text(d, 'k')} AS start_date",
        f"CASE WHEN {CHURNED} THEN {mixed_date_text(f'date_add({d}, cast(30 * (1 + k % 12) AS INT))', 'k + 1')} "
        "END AS end_date",
        f"CASE WHEN {CHURNED} THEN 'churned' ELSE 'active' END AS status",
        f"CASE WHEN {UPGRADED} THEN 'True' ELSE 'False' END AS is_upgraded",
        f"CASE WHEN {UPGRADED} THEN {_pick(PLAN_TEXT, pi + ' + 1')} END AS upgrade_plan",
        f"CASE WHEN {UPGRADED} THEN {mixed_date_text(f'date_add({d}, cast(60 + k % 141 AS INT))', 'k + 2')} "
        "END AS upgrade_date",
        f"CASE WHEN {UPGRADED} THEN {_pick(UPGRADE_MRR_TEXT, pi)} END AS upgrade_mrr_usd",
        "CASE WHEN k % 3 = 0 THEN 'annual' ELSE 'monthly' END AS billing_cycle",
        f"cast(k * 2 + dup AS BIGINT) AS {ROW_SEQ}",
    )


def bronze_subscriptions(customer: DataFrame) -> DataFrame:
    return _subscription_rows(customer).drop("k", "dup")


def bronze_transactions(orders: DataFrame) -> DataFrame:
    x = orders.selectExpr(
        "o_orderkey AS k", "o_custkey",
        "cast(o_totalprice AS DECIMAL(12,2)) AS price",
        "date_add(cast(o_orderdate AS DATE), 0) AS d0",
        _dup("o_orderkey % 89 = 12"),
    )
    d = "date_add(d0, dup)"
    return x.selectExpr(
        f"concat('TXN-', {_pad('k', 9)}) AS transaction_id",
        f"CASE WHEN k % 33 = 2 THEN NULL ELSE {_cust_id('o_custkey')} END AS customer_id",
        f"{mixed_date_text(d, 'k')} AS transaction_date",
        "CASE WHEN k % 47 = 3 THEN concat('-', cast(price AS STRING)) WHEN k % 67 = 5 THEN '0.0' "
        "WHEN k % 101 = 7 THEN NULL ELSE cast(price AS STRING) END AS amount",
        "CASE WHEN k % 7 = 3 THEN 'eur' WHEN k % 7 = 4 THEN 'GBP' ELSE ' usd' END AS currency",
        f"{_pick(PAYMENT_METHODS, 'k % 4')} AS payment_method",
        "CASE WHEN k % 97 = 1 THEN NULL WHEN k % 100 < 87 THEN 'success' WHEN k % 100 < 94 THEN 'failed' "
        "WHEN k % 100 < 98 THEN 'Pending' ELSE 'refunded' END AS status",
        "CASE WHEN k % 50 = 0 THEN '0.12' "
        "ELSE cast(cast(price * cast(0.02 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS STRING) END AS fee_usd",
        f"{_pick(CHANNELS, '(k % 7) % 4')} AS channel",
        "concat('Nation_', cast(k % 25 AS STRING)) AS country",
        f"{_pick(DESCRIPTIONS, 'k % 5')} AS description",
        f"cast(k * 2 + dup AS BIGINT) AS {ROW_SEQ}",
    )


def bronze_monthly_revenue(customer: DataFrame) -> DataFrame:
    """One row per subscription and schedule month.

    Months kept: all of them unless churned, then the first 2 + k%12; the
    sequence is generated to that length directly (no filter on a product).
    """
    x = _subscription_rows(customer).select(
        "k", "dup", "subscription_id", "customer_id", "plan", "billing_cycle", "mrr_usd", "upgrade_mrr_usd",
    ).selectExpr(
        "*",
        f"year({_base_date('k')}) * 12 + month({_base_date('k')}) - 1 AS mi0",
        f"year(date_add({_base_date('k')}, cast(60 + k % 141 AS INT))) * 12 "
        f"+ month(date_add({_base_date('k')}, cast(60 + k % 141 AS INT))) - 1 AS umi",
        f"{UPGRADED} AS up",
        f"explode(sequence(0, CASE WHEN {CHURNED} THEN least({SCHEDULE_MONTHS - 1}, 1 + k % 12) "
        f"ELSE {SCHEDULE_MONTHS - 1} END)) AS i",
    ).where(f"mi0 + i <= {LAST_MONTH_INDEX}")
    mi = "(mi0 + i)"
    return x.selectExpr(
        f"concat('REV-', substring(subscription_id, 5), '-', {_pad('i', 2)}) AS revenue_id",
        "subscription_id",
        "customer_id",
        f"cast(make_date(cast(floor({mi} / 12) AS INT), cast({mi} % 12 + 1 AS INT), 1) AS STRING) AS month",
        f"CASE WHEN up AND {mi} >= umi THEN upgrade_mrr_usd ELSE mrr_usd END AS mrr_usd",
        "plan",
        "billing_cycle",
        f"cast((k * 2 + dup) * 100 + i AS BIGINT) AS {ROW_SEQ}",
    )


def dealt(customer: DataFrame) -> DataFrame:
    """``customer`` in even parts, as many as its rows (counted from the files' footers) call for.

    A file is read by as few tasks as it has row groups, and a row group may hold a million
    customers. Rows go round, whatever keys they have.
    """
    parts = -(-customer.count() // CUSTOMERS_PER_TASK)
    return customer.repartition(parts) if parts > 1 else customer


def fixture_bronze(spark: SparkSession, sf_dir: str) -> LazyBronze:
    """The four tables, each built when it is first used: a query rarely needs all."""
    source = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    customer = cache(lambda: dealt(source("customer")))
    return LazyBronze(
        customers=lambda: bronze_customers(customer()),
        subscriptions=lambda: bronze_subscriptions(customer()),
        transactions=lambda: bronze_transactions(source("orders")),
        monthly_revenue=lambda: bronze_monthly_revenue(customer()),
    )
