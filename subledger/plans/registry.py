"""Query registry: ``name -> (spark builder, oracle SQL)``.

Each builder takes ``(spark, sf_dir)``, derives the bronze tables from the
driver tables in ``sf_dir`` and returns the lazily planned result over the
whole input. Decimal outputs are reported as DOUBLE (``report``) so that both
engines hand over the same value types; the library itself keeps decimals.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger.functions import iso_date, multi_format_date, whole_number
from subledger.functions.scalars import ISO_DATE, OTHER_DATE_LAYOUTS
from subledger.operators import quality
from subledger.operators.dedup import dropped_duplicates
from subledger.operators.distinct import customer_bitmaps, customer_numbers, distinct_customers
from subledger.operators.materialise import materialised
from subledger.operators.ordering import numbered
from subledger.operators.revenue import revenue_histogram
from subledger.operators.schedule import expand_monthly_revenue
from subledger.operators.upsert import incremental_gate, keyed_upsert
from subledger.params import DEFAULT_PLAN_PRICE, PLAN_PRICES, RunParams
from subledger.plans import kpi, marts, pipeline
from subledger.plans import oracle as o
from subledger.plans.monthly import MonthlyMrr
from subledger.plans.quarantine import flagged_at, quarantine_transactions
from subledger.plans.silver import deduped
from subledger.plans.warehouse import Warehouse
from subledger.session import checkpoint_dir
from subledger.sources.bronze import BRONZE_COLUMNS, Bronze
from subledger.sources.fixtures import FIXTURE_PARAMS, bronze_transactions, fixture_bronze

Builder = Callable[[SparkSession, str], DataFrame]

# Scenario of the incremental quarantine queries: a first load holding the
# orders placed before DAY1_CUTOFF, flagged at DAY1_RUN_TS; then the full
# reload, flagged at the fixture's run timestamp.
DAY1_CUTOFF = dt.date(1995, 6, 17)
DAY1_PARAMS = RunParams(as_of=FIXTURE_PARAMS.as_of, run_ts=dt.datetime(2001, 6, 30, 6, 0, 0))


def report(df: DataFrame) -> DataFrame:
    """Decimal columns as DOUBLE for the cross-engine comparison."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(fixture_bronze(spark, sf_dir), FIXTURE_PARAMS)


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None  # final SELECT over oracle relations; None -> rows-only check
    doubles: tuple[str, ...] = ()  # oracle columns to cast to DOUBLE
    bigints: tuple[str, ...] = ()  # oracle columns to cast to BIGINT (DuckDB HUGEINT sums)
    extra_relations: dict | None = None

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        sql = self.sql
        casts = [f"CAST({c} AS DOUBLE) AS {c}" for c in self.doubles]
        casts += [f"CAST({c} AS BIGINT) AS {c}" for c in self.bigints]
        if casts:
            sql = f"SELECT * REPLACE ({', '.join(casts)}) FROM ({sql}) q"
        return o.with_relations(sql, self.extra_relations)


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, doubles=(), bigints=(), extra_relations=None):
    def deco(fn: Builder) -> Builder:
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return report(fn(spark, sf_dir))

        build.__name__ = name
        REGISTRY[name] = Query(name, build, sql, tuple(doubles), tuple(bigints), extra_relations)
        return build

    return deco


# ---------------------------------------------------------------------------
# Dedup (W1-W4) and silver
# ---------------------------------------------------------------------------

def _bronze_cols(table: str) -> str:
    return ", ".join((*BRONZE_COLUMNS[table], "row_seq"))


for _t in ("customers", "subscriptions", "transactions", "monthly_revenue"):
    def _mk(t):
        @register(f"dedup_{t}", f"SELECT {_bronze_cols(t)} FROM d_{t}")
        def _q(spark, sf_dir, t=t):
            return deduped(fixture_bronze(spark, sf_dir), t)
    _mk(_t)


@register("stg_customers", "SELECT * FROM stg_customers", doubles=("cac_usd",))
def q_stg_customers(spark, sf_dir):
    return _wh(spark, sf_dir).stg_customers


@register("stg_subscriptions", "SELECT * FROM stg_subscriptions", doubles=("mrr_usd", "upgrade_mrr_usd"))
def q_stg_subscriptions(spark, sf_dir):
    return _wh(spark, sf_dir).stg_subscriptions


@register("stg_transactions", "SELECT * FROM stg_transactions", doubles=("amount_usd", "fee_usd"))
def q_stg_transactions(spark, sf_dir):
    return _wh(spark, sf_dir).stg_transactions


@register("stg_monthly_revenue", "SELECT * FROM stg_monthly_revenue", doubles=("mrr_usd",))
def q_stg_monthly_revenue(spark, sf_dir):
    return _wh(spark, sf_dir).stg_monthly_revenue


# ---------------------------------------------------------------------------
# Quarantine
# ---------------------------------------------------------------------------

@register("quarantine_customers", "SELECT * FROM quarantine_customers")
def q_quarantine_customers(spark, sf_dir):
    return _wh(spark, sf_dir).quarantine_customers


@register("quarantine_subscriptions", "SELECT * FROM quarantine_subscriptions")
def q_quarantine_subscriptions(spark, sf_dir):
    return _wh(spark, sf_dir).quarantine_subscriptions


@register("quarantine_transactions", "SELECT * FROM quarantine_transactions")
def q_quarantine_transactions(spark, sf_dir):
    return _wh(spark, sf_dir).quarantine_transactions


# ---------------------------------------------------------------------------
# Gold: MRR
# ---------------------------------------------------------------------------

@register("mrr_by_month_plan", "SELECT * FROM g_mrr_by_month",
          doubles=("total_mrr", "avg_mrr_per_customer"))
def q_mrr_by_month_plan(spark, sf_dir):
    return _wh(spark, sf_dir).mrr_components["mrr_by_month"]


@register("first_revenue_month", "SELECT * FROM g_first_revenue_month")
def q_first_revenue_month(spark, sf_dir):
    return _wh(spark, sf_dir).mrr_components["first_revenue_month"].select("customer_id", "first_month")


@register("new_mrr", "SELECT * FROM g_new_mrr", doubles=("new_mrr",))
def q_new_mrr(spark, sf_dir):
    return _wh(spark, sf_dir).mrr_components["new_mrr"]


@register("expansion_mrr", "SELECT * FROM g_expansion_mrr", doubles=("expansion_mrr",))
def q_expansion_mrr(spark, sf_dir):
    return _wh(spark, sf_dir).mrr_components["expansion_mrr"]


@register("churned_mrr", "SELECT * FROM g_churned_mrr", doubles=("churned_mrr",))
def q_churned_mrr(spark, sf_dir):
    return _wh(spark, sf_dir).mrr_components["churned_mrr"]


@register("mrr_total_month", "SELECT * FROM g_mrr_total", doubles=("total_mrr",),
          bigints=("total_active_customers",))
def q_mrr_total_month(spark, sf_dir):
    return _wh(spark, sf_dir).mrr_components["mrr_total"]


MART_MRR_DOUBLES = ("total_mrr", "avg_mrr_per_customer", "total_mrr_all_plans", "new_mrr",
                    "expansion_mrr", "churned_mrr", "net_new_mrr", "mrr_growth_rate_pct", "arr")


@register("mart_mrr", "SELECT * FROM mart_mrr", doubles=MART_MRR_DOUBLES,
          bigints=("total_active_customers",))
def q_mart_mrr(spark, sf_dir):
    return _wh(spark, sf_dir).mart_mrr


@register("mrr_growth_monthly", """
SELECT t.revenue_month, t.total_mrr,
  round((t.total_mrr - b.total_mrr) / nullif(b.total_mrr, 0) * 100, 2) AS mrr_growth_rate_pct
FROM g_mrr_total t ASOF LEFT JOIN g_mrr_total b ON b.revenue_month < t.revenue_month""",
          doubles=("total_mrr", "mrr_growth_rate_pct"))
def q_mrr_growth_monthly(spark, sf_dir):
    return _wh(spark, sf_dir).mrr_components["growth"].select(
        "revenue_month", "total_mrr", "mrr_growth_rate_pct")


# ---------------------------------------------------------------------------
# Gold: unit economics
# ---------------------------------------------------------------------------

@register("customer_revenue_summary", "SELECT * FROM g_avg_mrr_per_customer",
          doubles=("avg_monthly_mrr", "total_revenue_to_date"))
def q_customer_revenue_summary(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return marts.customer_revenue_summary(w.stg_monthly_revenue)


@register("churn_by_plan", "SELECT * FROM g_churn_by_plan", bigints=("churned_customers",))
def q_churn_by_plan(spark, sf_dir):
    return marts.churn_by_plan(_wh(spark, sf_dir).stg_subscriptions)


MART_CAC_DOUBLES = ("cac_usd", "mrr_usd", "avg_monthly_mrr", "total_revenue_to_date", "cac_payback_months")


@register("mart_cac_ltv", "SELECT * FROM g_customer_metrics", doubles=MART_CAC_DOUBLES)
def q_mart_cac_ltv(spark, sf_dir):
    return _wh(spark, sf_dir).mart_cac_ltv


_AVERAGES = {"avg_cac": ("cac_usd", 2), "avg_ltv": ("projected_ltv", 2), "avg_ltv_cac_ratio": ("ltv_cac_ratio", 2),
             "avg_payback_months": ("cac_payback_months", 1)}
_AVERAGES_SQL = ", ".join(f"round(avg({c}), {n}) AS {name}" for name, (c, n) in _AVERAGES.items())
_HEALTH_SQL = ", ".join(f"count(*) FILTER (unit_economics_health = '{h}') AS {h}_count"
                        for h in ("excellent", "healthy", "marginal", "poor"))


@register("cac_channel_summary", f"""
SELECT acquisition_channel, len(list(DISTINCT customer_id)) AS total_customers, sum(mrr_usd) AS total_mrr,
  {_AVERAGES_SQL}, {_HEALTH_SQL}
FROM g_customer_metrics GROUP BY ALL""",
          doubles=("avg_cac", "avg_ltv", "avg_ltv_cac_ratio", "avg_payback_months", "total_mrr"))
def q_cac_channel_summary(spark, sf_dir):
    return marts.cac_channel_summary(_wh(spark, sf_dir).customer_metrics)


# ---------------------------------------------------------------------------
# Gold: payments
# ---------------------------------------------------------------------------

@register("tx_monthly_summary", "SELECT * FROM g_tx_monthly_summary",
          doubles=("successful_volume_usd", "avg_transaction_value_usd", "total_fees_usd"))
def q_tx_monthly_summary(spark, sf_dir):
    return marts.tx_monthly_summary(_wh(spark, sf_dir).stg_transactions)


@register("tx_payment_method_summary", "SELECT * FROM g_tx_payment_method_summary",
          doubles=("total_volume_usd", "avg_transaction_value_usd"))
def q_tx_payment_method_summary(spark, sf_dir):
    return marts.tx_payment_method_summary(_wh(spark, sf_dir).stg_transactions)


@register("tx_channel_summary", "SELECT * FROM g_tx_channel_summary", doubles=("total_volume_usd",))
def q_tx_channel_summary(spark, sf_dir):
    return marts.tx_channel_summary(_wh(spark, sf_dir).stg_transactions)


MART_TX_DOUBLES = ("amount_usd", "fee_usd", "month_successful_volume_usd", "payment_method_total_volume_usd")


@register("mart_transactions", "SELECT * FROM mart_transactions", doubles=MART_TX_DOUBLES)
def q_mart_transactions(spark, sf_dir):
    return _wh(spark, sf_dir).mart_transactions


# ---------------------------------------------------------------------------
# Dashboard tiles
# ---------------------------------------------------------------------------

_TREND_SQL = """
SELECT revenue_month, max(total_mrr_all_plans) AS total_mrr, max(arr) AS arr,
  max(total_active_customers) AS total_active_customers
FROM mart_mrr GROUP BY revenue_month"""


@register("mrr_trend", _TREND_SQL, doubles=("total_mrr", "arr"), bigints=("total_active_customers",))
def q_mrr_trend(spark, sf_dir):
    return kpi.mrr_trend(_wh(spark, sf_dir).mart_mrr)


@register("kpi_mrr_latest",
          f"SELECT * FROM ({_TREND_SQL}) tr WHERE revenue_month = (SELECT max(revenue_month) FROM mart_mrr)",
          doubles=("total_mrr", "arr"), bigints=("total_active_customers",))
def q_kpi_mrr_latest(spark, sf_dir):
    return kpi.kpi_mrr_latest(_wh(spark, sf_dir).mart_mrr)


@register("mrr_by_plan", "SELECT plan, sum(total_mrr) AS total_mrr, count(*) AS months FROM mart_mrr GROUP BY plan",
          doubles=("total_mrr",))
def q_mrr_by_plan(spark, sf_dir):
    return kpi.mrr_by_plan(_wh(spark, sf_dir).mart_mrr)


@register("mrr_movement", """
SELECT revenue_month, max(new_mrr) AS new_mrr, max(expansion_mrr) AS expansion_mrr,
  max(churned_mrr) AS churned_mrr, max(net_new_mrr) AS net_new_mrr
FROM mart_mrr GROUP BY revenue_month""", doubles=("new_mrr", "expansion_mrr", "churned_mrr", "net_new_mrr"))
def q_mrr_movement(spark, sf_dir):
    return kpi.mrr_movement(_wh(spark, sf_dir).mart_mrr)


@register("customers_by_country",
          "SELECT country, count(DISTINCT customer_id) AS customers FROM g_customer_metrics GROUP BY country")
def q_customers_by_country(spark, sf_dir):
    return kpi.customers_by_country(_wh(spark, sf_dir).mart_cac_ltv)


@register("quarantine_breakdown", """
SELECT source_table, issue_type, count(*) AS rows FROM quarantine_customers GROUP BY ALL
UNION ALL SELECT source_table, issue_type, count(*) FROM quarantine_subscriptions GROUP BY ALL
UNION ALL SELECT source_table, issue_type, count(*) FROM quarantine_transactions GROUP BY ALL""")
def q_quarantine_breakdown(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return kpi.quarantine_breakdown(w.quarantine_customers, w.quarantine_subscriptions, w.quarantine_transactions)


@register("kpi_transactions", o.payments("", "total_transactions", "success_rate_pct", "failure_rate_pct",
                                         "volume:successful_volume_usd", source="mart_transactions"),
          doubles=("successful_volume_usd",))
def q_kpi_transactions(spark, sf_dir):
    return kpi.kpi_transactions(_wh(spark, sf_dir).stg_transactions)


@register("payment_tiles", "\nUNION ALL BY NAME\n".join(
    f"SELECT '{level}' AS level, * FROM ({o.payments(key, *o.TILE_METRICS)})"
    for level, key in (("month", "transaction_month"), ("payment_method", "payment_method"), ("channel", "channel"), ("all", ""))),
    doubles=("successful_volume_usd", "total_fees_usd"))
def q_payment_tiles(spark, sf_dir):
    return marts.payment_tiles(_wh(spark, sf_dir).stg_transactions)


@register("kpi_unit_economics", f"SELECT {_AVERAGES_SQL} FROM g_customer_metrics", doubles=tuple(_AVERAGES))
def q_kpi_unit_economics(spark, sf_dir):
    return kpi.kpi_unit_economics(_wh(spark, sf_dir).mart_cac_ltv)


@register("ltv_by_plan",
          "SELECT plan, round(avg(projected_ltv), 2) AS avg_ltv, count(*) AS rows FROM g_customer_metrics GROUP BY plan",
          doubles=("avg_ltv",))
def q_ltv_by_plan(spark, sf_dir):
    return kpi.ltv_by_plan(_wh(spark, sf_dir).mart_cac_ltv)


@register("health_by_plan",
          "SELECT plan, unit_economics_health, count(*) AS rows FROM g_customer_metrics GROUP BY ALL")
def q_health_by_plan(spark, sf_dir):
    return kpi.health_by_plan(_wh(spark, sf_dir).mart_cac_ltv)


# ---------------------------------------------------------------------------
# Data quality (Q1-Q3, Q8)
# ---------------------------------------------------------------------------

def _silver_and_quarantine(w: Warehouse) -> dict[str, DataFrame]:
    return {
        "stg_customers": w.stg_customers,
        "stg_subscriptions": w.stg_subscriptions,
        "stg_transactions": w.stg_transactions,
        "stg_monthly_revenue": w.stg_monthly_revenue,
        "quarantine_customers": w.quarantine_customers,
        "quarantine_subscriptions": w.quarantine_subscriptions,
        "quarantine_transactions": w.quarantine_transactions,
    }


def _status_sql(inner: str) -> str:
    return f"""
SELECT model, column_name, test_name, severity, CAST(failures AS BIGINT) AS failures,
  CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status
FROM ({inner}) t"""


_NOT_NULL_SQL = _status_sql("\nUNION ALL\n".join(
    f"SELECT '{t.model}' AS model, '{t.column}' AS column_name, 'not_null' AS test_name, "
    f"'{t.severity}' AS severity, count(*) FILTER (WHERE {t.column} IS NULL) AS failures FROM {t.model}"
    for t in quality.SCHEMA_TESTS if t.test == "not_null"
))
_UNIQUE_SQL = _status_sql("\nUNION ALL\n".join(
    f"SELECT '{t.model}' AS model, '{t.column}' AS column_name, 'unique' AS test_name, "
    f"'{t.severity}' AS severity, (SELECT count(*) FROM (SELECT {t.column} FROM {t.model} "
    f"WHERE {t.column} IS NOT NULL GROUP BY {t.column} HAVING count(*) > 1)) AS failures"
    for t in quality.SCHEMA_TESTS if t.test == "unique"
))


@register("dq_not_null", _NOT_NULL_SQL)
def q_dq_not_null(spark, sf_dir):
    return quality.not_null_report(_silver_and_quarantine(_wh(spark, sf_dir)))


@register("dq_unique", _UNIQUE_SQL)
def q_dq_unique(spark, sf_dir):
    return quality.unique_report(_silver_and_quarantine(_wh(spark, sf_dir)))


# Fixed check list of the bronze anomaly profile: table -> check -> (kind, column).
ANOMALY_CHECKS: dict[str, dict[str, tuple[str, str]]] = {
    "customers": {
        "duplicate_ids": ("duplicates", "customer_id"), "null_ids": ("nulls", "customer_id"),
        "negative_cac": ("negative", "cac_usd"), "non_iso_dates": ("non_iso", "signup_date"),
        "null_email": ("nulls", "email"),
    },
    "subscriptions": {
        "duplicate_ids": ("duplicates", "subscription_id"), "repeated_customers": ("duplicates", "customer_id"),
        "null_customer_id": ("nulls", "customer_id"), "null_plan": ("nulls", "plan"),
        "zero_mrr": ("zero", "mrr_usd"), "non_iso_dates": ("non_iso", "start_date"),
    },
    "transactions": {
        "duplicate_ids": ("duplicates", "transaction_id"), "null_customer_id": ("nulls", "customer_id"),
        "negative_amounts": ("negative", "amount"), "zero_amounts": ("zero", "amount"),
        "null_status": ("nulls", "status"), "non_iso_dates": ("non_iso", "transaction_date"),
        "future_dates": ("future", "transaction_date"),
    },
    "monthly_revenue": {
        "duplicate_ids": ("duplicates", "revenue_id"), "null_mrr": ("nulls", "mrr_usd"),
        "zero_mrr": ("zero", "mrr_usd"), "non_iso_dates": ("non_iso", "month"),
        "future_dates": ("future", "month"),
    },
}


def anomaly_spark(kind: str, col: str, params: RunParams = FIXTURE_PARAMS):
    c = F.col(col)
    if kind == "duplicates":
        return col  # one row per value, see quality.profile
    return F.count_if({
        "nulls": lambda: c.isNull(),
        "negative": lambda: whole_number(col) < 0,
        "zero": lambda: whole_number(col) == 0,
        "non_iso": lambda: c.isNotNull() & iso_date(col).isNull(),
        "future": lambda: iso_date(col) > F.lit(params.as_of),
    }[kind]())


def anomaly_sql(kind: str, col: str) -> str:
    if kind == "duplicates":
        return f"count({col}) - count(DISTINCT {col})"
    cond = {
        "nulls": f"{col} IS NULL",
        "negative": f"{o.N(col)} < 0",
        "zero": f"{o.N(col)} = 0",
        "non_iso": f"{col} IS NOT NULL AND {o.D(col)} IS NULL",
        "future": f"{o.D(col)} > {o.AS_OF}",
    }[kind]
    return f"count(*) FILTER (WHERE {cond})"


_PROFILE_SQL = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{name}' AS check_name, CAST({anomaly_sql(*spec)} AS BIGINT) AS failures FROM b_{t}"
    for t, checks in ANOMALY_CHECKS.items() for name, spec in checks.items()
)


@register("bronze_anomaly_profile", _PROFILE_SQL)
def q_bronze_anomaly_profile(spark, sf_dir):
    from functools import reduce

    b = fixture_bronze(spark, sf_dir)
    parts = [quality.profile(b.table(t), t, {n: anomaly_spark(*spec) for n, spec in checks.items()})
             for t, checks in ANOMALY_CHECKS.items()]
    return reduce(DataFrame.unionByName, parts)


# ---------------------------------------------------------------------------
# Incremental quarantine: keyed upsert, new column, gate, fix cycle
# ---------------------------------------------------------------------------

def _day1_bronze(spark: SparkSession, sf_dir: str) -> Bronze:
    full = fixture_bronze(spark, sf_dir)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    first = orders.where(F.col("o_orderdate") < F.lit(DAY1_CUTOFF).cast("timestamp"))
    return full.replace(transactions=bronze_transactions(first))


def _repaired_bronze(b: Bronze) -> Bronze:
    """The source system corrected the sign of negative amounts."""
    tx = b.transactions.withColumn("amount", F.regexp_replace("amount", "^-", ""))
    return b.replace(transactions=tx)


_DAY1_TS = "TIMESTAMP '2001-06-30 06:00:00'"
_DAY1_REL = {
    "b_transactions_day1": o.bronze_transactions_sql(
        f"(SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{DAY1_CUTOFF.isoformat()}')"),
    "d_transactions_day1": o.first_copies("b_transactions_day1", "transaction_id", "transaction_date"),
    "q_target": o.quarantine_transactions_sql("d_transactions_day1", run_ts=_DAY1_TS),
}
_GATE2 = f"{o.RUN_TS} > (SELECT max(flagged_at) FROM q_target)"


def _upsert_sql(target: str, batch: str) -> str:
    return f"""
SELECT * FROM {target} WHERE row_id IS NULL
UNION ALL BY NAME
SELECT * FROM {target} t WHERE row_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM {batch} b WHERE b.row_id = t.row_id)
UNION ALL BY NAME
SELECT * FROM {batch}"""


@register("quarantine_upsert", _upsert_sql("q_target", "q_batch"),
          extra_relations={**_DAY1_REL, "q_batch": o.quarantine_transactions_sql("d_transactions", _GATE2)})
def q_quarantine_upsert(spark, sf_dir):
    target = quarantine_transactions(_day1_bronze(spark, sf_dir), DAY1_PARAMS)
    full = fixture_bronze(spark, sf_dir)
    gate = incremental_gate(flagged_at(FIXTURE_PARAMS), target)
    batch = quarantine_transactions(full, FIXTURE_PARAMS, gate)
    return keyed_upsert(target, batch, "row_id")


@register("quarantine_upsert_new_column", _upsert_sql("q_target", "q_batch_v2"),
          extra_relations={**_DAY1_REL, "q_batch_v2": o.quarantine_transactions_sql(
              "d_transactions", _GATE2, extra=", fee_usd AS raw_fee_usd")})
def q_quarantine_upsert_new_column(spark, sf_dir):
    target = quarantine_transactions(_day1_bronze(spark, sf_dir), DAY1_PARAMS)
    full = fixture_bronze(spark, sf_dir)
    gate = incremental_gate(flagged_at(FIXTURE_PARAMS), target)
    batch = quarantine_transactions(full, FIXTURE_PARAMS, gate, extra={"raw_fee_usd": F.col("fee_usd")})
    return keyed_upsert(target, batch, "row_id")


@register("quarantine_incremental_gate", "SELECT * FROM q_rerun",
          extra_relations={**_DAY1_REL, "q_rerun": o.quarantine_transactions_sql(
              "d_transactions", f"{_DAY1_TS} > (SELECT max(flagged_at) FROM q_target)",
              run_ts=_DAY1_TS)})
def q_quarantine_incremental_gate(spark, sf_dir):
    """A re-run at the target's own timestamp: the gate is false, so rows whose
    only defect is a non-positive amount are not re-flagged; null id, customer
    and amount rows still are (the gate binds to the last disjunct only)."""
    target = quarantine_transactions(_day1_bronze(spark, sf_dir), DAY1_PARAMS)
    gate = incremental_gate(flagged_at(DAY1_PARAMS), target)
    return quarantine_transactions(fixture_bronze(spark, sf_dir), DAY1_PARAMS, gate)


_FIX_REL = {
    "q_v1": o.quarantine_transactions_sql("d_transactions", run_ts=_DAY1_TS),
    "b_transactions_fixed": "SELECT * REPLACE (regexp_replace(amount, '^-', '') AS amount) FROM b_transactions",
    "d_transactions_fixed": o.first_copies("b_transactions_fixed", "transaction_id", "transaction_date"),
    "q_fix_batch": o.quarantine_transactions_sql(
        "d_transactions_fixed", f"{o.RUN_TS} > (SELECT max(flagged_at) FROM q_v1)"),
}


@register("fix_cycle_replay", _upsert_sql("q_v1", "q_fix_batch"), extra_relations=_FIX_REL)
def q_fix_cycle_replay(spark, sf_dir):
    """Quarantine, fix at source, reload: the repaired rows leave the batch (and
    reach silver), while their old quarantine rows stay as history."""
    full = fixture_bronze(spark, sf_dir)
    v1 = quarantine_transactions(full, DAY1_PARAMS)
    gate = incremental_gate(flagged_at(FIXTURE_PARAMS), v1)
    batch = quarantine_transactions(_repaired_bronze(full), FIXTURE_PARAMS, gate)
    return keyed_upsert(v1, batch, "row_id")


def _replayed(spark: SparkSession, sf_dir: str) -> str:
    """Payment tables built from the load as it came, then taken to the repaired load by
    its change set; the folder they are in."""
    full = fixture_bronze(spark, sf_dir)
    root = f"{checkpoint_dir(spark).rstrip('/')}/fix-cycle-{uuid.uuid4().hex}"
    pipeline.build_transactions(spark, root, full.transactions, DAY1_PARAMS)
    repaired = _repaired_bronze(full).transactions
    pipeline.reload_transactions(spark, root, full.transactions, repaired, FIXTURE_PARAMS)
    return root


_FIXED = {"b_transactions_fixed": _FIX_REL["b_transactions_fixed"],
          "d_transactions": o.first_copies("b_transactions_fixed", "transaction_id", "transaction_date")}


@register("fix_cycle_replay_silver", "SELECT * FROM stg_transactions", doubles=("amount_usd", "fee_usd"),
          extra_relations=_FIXED)
def q_fix_cycle_replay_silver(spark, sf_dir):
    """Silver after the reload: equal to one built from the repaired load."""
    return pipeline.read_table(spark, _replayed(spark, sf_dir), "stg_transactions")


@register("fix_cycle_replay_mart", "SELECT * FROM mart_transactions", doubles=MART_TX_DOUBLES, extra_relations=_FIXED)
def q_fix_cycle_replay_mart(spark, sf_dir):
    """The payments mart after the reload: equal to one built from the repaired load."""
    return pipeline.read_table(spark, _replayed(spark, sf_dir), "mart_transactions")


_REVENUE_FIX = "month >= '2001-04-01' and mrr_usd = '0'"
_FIXED_REVENUE = {
    "b_monthly_revenue_fixed": f"SELECT * REPLACE (CASE WHEN {_REVENUE_FIX} THEN '49' ELSE mrr_usd END AS mrr_usd) FROM b_monthly_revenue",
    "d_monthly_revenue": o.first_copies("b_monthly_revenue_fixed", "revenue_id", "month"),
}


@register("fix_cycle_replay_mrr", "SELECT * FROM mart_mrr", doubles=MART_MRR_DOUBLES, bigints=("total_active_customers",),
          extra_relations=_FIXED_REVENUE)
def q_fix_cycle_replay_mrr(spark, sf_dir):
    """The MRR mart after revenue booked as zero in its last months was corrected at the source:
    those months are written again, the folders of the months before them are left alone."""
    full = fixture_bronze(spark, sf_dir).monthly_revenue
    fixed = full.withColumn("mrr_usd", F.when(F.expr(_REVENUE_FIX), "49").otherwise(F.col("mrr_usd")))
    root = f"{checkpoint_dir(spark).rstrip('/')}/fix-cycle-{uuid.uuid4().hex}"
    pipeline.build_revenue(spark, root, full, DAY1_PARAMS)
    pipeline.reload_revenue(spark, root, full, fixed, FIXTURE_PARAMS)
    return pipeline.read_table(spark, root, "mart_mrr")


# ---------------------------------------------------------------------------
# Order (O1-O3), additive distinct counts (A1, A6), month by month (A2-A5)
# ---------------------------------------------------------------------------

@register("mart_mrr_order",
          "SELECT revenue_month, plan, row_number() OVER (ORDER BY revenue_month, plan) AS position FROM mart_mrr")
def q_mart_mrr_order(spark, sf_dir):
    return numbered(_wh(spark, sf_dir).mart_mrr.select("revenue_month", "plan"), [F.col("revenue_month"), F.col("plan")])


@register("mart_cac_ltv_order", """
SELECT signup_date, customer_id, row_number() OVER (ORDER BY signup_date, customer_id) AS position FROM g_customer_metrics""")
def q_mart_cac_ltv_order(spark, sf_dir):
    rows = _wh(spark, sf_dir).customer_metrics.select("signup_date", "customer_id")
    return numbered(rows, [F.col("signup_date"), F.col("customer_id")])


@register("mart_transactions_order", """
SELECT transaction_date, transaction_id, row_number() OVER (ORDER BY transaction_date, transaction_id) AS position
FROM mart_transactions""")
def q_mart_transactions_order(spark, sf_dir):
    rows = _wh(spark, sf_dir).stg_transactions.select("transaction_date", "transaction_id")
    return numbered(rows, [F.col("transaction_date"), F.col("transaction_id")])


@register("customers_per_quarter", """
SELECT CAST(date_trunc('quarter', revenue_month) AS DATE) AS quarter, count(DISTINCT customer_id) AS customers
FROM g_revenue GROUP BY ALL""")
def q_customers_per_quarter(spark, sf_dir):
    """Paying customers per quarter, from the bitmaps per month and plan alone."""
    paying = revenue_histogram(_wh(spark, sf_dir).stg_monthly_revenue)
    bitmaps = materialised(customer_bitmaps(paying, customer_numbers(paying), "revenue_month", "plan"), "customer-bitmaps")
    return distinct_customers(bitmaps, quarter=F.trunc("revenue_month", "quarter"))


@register("mart_mrr_append", "SELECT * FROM mart_mrr", doubles=MART_MRR_DOUBLES, bigints=("total_active_customers",))
def q_mart_mrr_append(spark, sf_dir):
    """The mart of all months but the last, to which the last is appended from the carried state."""
    revenue = materialised(_wh(spark, sf_dir).stg_monthly_revenue, "revenue")
    month = F.trunc("revenue_month", "MM")
    last = F.lit(revenue.agg(F.max(month)).first()[0])
    mart = MonthlyMrr(spark, f"{checkpoint_dir(spark).rstrip('/')}/monthly-mrr-{uuid.uuid4().hex}")
    mart.start(revenue.where(month < last))
    mart.append(revenue.where(month == last))
    return mart.read()


# ---------------------------------------------------------------------------
# Re-aimed operators
# ---------------------------------------------------------------------------

_PRICE_SQL = "CASE lower(trim(plan)) " + " ".join(
    f"WHEN '{n}' THEN {p}" for n, p in PLAN_PRICES
) + f" ELSE {DEFAULT_PLAN_PRICE} END"

_SQL_LAYOUTS = {"yyyy-MM-dd": "%Y-%m-%d", "MM/dd/yyyy": "%m/%d/%Y", "dd/MM/yyyy": "%d/%m/%Y",
                "MM-dd-yyyy": "%m-%d-%Y", "dd-MM-yyyy": "%d-%m-%Y"}


def _multi_sql(col: str) -> str:
    return "coalesce(" + ", ".join(
        f"CAST(try_strptime({col}, '{_SQL_LAYOUTS[f]}') AS DATE)" for f in (ISO_DATE, *OTHER_DATE_LAYOUTS)
    ) + ")"


_HORIZON = o.AS_OF
_SCHEDULE_SQL = f"""
SELECT subscription_id || '-' || strftime(month, '%Y%m') AS revenue_id,
  subscription_id, customer_id, month,
  CASE WHEN month >= up_month THEN up_mrr ELSE base END AS mrr_usd,
  plan, billing_cycle
FROM (
  SELECT *, CAST(unnest(generate_series(first_m, last_m, INTERVAL 1 MONTH)) AS DATE) AS month
  FROM (
    SELECT subscription_id, customer_id, plan, billing_cycle,
      coalesce(CASE WHEN {o.N('mrr_usd')} > 0 THEN {o.N('mrr_usd', 10, 2)} END,
               CAST({_PRICE_SQL} AS DECIMAL(10,2))) AS base,
      CASE WHEN upper(trim(is_upgraded)) IN ('TRUE', '1', 'YES')
            AND {o.N('upgrade_mrr_usd')} > 0
           THEN CAST(date_trunc('month', {_multi_sql('upgrade_date')}) AS DATE) END AS up_month,
      CASE WHEN {o.N('upgrade_mrr_usd')} > 0 THEN {o.N('upgrade_mrr_usd', 10, 2)} END AS up_mrr,
      CAST(date_trunc('month', {_multi_sql('start_date')}) AS DATE) AS first_m,
      CAST(date_trunc('month', least(coalesce({_multi_sql('end_date')}, {_HORIZON}), {_HORIZON})) AS DATE) AS last_m
    FROM (SELECT unnest(r) FROM (SELECT arg_min(b, row_seq) AS r FROM b_subscriptions b GROUP BY subscription_id))
    WHERE subscription_id IS NOT NULL
  ) s
  WHERE first_m <= last_m
)"""


@register("expand_monthly_revenue", _SCHEDULE_SQL, doubles=("mrr_usd",))
def q_expand_monthly_revenue(spark, sf_dir):
    return expand_monthly_revenue(fixture_bronze(spark, sf_dir).subscriptions, FIXTURE_PARAMS.as_of)


def _layout_sql(col: str) -> str:
    return "CASE " + " ".join(
        f"WHEN try_strptime({col}, '{_SQL_LAYOUTS[f]}') IS NOT NULL THEN '{f}'"
        for f in (ISO_DATE, *OTHER_DATE_LAYOUTS)
    ) + " END"


@register("normalize_dates", f"""
SELECT customer_id, signup_date AS raw_signup_date,
  {o.D('signup_date')} AS iso_signup_date,
  {_multi_sql('signup_date')} AS signup_date,
  {_layout_sql('signup_date')} AS date_layout
FROM d_customers""")
def q_normalize_dates(spark, sf_dir):
    """Documented multi-layout date repair (off in the models): ISO first,
    then month-first, then day-first; reports which layout matched."""
    raw = deduped(fixture_bronze(spark, sf_dir), "customers")
    layouts = (ISO_DATE, *OTHER_DATE_LAYOUTS)
    layout = None
    for f in layouts:
        hit = F.try_to_date("signup_date", f).isNotNull()
        layout = F.when(hit, F.lit(f)) if layout is None else layout.when(hit, F.lit(f))
    return raw.select(
        "customer_id",
        F.col("signup_date").alias("raw_signup_date"),
        iso_date("signup_date").alias("iso_signup_date"),
        multi_format_date("signup_date").alias("signup_date"),
        layout.alias("date_layout"),
    )


@register("duplicate_transactions", f"""
SELECT transaction_id AS row_id, 'transactions' AS source_table, customer_id,
  transaction_date AS raw_transaction_date, amount AS raw_amount, status,
  'duplicate_transaction_id' AS issue_type, {o.RUN_TS} AS flagged_at,
  'investigate_payment_processor' AS recommended_action
FROM b_transactions
WHERE transaction_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY transaction_date ASC NULLS LAST, row_seq) > 1""")
def q_duplicate_transactions(spark, sf_dir):
    """Copies of a transaction id that dedup discards (the capture the
    quarantine comment promises but its code never does)."""
    b = fixture_bronze(spark, sf_dir)
    dupes = dropped_duplicates(b.transactions, "transaction_id", "transaction_date")
    return dupes.select(
        F.col("transaction_id").alias("row_id"),
        F.lit("transactions").alias("source_table"),
        "customer_id",
        F.col("transaction_date").alias("raw_transaction_date"),
        F.col("amount").alias("raw_amount"),
        "status",
        F.lit("duplicate_transaction_id").alias("issue_type"),
        flagged_at(FIXTURE_PARAMS).alias("flagged_at"),
        F.lit("investigate_payment_processor").alias("recommended_action"),
    )


# ---------------------------------------------------------------------------
# Bronze bulk load (S5): CSV -> bronze table, rows-only check
# ---------------------------------------------------------------------------

#: Texts that only survive a reader of RFC 4180: put into one text column per table.
_AWKWARD = {"customers": "full_name", "subscriptions": "billing_cycle", "transactions": "description",
            "monthly_revenue": "billing_cycle"}
_AWKWARD_SPARK = "concat({c}, ', \"', {c}, '\"', char(10), 'x')"
_AWKWARD_SQL = "{c} || ', \"' || {c} || '\"' || chr(10) || 'x'"


def _csv_query(table: str):
    column = _AWKWARD[table]
    shown = ", ".join(_AWKWARD_SQL.format(c=c) + f" AS {c}" if c == column else c for c in BRONZE_COLUMNS[table])
    name = "bronze_load_csv" if table == "transactions" else f"bronze_load_csv_{table}"

    @register(name, f"SELECT {shown} FROM b_{table}")
    def load(spark, sf_dir):
        """Derived bronze rows, with commas, quotes and line breaks in one column,
        written as raw CSV into the shared folder and bulk-loaded back as bronze."""
        from subledger.sources.bronze import CORRUPT, ROW_SEQ, load_csv

        root = f"{checkpoint_dir(spark).rstrip('/')}/csv-load-{uuid.uuid4().hex}"
        rows = fixture_bronze(spark, sf_dir).table(table).drop(ROW_SEQ)
        rows = rows.withColumn(column, F.expr(_AWKWARD_SPARK.format(c=column)))
        (rows.write.option("header", True).option("quote", '"').option("escape", '"')
             .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
             .csv(f"{root}/csv"))
        return load_csv(spark, f"{root}/csv", table, f"{root}/bronze", multi_line=True).drop(ROW_SEQ, CORRUPT)


for _t in _AWKWARD:
    _csv_query(_t)


def queries() -> dict[str, Builder]:
    return {name: q.build for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, q in REGISTRY.items() if (sql := q.oracle()) is not None}
