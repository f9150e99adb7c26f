"""Gold marts: MRR movements, unit economics, payment analytics.

Month / plan / payment-method / channel aggregates are computed first, written
to the shared folder and joined to the detail rows by ``context_join``: a
broadcast after their rows were counted, a salted shuffle join beyond that. So
no detail row is ever shuffled on one of these few keys, whatever the planner
estimates. Customer-grain joins stay shuffle joins; the one-to-many customer ->
subscriptions join is an inner join of two directly shuffled sides (which AQE
splits when a customer is hot) plus an anti join for customers without one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types

from subledger.operators import revenue as rv
from subledger.operators.materialise import context_join, materialised
from subledger.operators.rules import first_match
from subledger.params import HEALTH_CLASSES, HEALTH_DEFAULT, STATUS_PENDING

T = rv.T


def _rate_pct(flag_col: str, n: Column | None = None) -> Column:
    """round(count(flag) :: double / nullif(count(*), 0) * 100, 2)"""
    n = F.count(F.lit(1)) if n is None else n
    return F.round(F.count_if(F.col(flag_col)).cast("double") / F.nullif(n, F.lit(0)) * 100, 2)


# ---- mart_mrr (C8) ---------------------------------------------------------

def mrr_components(revenue: DataFrame) -> dict[str, DataFrame]:
    """Every step of the MRR mart, from silver monthly revenue; nothing runs before one is used."""
    hist = rv.revenue_histogram(revenue)
    cm = rv.customer_month(hist)
    by_plan = rv.mrr_by_month_plan(hist)
    totals = rv.month_totals(by_plan)
    return {
        "hist": hist,
        "customer_month": cm,
        "mrr_by_month": by_plan,
        "first_revenue_month": rv.first_revenue_month(cm),
        "new_mrr": rv.new_mrr(cm),
        "expansion_mrr": rv.expansion_mrr(hist),
        "churned_mrr": rv.churned_mrr(cm),
        "mrr_total": totals,
        "growth": rv.month_growth(totals),
    }


def mart_mrr(revenue: DataFrame) -> DataFrame:
    """C8, in order of month and plan."""
    return mart_mrr_of(materialised(rv.revenue_histogram(revenue), "revenue-histogram"))


def mart_mrr_of(hist: DataFrame) -> DataFrame:
    """C8 from a written ``revenue_histogram``."""
    cm = rv.customer_month(hist)
    by_plan = materialised(rv.mrr_by_month_plan(hist), "mrr-by-month-plan")
    growth = rv.month_growth(rv.month_totals(by_plan))
    return mrr_rows(by_plan, growth, rv.new_and_expansion(cm, hist), rv.churned_mrr(cm)).orderBy(T, "plan")


def mrr_rows(by_plan: DataFrame, growth: DataFrame, new_and_expansion: DataFrame, churned: DataFrame) -> DataFrame:
    """The mart's rows from its parts, for whichever months these cover.

    Growth is a lag over rows ordered by month and plan: the first plan
    row of a month sees the month before, the others see their own month again,
    so it is a window over months, and 0 (null for a zero total) elsewhere."""
    growth = growth.select(
        T,
        F.col("total_mrr").alias("total_mrr_all_plans"),
        "total_active_customers",
        F.col("mrr_growth_rate_pct").alias("_first_growth"),
    )
    months = growth.join(new_and_expansion, T, "left").join(churned, T, "left")
    in_month = Window.partitionBy(T).orderBy("plan")
    m = by_plan.withColumn("_place", F.row_number().over(in_month))
    j = context_join(m, materialised(months, "mrr-months"), T).withColumn(
        "mrr_growth_rate_pct",
        F.when(F.col("_place") == 1, F.col("_first_growth"))
        .when(F.col("total_mrr_all_plans") != 0, F.lit(0)))
    total = F.col("total_mrr_all_plans")
    z = F.lit(0)
    return j.select(
        T,
        "plan",
        "active_customers",
        "total_mrr",
        "avg_mrr_per_customer",
        "total_mrr_all_plans",
        "total_active_customers",
        F.coalesce("new_mrr", z).alias("new_mrr"),
        F.coalesce("new_customers", z).alias("new_customers"),
        F.coalesce("expansion_mrr", z).alias("expansion_mrr"),
        F.coalesce("expanded_customers", z).alias("expanded_customers"),
        F.coalesce("churned_mrr", z).alias("churned_mrr"),
        F.coalesce("churned_customers", z).alias("churned_customers"),
        (F.coalesce("new_mrr", z) + F.coalesce("expansion_mrr", z)
         + F.coalesce("churned_mrr", z)).alias("net_new_mrr"),
        "mrr_growth_rate_pct",
        (total * 12).alias("arr"),
    )


# ---- mart_cac_ltv (C9) -----------------------------------------------------

#: Most tasks among which the rows of one customer and month are spread.
SALTS = 64


def customer_revenue_summary(revenue: DataFrame) -> DataFrame:
    """Per-customer average / total MRR, months with revenue, first/last.

    A customer's months hold a row each, so sums before a shuffle on customer and month save
    little, and adaptive execution would merge them into hash tables of millions of groups. Both
    steps keep all shuffle partitions: rows are summed by customer, month and salt, then
    by customer, of whom no task sees more than SALTS rows a month.
    """
    mrr = revenue.schema["mrr_usd"].dataType
    total_type = types.DecimalType(min(mrr.precision + 10, 38), mrr.scale)  # as of a sum, and of an average
    avg_type = types.DecimalType(min(mrr.precision + 4, 38), min(mrr.scale + 4, 38))
    of = ["revenue_id"] if "revenue_id" in revenue.columns else revenue.columns  # any salt gives the same sums
    salt = F.pmod(F.xxhash64(*of), F.lit(SALTS)).cast("int")
    r = revenue.where(F.col("mrr_usd").isNotNull()).select("customer_id", T, "mrr_usd", salt.alias("_salt"))
    parts = rv.spread(r, "customer_id", T, "_salt").groupBy("customer_id", T, "_salt").agg(
        F.sum("mrr_usd").alias("_sum"), F.count(F.lit(1)).alias("_n"))
    total = F.sum("_sum").cast(total_type)
    return rv.spread(parts, "customer_id").groupBy("customer_id").agg(
        F.round((total / F.sum("_n")).cast(avg_type), 2).alias("avg_monthly_mrr"),
        total.alias("total_revenue_to_date"),
        F.countDistinct(T).alias("months_with_revenue"),
        F.min(T).alias("first_revenue_month"),
        F.max(T).alias("last_revenue_month"),
    )


def churn_by_plan(subscriptions: DataFrame) -> DataFrame:
    """Lifetime share of churned subscriptions per plan."""
    churned = F.sum(F.when(F.col("is_churned"), 1).otherwise(0))
    n = F.count(F.lit(1))
    return subscriptions.groupBy("plan").agg(
        n.alias("total_customers"),
        churned.alias("churned_customers"),
        F.round(churned.cast("double") / F.nullif(n, F.lit(0)), 4).alias("monthly_churn_rate"),
    )


CAC_LTV_CUSTOMER_COLS = (
    "customer_id", "signup_date", "signup_month", "acquisition_channel", "cac_usd",
    "country", "company_size", "industry",
)
CAC_LTV_SUB_COLS = ("plan", "mrr_usd", "status", "is_churned", "months_active", "billing_cycle")


def customer_metrics(customers: DataFrame, subscriptions: DataFrame, revenue: DataFrame) -> DataFrame:
    """Customer x subscription rows with unit-economics measures (unsorted).

    Ids of all customers lie in little space on disk, and their size is estimated from that; a
    broadcast of them does not fit, so joins by customer are merge joins whatever the estimate.
    """
    cust = materialised(customers.select(*CAC_LTV_CUSTOMER_COLS).join(
        customer_revenue_summary(revenue).select(
            "customer_id", "avg_monthly_mrr", "total_revenue_to_date", "months_with_revenue").hint("merge"),
        "customer_id", "left",
    ), "customer-revenue")
    subs = subscriptions.select("customer_id", "subscription_id", *CAC_LTV_SUB_COLS)
    rates = materialised(churn_by_plan(subscriptions).select("plan", "monthly_churn_rate"), "churn-by-plan")
    # customers LEFT JOIN subscriptions == matched pairs + customers with none
    matched = cust.join(subs.hint("merge"), "customer_id", "inner")
    unmatched = cust.join(subs.select("customer_id").distinct().hint("merge"), "customer_id", "left_anti")
    rows = context_join(matched.unionByName(unmatched, allowMissingColumns=True), rates, "plan")

    avg, rate, cac = F.col("avg_monthly_mrr"), F.col("monthly_churn_rate"), F.col("cac_usd")
    ratio = (avg / F.nullif(rate, F.lit(0))) / F.nullif(cac, F.lit(0))
    health = first_match([(label, ratio >= bound) for label, bound in HEALTH_CLASSES], HEALTH_DEFAULT)
    return rows.select(
        *CAC_LTV_CUSTOMER_COLS,
        *CAC_LTV_SUB_COLS,
        "avg_monthly_mrr",
        "total_revenue_to_date",
        "months_with_revenue",
        "monthly_churn_rate",
        F.when(rate > 0, F.round(avg / rate, 2)).alias("projected_ltv"),
        F.when((cac > 0) & (rate > 0), F.round((avg / rate) / cac, 2)).alias("ltv_cac_ratio"),
        F.when(avg > 0, F.round(cac / avg, 1)).alias("cac_payback_months"),
        health.alias("unit_economics_health"),
        "subscription_id",
    )


def mart_cac_ltv(customers: DataFrame, subscriptions: DataFrame, revenue: DataFrame) -> DataFrame:
    """C9, ordered by signup date (ties by customer and subscription, so the
    range partitioner of the sort can split a date shared by many rows)."""
    rows = customer_metrics(customers, subscriptions, revenue)
    return rows.orderBy("signup_date", "customer_id", "subscription_id").drop("subscription_id")


def cac_channel_summary(metrics: DataFrame) -> DataFrame:
    """Per acquisition channel (defined but not selected by the mart)."""
    h = F.col("unit_economics_health")
    return metrics.groupBy("acquisition_channel").agg(
        F.countDistinct("customer_id").alias("total_customers"),
        F.round(F.avg("cac_usd"), 2).alias("avg_cac"),
        F.round(F.avg("projected_ltv"), 2).alias("avg_ltv"),
        F.round(F.avg("ltv_cac_ratio"), 2).alias("avg_ltv_cac_ratio"),
        F.round(F.avg("cac_payback_months"), 1).alias("avg_payback_months"),
        F.sum("mrr_usd").alias("total_mrr"),
        F.count_if(h == "excellent").alias("excellent_count"),
        F.count_if(h == "healthy").alias("healthy_count"),
        F.count_if(h == "marginal").alias("marginal_count"),
        F.count_if(h == HEALTH_DEFAULT).alias("poor_count"),
    )


# ---- mart_transactions (C10) -----------------------------------------------

def _success_amount() -> Column:
    return F.when(F.col("is_successful"), F.col("amount_usd")).otherwise(F.lit(0))


def tx_monthly_summary(tx: DataFrame) -> DataFrame:
    """A10: eleven measures per transaction month."""
    succ = F.col("is_successful")
    return tx.groupBy("transaction_month").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(succ).alias("successful_transactions"),
        F.count_if(F.col("is_failed")).alias("failed_transactions"),
        F.count_if(F.col("is_refunded")).alias("refunded_transactions"),
        F.count_if(F.col("status") == STATUS_PENDING).alias("pending_transactions"),
        _rate_pct("is_successful").alias("success_rate_pct"),
        _rate_pct("is_failed").alias("failure_rate_pct"),
        F.sum(_success_amount()).alias("successful_volume_usd"),
        F.round(F.avg(F.when(succ, F.col("amount_usd"))), 2).alias("avg_transaction_value_usd"),
        F.sum(F.when(succ, F.col("fee_usd")).otherwise(F.lit(0))).alias("total_fees_usd"),
        F.countDistinct(F.when(succ, F.col("customer_id"))).alias("unique_paying_customers"),
    )


def tx_payment_method_summary(tx: DataFrame) -> DataFrame:
    """A11."""
    return tx.groupBy("payment_method").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        _rate_pct("is_successful").alias("success_rate_pct"),
        _rate_pct("is_failed").alias("failure_rate_pct"),
        F.sum(_success_amount()).alias("total_volume_usd"),
        F.round(F.avg(F.when(F.col("is_successful"), F.col("amount_usd"))), 2)
        .alias("avg_transaction_value_usd"),
    )


def tx_channel_summary(tx: DataFrame) -> DataFrame:
    """A12."""
    return tx.groupBy("channel").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        _rate_pct("is_successful").alias("success_rate_pct"),
        F.sum(_success_amount()).alias("total_volume_usd"),
        F.countDistinct("customer_id").alias("unique_customers"),
    )


TX_DETAIL_COLS = (
    "transaction_id", "customer_id", "transaction_date", "transaction_month", "amount_usd",
    "currency", "payment_method", "status", "is_successful", "is_failed", "is_refunded",
    "fee_usd", "channel", "country", "description",
)


PAYMENT_KEYS = ("transaction_month", "payment_method", "channel")
#: grouping_id of a grouping set: a bit for each of PAYMENT_KEYS that is summed over.
MONTH, METHOD, CHANNEL, ALL = 0b011, 0b101, 0b110, 0b111
LEVELS = {MONTH: "month", METHOD: "payment_method", CHANNEL: "channel", ALL: "all"}


def payment_measures(tx: DataFrame) -> DataFrame:
    """PAYMENT_KEYS and the additive measures of a transaction, one row each."""
    one = lambda c: F.when(c, 1).otherwise(0).cast("long")
    return tx.select(
        *PAYMENT_KEYS,
        F.lit(1).cast("long").alias("_n"),
        *[one(F.col(f"is_{n}")).alias(f"_{n}") for n in ("successful", "failed", "refunded")],
        one(F.col("status") == STATUS_PENDING).alias("_pending"),
        _success_amount().alias("_volume"),
        F.when(F.col("is_successful"), F.col("fee_usd")).otherwise(F.lit(0)).alias("_fees"),
    )


MEASURES = ("_n", "_successful", "_failed", "_refunded", "_pending", "_volume", "_fees")


def payment_cube(tx: DataFrame) -> DataFrame:
    """PAYMENT_KEYS -> sums of the additive measures. Null keys form groups of their own."""
    return payment_measures(tx).groupBy(*PAYMENT_KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])


def payment_levels(measures: DataFrame) -> DataFrame:
    """Sums per month, per method, per channel and over all rows, told apart by ``_level``.

    ``measures`` are rows of ``payment_measures`` or a ``payment_cube``; one pass and
    one shuffle of partial sums, whichever of the levels are read afterwards.
    """
    sets = [[k] for k in PAYMENT_KEYS] + [[]]
    return measures.groupingSets(sets, *PAYMENT_KEYS).agg(
        F.grouping_id().cast("int").alias("_level"), *[F.sum(m).alias(m) for m in MEASURES])


def _rate_of(part: str) -> Column:
    return F.round(F.col(part).cast("double") / F.nullif(F.col("_n"), F.lit(0)) * 100, 2)


def payment_tiles(tx: DataFrame) -> DataFrame:
    """G2, G11, G12, G13 in one pass: the additive figures of all four dashboard tiles."""
    level = F.create_map(*[F.lit(x) for kv in LEVELS.items() for x in kv])[F.col("_level")]
    return payment_levels(payment_measures(tx)).select(
        level.alias("level"), *PAYMENT_KEYS,
        F.col("_n").alias("total_transactions"),
        *[F.col(f"_{n}").alias(f"{n}_transactions") for n in ("successful", "failed", "refunded", "pending")],
        _rate_of("_successful").alias("success_rate_pct"),
        _rate_of("_failed").alias("failure_rate_pct"),
        F.col("_volume").alias("successful_volume_usd"),
        F.col("_fees").alias("total_fees_usd"),
    )


def _context(levels: DataFrame, level: int, key: str, rate: str, volume: str | None = None, rows: str | None = None) -> DataFrame:
    """One row per ``key`` with its success rate, and its volume and row count if named."""
    measures = [_rate_of("_successful").alias(rate)]
    measures += [F.col("_n").alias(rows)] if rows else []
    measures += [F.col("_volume").alias(volume)] if volume else []
    return levels.where(F.col("_level") == level).select(key, *measures)


def with_month_context(tx: DataFrame, levels: DataFrame, n: int | None = None) -> DataFrame:
    """Detail rows and the figures of their month: all that depends on the month alone."""
    month = _context(levels, MONTH, "transaction_month", "month_success_rate_pct",
                     "month_successful_volume_usd", "month_total_transactions")
    return context_join(tx.select(*TX_DETAIL_COLS), month, "transaction_month", n=n)


def with_global_contexts(rows: DataFrame, levels: DataFrame, n: int | None = None) -> DataFrame:
    """Rows of ``with_month_context`` and the figures of their method and channel over all months."""
    method = _context(levels, METHOD, "payment_method", "payment_method_success_rate_pct", "payment_method_total_volume_usd")
    channel = _context(levels, CHANNEL, "channel", "channel_success_rate_pct")
    out = context_join(context_join(rows, method, "payment_method", n=n), channel, "channel", n=n)
    return out.select(
        *TX_DETAIL_COLS,
        "month_total_transactions", "month_success_rate_pct", "month_successful_volume_usd",
        "payment_method_success_rate_pct", "payment_method_total_volume_usd",
        "channel_success_rate_pct",
    )


def mart_transactions(tx: DataFrame) -> DataFrame:
    """Detail rows plus month / method / channel context, in order.

    Keys join with plain equality, so a null method or channel gets null context.
    All contexts come from one small table, written and counted once.
    """
    levels = materialised(payment_levels(payment_measures(tx)), "payment-levels")
    n = levels.count()
    out = with_global_contexts(with_month_context(tx, levels, n), levels, n)
    return out.orderBy("transaction_date", "transaction_id")
