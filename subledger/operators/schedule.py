"""Subscription -> monthly revenue schedule (one row per subscription-month).

The reference builds its monthly revenue with a per-row Python loop; here it
is a generator expression: ``explode(sequence(first month, last month))``.
No shuffle; the fan-out per subscription is bounded by the months between
its start and the horizon.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.functions import lower_trim, month_start, multi_format_date, positive_money, text_to_bool
from subledger.operators.dedup import keep_first
from subledger.params import DEFAULT_PLAN_PRICE, PLAN_PRICES
from subledger.sources.bronze import ROW_SEQ


def plan_list_price(plan: Column) -> Column:
    """List price of a plan name; an unknown or missing plan gets the default."""
    expr = None
    for name, price in PLAN_PRICES:
        cond = lower_trim(plan) == name
        expr = F.when(cond, F.lit(price)) if expr is None else expr.when(cond, F.lit(price))
    return expr.otherwise(F.lit(DEFAULT_PLAN_PRICE)).cast("decimal(10,2)")


def expand_monthly_revenue(subscriptions_raw: DataFrame, horizon: dt.date) -> DataFrame:
    """Raw subscriptions -> (revenue_id, subscription_id, customer_id, month,
    mrr_usd, plan, billing_cycle).

    * keep the first copy of each subscription id (arrival order);
    * dates are read in any of the written layouts, month-first;
    * months run from the start month through the end date (or the horizon,
      whichever is earlier); a subscription whose start does not parse has none;
    * MRR is the subscription's positive MRR, else its plan's list price, and
      the upgrade MRR from the upgrade month on when the upgrade is complete.
    """
    subs = keep_first(subscriptions_raw, "subscription_id", ROW_SEQ, tie_break=None)
    start = multi_format_date("start_date")
    end = F.coalesce(multi_format_date("end_date"), F.lit(horizon))
    last = month_start(F.least(end, F.lit(horizon)))
    first = month_start(start)
    months = F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 1 MONTH")))
    upgrade_month = month_start(multi_format_date("upgrade_date"))
    upgrade_mrr = positive_money("upgrade_mrr_usd", 10)
    base = F.coalesce(positive_money("mrr_usd", 10), plan_list_price(F.col("plan")))
    x = subs.where(F.col("subscription_id").isNotNull()).select(
        "subscription_id", "customer_id", "plan", "billing_cycle",
        base.alias("_base"),
        F.when(text_to_bool("is_upgraded") & upgrade_mrr.isNotNull(), upgrade_month).alias("_up_month"),
        upgrade_mrr.alias("_up_mrr"),
        F.explode(months).alias("month"),
    )
    return x.select(
        F.concat_ws("-", "subscription_id", F.date_format("month", "yyyyMM")).alias("revenue_id"),
        "subscription_id",
        "customer_id",
        "month",
        F.when(F.col("month") >= F.col("_up_month"), F.col("_up_mrr")).otherwise(F.col("_base"))
        .alias("mrr_usd"),
        "plan",
        "billing_cycle",
    )
