"""Silver models: dedup first, then parse, normalise, flag and reject.

Order matters and is kept: duplicates are removed on the *raw* rows (ordered
by the raw date text), and validation filters run afterwards, so a valid row
can lose to an invalid copy exactly as in the reference. Every output
expression is computed from the raw columns in one projection, so flags that
test a raw column (e.g. ``plan is null``) are not affected by outputs that
reuse the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subledger.functions import (
    flag,
    iso_date,
    lower_trim,
    month_start,
    months_between_boundaries,
    positive_money,
    text_to_bool,
    upper_trim,
    whole_number,
)
from subledger.operators.dedup import keep_first
from subledger.operators.rules import all_of
from subledger.params import STATUS_CHURNED, STATUS_FAILED, STATUS_REFUNDED, STATUS_SUCCESS, RunParams
from subledger.sources.bronze import Bronze

# Dedup key and order column per bronze table.
DEDUP = {
    "customers": ("customer_id", "signup_date"),
    "subscriptions": ("subscription_id", "start_date"),
    "transactions": ("transaction_id", "transaction_date"),
    "monthly_revenue": ("revenue_id", "month"),
}


def deduped(bronze: Bronze, table: str) -> DataFrame:
    key, order = DEDUP[table]
    return keep_first(bronze.table(table), key, order)


def clean_customers(raw: DataFrame) -> DataFrame:
    """C1 body on already-deduped raw customers."""
    signup = iso_date("signup_date")
    cac0 = whole_number("cac_usd")
    keep = all_of([
        F.col("customer_id").isNotNull(),
        signup.isNotNull(),
        cac0 > 0,
        F.col("email").isNotNull(),
    ])
    return raw.where(keep).select(
        "customer_id",
        signup.alias("signup_date"),
        "full_name",
        lower_trim("email").alias("email"),
        upper_trim("country").alias("country"),
        "company_size",
        lower_trim("acquisition_channel").alias("acquisition_channel"),
        positive_money("cac_usd", 10).alias("cac_usd"),
        lower_trim("industry").alias("industry"),
        month_start(signup).alias("signup_month"),
        flag(F.col("email").isNull()).alias("is_missing_email"),
        flag(cac0 <= 0).alias("is_invalid_cac"),
    )


def clean_subscriptions(raw: DataFrame, params: RunParams) -> DataFrame:
    """C2 body. Unparseable dates stay as null columns; the row is kept."""
    start, end = iso_date("start_date"), iso_date("end_date")
    mrr0 = whole_number("mrr_usd")
    keep = all_of([
        F.col("subscription_id").isNotNull(),
        F.col("customer_id").isNotNull(),
        F.col("plan").isNotNull(),
        mrr0 > 0,
    ])
    as_of = F.lit(params.as_of)
    return raw.where(keep).select(
        "subscription_id",
        "customer_id",
        lower_trim("plan").alias("plan"),
        positive_money("mrr_usd", 10).alias("mrr_usd"),
        start.alias("start_date"),
        end.alias("end_date"),
        lower_trim("status").alias("status"),
        text_to_bool("is_upgraded").alias("is_upgraded"),
        lower_trim("upgrade_plan").alias("upgrade_plan"),
        iso_date("upgrade_date").alias("upgrade_date"),
        positive_money("upgrade_mrr_usd", 10).alias("upgrade_mrr_usd"),
        lower_trim("billing_cycle").alias("billing_cycle"),
        F.when(end.isNotNull(), months_between_boundaries(start, end))
        .otherwise(months_between_boundaries(start, as_of))
        .alias("months_active"),
        flag(lower_trim("status") == STATUS_CHURNED).alias("is_churned"),
        flag((mrr0 <= 0) | F.col("mrr_usd").isNull()).alias("is_zero_mrr"),
        flag(F.col("plan").isNull()).alias("is_missing_plan"),
    )


def clean_transactions(raw: DataFrame, params: RunParams) -> DataFrame:
    """C3 body. Rows with unparseable, future or null-status data are dropped."""
    tdate = iso_date("transaction_date")
    amount0 = whole_number("amount")
    status = lower_trim("status")
    as_of = F.lit(params.as_of)
    keep = all_of([
        F.col("transaction_id").isNotNull(),
        F.col("status").isNotNull(),
        F.col("customer_id").isNotNull(),
        amount0 > 0,
        tdate <= as_of,
    ])
    return raw.where(keep).select(
        "transaction_id",
        "customer_id",
        tdate.alias("transaction_date"),
        positive_money("amount", 12).alias("amount_usd"),
        upper_trim("currency").alias("currency"),
        lower_trim("payment_method").alias("payment_method"),
        status.alias("status"),
        positive_money("fee_usd", 10).alias("fee_usd"),
        lower_trim("channel").alias("channel"),
        upper_trim("country").alias("country"),
        lower_trim("description").alias("description"),
        flag(status == STATUS_SUCCESS).alias("is_successful"),
        flag(status == STATUS_FAILED).alias("is_failed"),
        flag(status == STATUS_REFUNDED).alias("is_refunded"),
        month_start(tdate).alias("transaction_month"),
        flag((amount0 <= 0) | F.col("amount").isNull()).alias("is_invalid_amount"),
        flag(F.col("customer_id").isNull()).alias("is_missing_customer"),
        flag(tdate > as_of).alias("is_future_dated"),
    )


def clean_monthly_revenue(raw: DataFrame, params: RunParams) -> DataFrame:
    """C4 body. Null / non-positive MRR is kept (as null); marts filter it."""
    month = iso_date("month")
    mrr0 = whole_number("mrr_usd")
    as_of = F.lit(params.as_of)
    keep = all_of([
        F.col("revenue_id").isNotNull(),
        F.col("customer_id").isNotNull(),
        F.col("subscription_id").isNotNull(),
        month <= as_of,
        F.col("plan").isNotNull(),
    ])
    return raw.where(keep).select(
        "revenue_id",
        "subscription_id",
        "customer_id",
        month.alias("revenue_month"),
        positive_money("mrr_usd", 10).alias("mrr_usd"),
        lower_trim("plan").alias("plan"),
        lower_trim("billing_cycle").alias("billing_cycle"),
        month_start(month).alias("revenue_month_start"),
        F.year(month).alias("revenue_year"),
        F.month(month).alias("revenue_month_num"),
        flag((mrr0 <= 0) | F.col("mrr_usd").isNull()).alias("is_zero_mrr"),
        flag(month > as_of).alias("is_future_dated"),
    )


def stg_customers(bronze: Bronze, params: RunParams) -> DataFrame:
    return clean_customers(deduped(bronze, "customers"))


def stg_subscriptions(bronze: Bronze, params: RunParams) -> DataFrame:
    return clean_subscriptions(deduped(bronze, "subscriptions"), params)


def stg_transactions(bronze: Bronze, params: RunParams) -> DataFrame:
    return clean_transactions(deduped(bronze, "transactions"), params)


def stg_monthly_revenue(bronze: Bronze, params: RunParams) -> DataFrame:
    return clean_monthly_revenue(deduped(bronze, "monthly_revenue"), params)
