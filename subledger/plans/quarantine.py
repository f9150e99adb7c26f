"""Quarantine models: rejected rows with a classified issue.

Each model is an ordered rule list (issue type), a second ordered list for
the notes/raw value (different priority, as in the reference), and the
OR of all defects as the row filter. Customers and subscriptions are full
rebuilds; transactions is incremental (keyed upsert on ``row_id``) and gets
the reference's gate, which binds to its last disjunct only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.functions import iso_date, whole_number
from subledger.operators.rules import any_of, first_match, first_match_value
from subledger.params import (
    ACTION_CUSTOMERS,
    ACTION_SUBSCRIPTIONS,
    ACTION_TRANSACTIONS,
    BAD_AMOUNT,
    NEGATIVE_CAC,
    NOTE_BAD_AMOUNT,
    NOTE_NULL_PLAN,
    NOTE_NULL_TRANSACTION_ID,
    NOTE_ORPHAN_SUBSCRIPTION,
    NOTE_ORPHAN_TRANSACTION,
    NOTE_ZERO_MRR,
    NULL_AMOUNT,
    NULL_CAC,
    NULL_CUSTOMER_ID,
    NULL_EMAIL,
    NULL_MRR,
    NULL_PLAN,
    NULL_TRANSACTION_ID,
    SOURCE_CUSTOMERS,
    SOURCE_SUBSCRIPTIONS,
    SOURCE_TRANSACTIONS,
    UNKNOWN_ISSUE,
    UNPARSEABLE_DATE,
    ZERO_MRR,
    RunParams,
)
from subledger.plans.silver import deduped
from subledger.sources.bronze import Bronze


def flagged_at(params: RunParams) -> Column:
    # A wall-clock-free timestamp (no time zone), identical on every executor.
    return F.lit(params.run_ts.isoformat(sep=" ")).cast("timestamp_ntz")


def _null(c: str) -> Column:
    return F.col(c).isNull()


# ---- customers -------------------------------------------------------------

def customer_issue_rules() -> list[tuple[str, Column]]:
    cac0 = whole_number("cac_usd")
    return [
        (NULL_CUSTOMER_ID, _null("customer_id")),
        (UNPARSEABLE_DATE, iso_date("signup_date").isNull()),
        (NULL_CAC, cac0.isNull()),
        (NEGATIVE_CAC, cac0 <= 0),
        (NULL_EMAIL, _null("email")),
    ]


def quarantine_customers_from(raw: DataFrame, params: RunParams) -> DataFrame:
    rules = customer_issue_rules()
    raw_value = first_match_value([
        (iso_date("signup_date").isNull(), F.col("signup_date")),
        (whole_number("cac_usd") <= 0, F.col("cac_usd")),
    ])
    return raw.where(any_of([p for _, p in rules])).select(
        F.col("customer_id").alias("row_id"),
        F.lit(SOURCE_CUSTOMERS).alias("source_table"),
        F.col("signup_date").alias("raw_signup_date"),
        F.col("cac_usd").alias("raw_cac_usd"),
        "email",
        "country",
        "acquisition_channel",
        first_match(rules, UNKNOWN_ISSUE).alias("issue_type"),
        raw_value.alias("problematic_raw_value"),
        flagged_at(params).alias("flagged_at"),
        F.lit(ACTION_CUSTOMERS).alias("recommended_action"),
    )


# ---- subscriptions ---------------------------------------------------------

def subscription_issue_rules() -> list[tuple[str, Column]]:
    mrr0 = whole_number("mrr_usd")
    return [
        (NULL_CUSTOMER_ID, _null("customer_id")),
        (NULL_PLAN, _null("plan")),
        (NULL_MRR, mrr0.isNull()),
        (ZERO_MRR, mrr0 <= 0),
    ]


def quarantine_subscriptions_from(raw: DataFrame, params: RunParams) -> DataFrame:
    rules = subscription_issue_rules()
    notes = first_match_value([
        (_null("plan"), F.lit(NOTE_NULL_PLAN)),
        (whole_number("mrr_usd") <= 0, F.lit(NOTE_ZERO_MRR)),
        (_null("customer_id"), F.lit(NOTE_ORPHAN_SUBSCRIPTION)),
    ])
    return raw.where(any_of([p for _, p in rules])).select(
        F.col("subscription_id").alias("row_id"),
        F.lit(SOURCE_SUBSCRIPTIONS).alias("source_table"),
        "customer_id",
        F.col("plan").alias("raw_plan"),
        F.col("mrr_usd").alias("raw_mrr_usd"),
        F.col("start_date").alias("raw_start_date"),
        "status",
        first_match(rules, UNKNOWN_ISSUE).alias("issue_type"),
        notes.alias("investigation_notes"),
        flagged_at(params).alias("flagged_at"),
        F.lit(ACTION_SUBSCRIPTIONS).alias("recommended_action"),
    )


# ---- transactions ----------------------------------------------------------

def transaction_issue_rules() -> list[tuple[str, Column]]:
    amount0 = whole_number("amount")
    return [
        (NULL_TRANSACTION_ID, _null("transaction_id")),
        (NULL_CUSTOMER_ID, _null("customer_id")),
        (NULL_AMOUNT, amount0.isNull()),
        (BAD_AMOUNT, amount0 <= 0),
    ]


def quarantine_transactions_from(raw: DataFrame, params: RunParams, gate: Column | None = None,
                                 extra: dict[str, Column] | None = None) -> DataFrame:
    """``gate`` is the incremental condition; ``None`` on a first/full build.
    ``extra`` appends columns (a newer model version; see ``keyed_upsert``).

    Written like the reference's WHERE without parentheses, so the gate is
    AND-ed to the last disjunct only (``a or b or c or (d and gate)``).
    """
    rules = transaction_issue_rules()
    preds = [p for _, p in rules]
    if gate is not None:
        preds = preds[:-1] + [preds[-1] & gate]
    notes = first_match_value([
        (_null("customer_id"), F.lit(NOTE_ORPHAN_TRANSACTION)),
        (whole_number("amount") <= 0, F.lit(NOTE_BAD_AMOUNT)),
        (_null("transaction_id"), F.lit(NOTE_NULL_TRANSACTION_ID)),
    ])
    return raw.where(any_of(preds)).select(
        F.col("transaction_id").alias("row_id"),
        F.lit(SOURCE_TRANSACTIONS).alias("source_table"),
        "customer_id",
        F.col("transaction_date").alias("raw_transaction_date"),
        F.col("amount").alias("raw_amount"),
        "currency",
        "payment_method",
        "status",
        "channel",
        "country",
        first_match(rules, UNKNOWN_ISSUE).alias("issue_type"),
        notes.alias("investigation_notes"),
        flagged_at(params).alias("flagged_at"),
        F.lit(ACTION_TRANSACTIONS).alias("recommended_action"),
        *[c.alias(n) for n, c in (extra or {}).items()],
    )


def quarantine_customers(bronze: Bronze, params: RunParams) -> DataFrame:
    return quarantine_customers_from(deduped(bronze, "customers"), params)


def quarantine_subscriptions(bronze: Bronze, params: RunParams) -> DataFrame:
    return quarantine_subscriptions_from(deduped(bronze, "subscriptions"), params)


def quarantine_transactions(bronze: Bronze, params: RunParams, gate: Column | None = None,
                            extra: dict[str, Column] | None = None) -> DataFrame:
    return quarantine_transactions_from(deduped(bronze, "transactions"), params, gate, extra)
