"""Run parameters and fixed values.

Nothing in the library reads the clock, and nothing has a default date: every
time-dependent model takes an ``as_of`` date (today, in a scheduled run) and a
``run_ts`` timestamp from its caller, so a rebuild is reproducible. Only the
command line asks the clock, once, when its flags are absent.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class RunParams:
    as_of: dt.date
    run_ts: dt.datetime

    @property
    def as_of_sql(self) -> str:
        return f"DATE '{self.as_of.isoformat()}'"

    @property
    def run_ts_sql(self) -> str:
        return f"TIMESTAMP '{self.run_ts.isoformat(sep=' ')}'"


# ---------------------------------------------------------------------------
# Fixed values that must equal the reference models' literals.
# ---------------------------------------------------------------------------

# Text accepted as boolean true (subscriptions.is_upgraded).
TRUE_TEXT = ("TRUE", "1", "YES")

# Constant columns of the quarantine tables.
SOURCE_CUSTOMERS = "customers"
SOURCE_SUBSCRIPTIONS = "subscriptions"
SOURCE_TRANSACTIONS = "transactions"
ACTION_CUSTOMERS = "investigate_source_system"
ACTION_SUBSCRIPTIONS = "investigate_billing_system"
ACTION_TRANSACTIONS = "investigate_payment_processor"
UNKNOWN_ISSUE = "unknown"

# Issue labels.
NULL_CUSTOMER_ID = "null_customer_id"
UNPARSEABLE_DATE = "unparseable_date"
NULL_CAC = "null_cac"
NEGATIVE_CAC = "negative_cac"
NULL_EMAIL = "null_email"
NULL_PLAN = "null_plan"
NULL_MRR = "null_mrr"
ZERO_MRR = "zero_mrr"
NULL_TRANSACTION_ID = "null_transaction_id"
NULL_AMOUNT = "null_amount"
BAD_AMOUNT = "negative_or_zero_amount"

# Investigation notes.
NOTE_NULL_PLAN = "Plan not assigned - check billing system"
NOTE_ZERO_MRR = "Zero MRR - check billing processor"
NOTE_ORPHAN_SUBSCRIPTION = "Orphaned subscription - no matching customer"
NOTE_ORPHAN_TRANSACTION = (
    "Orphaned transaction - no matching customer, check payment processor logs"
)
NOTE_BAD_AMOUNT = "Invalid amount - check payment processor for correct value"
NOTE_NULL_TRANSACTION_ID = "Missing transaction ID - check payment processor"

# Transaction status values used by the marts.
STATUS_SUCCESS = "success"
STATUS_FAILED = "failed"
STATUS_REFUNDED = "refunded"
STATUS_PENDING = "pending"
STATUS_CHURNED = "churned"

# Unit-economics health classes, with their lower LTV:CAC bounds.
HEALTH_CLASSES = (("excellent", 5), ("healthy", 3), ("marginal", 1))
HEALTH_DEFAULT = "poor"

# Plan list prices (monthly USD), used to default a zero MRR in the
# revenue schedule; an unknown plan gets the starter price.
PLAN_PRICES = (("starter", 49), ("growth", 99), ("pro", 199), ("enterprise", 499))
DEFAULT_PLAN_PRICE = 49
