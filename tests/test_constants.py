"""Labels, notes and actions are part of the results: pinned here, word by word."""

from subledger import params


def test_labels_notes_and_actions():
    got = {k: v for k, v in vars(params).items() if k.isupper() and isinstance(v, str)}
    assert got == {
        "SOURCE_CUSTOMERS": "customers", "SOURCE_SUBSCRIPTIONS": "subscriptions", "SOURCE_TRANSACTIONS": "transactions",
        "ACTION_CUSTOMERS": "investigate_source_system", "ACTION_SUBSCRIPTIONS": "investigate_billing_system",
        "ACTION_TRANSACTIONS": "investigate_payment_processor", "UNKNOWN_ISSUE": "unknown",
        "NULL_CUSTOMER_ID": "null_customer_id", "UNPARSEABLE_DATE": "unparseable_date", "NULL_CAC": "null_cac",
        "NEGATIVE_CAC": "negative_cac", "NULL_EMAIL": "null_email", "NULL_PLAN": "null_plan", "NULL_MRR": "null_mrr",
        "ZERO_MRR": "zero_mrr", "NULL_TRANSACTION_ID": "null_transaction_id", "NULL_AMOUNT": "null_amount",
        "BAD_AMOUNT": "negative_or_zero_amount",
        "NOTE_NULL_PLAN": "Plan not assigned - check billing system",
        "NOTE_ZERO_MRR": "Zero MRR - check billing processor",
        "NOTE_ORPHAN_SUBSCRIPTION": "Orphaned subscription - no matching customer",
        "NOTE_ORPHAN_TRANSACTION": "Orphaned transaction - no matching customer, check payment processor logs",
        "NOTE_BAD_AMOUNT": "Invalid amount - check payment processor for correct value",
        "NOTE_NULL_TRANSACTION_ID": "Missing transaction ID - check payment processor",
        "STATUS_SUCCESS": "success", "STATUS_FAILED": "failed", "STATUS_REFUNDED": "refunded", "STATUS_PENDING": "pending",
        "STATUS_CHURNED": "churned", "HEALTH_DEFAULT": "poor",
    }
    assert params.TRUE_TEXT == ("TRUE", "1", "YES")
    assert params.HEALTH_CLASSES == (("excellent", 5), ("healthy", 3), ("marginal", 1))
    assert params.PLAN_PRICES == (("starter", 49), ("growth", 99), ("pro", 199), ("enterprise", 499))
    assert params.DEFAULT_PLAN_PRICE == 49
