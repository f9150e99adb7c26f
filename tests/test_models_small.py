"""Hand-written cases for dedup order, issue priorities and mart traps."""

import datetime as dt
from decimal import Decimal

from subledger.operators.dedup import dropped_duplicates, keep_first
from subledger.sources.fixtures import FIXTURE_PARAMS
from subledger.plans import marts, quarantine, silver
from subledger.sources.bronze import BRONZE_COLUMNS

from conftest import rows


def _bronze(spark, table, records):
    cols = list(BRONZE_COLUMNS[table]) + ["row_seq"]
    schema = ", ".join(f"{c} {'bigint' if c == 'row_seq' else 'string'}" for c in cols)
    full = [tuple(r.get(c) for c in cols) for r in records]
    return spark.createDataFrame(full, schema)


def test_dedup_orders_by_raw_text_nulls_last_then_arrival(spark):
    df = _bronze(spark, "customers", [
        dict(customer_id="A", signup_date="2024-01-01", row_seq=1),
        dict(customer_id="A", signup_date="01/02/2024", row_seq=2),  # '0' < '2': wins
        dict(customer_id="B", signup_date=None, row_seq=3),
        dict(customer_id="B", signup_date="2024-05-05", row_seq=4),  # nulls last
        dict(customer_id="C", signup_date="2024-01-01", row_seq=6),
        dict(customer_id="C", signup_date="2024-01-01", row_seq=5),  # tie -> arrival
        dict(customer_id=None, signup_date="2024-01-01", row_seq=7),
        dict(customer_id=None, signup_date="2024-01-02", row_seq=8),  # null ids collapse
    ])
    got = rows(keep_first(df, "customer_id", "signup_date"), "customer_id", "row_seq")
    assert got == sorted([("A", 2), ("B", 4), ("C", 5), (None, 7)], key=repr)
    dropped = rows(dropped_duplicates(df, "customer_id", "signup_date"), "customer_id", "row_seq")
    assert dropped == sorted([("A", 1), ("B", 3), ("C", 6)], key=repr)


def test_customer_issue_priority_and_raw_value(spark):
    recs = [
        dict(customer_id=None, signup_date="bad", cac_usd="-5", email=None, row_seq=1),
        dict(customer_id="A", signup_date="bad", cac_usd="-5", email="x", row_seq=2),
        dict(customer_id="B", signup_date="2024-01-01", cac_usd="n/a", email="x", row_seq=3),
        dict(customer_id="C", signup_date="2024-01-01", cac_usd="0.30", email="x", row_seq=4),
        dict(customer_id="D", signup_date="2024-01-01", cac_usd="10", email=None, row_seq=5),
        dict(customer_id="E", signup_date="2024-01-01", cac_usd="10", email="x", row_seq=6),
    ]
    q = quarantine.quarantine_customers_from(_bronze(spark, "customers", recs), FIXTURE_PARAMS)
    got = rows(q, "row_id", "issue_type", "problematic_raw_value")
    assert got == sorted([
        (None, "null_customer_id", "bad"),
        ("A", "unparseable_date", "bad"),
        ("B", "null_cac", None),
        ("C", "negative_cac", "0.30"),
        ("D", "null_email", None),
    ], key=repr)
    clean = silver.clean_customers(_bronze(spark, "customers", recs))
    assert [r.customer_id for r in clean.collect()] == ["E"]


def test_subscription_notes_use_their_own_priority(spark):
    recs = [
        dict(subscription_id="S1", customer_id=None, plan=None, mrr_usd="0", row_seq=1),
        dict(subscription_id="S2", customer_id=None, plan="pro", mrr_usd="0", row_seq=2),
        dict(subscription_id="S3", customer_id="C", plan="pro", mrr_usd=None, row_seq=3),
    ]
    q = quarantine.quarantine_subscriptions_from(_bronze(spark, "subscriptions", recs), FIXTURE_PARAMS)
    got = rows(q, "row_id", "issue_type", "investigation_notes")
    assert got == [
        ("S1", "null_customer_id", "Plan not assigned - check billing system"),
        ("S2", "null_customer_id", "Zero MRR - check billing processor"),
        ("S3", "null_mrr", None),
    ]


def test_transaction_gate_binds_to_last_disjunct(spark):
    from pyspark.sql import functions as F

    recs = [
        dict(transaction_id=None, customer_id="C", amount="5", row_seq=1),
        dict(transaction_id="T1", customer_id=None, amount="5", row_seq=2),
        dict(transaction_id="T2", customer_id="C", amount=None, row_seq=3),
        dict(transaction_id="T3", customer_id="C", amount="-5", row_seq=4),
        dict(transaction_id="T4", customer_id="C", amount="0.4", row_seq=5),
    ]
    raw = _bronze(spark, "transactions", recs)
    open_gate = quarantine.quarantine_transactions_from(raw, FIXTURE_PARAMS, F.lit(True))
    closed = quarantine.quarantine_transactions_from(raw, FIXTURE_PARAMS, F.lit(False))
    null_gate = quarantine.quarantine_transactions_from(raw, FIXTURE_PARAMS, F.lit(None).cast("boolean"))
    assert {r.row_id for r in open_gate.collect()} == {None, "T1", "T2", "T3", "T4"}
    assert {r.row_id for r in closed.collect()} == {None, "T1", "T2"}
    assert {r.row_id for r in null_gate.collect()} == {None, "T1", "T2"}
    issues = dict(rows(open_gate, "row_id", "issue_type"))
    assert issues["T4"] == "negative_or_zero_amount"  # 0.4 rounds to 0


def test_subscription_months_active_and_kept_null_dates(spark):
    recs = [
        dict(subscription_id="S1", customer_id="C", plan=" Pro", mrr_usd="199", start_date="2001-01-31",
             end_date="2001-02-01", status="Churned ", is_upgraded="yes", row_seq=1),
        dict(subscription_id="S2", customer_id="C", plan="pro", mrr_usd="199", start_date="31/01/2001",
             end_date=None, status="active", is_upgraded=None, row_seq=2),
        dict(subscription_id="S3", customer_id="C", plan="pro", mrr_usd="199", start_date="2001-01-15",
             end_date="15/03/2001", status="active", row_seq=3),
    ]
    got = {r.subscription_id: r for r in silver.clean_subscriptions(
        _bronze(spark, "subscriptions", recs), FIXTURE_PARAMS).collect()}
    assert got["S1"].months_active == 1 and got["S1"].is_churned and got["S1"].plan == "pro"
    assert got["S1"].is_upgraded is True and got["S2"].is_upgraded is False
    assert got["S2"].start_date is None and got["S2"].months_active is None
    # non-ISO end date: treated as still running, counted to as_of (2001-06-30)
    assert got["S3"].end_date is None and got["S3"].months_active == 5


def _rev(spark, records):
    return spark.createDataFrame(
        [(c, m, p, Decimal(v) if v is not None else None) for c, m, p, v in records],
        "customer_id string, revenue_month date, plan string, mrr_usd decimal(10,2)")


def _brute_force(records):
    """Pairwise reference implementation of new / expansion / churn."""
    from collections import defaultdict

    rs = [(c, m, Decimal(v)) for c, m, _, v in records if v is not None]

    def add_months(d, n):
        import calendar
        y, mo = divmod(d.year * 12 + d.month - 1 + n, 12)
        return dt.date(y, mo + 1, min(d.day, calendar.monthrange(y, mo + 1)[1]))

    first = {}
    for c, m, _ in rs:
        first[c] = min(first.get(c, m), m)
    new = defaultdict(lambda: [Decimal(0), set()])
    for c, m, v in rs:
        if first[c] == m:
            new[m][0] += v
            new[m][1].add(c)
    exp = defaultdict(lambda: [Decimal(0), set()])
    for c, m, v in rs:
        for c2, m2, v2 in rs:
            if c == c2 and m2 == add_months(m, -1) and v > v2:
                exp[m][0] += v - v2
                exp[m][1].add(c)
    churn = defaultdict(lambda: [Decimal(0), set()])
    for c, m, v in rs:
        if not any(c2 == c and m2 == add_months(m, 1) for c2, m2, _ in rs):
            churn[m][0] += v
            churn[m][1].add(c)
    return (
        {m: (a, len(s)) for m, (a, s) in new.items()},
        {m: (a, len(s)) for m, (a, s) in exp.items()},
        {add_months(m, 1): (-a, len(s)) for m, (a, s) in churn.items()},
    )


def test_revenue_movements_match_pairwise_brute_force(spark):
    from subledger.operators import revenue as rv

    J, F_, M, A = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1), dt.date(2024, 4, 1)
    records = [
        # customer with two subscriptions: m x n pairs, equal values, a downgrade
        ("A", J, "starter", "49"), ("A", J, "pro", "199"),
        ("A", F_, "starter", "99"), ("A", F_, "pro", "199"), ("A", F_, "pro", "199"),
        ("A", M, "pro", "199"),
        # single subscription, upgrade then churn in the last month
        ("B", J, "growth", "99"), ("B", F_, "growth", "199"), ("B", M, "growth", "199"),
        ("B", A, "growth", "199"),
        # gap month (churn then return), null MRR ignored
        ("C", J, "pro", "199"), ("C", M, "pro", "199"), ("C", A, "pro", None),
        # month-end dates: add_months clamps (Jan 31 -> Feb 29)
        ("D", dt.date(2024, 1, 31), "pro", "10"), ("D", dt.date(2024, 2, 29), "pro", "20"),
        ("D", dt.date(2024, 1, 30), "pro", "5"),
    ]
    hist = rv.revenue_histogram(_rev(spark, records))
    cm = rv.customer_month(hist)
    want_new, want_exp, want_churn = _brute_force(records)

    def as_map(df, a, n):
        return {r[rv.T]: (r[a], r[n]) for r in df.collect()}

    assert as_map(rv.new_mrr(cm), "new_mrr", "new_customers") == want_new
    assert as_map(rv.expansion_mrr(hist), "expansion_mrr", "expanded_customers") == want_exp
    churn = {}
    for r in rv.churned_mrr(cm).collect():  # two last months may land on one date
        a, n = churn.get(r[rv.T], (Decimal(0), 0))
        churn[r[rv.T]] = (a + r["churned_mrr"], n + r["churned_customers"])
    assert churn == want_churn


def test_mart_mrr_growth_ties_and_dropped_final_churn(spark):
    J, F_ = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    rev = _rev(spark, [("A", J, "growth", "100"), ("B", J, "pro", "100"),
                       ("A", F_, "growth", "150"), ("B", F_, "pro", "150")])
    out = {(r.revenue_month, r.plan): r for r in marts.mart_mrr(rev).collect()}
    assert len(out) == 4
    # first plan row of February compares with January's total (200 -> 300)
    assert out[(F_, "growth")].mrr_growth_rate_pct == Decimal("50.00")
    assert out[(F_, "pro")].mrr_growth_rate_pct == Decimal("0.00")
    assert out[(J, "growth")].mrr_growth_rate_pct is None
    # churn of the final month would land in March, which has no row
    assert all(r.churned_mrr == 0 for r in out.values())
    assert out[(F_, "pro")].expansion_mrr == Decimal("100.00")
    assert out[(F_, "pro")].total_mrr_all_plans == Decimal("300.00")
    assert out[(F_, "pro")].arr == Decimal("3600.00")


def test_cac_ltv_zero_churn_plan_and_no_subscription_are_poor(spark):
    cust = spark.createDataFrame(
        [("A", dt.date(2024, 1, 1), Decimal("10.00")), ("B", dt.date(2024, 1, 2), Decimal("10.00"))],
        "customer_id string, signup_date date, cac_usd decimal(10,2)")
    for c in ("signup_month", "acquisition_channel", "country", "company_size", "industry"):
        from pyspark.sql import functions as F
        cust = cust.withColumn(c, F.lit(None).cast("date" if c == "signup_month" else "string"))
    subs = spark.createDataFrame(
        [("A", "S1", "pro", Decimal("199.00"), "active", False, 3, "monthly")],
        "customer_id string, subscription_id string, plan string, mrr_usd decimal(10,2), status string, "
        "is_churned boolean, months_active int, billing_cycle string")
    rev = _rev(spark, [("A", dt.date(2024, 1, 1), "pro", "199")])
    got = {r.customer_id: r for r in marts.mart_cac_ltv(cust, subs, rev).collect()}
    assert got["A"].monthly_churn_rate == 0.0 and got["A"].projected_ltv is None
    assert got["A"].unit_economics_health == "poor" and got["A"].cac_payback_months == Decimal("0.1")
    assert got["B"].plan is None and got["B"].unit_economics_health == "poor"


def test_transactions_null_method_gets_null_context(spark):
    tx = spark.createDataFrame(
        [("T1", "C", dt.date(2024, 1, 5), dt.date(2024, 1, 1), Decimal("10.00"), "USD", None, "success",
          True, False, False, None, "web", "X", "d"),
         ("T2", "C", dt.date(2024, 1, 6), dt.date(2024, 1, 1), Decimal("30.00"), "USD", "card", "failed",
          False, True, False, None, "web", "X", "d")],
        "transaction_id string, customer_id string, transaction_date date, transaction_month date, "
        "amount_usd decimal(12,2), currency string, payment_method string, status string, "
        "is_successful boolean, is_failed boolean, is_refunded boolean, fee_usd decimal(10,2), "
        "channel string, country string, description string")
    got = {r.transaction_id: r for r in marts.mart_transactions(tx).collect()}
    assert got["T1"].payment_method_success_rate_pct is None
    assert got["T2"].payment_method_success_rate_pct == 0.0
    assert got["T1"].month_total_transactions == 2 and got["T1"].month_success_rate_pct == 50.0
    assert got["T1"].month_successful_volume_usd == Decimal("10.00")
    assert got["T2"].channel_success_rate_pct == 50.0


def test_as_of_boundary_is_inclusive(spark):
    as_of = FIXTURE_PARAMS.as_of.isoformat()            # 2001-06-30
    later = (FIXTURE_PARAMS.as_of + dt.timedelta(days=1)).isoformat()
    tx = _bronze(spark, "transactions", [
        dict(transaction_id="T1", customer_id="C", amount="5", status="success", transaction_date=as_of, row_seq=1),
        dict(transaction_id="T2", customer_id="C", amount="5", status="success", transaction_date=later, row_seq=2),
    ])
    kept = silver.clean_transactions(tx, FIXTURE_PARAMS).collect()
    assert [r.transaction_id for r in kept] == ["T1"] and kept[0].is_future_dated is False
    rev = _bronze(spark, "monthly_revenue", [
        dict(revenue_id="R1", subscription_id="S", customer_id="C", month=as_of, mrr_usd="10", plan="pro", row_seq=1),
        dict(revenue_id="R2", subscription_id="S", customer_id="C", month=later, mrr_usd="10", plan="pro", row_seq=2),
        dict(revenue_id="R3", subscription_id="S", customer_id="C", month=as_of, mrr_usd=None, plan="pro", row_seq=3),
    ])
    got = {r.revenue_id: r for r in silver.clean_monthly_revenue(rev, FIXTURE_PARAMS).collect()}
    assert set(got) == {"R1", "R3"}                      # null MRR is kept in silver
    assert got["R3"].mrr_usd is None and got["R3"].is_zero_mrr is True


def test_revenue_schedule_prices_upgrades_and_dates(spark):
    from subledger.operators.schedule import expand_monthly_revenue

    subs = _bronze(spark, "subscriptions", [
        # zero MRR -> plan list price; upgrade from the upgrade month on; ends mid-March
        dict(subscription_id="S1", customer_id="C1", plan=" Growth", mrr_usd="0", start_date="2001-01-20",
             end_date="03/15/2001", is_upgraded="True", upgrade_date="2001-02-05", upgrade_mrr_usd="199.0",
             row_seq=1),
        # unknown plan -> default price; runs to the horizon (2001-06-30)
        dict(subscription_id="S2", customer_id="C2", plan="legacy", mrr_usd=None, start_date="2001-05-31",
             row_seq=2),
        # unparseable start -> no months
        dict(subscription_id="S3", customer_id="C3", plan="pro", mrr_usd="199", start_date="not a date",
             row_seq=3),
    ])
    got = rows(expand_monthly_revenue(subs, FIXTURE_PARAMS.as_of), "revenue_id", "month", "mrr_usd")
    assert got == [
        ("S1-200101", dt.date(2001, 1, 1), Decimal("99.00")),
        ("S1-200102", dt.date(2001, 2, 1), Decimal("199.00")),
        ("S1-200103", dt.date(2001, 3, 1), Decimal("199.00")),
        ("S2-200105", dt.date(2001, 5, 1), Decimal("49.00")),
        ("S2-200106", dt.date(2001, 6, 1), Decimal("49.00")),
    ]
