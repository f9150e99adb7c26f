"""Conservation and known counts at sf0.01, determinism of a rebuild."""

from pyspark.sql import functions as F

from subledger.functions import iso_date, whole_number
from subledger.plans.silver import deduped
from subledger.plans.warehouse import Warehouse
from subledger.sources.fixtures import FIXTURE_PARAMS, fixture_bronze

from conftest import SF01


def test_bronze_and_model_counts(spark):
    b = fixture_bronze(spark, SF01)
    assert [b.table(t).count() for t in ("customers", "subscriptions", "transactions", "monthly_revenue")] \
        == [1516, 1515, 15169, 21084]
    w = Warehouse(b, FIXTURE_PARAMS)
    assert w.stg_customers.count() == 634
    assert w.stg_subscriptions.count() == 1432
    assert w.stg_transactions.count() == 6771
    assert w.mart_mrr.count() == 72
    assert w.mart_cac_ltv.count() == 641
    issues = {r.issue_type: r["count"] for r in w.quarantine_customers.groupBy("issue_type").count().collect()}
    assert issues == {"unparseable_date": 753, "negative_cac": 70, "null_cac": 23, "null_email": 12,
                      "null_customer_id": 1}
    health = {r.unit_economics_health: r["count"]
              for r in w.mart_cac_ltv.groupBy("unit_economics_health").count().collect()}
    assert health == {"poor": 578, "marginal": 43, "excellent": 14, "healthy": 6}


def test_conservation_of_deduped_rows(spark):
    """deduped = silver + quarantine + rows dropped by neither (reason-coded)."""
    b = fixture_bronze(spark, SF01)
    w = Warehouse(b, FIXTURE_PARAMS)
    for table, stg, q in (("customers", w.stg_customers, w.quarantine_customers),
                          ("subscriptions", w.stg_subscriptions, w.quarantine_subscriptions),
                          ("transactions", w.stg_transactions, w.quarantine_transactions)):
        d = deduped(b, table).count()
        assert d == stg.count() + q.count() + _neither(deduped(b, table), table), table


def _neither(raw, table):
    if table == "customers":
        return 0
    if table == "subscriptions":
        return raw.where(F.col("subscription_id").isNull() & F.col("customer_id").isNotNull()
                         & F.col("plan").isNotNull() & (whole_number("mrr_usd") > 0)).count()
    # transactions: valid id/customer/amount but null status, bad or future date
    ok = F.col("transaction_id").isNotNull() & F.col("customer_id").isNotNull() & (whole_number("amount") > 0)
    bad = F.col("status").isNull() | iso_date("transaction_date").isNull() \
        | (iso_date("transaction_date") > F.lit(FIXTURE_PARAMS.as_of))
    n = raw.where(ok & bad).count()
    assert n == 143 + 6870 + 98
    return n


def test_rebuild_is_deterministic(spark):
    def snapshot():
        w = Warehouse(fixture_bronze(spark, SF01), FIXTURE_PARAMS)
        return {
            "mrr": sorted(map(tuple, w.mart_mrr.collect())),
            "q": sorted(map(repr, w.quarantine_transactions.collect())),
        }
    assert snapshot() == snapshot()
