"""Plans as they come out when inputs are too large to be estimated small, output types and order."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from subledger.operators import materialise
from subledger.operators.quality import profile
from subledger.plans import marts
from subledger.plans.warehouse import Warehouse
from subledger.sources.fixtures import FIXTURE_PARAMS, fixture_bronze

from conftest import SF001, rows


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("silver")
    w = Warehouse(fixture_bronze(spark, SF001), FIXTURE_PARAMS)
    for name in ("stg_customers", "stg_subscriptions", "stg_transactions", "stg_monthly_revenue"):
        getattr(w, name).write.parquet(f"{root}/{name}")
    return lambda name: spark.read.parquet(f"{root}/{name}")


@pytest.fixture
def large(spark):
    """Nothing is estimated to be small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(plan):
    """Keys of the exchanges in the final plan."""
    final = plan.split("== Initial Plan ==")[0]
    return re.findall(r"Exchange (\w+\([^\n]*?\)),", final)


def test_mart_transactions_never_shuffles_detail_rows_on_a_context_key(silver, large):
    tx = silver("stg_transactions")
    out = marts.mart_transactions(tx)
    plan = plan_of(out)
    assert not any(k.startswith("hashpartitioning") for k in shuffles(plan)), shuffles(plan)
    assert plan.split("== Initial Plan ==")[0].count("BroadcastHashJoin") == 3
    assert sum("rangepartitioning" in k for k in shuffles(plan)) == 1


def test_payment_tiles_take_one_scan_and_one_shuffle(silver, large):
    tx = silver("stg_transactions")
    plan = plan_of(marts.payment_tiles(tx)).split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1
    assert len(shuffles(plan)) == 1
    levels = {(r.level, r.n) for r in marts.payment_tiles(tx).groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert ("all", 1) in levels and len(levels) == 4


def test_the_global_payment_tile_needs_no_context(spark, silver):
    from subledger.plans import kpi

    tx = silver("stg_transactions")
    plan = plan_of(kpi.kpi_transactions(tx))
    assert "Join" not in plan and "BroadcastExchange" not in plan
    assert rows(kpi.kpi_transactions(tx)) == rows(kpi.kpi_transactions(marts.mart_transactions(tx)))


def test_levels_from_a_cube_equal_those_from_rows(silver):
    tx = silver("stg_transactions")
    tx = tx.withColumn("channel", F.when(F.col("channel") != "web", F.col("channel")))  # a null key is no total
    one = marts.payment_levels(marts.payment_measures(tx))
    two = marts.payment_levels(marts.payment_cube(tx))
    assert rows(one) == rows(two.select(*one.columns))
    assert one.where("_level = 6 and channel is null").count() == 1


def test_mart_cac_ltv_never_shuffles_detail_rows_on_the_plan(silver, large):
    out = marts.mart_cac_ltv(silver("stg_customers"), silver("stg_subscriptions"), silver("stg_monthly_revenue"))
    assert not any("(plan#" in k for k in shuffles(plan_of(out)))


def test_mart_mrr_has_one_histogram_shuffle_and_no_window_over_plan_rows(silver, large):
    plan = plan_of(marts.mart_mrr(silver("stg_monthly_revenue")))
    # the histogram is written before this plan; it reads it and shuffles no four-column key
    assert not any(k.count("#") >= 4 and "mrr_usd" in k for k in shuffles(plan))
    assert "LeftAnti" not in plan and "LeftSemi" not in plan
    assert "SinglePartition" not in plan


def test_a_hot_customer_s_join_is_split(spark, silver, large):
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    customers = silver("stg_customers")
    one = customers.first().customer_id
    subs = silver("stg_subscriptions")
    hot = subs.limit(1).crossJoin(spark.range(20_000)).withColumn("customer_id", F.lit(one)).withColumn(
        "subscription_id", F.concat(F.lit("H"), F.col("id").cast("string"))).drop("id")
    subs = materialise.materialised(subs.unionByName(hot.repartition(16)), "test-subs")
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = marts.customer_metrics(customers, subs, silver("stg_monthly_revenue"))
        out.write.format("noop").mode("overwrite").save()
        plan = plan_of(out.select("customer_id", "subscription_id", "projected_ltv"))
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert "skew=true" in plan


def test_contexts_over_the_bound_are_joined_by_a_salted_shuffle(silver, monkeypatch):
    tx = silver("stg_transactions")
    want = rows(marts.mart_transactions(tx))
    monkeypatch.setattr(materialise, "BROADCAST_ROWS", 0)
    out = marts.mart_transactions(tx)
    assert rows(out) == want
    assert "_salt" in out._jdf.queryExecution().toString()


def test_profile_does_not_expand_rows(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", None), (None, "1")], "x string, y string")
    out = profile(df, "t", {"dup_x": "x", "dup_y": "y", "nulls": F.count_if(F.col("x").isNull())})
    assert rows(out, "check_name", "failures") == [("dup_x", 1), ("dup_y", 2), ("nulls", 1)]
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
    assert rows(profile(df.where("false"), "t", {"dup_x": "x"}), "failures") == [(0,)]


TYPES = {
    "stg_customers": {"cac_usd": "decimal(10,2)", "signup_date": "date", "signup_month": "date", "is_invalid_cac": "boolean"},
    "stg_subscriptions": {"mrr_usd": "decimal(10,2)", "upgrade_mrr_usd": "decimal(10,2)", "months_active": "int"},
    "stg_transactions": {"amount_usd": "decimal(12,2)", "fee_usd": "decimal(10,2)", "transaction_month": "date"},
    "stg_monthly_revenue": {"mrr_usd": "decimal(10,2)", "revenue_year": "int", "revenue_month_num": "int"},
    "mart_mrr": {"active_customers": "bigint", "revenue_month": "date", "net_new_mrr": "decimal", "arr": "decimal"},
    "mart_cac_ltv": {"cac_usd": "decimal(10,2)", "projected_ltv": "double", "ltv_cac_ratio": "double"},
    "mart_transactions": {"amount_usd": "decimal(12,2)", "fee_usd": "decimal(10,2)", "month_success_rate_pct": "double"},
}


def test_types_of_the_models(spark):
    w = Warehouse(fixture_bronze(spark, SF001), FIXTURE_PARAMS)
    for model, columns in TYPES.items():
        got = {f.name: f.dataType.simpleString() for f in getattr(w, model).schema.fields}
        for name, kind in columns.items():
            assert got[name].startswith(kind), (model, name, got[name])


@pytest.mark.parametrize("model, key", [
    ("mart_mrr", ("revenue_month", "plan")),
    ("mart_cac_ltv", ("signup_date",)),
    ("mart_transactions", ("transaction_date", "transaction_id")),
])
def test_marts_come_in_order(spark, model, key):
    out = getattr(Warehouse(fixture_bronze(spark, SF001), FIXTURE_PARAMS), model)
    got = [tuple(r[c] for c in key) for r in out.collect()]
    assert got == sorted(got) and len(set(got)) > 1


def test_growth_of_months_without_revenue_total(spark):
    m = [dt.date(2024, i, 1) for i in (1, 2, 3)]
    recs = [("a", m[0], "x", Decimal("10.00")), ("a", m[0], "y", Decimal("10.00")), ("a", m[1], "x", Decimal("30.00")),
            ("a", m[1], "y", Decimal("10.00")), ("a", m[2], "x", Decimal("0.00")), ("a", m[2], "y", Decimal("0.00"))]
    df = spark.createDataFrame(recs, "customer_id string, revenue_month date, plan string, mrr_usd decimal(10,2)")
    got = [r.mrr_growth_rate_pct for r in marts.mart_mrr(df).collect()]
    assert [None if g is None else float(g) for g in got] == [None, 0.0, 100.0, 0.0, -100.0, None]


def test_customers_are_never_broadcast(silver, monkeypatch):
    """However small Spark takes tables of customers to be: a broadcast goes whole through the driver."""
    monkeypatch.setattr(marts, "materialised", lambda df, label: df)  # the whole query in one plan
    plan = plan_of(marts.customer_metrics(silver("stg_customers"), silver("stg_subscriptions"), silver("stg_monthly_revenue")))
    assert {"Inner", "LeftAnti"} <= set(re.findall(r"SortMergeJoin \[customer_id.*?\], (\w+)", plan))
    assert "BroadcastHashJoin [plan" in plan and "BroadcastHashJoin [customer_id" not in plan
