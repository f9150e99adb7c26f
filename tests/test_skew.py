"""A customer holding a third of all revenue rows stays bounded and exact."""

import datetime as dt
import re
from collections import Counter
from decimal import Decimal

from pyspark.sql import functions as F

from subledger.operators import revenue as rv
from subledger.operators.dedup import keep_first
from subledger.plans import marts

MONTHS = [dt.date(2024, m, 1) for m in (1, 2, 3)]
PRICES = ["49.00", "99.00", "199.00"]


def _skewed(spark, hot_subs=2000, others=4000):
    # HOT has `hot_subs` subscriptions across three months (a third of all
    # rows); every other customer has one row per month.
    hot = spark.range(hot_subs * len(MONTHS)).select(
        F.lit("HOT").alias("customer_id"),
        F.element_at(F.array(*[F.lit(m) for m in MONTHS]), (F.col("id") % 3 + 1).cast("int")).alias("revenue_month"),
        F.lit("pro").alias("plan"),
        F.element_at(F.array(*[F.lit(p) for p in PRICES]), (F.col("id") % 7 % 3 + 1).cast("int"))
        .cast("decimal(10,2)").alias("mrr_usd"),
    )
    rest = spark.range(others).select(
        F.concat(F.lit("C"), (F.col("id") % (others // 3)).cast("string")).alias("customer_id"),
        F.element_at(F.array(*[F.lit(m) for m in MONTHS]), (F.col("id") % 3 + 1).cast("int")).alias("revenue_month"),
        F.lit("starter").alias("plan"),
        F.lit("49.00").cast("decimal(10,2)").alias("mrr_usd"),
    )
    return hot.unionByName(rest)


def test_hot_customer_histogram_is_bounded(spark):
    hist = rv.revenue_histogram(_skewed(spark))
    hot_rows = hist.where("customer_id = 'HOT'").count()
    assert hot_rows <= len(MONTHS) * 1 * len(PRICES)


def test_hot_customer_expansion_is_exact_without_pairs(spark):
    df = _skewed(spark)
    hot = [(r.revenue_month, r.mrr_usd) for r in df.where("customer_id = 'HOT'").collect()]
    by_month = {m: Counter(v for mm, v in hot if mm == m) for m in MONTHS}
    want = {}
    for prev, cur in zip(MONTHS, MONTHS[1:]):
        gain = sum((a - b) * na * nb for a, na in by_month[cur].items()
                   for b, nb in by_month[prev].items() if a > b)
        want[cur] = gain
    got = {r.revenue_month: (r.expansion_mrr, r.expanded_customers)
           for r in rv.expansion_mrr(rv.revenue_histogram(df)).collect()}
    for m, gain in want.items():
        assert got[m] == (Decimal(gain), 1)  # only HOT has differing values


def test_plans_pre_aggregate_before_the_shuffle(spark):
    hist = rv.revenue_histogram(_skewed(spark))
    plan = hist._jdf.queryExecution().executedPlan().toString()
    # partial count below the first exchange: map-side combine of hot groups
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning(customer_id")
    dedup = keep_first(_skewed(spark).withColumn("row_seq", F.lit(1)), "customer_id", "revenue_month")
    dplan = dedup._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in dplan and "WindowGroupLimit" in dplan


def _big_customer(spark, values=1500):
    """One customer with a third of the rows and as many distinct values."""
    big = [("HOT", m, "pro", Decimal(f"{100 + i}.{i % 100:02d}")) for i, m in enumerate(MONTHS * values)]
    rest = [(f"C{i}", m, "starter", Decimal("49.00")) for i in range(2 * values) for m in MONTHS]
    return spark.createDataFrame(big + rest, "customer_id string, revenue_month date, plan string, mrr_usd decimal(10,2)")


def test_a_customer_with_very_many_values_is_exact_and_spread(spark):
    df = _big_customer(spark)
    hist = rv.revenue_histogram(df)
    hot = {m: sorted(r.mrr_usd for r in df.where((F.col("customer_id") == "HOT") & (F.col("revenue_month") == m)).collect())
           for m in MONTHS}
    got = {r.revenue_month: r.expansion_mrr for r in rv.expansion_mrr(hist).collect()}
    for prev, cur in zip(MONTHS, MONTHS[1:]):
        assert got[cur] == sum(a - b for a in hot[cur] for b in hot[prev] if a > b)
    # churn and first months shuffle on (customer, month), not on the customer
    cm = rv.customer_month(hist)
    plan = rv._churn_rows(cm)._jdf.queryExecution().executedPlan().toString()
    keys = [x for x in plan.split("Exchange hashpartitioning(")[1:]]
    assert keys and all(x.startswith("customer_id") and not re.match(r"customer_id#\d+, \d+\)", x) for x in keys)


def test_movement_windows_keep_all_shuffle_partitions(spark):
    """Adaptive execution would merge them by compressed size, whatever memory their rows take in the windows."""
    hist = rv.revenue_histogram(_skewed(spark))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert parts > 1
    assert rv._churn_rows(rv.customer_month(hist)).rdd.getNumPartitions() == parts
    expansion = rv.expansion_rows(hist)
    expansion.collect()
    final = expansion._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    kept = [x for x in final.splitlines() if "REPARTITION_BY_NUM" in x]
    assert len(kept) == 2 and all(f", {parts})" in x for x in kept) and sum("_hi" in x for x in kept) == 1


def test_the_revenue_summary_keeps_all_shuffle_partitions(spark):
    """No aggregate by customer lies behind partitions that adaptive execution may merge; a hot customer is exact."""
    rows = _skewed(spark).coalesce(4).withColumn("revenue_id", F.concat(F.lit("R"), F.monotonically_increasing_id()))
    out = marts.customer_revenue_summary(rows)
    exchanges = re.findall(r"Exchange .*", out._jdf.queryExecution().executedPlan().toString())
    assert len(exchanges) == 2 and all("REPARTITION_BY_NUM" in e for e in exchanges), exchanges
    prices = [Decimal(r.mrr_usd) for r in rows.where("customer_id = 'HOT'").select("mrr_usd").collect()]
    hot = out.where("customer_id = 'HOT'").first()
    assert hot.total_revenue_to_date == sum(prices) and hot.months_with_revenue == len(MONTHS)
    assert hot.avg_monthly_mrr == round(sum(prices) / len(prices), 2)
    types = dict(out.dtypes)
    assert (types["avg_monthly_mrr"], types["total_revenue_to_date"]) == ("decimal(11,2)", "decimal(20,2)")
