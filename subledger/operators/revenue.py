"""Month-over-month revenue movements without pairwise self-joins.

The reference computes expansion and churn with self-joins on customer id,
which for a customer with many subscriptions emits every (this month row,
last month row) pair. Here every movement is an exact aggregate formulation
over a per-customer histogram:

1. ``revenue_histogram``: rows collapse to ``(customer, month, plan, mrr) ->
   rows`` with map-side partial aggregation, so a customer or month holding a
   huge share of the rows is a few rows per map task before the shuffle. The
   mart writes it once; every step reads it back.
2. Each step shuffles on keys finer than the customer - customer and month, or
   customer, month pair and value bucket - so a customer with very many
   distinct values is spread over many tasks like everybody else.
3. Only month-level results are shuffled at the end, and they are tiny.

Expansion identity: sum over pairs a > b of (a - b) = sum over values a of
``a * count(b < a) - sum(b < a)``, a running count/sum in value order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

C, T, P, V = "customer_id", "revenue_month", "plan", "mrr_usd"


def revenue_histogram(revenue: DataFrame) -> DataFrame:
    """(customer, month, plan, mrr) -> rows, from rows with an MRR and a customer."""
    return (
        revenue.where(F.col(V).isNotNull() & F.col(C).isNotNull())
        .groupBy(C, T, P, V)
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` by ``keys`` in all of ``spark.sql.shuffle.partitions``.

    Adaptive execution merges partitions by their compressed bytes; rows of ids, months and
    counts take several hundred each in the sorts and hash tables behind the shuffle.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _amount() -> Column:
    return F.col(V) * F.col("rows")


def mrr_by_month_plan(hist: DataFrame) -> DataFrame:
    """A1: active customers (distinct), total and average MRR per month and plan.

    Customers are told apart on (month, plan, customer), so the distinct count
    is a plain count and only a small month x plan shuffle follows.
    """
    per_customer = hist.groupBy(T, P, C).agg(F.sum(_amount()).alias("_mrr"), F.sum("rows").alias("_n"))
    return (
        per_customer.groupBy(T, P)
        .agg(
            F.count(F.lit(1)).alias("active_customers"),
            F.sum("_mrr").alias("total_mrr"),
            F.sum("_n").alias("_n"),
        )
        .select(
            T, P, "active_customers", "total_mrr",
            F.round(F.col("total_mrr") / F.col("_n"), 2).alias("avg_mrr_per_customer"),
        )
    )


def customer_month(hist: DataFrame) -> DataFrame:
    """(customer, month) -> MRR summed over that customer's rows; unique key."""
    return hist.groupBy(C, T).agg(F.sum(_amount()).alias(V))


def first_revenue_month(cm: DataFrame) -> DataFrame:
    """A2: first month with revenue per customer, and the MRR of that month."""
    return cm.groupBy(C).agg(
        F.min(T).alias("first_month"),
        F.min_by(V, T).alias("first_month_mrr"),
    )


def _new_rows(cm: DataFrame) -> DataFrame:
    """One row per customer: its first revenue month and the MRR in it."""
    return first_revenue_month(cm).select(
        F.col("first_month").alias(T), F.col("first_month_mrr").alias("new_mrr"),
        F.lit(1).cast("long").alias("new_customers"))


def new_mrr(cm: DataFrame) -> DataFrame:
    """A3: MRR and count of customers in their first revenue month."""
    return _new_rows(cm).groupBy(T).agg(
        F.sum("new_mrr").alias("new_mrr"), F.sum("new_customers").alias("new_customers"))


def _churn_rows(cm: DataFrame) -> DataFrame:
    """(last month, MRR) per customer-month with no revenue in the month after.

    For each customer-month, a probe row keyed by (customer, m + 1) meets the
    customer-month rows keyed by their own month; a probe whose key group has
    no customer-month row is a churn. The window is per customer and key and
    sees at most a few rows.
    """
    # each customer-month row plays both roles (explode, not a union: one read)
    roles = F.explode(F.array(
        F.struct(F.add_months(T, 1).alias("_key"), F.col(T).alias("_t"), F.lit(False).alias("_present")),
        F.struct(F.col(T).alias("_key"), F.lit(None).cast("date").alias("_t"), F.lit(True).alias("_present")),
    )).alias("_r")
    w = Window.partitionBy(C, "_key")
    marked = spread(cm.select(C, V, roles).select(C, V, "_r.*"), C, "_key") \
        .withColumn("_has_next", F.max("_present").over(w))
    return marked.where(~F.col("_present") & ~F.col("_has_next")).select(F.col("_t").alias(T), V)


def churned_mrr(cm: DataFrame) -> DataFrame:
    """A5: customers with revenue in month m and none in m + 1, reported in m + 1
    (grouped by m, as in the reference, then shifted). The MRR is negated."""
    return (
        _churn_rows(cm)
        .groupBy(T)
        .agg(
            (F.sum(V) * F.lit(-1)).alias("churned_mrr"),
            F.count(F.lit(1)).alias("churned_customers"),
        )
        .select(F.add_months(T, 1).alias(T), "churned_mrr", "churned_customers")
    )


LOW_BITS = 16  # a level-0 window holds at most 2**16 distinct values


def expansion_rows(hist: DataFrame) -> DataFrame:
    """(month, gain, 1) per customer-month that has a pair this > last.

    For each (customer, month m) the gain is sum over values a of m and b of
    m - 1 with a > b of (a - b) * n_a * n_b. Values become exact integer units
    (cents for scale 2) and are split into buckets of 2**16 consecutive units,
    so no window partition is large however many distinct values a customer
    has:

    * pairs inside one bucket: running count / sum of last-month values in
      value order, per (customer, month pair, bucket) - at most 2**16 values;
    * pairs across buckets, from bucket totals only:
      sum over this-buckets i of (SA_i * NB(<i) - NA_i * SB(<i)), with NB / SB
      the last-month count / sum of all lower buckets - a range window over
      the bucket totals of one customer and month pair (at most
      10**precision / 2**16 buckets).

    One linear pipeline (no union, no self-join): each value row yields its
    "this month" and "last month" role with an explode, then window, bucket
    totals, window, per-customer sum.
    """
    scale = hist.schema[V].dataType.scale
    big = "decimal(38,0)"
    units = (F.col(V) * F.lit(10 ** scale)).cast("long")
    vals = hist.groupBy(C, T, V).agg(F.sum("rows").alias("n"))
    zero = F.lit(0).cast("long")
    roles = F.explode(F.array(
        # as this month m: compared with the month before
        F.struct(F.add_months(T, -1).alias("_key"), F.col(T).alias("_t"),
                 F.col("n").alias("n_this"), zero.alias("n_last")),
        # as last month: compared with by the month after
        F.struct(F.col(T).alias("_key"), F.lit(None).cast("date").alias("_t"),
                 zero.alias("n_this"), F.col("n").alias("n_last")),
    )).alias("_r")
    rows = vals.select(C, units.alias("_u"), roles).select(
        C, "_u", "_r.*", F.shiftright("_u", LOW_BITS).alias("_hi"))
    rows = spread(rows, C, "_key", "_hi")

    # pairs within a bucket; equal values: this-month rows sort before
    # last-month rows, so only strictly lower last-month values count
    w0 = (
        Window.partitionBy(C, "_key", "_hi")
        .orderBy(F.col("_u").asc(), F.col("n_last").asc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    below_n = F.sum("n_last").over(w0)
    below_s = F.sum(F.col("n_last").cast(big) * F.col("_u")).over(w0)
    scored = rows.select(
        "*",
        (F.col("n_this").cast(big) * (F.col("_u").cast(big) * below_n - below_s)).alias("_wg"),
        ((F.col("n_this") > 0) & (below_n > 0)).alias("_wp"),
    )
    # bucket totals (this-month rows keep their own month: two months can
    # share a previous month), then pairs across buckets
    buckets = scored.groupBy(C, "_key", "_t", "_hi").agg(
        F.sum("n_this").alias("_na"),
        F.sum(F.col("n_this").cast(big) * F.col("_u")).alias("_sa"),
        F.sum("n_last").alias("_nb"),
        F.sum(F.col("n_last").cast(big) * F.col("_u")).alias("_sb"),
        F.sum("_wg").alias("_wg"),
        F.max("_wp").alias("_wp"),
    )
    w1 = Window.partitionBy(C, "_key").orderBy("_hi").rangeBetween(Window.unboundedPreceding, -1)
    lower_n = F.coalesce(F.sum("_nb").over(w1), F.lit(0))
    lower_s = F.coalesce(F.sum("_sb").over(w1), F.lit(0))
    per_bucket = spread(buckets, C, "_key").select(
        C, F.col("_t").alias(T),
        (F.col("_wg") + F.col("_sa") * lower_n - F.col("_na").cast(big) * lower_s).alias("_gain"),
        (F.col("_wp") | (lower_n > 0)).alias("_pair"),
    ).where(F.col("_na") > 0)
    unit = F.lit(10 ** scale).cast(big)
    return (
        per_bucket.groupBy(C, T)
        .agg(F.sum("_gain").alias("_gain_units"), F.max("_pair").alias("_pair"))
        .where(F.col("_pair"))
        .select(T, (F.col("_gain_units") / unit).cast(f"decimal(38,{scale})").alias("expansion_mrr"),
                F.lit(1).cast("long").alias("expanded_customers"))
    )


def expansion_mrr(hist: DataFrame) -> DataFrame:
    """A4: sum of (this - last) over every pair of a customer's rows in month m
    and in m - 1 with this > last, and the count of customers with such a pair.
    """
    return expansion_rows(hist).groupBy(T).agg(
        F.sum("expansion_mrr").alias("expansion_mrr"),
        F.sum("expanded_customers").alias("expanded_customers"),
    )


def new_and_expansion(cm: DataFrame, hist: DataFrame) -> DataFrame:
    """New and expansion MRR per month."""
    return added_moves(_new_rows(cm), expansion_rows(hist))


def added_moves(new: DataFrame, expansion: DataFrame) -> DataFrame:
    """Month sums over the union of the per-customer contribution rows (one shuffle, not two)."""
    return new.unionByName(expansion, allowMissingColumns=True).groupBy(T).agg(
        F.sum("new_mrr").alias("new_mrr"),
        F.sum("new_customers").alias("new_customers"),
        F.sum("expansion_mrr").alias("expansion_mrr"),
        F.sum("expanded_customers").alias("expanded_customers"),
    )


def month_totals(by_plan: DataFrame) -> DataFrame:
    """Month totals over plans (distinct counts are *added*, as in the reference)."""
    return by_plan.groupBy(T).agg(
        F.sum("total_mrr").alias("total_mrr"),
        F.sum("active_customers").alias("total_active_customers"),
    )


def month_growth(totals: DataFrame) -> DataFrame:
    """Previous month's total and growth %, at month grain.

    The window has no partition key, so it runs in one task; its input is one
    row per month (bounded by the length of the history), not per customer.
    """
    w = Window.orderBy(T)
    prev = F.lag("total_mrr").over(w)
    return totals.select(
        *totals.columns, prev.alias("prev_total_mrr"),
        F.round((F.col("total_mrr") - prev) / F.nullif(prev, F.lit(0)) * 100, 2)
        .alias("mrr_growth_rate_pct"),
    )
