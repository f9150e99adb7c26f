"""Dashboard tile queries over the gold marts.

The reference names the tiles but not their formulas; where a gold column
fixes the value it is used as is. Month-level measures of ``mart_mrr`` are
repeated on every plan row, so they are read at month grain (``max`` per
month), never summed across plans.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

T = "revenue_month"


def mrr_trend(mart_mrr: DataFrame) -> DataFrame:
    """One row per month."""
    return mart_mrr.groupBy(T).agg(
        F.max("total_mrr_all_plans").alias("total_mrr"),
        F.max("arr").alias("arr"),
        F.max("total_active_customers").alias("total_active_customers"),
    )


def kpi_mrr_latest(mart_mrr: DataFrame) -> DataFrame:
    """G1: total MRR, ARR and active customers of the latest month.

    A top-1 over the month-grain trend (one row per month): planned as a
    TakeOrderedAndProject, so the mart is computed once (a scalar subquery
    for the max month would plan it twice).
    """
    return mrr_trend(mart_mrr).orderBy(F.col(T).desc()).limit(1)


def mrr_by_plan(mart_mrr: DataFrame) -> DataFrame:
    """MRR summed over months, per plan."""
    return mart_mrr.groupBy("plan").agg(
        F.sum("total_mrr").alias("total_mrr"),
        F.count(F.lit(1)).alias("months"),
    )


def mrr_movement(mart_mrr: DataFrame) -> DataFrame:
    """New / expansion / churned / net new per month (month grain)."""
    return mart_mrr.groupBy(T).agg(
        F.max("new_mrr").alias("new_mrr"),
        F.max("expansion_mrr").alias("expansion_mrr"),
        F.max("churned_mrr").alias("churned_mrr"),
        F.max("net_new_mrr").alias("net_new_mrr"),
    )


def customers_by_country(mart_cac_ltv: DataFrame) -> DataFrame:
    """G6."""
    return mart_cac_ltv.groupBy("country").agg(F.countDistinct("customer_id").alias("customers"))


def quarantine_breakdown(*quarantine_tables: DataFrame) -> DataFrame:
    """Rows per source table and issue type over all quarantine tables.

    Each table is aggregated first (partial aggregation), then the tiny
    results are unioned.
    """
    parts = [q.groupBy("source_table", "issue_type").agg(F.count(F.lit(1)).alias("rows"))
             for q in quarantine_tables]
    return reduce(DataFrame.unionByName, parts)


def kpi_transactions(tx: DataFrame) -> DataFrame:
    """Success rate, total transactions, successful volume, failure rate.

    ``tx`` is the payments mart or, as no context column is used, the silver
    transactions, which have the same rows and need no context.
    """
    n = F.count(F.lit(1))
    return tx.agg(
        n.alias("total_transactions"),
        F.round(F.count_if("is_successful").cast("double") / F.nullif(n, F.lit(0)) * 100, 2)
        .alias("success_rate_pct"),
        F.round(F.count_if("is_failed").cast("double") / F.nullif(n, F.lit(0)) * 100, 2)
        .alias("failure_rate_pct"),
        F.sum(F.when(F.col("is_successful"), F.col("amount_usd")).otherwise(F.lit(0)))
        .alias("successful_volume_usd"),
    )


def kpi_unit_economics(mart_cac_ltv: DataFrame) -> DataFrame:
    """Average CAC, LTV, LTV:CAC and payback over customer rows."""
    return mart_cac_ltv.agg(
        F.round(F.avg("cac_usd"), 2).alias("avg_cac"),
        F.round(F.avg("projected_ltv"), 2).alias("avg_ltv"),
        F.round(F.avg("ltv_cac_ratio"), 2).alias("avg_ltv_cac_ratio"),
        F.round(F.avg("cac_payback_months"), 1).alias("avg_payback_months"),
    )


def ltv_by_plan(mart_cac_ltv: DataFrame) -> DataFrame:
    """G10a."""
    return mart_cac_ltv.groupBy("plan").agg(
        F.round(F.avg("projected_ltv"), 2).alias("avg_ltv"),
        F.count(F.lit(1)).alias("rows"),
    )


def health_by_plan(mart_cac_ltv: DataFrame) -> DataFrame:
    """Health scorecard."""
    return mart_cac_ltv.groupBy("plan", "unit_economics_health").agg(
        F.count(F.lit(1)).alias("rows"))
