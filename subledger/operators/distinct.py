"""Distinct counts that can be added: bitmaps over dense customer numbers.

A distinct count per month cannot be added up to one per quarter; a bitmap can. Customers
get dense numbers once; per month and plan, the numbers of paying customers are kept
as bitmaps of 32,768 bits (one row per stretch of numbers that occurs). Any later count
over months or plans is a bitwise or of such rows: history is not read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.operators.ordering import numbered

NUMBER = "customer_no"


def customer_numbers(customers: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """customer_id, customer_no (dense, from 1 on) of all non-null ids in ``customers``.

    ``known`` numbers stay; new customers are numbered behind them. Numbers
    follow the order of the ids, without a global task. The known meet the ids in a
    merge join, as in ``customer_bitmaps``.
    """
    ids = customers.select("customer_id").where("customer_id is not null").distinct()
    if known is None:
        return numbered(ids, [F.col("customer_id")], NUMBER)
    last = known.agg(F.coalesce(F.max(NUMBER), F.lit(0))).first()[0]
    fresh = numbered(ids.join(known.hint("merge"), "customer_id", "left_anti"), [F.col("customer_id")], NUMBER)
    return known.select("customer_id", NUMBER).unionByName(fresh.withColumn(NUMBER, F.col(NUMBER) + F.lit(last)))


def customer_bitmaps(rows: DataFrame, numbers: DataFrame, *keys: str) -> DataFrame:
    """(keys, stretch, bits): the customers of each key, 32,768 numbers to a row of 4 KB.

    Partial bitmaps are built before the shuffle, so a key with very many rows
    is a row per stretch and task. Numbers are a row per customer, which files hold in
    little space and a broadcast does not, so the join is a merge join whatever their size
    is estimated to be.
    """
    met = rows.select(*keys, "customer_id").join(numbers.hint("merge"), "customer_id")
    return met.groupBy(*keys, F.bitmap_bucket_number(NUMBER).alias("stretch")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(NUMBER)).alias("bits"))


def distinct_customers(bitmaps: DataFrame, **keys: Column) -> DataFrame:
    """Exact distinct ``customers`` per named key (expressions over the bitmaps' keys), from bitmaps alone."""
    wide = bitmaps.select(*[k.alias(name) for name, k in keys.items()], "stretch", "bits")
    per_stretch = wide.groupBy(*keys, "stretch").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("_n"))
    return per_stretch.groupBy(*keys).agg(F.sum("_n").alias("customers"))
