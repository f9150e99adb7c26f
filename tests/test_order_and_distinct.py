"""Row numbers and file order without a global task; distinct counts from bitmaps."""

import random

import pytest
from pyspark.sql import functions as F

from subledger.operators import materialise
from subledger.operators.distinct import NUMBER, customer_bitmaps, customer_numbers, distinct_customers
from subledger.operators.ordering import file_ranges, numbered, overlapping_files
from subledger.operators.partitions import PartitionedTable

from conftest import rows


@pytest.mark.parametrize("parts", ["1", "8", "50"])
def test_numbers_follow_the_order(spark, parts):
    rng = random.Random(3)
    recs = [(rng.choice([None, *range(40)]), f"x{i}") for i in range(700)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = numbered(spark.createDataFrame(recs, "a int, b string").repartition(7), [F.col("a"), F.col("b").desc()]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    got = [(r.a, r.b) for r in sorted(got, key=lambda r: r.position)]
    by_b = sorted(recs, key=lambda r: r[1], reverse=True)
    assert got == sorted(by_b, key=lambda r: -1 if r[0] is None else r[0])
    assert rows(numbered(spark.createDataFrame([], "a int"), [F.col("a")])) == []


def test_numbers_need_no_global_task(spark, monkeypatch):
    df = spark.range(5000).select((F.col("id") * 7 % 5000).alias("a"))
    plan = numbered(df, [F.col("a")])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan  # of rows; the ranges were numbered before
    monkeypatch.setattr(materialise, "BROADCAST_ROWS", 0)
    assert numbered(df, [F.col("a")]).where("position != a + 1").count() == 0


def test_files_that_follow_each_other(spark, scratch):
    df = spark.range(2000).select((F.col("id") * 7 % 2000).alias("a"), F.lit("m").alias("_m"))
    df.repartition(4).write.parquet(f"{scratch}/mixed")
    assert overlapping_files(spark.read.parquet(f"{scratch}/mixed"), ["a"]) == 3
    df.orderBy("a").write.parquet(f"{scratch}/sorted")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = PartitionedTable(spark, f"{scratch}/parts", "_m")
        table.replace(df, order=("a",))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert overlapping_files(spark.read.parquet(f"{scratch}/sorted"), ["a"]) == 0
    hot = table.read()  # one value of the partition column, several files
    assert file_ranges(hot, ["a"]).count() > 3 and overlapping_files(hot, ["a"]) == 0
    assert [r.a for r in hot.orderBy("a").collect()] == list(range(2000))


def test_distinct_counts_from_bitmaps(spark):
    rng = random.Random(8)
    recs = [(f"c{rng.randrange(500)}" if rng.random() > 0.05 else None, rng.randrange(12), rng.choice("xy")) for _ in range(4000)]
    recs += [("hot", 3, "x")] * 2000
    df = spark.createDataFrame(recs, "customer_id string, month int, plan string")
    numbers = customer_numbers(df)
    assert sorted(r[NUMBER] for r in numbers.collect()) == list(range(1, numbers.count() + 1))
    bitmaps = customer_bitmaps(df, numbers, "month", "plan")
    for keys in ({"month": F.col("month")}, {"quarter": F.floor(F.col("month") / 3)}, {"plan": F.col("plan")},
                 {"quarter": F.floor(F.col("month") / 3), "plan": F.col("plan")}):
        want = df.where("customer_id is not null").groupBy(*[k.alias(n) for n, k in keys.items()]).agg(
            F.countDistinct("customer_id").alias("customers"))
        assert rows(distinct_customers(bitmaps, **keys)) == rows(want)


def test_new_customers_are_numbered_behind_the_known(spark):
    df = lambda ids: spark.createDataFrame([(i,) for i in ids], "customer_id string")
    one = customer_numbers(df(["b", "d", None, "b"]))
    assert rows(one) == [("b", 1), ("d", 2)]
    two = customer_numbers(df(["a", "d", "c", None]), one)
    assert rows(two) == [("a", 3), ("b", 1), ("c", 4), ("d", 2)]
    # more than one stretch of 32,768 numbers, bitmaps of two loads together
    many = spark.range(70_000).select(F.format_string("k%06d", "id").alias("customer_id"), (F.col("id") % 3).alias("m"))
    numbers = customer_numbers(many.select("customer_id"), two)
    bits = customer_bitmaps(many, numbers, "m").unionByName(customer_bitmaps(many.where("m = 1"), numbers, "m"))
    assert bits.select("stretch").distinct().count() == 3
    assert rows(distinct_customers(bits, half=F.col("m") > 0)) == [(False, 23_334), (True, 46_666)]
    assert rows(distinct_customers(bits, all=F.lit(1))) == [(1, 70_000)]


def test_customers_are_never_broadcast(spark):
    """Also not when their files are smaller than the threshold: the hash table of a row per customer fills the driver."""
    df = spark.createDataFrame([(f"c{i % 30}", i % 4) for i in range(200)], "customer_id string, m int")
    numbers = customer_numbers(df)
    bitmaps = customer_bitmaps(df, numbers, "m")
    more = customer_numbers(df.withColumn("customer_id", F.concat(F.lit("d"), "customer_id")), numbers)
    assert rows(distinct_customers(bitmaps, all=F.lit(1))) == [(1, 30)] and more.count() == 60
    plan = bitmaps._jdf.queryExecution().executedPlan().toString()
    met = plan[:plan.index("SortMergeJoin")]  # above the join with the numbers; below it, ranges of the numbers are broadcast
    assert "BroadcastHashJoin" not in met
