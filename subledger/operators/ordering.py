"""Global order without a global task: row numbers, and files whose ranges do not overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subledger.operators.materialise import BROADCAST_ROWS, materialised


def numbered(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """``df`` with the place of each row in ``order``, from 1 on, as ``name``.

    Rows are dealt by ranges and sorted in them; each keeps its range and its place
    there. How many rows lie in earlier ranges is a running sum over one row per range, so
    no task sees more than a range. Rows equal in ``order`` get places in any order.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialised(dealt.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialised(sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")), "range-starts")
    side = F.broadcast(starts) if starts.count() <= BROADCAST_ROWS else starts
    place = F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    return placed.withColumn("_part", part).join(side, "_part").select(*df.columns, place.alias(name))


def file_ranges(df: DataFrame, keys: list[str]) -> DataFrame:
    """path, rows, first, last (structs of ``keys``): one row per file of a table read from files."""
    key = F.struct(*keys)
    return df.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(key).alias("first"), F.max(key).alias("last"))


def overlapping_files(df: DataFrame, keys: list[str]) -> int:
    """How many files of a table begin before the file in front of them, by path, has ended.

    Zero says: files read in the order of their paths give rows in the order of ``keys``, if
    each is sorted. One row per file is compared.
    """
    before = F.lag("last").over(Window.orderBy("path"))
    return file_ranges(df, keys).withColumn("before", before).where("before > first").count()
