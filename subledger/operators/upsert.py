"""Keyed incremental upsert on plain Parquet.

Parquet has no MERGE. An upsert is

    next = (old rows whose key is not in the batch)  union  batch

over the hash buckets that the batch touches, written by dynamic partition overwrite.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.operators.materialise import materialised
from subledger.operators.partitions import PartitionedTable


def keyed_upsert(target: DataFrame | None, batch: DataFrame, key: str) -> DataFrame:
    """MERGE semantics: batch rows replace target rows with the same key.

    * A null key never matches, so null-key target rows are all kept and
      null-key batch rows are appended. They bypass the join entirely: all
      null keys would otherwise hash to the same reducer.
    * The anti join reads only the batch's distinct keys (partial-aggregated
      before the shuffle), so a hot key in the batch is one row per map task.
    * New batch columns are appended to the target schema (null for old
      rows); target columns missing in the batch become null for batch rows.
    """
    if target is None:
        return batch
    k = F.col(key)
    batch_keys = batch.where(k.isNotNull()).select(key).distinct()
    kept = target.where(k.isNotNull()).join(batch_keys, key, "left_anti")
    kept = kept.select(*target.columns)  # the join moves the key first
    return (
        target.where(k.isNull())
        .unionByName(kept)
        .unionByName(batch, allowMissingColumns=True)
    )


def incremental_gate(run_ts: Column, target: DataFrame | None, ts_col: str = "flagged_at") -> Column | None:
    """``run_ts > (select max(ts_col) from target)`` as an uncorrelated scalar
    subquery: one tiny aggregate job whose value Spark then folds in as a
    literal (no join). An empty target gives null, which makes the gated
    predicate null (not true). ``None`` when there is no target (first run)."""
    if target is None:
        return None
    return run_ts > target.select(F.max(ts_col)).scalar()


class KeyedTable(PartitionedTable):
    """A table with a key, in hash buckets of it; ``_batch`` names the batch a row came with."""

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int = 64):
        super().__init__(spark, root, "_bucket")
        self.key, self.buckets = key, buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.coalesce(F.col(self.key), F.lit(""))), F.lit(self.buckets)).cast("int")

    def read(self, parts: list | None = None, without: str | None = None) -> DataFrame | None:
        """The rows without helper columns, and without those that came with the batch ``without``."""
        table = self.rows(parts)
        if table is not None and without is not None:
            table = table.where(F.col("_batch") != without)
        return table if table is None else table.select(*[c for c in table.columns if not c.startswith("_")])

    def upsert(self, batch: DataFrame, tag: str | None = None, gone: DataFrame | None = None) -> None:
        """``keyed_upsert`` of ``batch``; rows whose key is in ``gone`` (one column) leave first.

        The same batch under the same ``tag`` again changes nothing, also after an
        upsert that broke off: its keyed rows replace themselves, and null-key rows
        that came with this tag are dropped before they are appended.
        """
        tag = tag or uuid.uuid4().hex
        batch = materialised(batch.withColumns({"_batch": F.lit(tag), "_bucket": self._bucket()}), "upsert-batch")
        moved = batch.select("_bucket")
        if gone is not None:
            gone = materialised(gone.select(F.col(gone.columns[0]).alias(self.key)), "upsert-gone")
            moved = moved.unionByName(gone.select(self._bucket().alias("_bucket")))
        touched = [r[0] for r in moved.distinct().collect()]  # at most `buckets`
        target = self.rows(touched)
        if target is not None:
            target = target.where(F.col(self.key).isNotNull() | (F.col("_batch") != tag))
            if gone is not None:
                target = target.join(gone, self.key, "left_anti").select(*target.columns)
        self.replace(keyed_upsert(target, batch, self.key), touched)
