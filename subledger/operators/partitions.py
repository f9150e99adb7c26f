"""A Parquet table in partitions, of which a change overwrites those it touches.

The write is Spark's own dynamic partition overwrite: partitions that the rows
(or the caller) name are replaced, the others are not looked at. What is written
is first materialised in the shared folder when it was read from the table itself.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.operators.materialise import materialised

#: True in the one row that stands for a partition without rows: an overwrite by
#: rows alone could not empty a partition.
VOID = "_void"


def dealt(rows: DataFrame, by: str, order: tuple[str, ...] = ()) -> DataFrame:
    """Rows among write tasks by partition value, or by ranges of it and ``order``, sorted.

    Either way one value's rows are split among tasks when they are many.
    """
    if not order:
        return rows.hint("rebalance", by)
    return rows.repartitionByRange(by, *order).sortWithinPartitions(by, *order)


class PartitionedTable:
    """Rows of ``root`` in one folder per value of the column ``by``."""

    def __init__(self, spark: SparkSession, root: str, by: str):
        self.spark, self.root, self.by = spark, root.rstrip("/"), by

    def rows(self, parts: list | None = None) -> DataFrame | None:
        """All columns, also the helpers; only ``parts`` if named; None before the first write."""
        try:
            table = self.spark.read.option("mergeSchema", True).parquet(self.root)
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise
        if parts is not None:
            table = table.where(F.col(self.by).isin(parts))  # reaches the file listing
        return table.where(~F.col(VOID)).drop(VOID)

    def read(self, parts: list | None = None) -> DataFrame | None:
        """The rows without helper columns (names that begin with an underscore)."""
        table = self.rows(parts)
        return table if table is None else table.select(*[c for c in table.columns if not c.startswith("_")])

    def replace(self, rows: DataFrame, parts: list | None = None, order: tuple[str, ...] = ()) -> None:
        """``rows`` as the whole content of ``parts`` (by default, of the partitions they are in).

        ``rows`` may read the table. Partitions of ``parts`` without a row become empty.
        A partition with very many rows is written by several tasks. With ``order`` the files
        of a partition follow each other in these columns.
        """
        rows = materialised(rows, "partitions")
        if parts is None:
            parts = [r[0] for r in rows.select(self.by).distinct().collect()]  # one per folder
        if not parts:
            return
        kind = rows.schema[self.by].dataType
        voids = self.spark.createDataFrame([(p, True) for p in parts], f"{self.by} {kind.simpleString()}, {VOID} boolean")
        whole = rows.withColumn(VOID, F.lit(False)).unionByName(voids, allowMissingColumns=True)
        (dealt(whole, self.by, order).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy(self.by).parquet(self.root))
