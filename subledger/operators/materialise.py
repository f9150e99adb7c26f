"""Intermediate tables in the shared checkpoint folder, and size-checked broadcasts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.session import checkpoint_dir

#: Most rows of a side that is broadcast. Context rows hold a key and a few
#: numbers, some 100 bytes, so this is about Spark's own 10 MB threshold.
BROADCAST_ROWS = 100_000

_folder: ContextVar[str | None] = ContextVar("folder", default=None)


@contextmanager
def work_folder(spark: SparkSession) -> Iterator[str]:
    """A folder of this run for all that ``materialised`` writes inside the block.

    It is deleted at the end of the block, so nothing that still reads it may
    leave the block: write or collect results first.
    """
    path = f"{checkpoint_dir(spark).rstrip('/')}/work-{uuid.uuid4().hex}"
    token = _folder.set(path)
    try:
        yield path
    finally:
        _folder.reset(token)
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def materialised(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Several consumers then share one computation, whatever AQE can reuse, and a
    lost executor re-reads files. Outside a ``work_folder`` the files stay.
    """
    root = _folder.get() or checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{root}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def context_join(rows: DataFrame, context: DataFrame, key: str, how: str = "left", n: int | None = None) -> DataFrame:
    """Join detail ``rows`` to a materialised table with one row per ``key``.

    The table's rows are counted (from its files' footers), unless a bound ``n``
    is known. Up to BROADCAST_ROWS it is broadcast, whatever the planner would have guessed,
    so the detail rows stay where they are. A larger table is joined by shuffle
    with the detail rows salted, so that a key with a third of them is spread.
    """
    if (context.count() if n is None else n) <= BROADCAST_ROWS:
        return rows.join(F.broadcast(context), key, how)
    salts = 64
    salted = context.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int"))
    return dealt.join(salted, [key, "_salt"], how).drop("_salt")
