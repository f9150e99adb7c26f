"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.session import checkpoint_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver was started."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    Cuts lineage and pins values (row ids, fingerprints) that later jobs join
    on, so a lost executor re-reads files instead of re-running Python.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/llm-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names for helpers that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def row_key(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with a hash of its text; (doc_id, hash) tells its rows apart.

    Two rows that share both are repeats of one row for every operator here.
    """
    (name,) = fresh(df, "text_key")
    return df.withColumn(name, F.xxhash64(text_or_empty())), name


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, text_key) is not in ``dropped``."""
    keyed, key = row_key(docs)
    bad = dropped.select(
        F.col("doc_id").alias("drop_id"), F.col("text_key").alias("drop_key")
    ).distinct()
    return keyed.join(
        bad,
        keyed["doc_id"].eqNullSafe(bad["drop_id"]) & (keyed[key] == bad["drop_key"]),
        "left_anti",
    ).select(*[keyed[c] for c in docs.columns])


def pieces(texts: Iterable[str], most: int) -> Iterator[tuple[int, int]]:
    """Ranges [a, b) over ``texts`` of about ``most`` characters, one text at least."""
    start, size = 0, 0
    texts = list(texts)
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def chunks(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes in a column, one row at least."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
    a = 0
    while a < len(ends):
        before = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(a, b - a)
        a = b
