"""Incremental transaction quarantine driven by arriving bronze files.

The reference re-reads all bronze transactions at every scheduled run and
upserts the quarantine by ``row_id``. When bronze arrives as files, Structured
Streaming does the bookkeeping of which files are new, and
``Trigger.AvailableNow`` turns it into the scheduled-batch job the reference runs
(process what has arrived, then stop).

Duplicates are removed over all files so far: a second keyed table holds, per
transaction id, date text and arrival number of the copy that has won until now (null ids
are one group, as in the models). Of a micro-batch only rows that beat the winner of their id
count. They replace what quarantine has of this id: with a flag if they are
defective, with nothing if they are not, as their id's defective copy would not have been
flagged had the files come together. So the quarantine after any number
of batches has the rows of one batch over all files; only ``flagged_at`` differs.

A micro-batch that is run again after a failure, whole or in part, changes
nothing: rows carry its tag, and winners are written last. Run timestamps have to increase from batch
to batch, as the gate compares them with the newest flag; one that does not
raises a ValueError instead of dropping rows.
"""

from __future__ import annotations

import zlib
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from subledger.operators.dedup import keep_first
from subledger.operators.materialise import materialised, work_folder
from subledger.operators.upsert import KeyedTable
from subledger.params import RunParams
from subledger.plans.quarantine import quarantine_transactions_from
from subledger.plans.silver import DEDUP
from subledger.session import checkpoint_dir
from subledger.sources.bronze import ROW_SEQ, text_schema

_KEY = "_key"
_ID, _DATE = DEDUP["transactions"]


class StreamTables:
    """The quarantine that a stream keeps under ``root``, and its winners."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        root = root.rstrip("/")
        self.flagged = KeyedTable(spark, f"{root}/flagged", _KEY, buckets)
        self.winners = KeyedTable(spark, f"{root}/winners", _KEY, buckets)

    def read(self) -> DataFrame | None:
        return self.flagged.read()


def _beats(date: Column, seq: Column, other_date: Column, other_seq: Column) -> Column:
    """In the order of ``keep_first``: by date text, null last, then by arrival."""
    return (
        F.when(date.isNull() & other_date.isNull() | (date == other_date), seq < other_seq)
        .otherwise(F.coalesce(date < other_date, date.isNotNull()))
    )


def winning_rows(batch: DataFrame, winners: DataFrame | None) -> DataFrame:
    """First copies of the batch that come before the winner so far, with their ``_key``."""
    key = F.coalesce(F.concat(F.lit("="), F.col(_ID)), F.lit(""))
    first = keep_first(batch, _ID, _DATE).withColumn(_KEY, key)
    if winners is None:
        return first
    so_far = winners.select(_KEY, F.col(_DATE).alias("_date"), F.col(ROW_SEQ).alias("_seq"), F.lit(True).alias("_seen"))
    won = F.col("_seen").isNull() | _beats(F.col(_DATE), F.col(ROW_SEQ), F.col("_date"), F.col("_seq"))
    return first.join(so_far, _KEY, "left").where(won).drop("_date", "_seq", "_seen")


def publish_batch(tables: StreamTables, batch: DataFrame, params: RunParams, tag: str) -> None:
    """Take one micro-batch into the winners and the quarantine."""
    earlier = tables.flagged.read(without=tag)
    last = None if earlier is None else earlier.agg(F.max("flagged_at")).first()[0]
    if last is not None and params.run_ts <= last:
        raise ValueError(f"run timestamp {params.run_ts} is not after {last}")
    with work_folder(batch.sparkSession):
        won = materialised(winning_rows(batch, tables.winners.rows()), "winning-rows")
        # the gate holds: the run comes after every flag so far
        flagged = quarantine_transactions_from(won, params, extra={_KEY: F.col(_KEY)})
        tables.flagged.upsert(flagged, tag, gone=won.select(_KEY))
        tables.winners.upsert(won.select(_KEY, _DATE, ROW_SEQ), tag)


def start(
    spark: SparkSession,
    landing_dir: str,
    table_root: str,
    params_for_batch: Callable[[int], RunParams],
    checkpoint_location: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the stream; ``params_for_batch(batch_id)`` gives the run timestamp.

    The landing files are bronze transactions in parquet (text columns plus
    ``row_seq``). The result is ``StreamTables(spark, table_root).read()``.
    """
    tables = StreamTables(spark, table_root)
    ckpt = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/stream-quarantine-transactions"

    stream_no = zlib.crc32(ckpt.encode())

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        publish_batch(tables, batch, params_for_batch(batch_id), f"{stream_no}-{batch_id}")

    stream = spark.readStream.schema(text_schema("transactions", with_row_seq=True)).parquet(landing_dir)
    writer = stream.writeStream.foreachBatch(upsert_batch).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
