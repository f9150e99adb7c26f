"""Keep-first deduplication by key (``qualify row_number() ... = 1``).

Spark plans ``row_number() = 1`` as a WindowGroupLimit: a *partial* top-1 per
key runs before the shuffle, so a key that holds a third of all rows leaves
each map task as a single row and cannot pile up in one reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subledger.sources.bronze import ROW_SEQ

_RN = "_dedup_rn"


def _order(df: DataFrame, order_by: str, tie_break: str | None):
    # Ascending with nulls last (the warehouse default the reference runs on),
    # then the arrival order so that equal sort values resolve the same way
    # in every run and every recomputed task.
    cols = [F.col(order_by).asc_nulls_last()]
    if tie_break and tie_break in df.columns:
        cols.append(F.col(tie_break).asc_nulls_last())
    return cols


def keep_first(df: DataFrame, key: str, order_by: str, tie_break: str | None = ROW_SEQ) -> DataFrame:
    """One row per ``key`` value (null keys form one group, as in SQL windows)."""
    w = Window.partitionBy(key).orderBy(*_order(df, order_by, tie_break))
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def dropped_duplicates(df: DataFrame, key: str, order_by: str, tie_break: str = ROW_SEQ) -> DataFrame:
    """Rows that ``keep_first`` discards for a non-null key.

    Keys that occur once are set apart by a partial count, so only the few
    repeated ones are looked at further. Of their rows those that are not the
    winner are kept by an anti join on (key, arrival order), rather than by a
    ``row_number() > 1`` window, which would put all copies of a hot key into
    one task. ``tie_break`` has to be there and not null; a null ends the job.
    """
    if tie_break not in df.columns:
        raise ValueError(f"dropped_duplicates needs the column {tie_break}")
    seq = F.coalesce(F.col(tie_break), F.raise_error(F.lit(f"{tie_break} is null")).cast("long"))
    keyed = df.where(F.col(key).isNotNull()).withColumn(tie_break, seq)
    many = keyed.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    repeated = keyed.join(many, key, "left_semi").select(*df.columns)
    winners = keep_first(repeated, key, order_by, tie_break).select(key, tie_break)
    return repeated.join(winners, [key, tie_break], "left_anti").select(*df.columns)
