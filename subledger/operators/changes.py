"""What differs between two loads of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_digest(columns: list[str]) -> list[Column]:
    """128 bits over the columns, null told apart from every value."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return [F.xxhash64(F.lit(salt), nulls, *columns).alias(f"_digest{salt}") for salt in (1, 2)]


def changed_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Distinct keys (null among them) whose rows differ between two loads, as ``key``.

    Rows are counted per key and digest, +1 in the old load and -1 in the new one; what
    does not cancel out has changed, come or gone, repeated rows included. One
    shuffle of key and digest with partial sums; a hot key is dealt by its digests.
    """
    columns = [c for c in old.columns if c in new.columns]
    sign = lambda df, n: df.select(key, *row_digest(columns), F.lit(n).alias("_n"))
    both = sign(old, 1).unionByName(sign(new, -1))
    odd = both.groupBy(key, "_digest1", "_digest2").agg(F.sum("_n").alias("_n")).where("_n != 0")
    return odd.select(key).distinct()


def rows_of(df: DataFrame, keys: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose key (null equals null) is in ``keys``; ``left_anti`` for the others."""
    side = keys.select(F.col(key).alias("_changed_key"))
    return df.join(side, F.col(key).eqNullSafe(F.col("_changed_key")), how)
