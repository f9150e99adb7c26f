"""The MRR mart, month by month: a new month meets a carried state, not the history.

The state lies in three tables in folders per calendar month:

* ``histogram``: (customer, month, plan, mrr) -> rows, of which a new month reads the month before
  (what its customers may expand from, or be missed by);
* ``known``: customers by the month they first paid in, of which it reads the ids;
* ``mart_mrr``: the rows themselves, of which it reads the last total (growth).

A month is written whole, so appending it again, after a failure or with corrected
rows, replaces it; with ``append_from`` and ``rewrite`` the later months follow, from their histograms.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.operators import revenue as rv
from subledger.operators.materialise import materialised, work_folder
from subledger.operators.partitions import PartitionedTable
from subledger.plans import marts

T, C = rv.T, rv.C
_MONTH = "_month"


def _month(date: str = T):
    return F.trunc(date, "MM")


def _with_month(df: DataFrame, date: str = T) -> DataFrame:
    return df.withColumn(_MONTH, _month(date))


class MonthlyMrr:
    """The mart under ``root`` and the state it is continued from."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, root = spark, root.rstrip("/")
        self.histogram, self.known, self.mart = (
            PartitionedTable(spark, f"{root}/{n}", _MONTH) for n in ("histogram", "known", "mart_mrr"))

    def read(self) -> DataFrame | None:
        return self.mart.read()

    def start(self, revenue: DataFrame) -> None:
        """State and mart of a whole history at once."""
        with work_folder(self.spark):
            hist = materialised(rv.revenue_histogram(revenue), "revenue-histogram")
            first = rv.first_revenue_month(rv.customer_month(hist)).select(C, "first_month")
            self.histogram.replace(_with_month(hist))
            self.known.replace(_with_month(first, "first_month"))
            self.mart.replace(_with_month(marts.mart_mrr_of(hist)), order=(T, "plan"))

    def append(self, revenue: DataFrame) -> dt.date | None:
        """Append (or replace) the one calendar month that ``revenue`` has rows of.

        It must not come before a month that is there; for such a correction see
        ``append_from``. Rows without MRR or customer count for nothing, as in the mart.
        """
        with work_folder(self.spark):
            hist = materialised(_with_month(rv.revenue_histogram(revenue)), "revenue-histogram")
            months = [r[0] for r in hist.select(_MONTH).distinct().limit(2).collect()]
            if len(months) > 1:
                raise ValueError(f"rows of more than one month: {sorted(months)}")
            if not months:
                return None
            last = self.histogram.rows()
            last = None if last is None else last.agg(F.max(_MONTH)).first()[0]
            if last is not None and months[0] < last:
                raise ValueError(f"{months[0]} comes before {last}")
            self._write(months[0], hist)
            return months[0]

    def append_from(self, revenue: DataFrame) -> list[dt.date]:
        """Replace the one month of ``revenue``, then bring the months after it up to date."""
        with work_folder(self.spark):
            hist = materialised(_with_month(rv.revenue_histogram(revenue)), "revenue-histogram")
            (first,) = (r[0] for r in hist.select(_MONTH).distinct().limit(2).collect())
            return self._from(first, {first: hist})

    def rewrite(self, revenue: DataFrame, months: list[dt.date]) -> list[dt.date]:
        """``revenue`` as all rows of ``months`` (some may have none now), then the months after the first."""
        if not months:
            return []
        with work_folder(self.spark):
            hist = materialised(_with_month(rv.revenue_histogram(revenue)), "revenue-histogram")
            return self._from(min(months), {m: hist.where(F.col(_MONTH) == F.lit(m)) for m in months})

    def _from(self, first: dt.date, new: dict[dt.date, DataFrame]) -> list[dt.date]:
        here = self._rows(self.histogram, F.col(_MONTH) > F.lit(first))
        later = [] if here is None else [r[0] for r in here.select(_MONTH).distinct().collect()]
        months = sorted({*new, *later})  # one per month of history
        for month in months:
            hist = new.get(month)
            self._write(month, self._rows(self.histogram, F.col(_MONTH) == F.lit(month)) if hist is None else hist)
        return months

    @staticmethod
    def _rows(table: PartitionedTable, where) -> DataFrame | None:
        rows = table.rows()
        return None if rows is None else rows.where(where)

    def _write(self, month: dt.date, hist: DataFrame) -> None:
        here = F.lit(month)
        before = self._rows(self.histogram, F.col(_MONTH) == F.add_months(here, -1))
        both = hist if before is None else hist.unionByName(before)
        cm = rv.customer_month(hist)
        known = self._rows(self.known, F.col(_MONTH) < here)
        fresh = cm if known is None else cm.join(known.select(C), C, "left_anti")
        new = materialised(rv.first_revenue_month(fresh), "new-customers")
        by_plan = materialised(rv.mrr_by_month_plan(hist), "mrr-by-month-plan")
        # the total before this month, wherever it is, for the growth of its first
        totals = rv.month_totals(by_plan)
        earlier = self._rows(self.mart, F.col(_MONTH) < here)
        if earlier is not None:
            of = F.struct(T, F.col("total_mrr_all_plans").alias("total_mrr"), "total_active_customers")
            totals = totals.unionByName(
                earlier.agg(F.max_by(of, T).alias("last")).where("last is not null").select("last.*"))
        in_month = _month() == here
        new_rows = new.select(F.col("first_month").alias(T), F.col("first_month_mrr").alias("new_mrr"),
                              F.lit(1).cast("long").alias("new_customers"))
        moves = rv.added_moves(new_rows, rv.expansion_rows(both).where(in_month))
        rows = marts.mrr_rows(by_plan, rv.month_growth(totals).where(in_month), moves,
                              rv.churned_mrr(rv.customer_month(both)).where(in_month))
        rows = materialised(_with_month(rows), "mrr-rows")
        self.mart.replace(rows, [month], (T, "plan"))
        self.known.replace(_with_month(new.select(C, "first_month"), "first_month"), [month])
        self.histogram.replace(hist, [month])  # last: a month that is here is complete
