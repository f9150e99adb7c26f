"""The MRR mart continued month by month equals the mart of the whole."""

import datetime as dt
import tempfile
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from subledger.plans import marts
from subledger.plans.monthly import MonthlyMrr

from conftest import files, rows

SCHEMA = "customer_id string, revenue_month date, plan string, mrr_usd decimal(10,2)"
START = dt.date(2023, 11, 1)


def month(i):
    return dt.date(START.year + (START.month - 1 + i) // 12, (START.month - 1 + i) % 12 + 1, 1)


records = st.lists(
    st.tuples(st.sampled_from("abcd"), st.integers(0, 4), st.sampled_from([1, 28, 30]), st.sampled_from("xy"),
              st.sampled_from(["0.00", "5.00", "9.99", "20.00", None])), min_size=1, max_size=25)


def frame(spark, recs):
    def day(m, d):
        return m.replace(day=28 if m.month == 2 and d > 28 else d)

    return spark.createDataFrame(
        [(c, day(month(i), d), p, None if v is None else Decimal(v)) for c, i, d, p, v in recs], SCHEMA)


def part(recs, i):
    return [r for r in recs if r[1] == i]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(recs=records)
def test_months_one_by_one_equal_the_whole(spark, recs):
    mart = MonthlyMrr(spark, tempfile.mkdtemp(prefix="subledger-test-", dir="/tmp"))
    for i in sorted({r[1] for r in recs}):
        mart.append(frame(spark, part(recs, i)))
    want = rows(marts.mart_mrr(frame(spark, recs)))
    got = mart.read()
    assert (rows(got) if got is not None else []) == want


RECS = [("a", 0, 1, "x", "10.00"), ("a", 1, 1, "x", "15.00"), ("b", 0, 1, "y", "5.00"), ("b", 2, 1, "y", "5.00"),
        ("c", 1, 1, "x", "7.00"), ("c", 2, 1, "y", "9.00"), ("a", 2, 1, "x", "3.00"), ("d", 3, 1, "x", "1.00"),
        ("c", 3, 1, "y", "30.00")]


@pytest.fixture
def built(spark, scratch):
    mart = MonthlyMrr(spark, scratch)
    mart.start(frame(spark, [r for r in RECS if r[1] < 3]))
    return mart


def test_a_month_that_is_appended_again_changes_nothing(spark, built, scratch):
    assert built.append(frame(spark, part(RECS, 3))) == month(3)
    want = rows(marts.mart_mrr(frame(spark, RECS)))
    assert rows(built.read()) == want
    before = files(f"{scratch}/mart_mrr")
    built.append(frame(spark, part(RECS, 3)))
    assert rows(built.read()) == want
    after = files(f"{scratch}/mart_mrr")  # the months before were not written
    assert [k for k in after if after[k] != before[k]] == [f"_month={month(3).isoformat()}"]


def test_an_append_that_broke_off_is_run_again(spark, built, monkeypatch):
    replace = type(built.known).replace

    def failing(self, *a, **k):
        if self is built.known:
            raise RuntimeError("lost")
        return replace(self, *a, **k)

    monkeypatch.setattr(type(built.known), "replace", failing)
    with pytest.raises(RuntimeError):
        built.append(frame(spark, part(RECS, 3)))
    monkeypatch.setattr(type(built.known), "replace", replace)
    built.append(frame(spark, part(RECS, 3)))
    assert rows(built.read()) == rows(marts.mart_mrr(frame(spark, RECS)))


def test_months_in_order_only(spark, built):
    with pytest.raises(ValueError, match="before"):
        built.append(frame(spark, part(RECS, 1)))
    with pytest.raises(ValueError, match="more than one"):
        built.append(frame(spark, RECS))
    assert built.append(frame(spark, [("z", 7, 1, "x", None)])) is None


def test_a_corrected_month_and_those_after_it(spark, built):
    """Customers come, go and change their first month in a month that is corrected."""
    built.append(frame(spark, part(RECS, 3)))
    fixed = [("b", 1, 1, "y", "6.00"), ("d", 1, 1, "x", "2.00"), ("a", 1, 1, "x", "1.00")]
    assert built.append_from(frame(spark, fixed)) == [month(i) for i in (1, 2, 3)]
    assert rows(built.read()) == rows(marts.mart_mrr(frame(spark, [r for r in RECS if r[1] != 1] + fixed)))


def test_months_that_lose_all_their_rows(spark, built):
    built.append(frame(spark, part(RECS, 3)))
    assert built.rewrite(frame(spark, [("c", 2, 1, "y", "2.00")]), [month(1), month(2)]) == [month(i) for i in (1, 2, 3)]
    left = [r for r in RECS if r[1] not in (1, 2)] + [("c", 2, 1, "y", "2.00")]
    assert rows(built.read()) == rows(marts.mart_mrr(frame(spark, left)))


def test_the_month_before_is_pruned_to(spark, built):
    from pyspark.sql import functions as F

    before = built._rows(built.histogram, F.col("_month") == month(2))
    plan = before._jdf.queryExecution().executedPlan().toString()
    assert "_month#" in plan.split("PartitionFilters: [")[1].split("]")[0]
