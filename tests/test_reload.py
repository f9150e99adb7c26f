"""A corrected load taken through silver, quarantine and gold by its change set."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from subledger.operators.changes import changed_keys, rows_of
from subledger.operators.upsert import keyed_upsert
from subledger.params import RunParams
from subledger.plans import marts, pipeline
from subledger.plans.quarantine import quarantine_transactions
from subledger.plans.silver import stg_transactions
from subledger.sources.bronze import Bronze
from subledger.sources.fixtures import fixture_bronze

from conftest import SF001, files, rows

P1 = RunParams(dt.date(2001, 6, 30), dt.datetime(2001, 6, 30, 6))
P2 = RunParams(dt.date(2001, 6, 30), dt.datetime(2001, 7, 1, 6))


def test_changed_keys(spark):
    df = lambda recs: spark.createDataFrame(recs, "k string, x string, y int")
    old = df([("a", "1", 1), ("b", "1", 1), ("b", "1", 1), ("c", None, 1), ("d", "1", None), (None, "1", 1), ("e", "1", 1), ("s", "1", 2)])
    new = df([("a", "1", 1), ("b", "1", 1), ("c", "", 1), ("d", None, None), (None, "2", 1), ("f", "1", 1), ("s", "1", 2)])
    # b: one copy fewer; c, d: null is no value; e went, f came
    assert rows(changed_keys(old, new, "k")) == sorted([("b",), ("c",), ("d",), ("e",), ("f",), (None,)], key=repr)
    assert rows(changed_keys(old, old, "k")) == []
    assert rows(rows_of(old, spark.createDataFrame([(None,), ("a",)], "k string"), "k"), "k") == [("a",), (None,)]


@pytest.fixture(scope="module")
def load(spark):
    return fixture_bronze(spark, SF001).transactions.cache()


def bronze(tx):
    return Bronze(None, None, tx, None)


def repaired(load, where):
    return load.withColumn("amount", F.when(F.expr(where), F.lit("12.34")).otherwise(F.col("amount")))


CASES = {
    "repaired in one quarter": lambda t: repaired(t, "transaction_date >= '1995-04-01' and transaction_date < '1995-07-01'"),
    "a month that empties": lambda t: t.where("not transaction_date like '1996-02-%'"),
    "moved to another month": lambda t: t.withColumn("transaction_date", F.when(
        F.col("transaction_date").like("1994-03-%"), F.lit("1997-11-05")).otherwise(F.col("transaction_date"))),
    "a copy that wins now, and null ids": lambda t: t.unionByName(t.where("row_seq % 40 = 2").withColumns({
        "transaction_date": F.lit("1992-01-01"), "row_seq": F.col("row_seq") + 1_000_000, "amount": F.lit("7")})).unionByName(
        t.where("row_seq % 400 = 4").withColumn("transaction_id", F.lit(None).cast("string"))),
    "nothing": lambda t: t,
    "everything": lambda t: t.withColumn("channel", F.lit("other")),
}


@pytest.mark.parametrize("case", CASES)
def test_equal_to_a_rebuild(spark, scratch, load, case):
    new = CASES[case](load)
    pipeline.build_transactions(spark, scratch, load, P1)
    paths = {n: p for n, p in pipeline.publish.current(spark, scratch).items() if n in pipeline.BY_MONTH}
    before = {n: files(p) for n, p in paths.items()}
    months = pipeline.reload_transactions(spark, scratch, load, new, P2)
    silver = stg_transactions(bronze(new), P2)
    assert rows(pipeline.read_table(spark, scratch, "stg_transactions")) == rows(silver)
    assert rows(pipeline.read_table(spark, scratch, "mart_transactions")) == rows(marts.mart_transactions(silver))
    for n, p in paths.items():
        for folder, names in files(p).items():
            touched = folder.removeprefix("_month=") in {m.isoformat() for m in months}
            assert touched == (names != before[n].get(folder)), (n, folder)
    if case == "repaired in one quarter":
        assert months == [dt.date(1995, m, 1) for m in (4, 5, 6)]
    if case == "nothing":
        assert months == []
    # quarantine: changed rows replace theirs, repaired ones stay as history
    v1 = quarantine_transactions(bronze(load), P1)
    keys = changed_keys(load, new, "transaction_id").withColumnRenamed("transaction_id", "row_id")
    batch = rows_of(quarantine_transactions(bronze(new), P2), keys, "row_id")
    assert rows(pipeline.read_table(spark, scratch, "quarantine_transactions")) == rows(keyed_upsert(v1, batch, "row_id"))


def test_other_months_are_not_read(spark, scratch, load):
    pipeline.build_transactions(spark, scratch, load, P1)
    table = pipeline.by_month(spark, pipeline.publish.current(spark, scratch)["stg_transactions"])
    months = [dt.date(1995, 4, 1), dt.date(1995, 5, 1)]
    some = table.read(months)
    assert {f.rsplit("/", 2)[1] for f in some.inputFiles()} >= {"_month=1995-04-01"}
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "_month#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert rows(some.select(F.trunc("transaction_date", "MM").alias("m")).distinct()) == [(m,) for m in months]


def test_a_reload_that_broke_off_is_run_again(spark, scratch, load, monkeypatch):
    new = CASES["repaired in one quarter"](load)
    pipeline.build_transactions(spark, scratch, load, P1)
    calls = []
    replace = pipeline.PartitionedTable.replace

    def failing(self, *a):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return replace(self, *a)

    monkeypatch.setattr(pipeline.PartitionedTable, "replace", failing)
    with pytest.raises(RuntimeError):
        pipeline.reload_transactions(spark, scratch, load, new, P2)
    pipeline.reload_transactions(spark, scratch, load, new, P2)
    want = rows(pipeline.read_table(spark, scratch, "quarantine_transactions"))
    pipeline.reload_transactions(spark, scratch, load, new, P2)
    silver = stg_transactions(bronze(new), P2)
    assert rows(pipeline.read_table(spark, scratch, "mart_transactions")) == rows(marts.mart_transactions(silver))
    assert rows(pipeline.read_table(spark, scratch, "quarantine_transactions")) == want
