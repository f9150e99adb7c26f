"""Keyed upsert (MERGE semantics), schema evolution, gate, versioned table."""

import datetime as dt

from pyspark.sql import functions as F

from subledger.operators import publish
from subledger.operators.partitions import PartitionedTable
from subledger.operators.upsert import KeyedTable, incremental_gate, keyed_upsert

from conftest import files, rows

TS1 = dt.datetime(2024, 1, 1, 6)
TS2 = dt.datetime(2024, 1, 2, 6)


def _q(spark, recs, extra=False):
    schema = "row_id string, issue_type string, flagged_at timestamp_ntz"
    if extra:
        schema += ", raw_fee_usd string"
    return spark.createDataFrame(recs, schema)


def test_upsert_replaces_matches_appends_null_keys(spark):
    target = _q(spark, [("A", "old", TS1), ("B", "old", TS1), (None, "old", TS1)])
    batch = _q(spark, [("B", "new", TS2), ("C", "new", TS2), (None, "new", TS2)])
    got = rows(keyed_upsert(target, batch, "row_id"), "row_id", "issue_type")
    assert got == sorted([("A", "old"), ("B", "new"), ("C", "new"), (None, "old"), (None, "new")], key=repr)


def test_upsert_without_target_is_the_batch(spark):
    batch = _q(spark, [("A", "new", TS2)])
    assert rows(keyed_upsert(None, batch, "row_id")) == rows(batch)


def test_upsert_appends_new_columns_at_the_end(spark):
    target = _q(spark, [("A", "old", TS1)])
    batch = _q(spark, [("B", "new", TS2, "0.12")], extra=True)
    out = keyed_upsert(target, batch, "row_id")
    assert out.columns == ["row_id", "issue_type", "flagged_at", "raw_fee_usd"]
    assert rows(out, "row_id", "raw_fee_usd") == [("A", None), ("B", "0.12")]


def test_gate_is_a_scalar_subquery(spark):
    target = _q(spark, [("A", "old", TS1), ("B", "old", TS2)])
    after = incremental_gate(F.lit(dt.datetime(2024, 1, 3)).cast("timestamp_ntz"), target)
    same = incremental_gate(F.lit(TS2).cast("timestamp_ntz"), target)
    empty = incremental_gate(F.lit(TS2).cast("timestamp_ntz"), target.where("false"))
    r = spark.range(1).select(after.alias("a"), same.alias("s"), empty.alias("e")).first()
    assert (r.a, r.s, r.e) == (True, False, None)
    assert incremental_gate(F.lit(TS2), None) is None


def test_publishing_moves_all_tables_at_once(spark, scratch):
    one, two = f"{scratch}/a/1", f"{scratch}/a/2"
    _q(spark, [("A", "old", TS1)]).write.parquet(one)
    _q(spark, [("A", "new", TS2), ("B", "new", TS2)]).write.parquet(two)
    assert publish.current(spark, scratch) == {}
    assert publish.publish(spark, scratch, {"a": one, "b": one}) == 1
    assert publish.publish(spark, scratch, {"a": two}) == 2
    assert publish.current(spark, scratch) == {"a": two, "b": one}
    assert rows(publish.published(spark, scratch, "a"), "row_id", "issue_type") == [("A", "new"), ("B", "new")]


def test_dq_reports_apply_severity(spark):
    from subledger.operators.quality import not_null_report, unique_report

    cust = spark.createDataFrame(
        [("A", None, "web"), ("A", dt.date(2024, 1, 1), None), (None, dt.date(2024, 1, 2), "web")],
        "customer_id string, signup_date date, acquisition_channel string")
    rep = {(r.column_name, r.test_name): (r.failures, r.status)
           for r in not_null_report({"stg_customers": cust}).unionByName(
               unique_report({"stg_customers": cust})).collect()}
    assert rep[("signup_date", "not_null")] == (1, "warn")         # severity warn
    assert rep[("acquisition_channel", "not_null")] == (1, "fail")
    assert rep[("customer_id", "not_null")] == (1, "fail")
    assert rep[("customer_id", "unique")] == (1, "fail")            # 'A' twice; nulls ignored


def test_an_upsert_rewrites_only_the_buckets_it_touches(spark, scratch):
    table = KeyedTable(spark, f"{scratch}/q", "row_id", buckets=16)
    assert table.read() is None
    recs = [(f"K{i}", "old", TS1) for i in range(200)] + [(None, "old", TS1)]
    table.upsert(_q(spark, recs))
    first = files(f"{scratch}/q")
    assert len(first) == 16
    table.upsert(_q(spark, [("K7", "new", TS2, "0.12"), (None, "new", TS2, None)], extra=True), tag="x-1")
    moved = [b for b, v in files(f"{scratch}/q").items() if v != first[b]]
    assert 1 <= len(moved) <= 2
    got = table.read()
    assert got.columns == ["row_id", "issue_type", "flagged_at", "raw_fee_usd"]
    want = [(f"K{i}", "new" if i == 7 else "old") for i in range(200)] + [(None, "old"), (None, "new")]
    assert rows(got, "row_id", "issue_type") == sorted(want, key=repr)
    assert rows(got.where("row_id = 'K7'"), "raw_fee_usd") == [("0.12",)]
    table.upsert(_q(spark, []).limit(0))
    assert rows(table.read(), "row_id", "issue_type") == sorted(want, key=repr)


def test_an_upsert_that_is_repeated_changes_nothing(spark, scratch):
    table = KeyedTable(spark, f"{scratch}/q", "row_id", buckets=4)
    table.upsert(_q(spark, [("A", "old", TS1), ("B", "old", TS1), (None, "old", TS1)]), tag="1")
    batch = _q(spark, [("B", "new", TS2), ("C", "new", TS2), (None, "new", TS2), (None, "new", TS2)])
    table.upsert(batch, tag="2")
    want = rows(table.read())
    # an upsert that broke off has replaced some buckets: run again, it replaces all
    for part in ("row_id = 'B'", "row_id IS NULL", "true"):
        table.upsert(batch.where(part), tag="2")
        table.upsert(batch, tag="2")
        assert rows(table.read()) == want
    assert rows(table.read(without="2"), "row_id", "issue_type") == [("A", "old"), (None, "old")]
    table.upsert(batch, tag="3")  # another batch: null keys are appended again, as MERGE does
    assert table.read().where("row_id IS NULL").count() == 5


def test_keys_that_are_gone_leave_first(spark, scratch):
    table = KeyedTable(spark, f"{scratch}/q", "row_id", buckets=4)
    table.upsert(_q(spark, [(k, "old", TS1) for k in "ABCD"]))
    gone = spark.createDataFrame([("A",), ("B",), ("Z",)], "k string")
    table.upsert(_q(spark, [("B", "new", TS2)]), gone=gone)
    assert rows(table.read(), "row_id", "issue_type") == [("B", "new"), ("C", "old"), ("D", "old")]
    table.upsert(_q(spark, []), gone=spark.createDataFrame([(k,) for k in "BCD"], "k string"))
    assert rows(table.read()) == [] and table.read().columns == ["row_id", "issue_type", "flagged_at"]


def test_partitions_are_replaced_and_emptied(spark, scratch):
    table = PartitionedTable(spark, f"{scratch}/t", "_p")
    df = lambda recs: spark.createDataFrame(recs, "_p date, x string, y int")
    days = [dt.date(2024, 1, i) for i in (1, 2, 3)]
    assert table.read() is None
    table.replace(df([(d, "a", i) for i, d in enumerate(days)] + [(days[0], None, None)]))
    first = files(f"{scratch}/t")
    table.replace(df([(days[1], "b", 7)]), [days[1], days[2]])
    second = files(f"{scratch}/t")
    assert first["_p=2024-01-01"] == second["_p=2024-01-01"] and first["_p=2024-01-02"] != second["_p=2024-01-02"]
    assert rows(table.read()) == [("a", 0), ("b", 7), (None, None)] and table.read().columns == ["x", "y"]
    assert rows(table.read([days[2]])) == []
    table.replace(table.rows([days[0]]).withColumn("x", F.lit("self")))  # rows read from the table itself
    assert rows(table.read([days[0]])) == [("self", 0), ("self", None)]
    plan = table.rows([days[0]])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan or "PartitionFilters: [(_p" in plan or "_p#" in plan.split("PartitionFilters")[1][:80]


def test_dropped_duplicates_needs_an_arrival_order(spark):
    import pytest

    from subledger.operators.dedup import dropped_duplicates

    df = spark.createDataFrame([("A", "2", 1), ("A", "1", 2), ("A", "1", 3), ("B", "1", 4), (None, "1", 5), (None, "1", 6)],
                               "k string, d string, row_seq long")
    assert rows(dropped_duplicates(df, "k", "d"), "k", "row_seq") == [("A", 1), ("A", 3)]
    with pytest.raises(ValueError):
        dropped_duplicates(df.drop("row_seq"), "k", "d")
    with pytest.raises(Exception, match="row_seq is null"):
        dropped_duplicates(df.withColumn("row_seq", F.lit(None).cast("long")), "k", "d").collect()
