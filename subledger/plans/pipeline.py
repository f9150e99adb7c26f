"""Materialised build: bronze -> silver -> quarantine -> gold (+ DQ reports).

This is the production path at scale. The lazy ``Warehouse`` recomputes a
silver model inside every gold query that uses it; here each expensive step
runs once and is written:

1. each bronze table is deduplicated once and written to a work folder in the
   shared checkpoint folder (``spark.checkpoint.dir``): silver and quarantine both
   read it, so the dedup shuffle - the largest shuffle of the pipeline - is
   not repeated, and a lost executor never sends the job back to bronze;
2. silver tables are written, then the marts read them (column-pruned scans
   instead of re-running dedup and parsing per branch);
3. **write, audit, publish**: nulls of tested columns are counted by the jobs that
   write silver, keys are tested on what was written, and a failed test of severity
   ``error`` ends the build before gold is computed. All tables become current
   together, by one append to a small log; until then readers have the last build;
4. the incremental quarantine is a keyed upsert that rewrites the hash buckets
   its batch touches.

``reload`` takes corrected loads of bronze tables through silver, quarantine and gold
without a rebuild (see ``operators.changes``): of transactions and revenue only
months with changed rows are written, and those of the MRR mart after them; customers and
subscriptions take the rows of changed keys out and in again.

All time-dependent values come from ``RunParams``; re-running with the same
parameters over the same bronze rewrites identical tables. Everything that
was written on the way is deleted at the end.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.operators import publish
from subledger.operators.changes import changed_keys, rows_of
from subledger.operators.dedup import keep_first
from subledger.operators.materialise import materialised, work_folder
from subledger.operators.ordering import overlapping_files
from subledger.operators.partitions import VOID, PartitionedTable, dealt
from subledger.operators.quality import NullCounts, not_null_report, profile, unique_report
from subledger.operators.upsert import KeyedTable, incremental_gate
from subledger.params import RunParams
from subledger.plans import marts, quarantine, silver
from subledger.plans.monthly import MonthlyMrr
from subledger.sources.bronze import CORRUPT, TABLES, Bronze

SILVER = ("stg_customers", "stg_subscriptions", "stg_transactions", "stg_monthly_revenue")

#: Tables in folders per month, with the column that says the month.
BY_MONTH = {"stg_transactions": "transaction_month", "payment_cube": "transaction_month",
            "mart_transactions": "transaction_month", "stg_monthly_revenue": "revenue_month_start"}
_MONTH = "_month"

#: Order of the files of a mart: each is sorted, and none begins before the one in front of it has ended.
ORDER = {"mart_mrr": ("revenue_month", "plan"), "mart_cac_ltv": ("signup_date",),
         "mart_transactions": ("transaction_date", "transaction_id")}

#: Failures that do not stop a build: the marts leave rows without MRR out.
ACCEPTED = frozenset({("stg_monthly_revenue", "mrr_usd", "not_null")})


class AuditFailed(Exception):
    """A test of severity ``error`` failed on silver; nothing was published."""

    def __init__(self, failures: list[tuple[str, str, str, int]]):
        self.failures = failures
        super().__init__("; ".join(f"{m}.{c} {t}: {n}" for m, c, t, n in failures))


@dataclass
class BuildResult:
    tables: dict[str, str] = field(default_factory=dict)
    build: int = 0


def by_month(spark: SparkSession, path: str) -> PartitionedTable:
    return PartitionedTable(spark, path, _MONTH)


def _write(df: DataFrame, name: str, path: str) -> str:
    """``df`` in a new folder; a month's rows in a folder of their own where BY_MONTH says so."""
    if name in BY_MONTH:
        months = df.withColumn(_MONTH, F.col(BY_MONTH[name]))
        # a void row in a folder of its own: a table without rows has a schema too
        void = df.sparkSession.createDataFrame([(True,)], f"{VOID} boolean")
        months = months.withColumn(VOID, F.lit(False)).unionByName(void, allowMissingColumns=True)
        dealt(months, _MONTH, ORDER.get(name, ())).write.partitionBy(_MONTH).parquet(path)
    else:
        df.write.parquet(path)
    return path


def _read(spark: SparkSession, name: str, path: str) -> DataFrame:
    if name == "mart_mrr":
        return _mrr(spark, path).read()
    return by_month(spark, path).read() if name in BY_MONTH else spark.read.parquet(path)


def _mrr(spark: SparkSession, path: str) -> MonthlyMrr:
    return MonthlyMrr(spark, path)


def read_table(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    """A published table as its model defines it."""
    out_root = out_root.rstrip("/")
    if name == "quarantine_transactions":
        return flagged_transactions(spark, out_root).read()
    paths = publish.current(spark, out_root)
    table = _read(spark, name, paths[name])
    if name == "mart_transactions":
        # the figures of a method or channel follow from all months: joined here, from the cube
        cube = by_month(spark, paths["payment_cube"]).rows().drop(_MONTH)
        levels = marts.payment_levels(cube)
        return marts.with_global_contexts(table, levels, levels.count())
    return table


def flagged_transactions(spark: SparkSession, out_root: str) -> KeyedTable:
    return KeyedTable(spark, f"{out_root}/quarantine/quarantine_transactions", "row_id")


def _tag(params: RunParams) -> str:
    return params.run_ts.isoformat()


def _gate(flagged: KeyedTable, params: RunParams) -> Column | None:
    """The incremental condition against the rows of earlier runs: a run that is repeated sees the same."""
    return incremental_gate(quarantine.flagged_at(params), flagged.read(without=_tag(params)))


def malformed_lines(bronze: Bronze) -> DataFrame:
    """Per bronze table the lines that its raw file could not give all columns for."""
    parts = []
    for name in TABLES:
        table = bronze.table(name)
        bad = F.col(CORRUPT).isNotNull() if CORRUPT in table.columns else F.lit(False)
        parts.append(profile(table, name, {"malformed_lines": F.count_if(bad)}))
    return reduce(DataFrame.unionByName, parts)


def audit(report: DataFrame, accepted: frozenset = ACCEPTED) -> None:
    """Raise if a test of severity ``error`` on a silver model failed that is not ``accepted``."""
    bad = [(r.model, r.column_name, r.test_name, r.failures) for r in report.where("status = 'fail'").collect()]
    bad = [x for x in bad if x[0] in SILVER and x[:3] not in accepted]
    if bad:
        raise AuditFailed(bad)


def build(spark: SparkSession, bronze: Bronze, out_root: str, params: RunParams,
          accepted: frozenset = ACCEPTED) -> BuildResult:
    """Build every layer and publish it. ``accepted`` names tests that may fail.

    Tests of quarantine tables are reported, not enforced: gold does not read these.
    """
    out_root = out_root.rstrip("/")
    res = BuildResult()
    stamp = f"{params.run_ts:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    nulls = NullCounts()

    def write(layer: str, name: str, df: DataFrame) -> DataFrame:
        path = _write(nulls.watch(name, df), name, f"{out_root}/{layer}/{name}/{stamp}")
        res.tables[name] = path
        return _read(spark, name, path)

    with work_folder(spark):
        # 1. dedup once per table that feeds two models
        dedup = {t: materialised(silver.deduped(bronze, t), f"dedup-{t}")
                 for t in ("customers", "subscriptions", "transactions")}

        # 2. silver and the rebuilt quarantines
        s = {
            "stg_customers": write("silver", "stg_customers", silver.clean_customers(dedup["customers"])),
            "stg_subscriptions": write("silver", "stg_subscriptions", silver.clean_subscriptions(dedup["subscriptions"], params)),
            "stg_transactions": write("silver", "stg_transactions", silver.clean_transactions(dedup["transactions"], params)),
            "stg_monthly_revenue": write("silver", "stg_monthly_revenue", silver.stg_monthly_revenue(bronze, params)),
        }
        write("quarantine", "quarantine_customers", quarantine.quarantine_customers_from(dedup["customers"], params))
        write("quarantine", "quarantine_subscriptions",
              quarantine.quarantine_subscriptions_from(dedup["subscriptions"], params))

        # 3. audit: what the writes have counted, and the keys
        unique = materialised(unique_report(s), "unique")
        audit(nulls.report(spark).unionByName(unique), accepted)

        # 4. the incremental quarantine
        flagged = flagged_transactions(spark, out_root)
        batch = quarantine.quarantine_transactions_from(dedup["transactions"], params, _gate(flagged, params))
        flagged.upsert(batch, _tag(params))
        res.tables["quarantine_transactions"] = flagged.root
        rows = flagged.read()

        # 5. gold, from the written silver tables
        res.tables["mart_mrr"] = f"{out_root}/gold/mart_mrr/{stamp}"
        _mrr(spark, res.tables["mart_mrr"]).start(s["stg_monthly_revenue"])
        write("gold", "mart_cac_ltv", marts.mart_cac_ltv(s["stg_customers"], s["stg_subscriptions"], s["stg_monthly_revenue"]))
        write("gold", "payment_cube", marts.payment_cube(s["stg_transactions"]))
        cube = by_month(spark, res.tables["payment_cube"]).rows()
        write("gold", "mart_transactions", _month_mart(s["stg_transactions"], cube))

        # 6. reports, then everything becomes current at once
        last = not_null_report({"quarantine_transactions": batch.limit(0) if rows is None else rows})
        write("dq", "dq_not_null", nulls.report(spark).unionByName(last))
        write("dq", "dq_unique", unique)
        write("dq", "dq_malformed", malformed_lines(bronze))
        write("dq", "dq_file_order", file_order(spark, res.tables))
        res.build = publish.publish(spark, out_root, res.tables)
    return res


def file_order(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """table_name, overlapping_files: zero where the files of a mart follow its order."""
    rows = [(name, overlapping_files(_read(spark, name, paths[name]), list(keys))) for name, keys in ORDER.items()]
    return spark.createDataFrame(rows, "table_name string, overlapping_files long")


def _month_mart(tx: DataFrame, cube: DataFrame) -> DataFrame:
    levels = materialised(marts.payment_levels(cube), "payment-levels")
    return marts.with_month_context(tx, levels, levels.count())


def build_transactions(spark: SparkSession, out_root: str, load: DataFrame, params: RunParams) -> int:
    """Only the payments side of ``build``: silver transactions, cube, mart and quarantine."""
    out_root = out_root.rstrip("/")
    stamp = f"{params.run_ts:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    path = lambda layer, name: f"{out_root}/{layer}/{name}/{stamp}"
    with work_folder(spark):
        first = materialised(keep_first(load, *silver.DEDUP["transactions"]), "dedup-transactions")
        tables = {"stg_transactions": _write(
            silver.clean_transactions(first, params), "stg_transactions", path("silver", "stg_transactions"))}
        tx = _read(spark, "stg_transactions", tables["stg_transactions"])
        tables["payment_cube"] = _write(marts.payment_cube(tx), "payment_cube", path("gold", "payment_cube"))
        cube = by_month(spark, tables["payment_cube"]).rows()
        tables["mart_transactions"] = _write(_month_mart(tx, cube), "mart_transactions", path("gold", "mart_transactions"))
        flagged = flagged_transactions(spark, out_root)
        flagged.upsert(quarantine.quarantine_transactions_from(first, params, _gate(flagged, params)), _tag(params))
        tables["quarantine_transactions"] = flagged.root
        return publish.publish(spark, out_root, tables)


def build_revenue(spark: SparkSession, out_root: str, load: DataFrame, params: RunParams) -> int:
    """Only silver monthly revenue and the MRR mart of ``build``."""
    out_root = out_root.rstrip("/")
    stamp = f"{params.run_ts:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    first = keep_first(load, *silver.DEDUP["monthly_revenue"])
    tables = {"stg_monthly_revenue": _write(
        silver.clean_monthly_revenue(first, params), "stg_monthly_revenue", f"{out_root}/silver/stg_monthly_revenue/{stamp}"),
        "mart_mrr": f"{out_root}/gold/mart_mrr/{stamp}"}
    _mrr(spark, tables["mart_mrr"]).start(_read(spark, "stg_monthly_revenue", tables["stg_monthly_revenue"]))
    return publish.publish(spark, out_root, tables)


def reload_transactions(spark: SparkSession, out_root: str, old: DataFrame, new: DataFrame, params: RunParams) -> list[dt.date]:
    """Take a corrected load of bronze transactions into the published tables.

    ``old`` is the load they were built from. Transactions whose rows differ are deduplicated and
    cleaned again; the months these rows were in, or are in now, are written anew in
    silver, in the cube and in the mart; other months are neither read nor written. Quarantine
    gets the changed rows by its keyed upsert, and old flags of repaired rows stay as
    history. Returns the months. A reload that broke off can be run again.
    """
    out_root = out_root.rstrip("/")
    key = "transaction_id"
    with work_folder(spark):
        keys = materialised(changed_keys(old, new, key), "changed-keys")

        def first_copies(load: DataFrame) -> DataFrame:
            return keep_first(rows_of(load, keys, key), *silver.DEDUP["transactions"])

        again = materialised(first_copies(new), "changed-rows")
        now = materialised(silver.clean_transactions(again, params), "changed-silver")
        before = silver.clean_transactions(first_copies(old), params)
        month = "transaction_month"
        months = sorted(r[0] for r in before.select(month).union(now.select(month)).distinct().collect())

        paths = publish.current(spark, out_root)
        tx, cube, mart = (by_month(spark, paths[n]) for n in ("stg_transactions", "payment_cube", "mart_transactions"))
        if months:
            kept = rows_of(tx.read(months), keys, key, "left_anti")
            tx.replace(kept.unionByName(now).withColumn(_MONTH, F.col(month)), months)
            touched = tx.read(months)
            cube.replace(marts.payment_cube(touched).withColumn(_MONTH, F.col(month)), months)
            again_mart = _month_mart(touched, cube.rows(months)).withColumn(_MONTH, F.col(month))
            mart.replace(again_mart, months, ORDER["mart_transactions"])

        flagged = flagged_transactions(spark, out_root)
        flagged.upsert(quarantine.quarantine_transactions_from(again, params, _gate(flagged, params)), _tag(params))
    return months


def reload_revenue(spark: SparkSession, out_root: str, old: DataFrame, new: DataFrame, params: RunParams) -> list[dt.date]:
    """The same for a corrected load of monthly revenue: silver and the MRR mart.

    Silver is written in the months of changed rows, the mart there and in the months
    after the first of them (a first month of a customer, a growth rate or a churn may have moved). Returns the
    months of the mart. ``reload`` brings the customer mart up to date as well.
    """
    out_root = out_root.rstrip("/")
    key, month = "revenue_id", BY_MONTH["stg_monthly_revenue"]
    with work_folder(spark):
        keys = materialised(changed_keys(old, new, key), "changed-keys")

        def cleaned(load: DataFrame) -> DataFrame:
            first = keep_first(rows_of(load, keys, key), *silver.DEDUP["monthly_revenue"])
            return silver.clean_monthly_revenue(first, params)

        now = materialised(cleaned(new), "changed-silver")
        months = sorted(r[0] for r in cleaned(old).select(month).union(now.select(month)).distinct().collect())
        if not months:
            return []
        paths = publish.current(spark, out_root)
        table = by_month(spark, paths["stg_monthly_revenue"])
        kept = rows_of(table.read(months), keys, key, "left_anti")
        table.replace(kept.unionByName(now).withColumn(_MONTH, F.col(month)), months)
        return _mrr(spark, paths["mart_mrr"]).rewrite(table.read(months), months)


def reload(spark: SparkSession, out_root: str, old: Bronze, new: Bronze, params: RunParams) -> dict[str, str]:
    """Take corrected loads of all four bronze tables into the published ones, without a rebuild.

    Transactions and revenue go by month. Of customers and subscriptions the rows
    of changed keys are cleaned again and exchanged in silver; their quarantines, as in the
    models, are rebuilt from the load. The customer mart follows from silver, not from bronze. What is
    written whole is published together at the end; returns its folders.
    """
    out_root = out_root.rstrip("/")
    reload_transactions(spark, out_root, old.table("transactions"), new.table("transactions"), params)
    months = reload_revenue(spark, out_root, old.table("monthly_revenue"), new.table("monthly_revenue"), params)
    stamp = f"{params.run_ts:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    tables: dict[str, str] = {}
    clean = {"customers": lambda raw: silver.clean_customers(raw),
             "subscriptions": lambda raw: silver.clean_subscriptions(raw, params)}
    flag = {"customers": quarantine.quarantine_customers_from, "subscriptions": quarantine.quarantine_subscriptions_from}
    with work_folder(spark):
        for name, cleaned in clean.items():
            key, order = silver.DEDUP[name]
            keys = materialised(changed_keys(old.table(name), new.table(name), key), "changed-keys")
            if keys.isEmpty():
                continue
            again = keep_first(rows_of(new.table(name), keys, key), key, order)
            kept = rows_of(read_table(spark, out_root, f"stg_{name}"), keys, key, "left_anti")
            tables[f"stg_{name}"] = _write(
                kept.unionByName(cleaned(again)), f"stg_{name}", f"{out_root}/silver/stg_{name}/{stamp}")
            tables[f"quarantine_{name}"] = _write(
                flag[name](keep_first(new.table(name), key, order), params), f"quarantine_{name}",
                f"{out_root}/quarantine/quarantine_{name}/{stamp}")
        if tables or months:
            s = {n: _read(spark, n, tables.get(n) or publish.current(spark, out_root)[n])
                 for n in ("stg_customers", "stg_subscriptions", "stg_monthly_revenue")}
            tables["mart_cac_ltv"] = _write(
                marts.mart_cac_ltv(s["stg_customers"], s["stg_subscriptions"], s["stg_monthly_revenue"]),
                "mart_cac_ltv", f"{out_root}/gold/mart_cac_ltv/{stamp}")
            publish.publish(spark, out_root, tables)
    return tables
