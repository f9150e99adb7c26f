"""Data-quality checks: column tests (unique / not_null) and a bronze profile.

One aggregation pass per table computes every not_null count; each unique
test is a keyed aggregation (partial aggregation before the shuffle, so a key
repeated a billion times is one row per map task). Results are tiny report
DataFrames, one row per test, built without collecting anything.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ColumnTest:
    model: str
    column: str
    test: str  # "unique" | "not_null"
    severity: str = "error"  # "error" | "warn"


# The column tests declared on the silver and quarantine models.
SCHEMA_TESTS: tuple[ColumnTest, ...] = (
    ColumnTest("stg_customers", "customer_id", "unique"),
    ColumnTest("stg_customers", "customer_id", "not_null"),
    ColumnTest("stg_customers", "signup_date", "not_null", "warn"),
    ColumnTest("stg_customers", "acquisition_channel", "not_null"),
    ColumnTest("stg_subscriptions", "subscription_id", "unique"),
    ColumnTest("stg_subscriptions", "subscription_id", "not_null"),
    ColumnTest("stg_subscriptions", "customer_id", "not_null"),
    ColumnTest("stg_subscriptions", "plan", "not_null", "warn"),
    ColumnTest("stg_subscriptions", "status", "not_null"),
    ColumnTest("stg_transactions", "transaction_id", "unique"),
    ColumnTest("stg_transactions", "transaction_id", "not_null"),
    ColumnTest("stg_transactions", "status", "not_null"),
    ColumnTest("stg_monthly_revenue", "revenue_id", "unique"),
    ColumnTest("stg_monthly_revenue", "revenue_id", "not_null"),
    ColumnTest("stg_monthly_revenue", "customer_id", "not_null"),
    ColumnTest("stg_monthly_revenue", "mrr_usd", "not_null"),
    ColumnTest("quarantine_customers", "row_id", "not_null"),
    ColumnTest("quarantine_subscriptions", "row_id", "not_null"),
    ColumnTest("quarantine_transactions", "row_id", "not_null"),
)


def _status(failures: Column, severity: Column) -> Column:
    return (
        F.when(failures == 0, F.lit("pass"))
        .when(severity == "warn", F.lit("warn"))
        .otherwise(F.lit("fail"))
    )


def _report(df: DataFrame) -> DataFrame:
    return df.select(
        "model", "column_name", "test_name", "severity",
        F.col("failures").cast("long").alias("failures"),
        _status(F.col("failures"), F.col("severity")).alias("status"),
    )


def not_null_report(models: dict[str, DataFrame], tests=SCHEMA_TESTS) -> DataFrame:
    """One aggregate per model counting nulls of every tested column."""
    parts = []
    for model, df in models.items():
        mine = [t for t in tests if t.model == model and t.test == "not_null"]
        if not mine:
            continue
        counts = df.agg(*[F.count_if(F.col(t.column).isNull()).alias(f"c{i}") for i, t in enumerate(mine)])
        rows = F.array(*[
            F.struct(F.lit(t.column).alias("column_name"), F.lit(t.severity).alias("severity"),
                     F.col(f"c{i}").alias("failures"))
            for i, t in enumerate(mine)
        ])
        parts.append(
            counts.select(F.inline(rows))
            .select(F.lit(model).alias("model"), "column_name", F.lit("not_null").alias("test_name"),
                    "severity", "failures")
        )
    return _report(reduce(DataFrame.unionByName, parts))


class NullCounts:
    """Counts the nulls of a model's tested columns while the model is written.

    ``watch`` adds the counts to a frame (``DataFrame.observe``): the job that
    writes it delivers them, so no second scan is needed. A task that is run twice after
    a lost executor may be counted twice; zero stays zero.
    """

    def __init__(self, tests=SCHEMA_TESTS):
        self.tests = [t for t in tests if t.test == "not_null"]
        self.seen: dict[str, Observation] = {}

    def watch(self, model: str, df: DataFrame) -> DataFrame:
        mine = [t for t in self.tests if t.model == model]
        if not mine:
            return df
        self.seen[model] = Observation()
        return df.observe(self.seen[model], *[F.count_if(F.col(t.column).isNull()).alias(t.column) for t in mine])

    def report(self, spark: SparkSession) -> DataFrame:
        """The rows of ``not_null_report`` for the models that were written."""
        rows = [(t.model, t.column, t.test, t.severity, self.seen[t.model].get[t.column])
                for t in self.tests if t.model in self.seen]
        return _report(spark.createDataFrame(
            rows, "model string, column_name string, test_name string, severity string, failures long"))


def unique_report(models: dict[str, DataFrame], tests=SCHEMA_TESTS) -> DataFrame:
    """Failures = number of non-null values that occur more than once."""
    parts = []
    for t in tests:
        if t.test != "unique" or t.model not in models:
            continue
        dupes = (
            models[t.model].where(F.col(t.column).isNotNull())
            .groupBy(t.column).count().where(F.col("count") > 1)
        )
        parts.append(dupes.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(t.model).alias("model"), F.lit(t.column).alias("column_name"),
            F.lit("unique").alias("test_name"), F.lit(t.severity).alias("severity"), "failures",
        ))
    return _report(reduce(DataFrame.unionByName, parts))


def profile(df: DataFrame, table: str, checks: dict[str, Column | str]) -> DataFrame:
    """Long (table_name, check_name, failures) rows.

    A check is a Column *aggregate* (e.g. ``F.count_if(..)``), all of which run in
    one pass, or a column name: then its failures are the rows beyond the first of
    each non-null value, from one row per value (partial counts before the
    shuffle). Two distinct counts in one aggregate would expand every row instead.
    """
    plain = {n: c for n, c in checks.items() if not isinstance(c, str)}
    parts = []
    if plain:
        agg = df.agg(*[c.cast("long").alias(f"c{i}") for i, c in enumerate(plain.values())])
        rows = F.array(*[
            F.struct(F.lit(n).alias("check_name"), F.col(f"c{i}").alias("failures"))
            for i, n in enumerate(plain)
        ])
        parts.append(agg.select(F.inline(rows)))
    for name, key in checks.items():
        if isinstance(key, str):
            per_value = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
            beyond = F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long")
            parts.append(per_value.agg(beyond.alias("failures")).select(F.lit(name).alias("check_name"), "failures"))
    return reduce(DataFrame.unionByName, parts).select(F.lit(table).alias("table_name"), "check_name", "failures")
