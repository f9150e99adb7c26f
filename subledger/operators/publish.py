"""Publishing the tables of a build together.

A build writes its tables to folders of their own; a row per table in a small log
says which folder is current. The log is appended to once, after everything
is written and audited, so readers see the tables of one complete build or of the
one before it. Folders that the log no longer names can be removed by the
storage's life-cycle rules.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "published"
LOG_SCHEMA = "build long, table_name string, path string"


def log(spark: SparkSession, root: str) -> DataFrame:
    """build, table_name, path: one row per table and build that was published."""
    path = f"{root.rstrip('/')}/{LOG}"
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def current(spark: SparkSession, root: str) -> dict[str, str]:
    """Folder by table, of the newest build that published the table."""
    newest = log(spark, root).groupBy("table_name").agg(F.max_by("path", "build").alias("path"))
    return {r.table_name: r.path for r in newest.collect()}  # one row per table


def publish(spark: SparkSession, root: str, tables: dict[str, str]) -> int:
    """Make ``tables`` (name -> folder) current; returns the build's number."""
    build = (log(spark, root).agg(F.max("build")).first()[0] or 0) + 1
    rows = spark.createDataFrame([(build, n, p) for n, p in tables.items()], LOG_SCHEMA)
    rows.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/{LOG}")
    return build


def published(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(current(spark, root)[name])
