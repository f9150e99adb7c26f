"""Bronze (raw, all-text) relations: schemas, CSV bulk load, parquet read.

Every bronze column is text; typing happens in silver with safe casts. Each
table carries one helper column, ``row_seq`` (bigint arrival order), used only
to make the keep-first dedup a total order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger.operators.materialise import BROADCAST_ROWS, materialised

# Bronze column lists, as the raw CSV files carry them.
BRONZE_COLUMNS: dict[str, tuple[str, ...]] = {
    "customers": (
        "customer_id", "signup_date", "full_name", "email", "country",
        "company_size", "acquisition_channel", "cac_usd", "industry",
    ),
    "subscriptions": (
        "subscription_id", "customer_id", "plan", "mrr_usd", "start_date",
        "end_date", "status", "is_upgraded", "upgrade_plan", "upgrade_date",
        "upgrade_mrr_usd", "billing_cycle",
    ),
    "transactions": (
        "transaction_id", "customer_id", "transaction_date", "amount",
        "currency", "payment_method", "status", "fee_usd", "channel",
        "country", "description",
    ),
    "monthly_revenue": (
        "revenue_id", "subscription_id", "customer_id", "month", "mrr_usd",
        "plan", "billing_cycle",
    ),
}
ROW_SEQ = "row_seq"
TABLES = tuple(BRONZE_COLUMNS)


def text_schema(table: str, with_row_seq: bool = False) -> T.StructType:
    fields = [T.StructField(c, T.StringType(), True) for c in BRONZE_COLUMNS[table]]
    if with_row_seq:
        fields.append(T.StructField(ROW_SEQ, T.LongType(), True))
    return T.StructType(fields)


@dataclass(frozen=True)
class Bronze:
    customers: DataFrame
    subscriptions: DataFrame
    transactions: DataFrame
    monthly_revenue: DataFrame

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def replace(self, **tables: DataFrame) -> "Bronze":
        cur = {t: self.table(t) for t in TABLES}
        cur.update(tables)
        return Bronze(**cur)


class LazyBronze:
    """A ``Bronze`` whose tables are built when they are first asked for."""

    def __init__(self, **tables: Callable[[], DataFrame]):
        self._make = tables
        self._made: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._make[name]()
        return self._made[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._make:
            raise AttributeError(name)
        return self.table(name)

    def replace(self, **tables: DataFrame) -> "LazyBronze":
        given = {t: (lambda df=df: df) for t, df in tables.items()}
        return LazyBronze(**{**{t: (lambda t=t: self.table(t)) for t in self._make}, **given})


#: Text of a line that does not parse as the table's columns.
CORRUPT = "_corrupt_record"


#: RFC 4180: fields may be quoted, a quote inside doubled.
_CSV = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Raw CSV with header, every column text (no inference); empty field -> null.

    A line with too few or too many fields keeps what it has and its text in
    ``_corrupt_record``.
    """
    schema = text_schema(table).add(CORRUPT, T.StringType(), True)
    return spark.read.schema(schema).options(header=True, enforceSchema=False, **_CSV).csv(path)


def _ranked(staged: DataFrame, **more: Column) -> DataFrame:
    """(_file, _block, _rank and ``more``): one row per input split, ranked by file and place in it."""
    blocks = staged.groupBy("_file", "_block").agg(*[c.alias(n) for n, c in more.items()] or [F.lit(1).alias("_one")])
    return blocks.withColumn("_rank", F.row_number().over(Window.orderBy("_file", "_block")) - 1)


def _side(df: DataFrame, label: str) -> DataFrame:
    df = materialised(df, label)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _with_places(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_place"),
    )


def read_csv_records(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Raw CSV whose quoted fields may hold line breaks, split among tasks like any text.

    A line break ends a record where an even number of quotes lies before it in the
    file. Lines are read by splits and keep their file, split and place. Per split, the parity of its
    quotes and the place where its last record begins are found; a running sum over the
    splits of a file (one row each) says in which state a split begins and to which
    record its first lines belong. Within a split both follow from a window in its
    order. Records of one line, nearly all as a rule, are parsed where they are; the lines of
    longer ones are gathered per record, which has to fit in a row. Spark's own parser
    (``from_csv``) then takes the records.

    Adds ``_file``, ``_block``, ``_rank`` (of the split) and ``_place`` (of the record's first line) to the columns
    of ``read_csv``. Headers are checked and left out, blank lines too. As by RFC 4180, a quote
    inside an unquoted field is not allowed: it would shift the records behind it.
    """
    lines = _with_places(spark.read.option("lineSep", "\n").text(path))
    odd = (F.length("value") - F.length(F.translate("value", '"', ""))) % 2
    staged = materialised(lines.withColumn("_odd", odd), f"csv-{table}")

    # within a split: quotes before a line, and whether it begins a record in either state of the split's begin
    inside = Window.partitionBy("_file", "_block").orderBy("_place")
    before = F.coalesce(F.sum("_odd").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    counted = materialised(staged.withColumn("_before", before), f"csv-{table}")
    splits = _ranked(
        counted, _quotes=F.sum("_odd") % 2, _first=F.min("_place"),
        _last0=F.max(F.when(F.col("_before") == 0, F.col("_place"))),
        _last1=F.max(F.when(F.col("_before") == 1, F.col("_place"))),
    )
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_state", F.coalesce(F.sum("_quotes").over(earlier), F.lit(0)) % 2)
    last = F.when(F.col("_state") == 0, F.col("_last0")).otherwise(F.col("_last1"))
    begun = F.when(last.isNotNull(), F.struct(
        "_block", "_rank", last.alias("_place"), ((F.col("_block") == 0) & (last == F.col("_first"))).alias("_head")))
    splits = splits.withColumn("_begun", F.last(begun, ignorenulls=True).over(earlier))

    rows = counted.join(_side(splits.select("_file", "_block", "_rank", "_first", "_state", "_begun"), "csv-splits"), ["_file", "_block"])
    starts = F.col("_before") == F.col("_state")
    head = (F.col("_block") == 0) & (F.col("_place") == F.col("_first"))
    own = F.when(starts, F.struct("_block", "_rank", "_place", head.alias("_head")))
    in_order = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = materialised(rows.select(
        "_file", "_block", "_place", "value", F.coalesce(F.last(own, ignorenulls=True).over(in_order), "_begun").alias("_record"),
        (starts & (F.col("_odd") == 0)).alias("_single"),
    ), f"csv-{table}")
    line = F.struct("_block", "_place", "value")
    long = rows.where("not _single").groupBy("_file", "_record").agg(F.array_sort(F.collect_list(line)).alias("_lines")).select(
        "_file", "_record", F.array_join(F.col("_lines.value"), "\n").alias("value"))
    records = rows.where("_single").select("_file", "_record", "value").unionByName(long)
    records = records.withColumn("value", F.regexp_replace("value", "\r$", ""))

    schema = text_schema(table).add(CORRUPT, T.StringType(), True)
    parsed = records.withColumn("_row", F.from_csv("value", schema.simpleString()[7:-1].replace(":", " "), {**_CSV, "multiLine": "true"}))
    is_header = F.col("_record._head")
    names = parsed.where(is_header).select(F.array(*[F.col(f"_row.{c}") for c in BRONZE_COLUMNS[table]]).alias("names")).distinct()
    wrong = [r.names for r in names.limit(2).collect() if tuple(r.names) != BRONZE_COLUMNS[table]]
    if wrong:
        raise ValueError(f"header of {table}: {wrong[0]}")
    return parsed.where(~is_header & (F.trim("value") != "")).select("_row.*", "_file", "_record.*")


def load_csv(spark: SparkSession, csv_path: str, table: str, out_root: str, multi_line: bool = False) -> DataFrame:
    """Bulk load: raw CSV -> a bronze table (rewritten as a whole), then read back.

    ``row_seq`` orders the rows by file name, then by place in the file, however
    the files were split among tasks: a first write keeps file, block and position
    in the task; the blocks, one row per input split, are then ranked. ``multi_line``
    lets quoted fields hold line breaks.
    """
    if multi_line:
        out = read_csv_records(spark, csv_path, table)
    else:
        staged = materialised(_with_places(read_csv(spark, csv_path, table)), f"csv-{table}")
        out = staged.join(_side(_ranked(staged).select("_file", "_block", "_rank"), "csv-blocks"), ["_file", "_block"])
    seq = F.shiftleft(F.col("_rank").cast("long"), 33).bitwiseOR(F.col("_place"))
    out = out.select(*BRONZE_COLUMNS[table], CORRUPT, seq.alias(ROW_SEQ))
    out.write.mode("overwrite").parquet(out_root)
    return spark.read.schema(out.schema).parquet(out_root)


def read_bronze(spark: SparkSession, root: str) -> Bronze:
    """Bronze tables previously written as parquet under ``root/<table>``."""
    return Bronze(**{t: spark.read.parquet(f"{root}/{t}") for t in TABLES})


def write_bronze(bronze: Bronze, root: str) -> None:
    for t in TABLES:
        bronze.table(t).write.mode("overwrite").parquet(f"{root}/{t}")
