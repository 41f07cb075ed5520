"""Readers and writers of the row files (CSV with header, all text; JSON) around the pipeline."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FEED_COLUMNS = ("feed_id", "feed_url", "source_type", "author")
ITEM_COLUMNS = ("item_id", "published_at", "source_type", "source_url", "author", "text")
FAULTY = "_faulty_row"
STATUS_SCHEMA = "feed_count bigint, successful_feed_count bigint, failed_feed_count bigint, item_count bigint, feeds array<struct<feed_id:string,feed_url:string,ok:boolean,item_count:bigint,error:string>>"


def read_rows(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of a CSV file as text; blank and missing cells are ''. The header names the columns, quotes may hold line ends."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("inferSchema", False)
    df = reader.csv(path)
    df = df.select([F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])
    return df.withColumns({c: F.lit("") for c in columns if c not in df.columns}).select(*columns) if columns else df


def checked_rows(spark: SparkSession, path: str, columns: Sequence[str], header: bool = True) -> tuple[DataFrame, DataFrame]:
    """Rows of CSV files with just these cells, as ``read_rows`` gives them, and all others as (file, line).

    With a header its names must be ``columns``, in order. A row with too many or too few cells, or that is no CSV, is
    quarantined with its text as it stands, and the rows beside it stay. A single empty cell may be blank text.
    """
    cells = ", ".join(f"`{c}` string" for c in (*columns, FAULTY))
    reader = spark.read.schema(cells).option("header", header).option("enforceSchema", False).option("multiLine", True).option("escape", '"')
    raw = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", FAULTY).csv(path)
    cell = F.col(f"`{columns[0]}`")
    raw = raw.where(cell.isNull() | (F.length(cell) >= 0))  # Spark reads no rows for the fault alone: this asks for a cell, and decides nothing
    good = raw.where(F.col(FAULTY).isNull()).select([F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns])
    return good, raw.where(F.col(FAULTY).isNotNull()).select(F.col("_metadata.file_path").alias("file"), F.col(FAULTY).alias("line"))


def read_feeds(spark: SparkSession, path: str) -> DataFrame:
    return read_rows(spark, path, FEED_COLUMNS)


def read_items(spark: SparkSession, path: str) -> DataFrame:
    return read_rows(spark, path, ITEM_COLUMNS)


def named_payloads(files: DataFrame) -> DataFrame:
    """(feed_id, payload, content) of binary files: the file's name without its ending is the feed, its path the payload."""
    name = F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1)
    return files.select(name.alias("feed_id"), F.col("path").alias("payload"), "content")


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed payload files, see ``named_payloads``."""
    return named_payloads(spark.read.format("binaryFile").load(path))


def read_status(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATUS_SCHEMA).option("multiLine", True).json(path)


def publish(df: DataFrame, path: str, write: Callable[[DataFrame, str], None]) -> None:
    """Puts what ``write(df, folder)`` writes in place of ``path``: all of it, or nothing.

    Everything is written to a folder beside it first. Only when all tasks have ended is that folder renamed into place,
    so a job that fails, or is killed, leaves what was published before; until then readers see that. What a task of a
    lost executor had begun is in neither.
    """
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    system = target.getFileSystem(conf)
    new, old = (jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{target.getName()}-{kind}-{uuid.uuid4().hex}") for kind in ("new", "old"))
    try:
        write(df, new.toString())
        had = system.exists(target)
        if had and not system.rename(target, old):
            raise OSError(f"{path} can't be moved")
        if not system.rename(new, target):
            if had:
                system.rename(old, target)
            raise OSError(f"{path} can't be put in place")
    finally:
        system.delete(new, True)
    system.delete(old, True)


def write_rows(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """CSV in a fixed column order; missing columns and nulls are ''. Published as a whole; the parts keep the order of ``df``."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns]
    publish(df.select(cells), path, lambda rows, to: rows.write.option("header", True).option("escape", '"').option("emptyValue", "").csv(to))


def write_weekly(df: DataFrame, path: str, week: str = "period_start") -> None:
    """Parquet, one folder for each week, published as a whole."""
    publish(df, path, lambda rows, to: rows.write.partitionBy(week).parquet(to))


def write_json_rows(df: DataFrame, path: str, value: str) -> None:
    """One line of text for each row: canonical contracts, locks, manifests. Published as a whole, in the order of ``df``."""
    publish(df.select(F.col(value).alias("value")), path, lambda rows, to: rows.write.text(to))


def write_status(statuses: DataFrame, path: str) -> None:
    """Fetch statuses with their totals as one JSON row. One row for each configured feed: a small list."""
    from factmill.operators.quality import feed_rollup

    feeds = statuses.agg(F.array_sort(F.collect_list(F.struct("feed_id", "feed_url", "ok", "item_count", "error"))).alias("feeds"))
    publish(feed_rollup(statuses).crossJoin(feeds), path, lambda rows, to: rows.write.json(to))
