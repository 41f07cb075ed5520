"""Data quality: symbol and frequency summaries, feed status rollups, dataset inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factmill.functions.text import empty_as_null
from factmill.sources.blobs import streamed_digests
from factmill.sources.files import publish


def symbol_summary(events: DataFrame) -> DataFrame:
    """symbol_count and symbols (sorted): the distinct non-blank upper-case symbols. Partial sets are combined before they meet."""
    symbols = events.select(F.upper(F.btrim("symbol")).alias("s")).where("s <> ''").distinct()
    return symbols.agg(F.count(F.lit(1)).alias("symbol_count"), F.array_sort(F.collect_list("s")).alias("symbols"))


def frequencies(events: DataFrame, column: str) -> DataFrame:
    """(value, count) of a column; blank counts as ``unknown``."""
    value = F.coalesce(empty_as_null(F.btrim(column)), F.lit("unknown"))
    return events.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("count"))


def frequency_map(events: DataFrame, column: str) -> DataFrame:
    return frequencies(events, column).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("value", "count")))).alias("counts"))


def feed_rollup(statuses: DataFrame) -> DataFrame:
    """Totals of fetch statuses (ok, item_count) in one row."""
    return statuses.agg(
        F.count(F.lit(1)).alias("feed_count"), F.count_if(F.col("ok")).alias("successful_feed_count"), F.count_if(~F.col("ok")).alias("failed_feed_count"),
        F.coalesce(F.sum("item_count"), F.lit(0)).alias("item_count"),
    )


def success_ratio(rollup: DataFrame) -> DataFrame:
    """The rollup with feed_success_ratio, 4 decimals, null without feeds."""
    exact = F.try_divide(F.col("successful_feed_count").cast("double"), F.col("feed_count").cast("double"))
    return rollup.withColumn("feed_success_ratio", F.round(exact, 4))


def quality_summary(events: DataFrame, statuses: DataFrame | None = None) -> DataFrame:
    """One row: symbols, confidence and event type counts, and feed totals where statuses are given."""
    out = symbol_summary(events).crossJoin(frequency_map(events, "confidence").withColumnRenamed("counts", "confidence_counts"))  # one row each
    out = out.crossJoin(frequency_map(events, "event_type").withColumnRenamed("counts", "event_type_counts"))
    return out.crossJoin(success_ratio(feed_rollup(statuses))) if statuses is not None else out


def file_digests(spark: SparkSession, path: str, base: str | None = None) -> DataFrame:
    """path (below ``base``, if given), artifact (the file's name), bytes and sha256 of each file, of any size."""
    files = streamed_digests(spark, path, base)
    return files.select(F.col("name").alias("path"), F.element_at(F.split("name", "/"), -1).alias("artifact"), "bytes", F.col("digest").alias("sha256"))


def file_row_counts(rows: DataFrame, base: str | None = None) -> DataFrame:
    """(path, row_count) of the files that ``rows`` is read from; paths as in ``file_digests``. A file without rows has none."""
    path = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    path = F.regexp_replace(path, "^file:/+", "file:/")
    path = path if base is None else F.substring_index(path, f"{base.rstrip('/')}/", -1)
    return rows.groupBy(path.alias("path")).agg(F.count(F.lit(1)).alias("row_count"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(artifact, row_count) of named tables; an empty table counts 0."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("artifact"), "row_count") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def manifest_artifacts(digests: DataFrame, rows: DataFrame) -> DataFrame:
    """artifact, path, sha256 and row_count (null where ``rows`` has no such file) of each file, joined by path."""
    counts = rows.select(F.col("path").alias("r_path"), "row_count")
    return digests.join(counts, F.col("path") == F.col("r_path"), "left").select("artifact", "path", "sha256", "row_count")


def live_manifest(spark: SparkSession, path: str, rows: DataFrame, quality: DataFrame, base: str | None = None) -> DataFrame:
    """One JSON row: artifacts (path, sha256, row_count) in order of path, their number, and the quality summary.

    ``rows``: (path, row_count), see ``file_row_counts``. A manifest lists the files of one publication: a small list.
    """
    listed = manifest_artifacts(file_digests(spark, path, base), rows)
    listed = listed.agg(F.count(F.lit(1)).alias("artifact_count"), F.array_sort(F.collect_list(F.struct("path", "sha256", "row_count"))).alias("artifacts"))
    return listed.crossJoin(quality).select(F.to_json(F.struct("artifact_count", "artifacts", F.struct(*quality.columns).alias("data_quality"))).alias("value"))


def write_live_manifest(spark: SparkSession, path: str, rows: DataFrame, quality: DataFrame, output: str, base: str | None = None) -> None:
    publish(live_manifest(spark, path, rows, quality, base), output, lambda df, to: df.coalesce(1).write.text(to))
