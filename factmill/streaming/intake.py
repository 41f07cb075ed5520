"""Structured Streaming forms of the intake: payloads, dedup by id, mentions, weekly counts and gates, the tracker's state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factmill.operators.feeds import items_of_entries, parse_payloads
from factmill.operators.mentions import mentions
from factmill.operators.tracker import symbol_evidence, tracker_of
from factmill.operators.weekly import weekly_gate
from factmill.sources.files import named_payloads


def new_items(items: DataFrame, delay: str = "14 days") -> DataFrame:
    """Items of a stream once each by item_id; state older than the watermark on published_ts is dropped."""
    stamped = items.withColumn("published_ts", F.to_timestamp("published_at"))
    return stamped.withWatermark("published_ts", delay).dropDuplicatesWithinWatermark(["item_id"])


def stream_mentions(items: DataFrame, aliases: DataFrame) -> DataFrame:
    """(item_id, published_ts, symbol) of streamed or stored items, found within each row by the batch function."""
    return mentions(items, aliases, ("item_id", "published_ts"))


def weekly_tumbling(events: DataFrame, time: str, keys: list[str], delay: str = "14 days") -> DataFrame:
    """Counts for each Monday-based week and key. A week is emitted once, when the watermark has passed its end."""
    week = F.window(F.col(time), "7 days", "7 days", "4 days")  # epoch day 0 is a Thursday
    counted = events.withWatermark(time, delay).groupBy(week.alias("w"), *keys).agg(F.count(F.lit(1)).alias("events"))
    return counted.select(F.to_date("w.start").alias("period_start"), *keys, "events")


def run_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Processes what is there and stops; appends to Parquet with exactly-once file commits."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()


def _batches(stream: DataFrame, checkpoint: str, mode: str, each: Callable[[DataFrame, int], None]) -> None:
    """Hands what is there to ``each``, batch by batch, and stops. A batch may come twice, with the same number."""
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()


def _keep(rows: DataFrame, path: str, batch_id: int) -> None:
    """Writes a batch into a folder of its own, over what an earlier try of the same batch left there."""
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")


def refresh_evidence(events: DataFrame, path: str, checkpoint: str) -> None:
    """Keeps each symbol's evidence as state of the stream: score, count, latest event and deciding types.

    A batch costs its own events and writes the evidence of the symbols that it touched, whatever came before; events
    that come again, by event_id, change nothing. State: a row for each symbol, and the ids seen.
    """
    evidence = symbol_evidence(events.dropDuplicates(["event_id"]))
    _batches(evidence, checkpoint, "update", lambda batch, batch_id: _keep(batch, path, batch_id))


def current_tracker(spark: SparkSession, watchlist: DataFrame, path: str) -> DataFrame:
    """The tracker of all that ``refresh_evidence`` has seen: of each symbol the evidence of its last batch."""
    kept = spark.read.parquet(path)
    fields = [c for c in kept.columns if c not in ("e_symbol", "batch")]
    last = kept.groupBy("e_symbol").agg(F.max_by(F.struct(*fields), "batch").alias("last"))
    return tracker_of(watchlist, last.select("e_symbol", "last.*"))


def close_weeks(observations: DataFrame, feeds: DataFrame, path: str, checkpoint: str, delay: str = "14 days") -> None:
    """Reports each week's feed completeness once, when the watermark (``delay`` behind the latest ts) has passed its end.

    ``observations``: ts, feed_id, ok, item_date of each fetch. A feed succeeded in a week if one of its fetches did; its
    last item is the latest of the week's fetches. All feeds of a week close in one batch, so configured feeds that were
    not seen are missing there, and those whose items are older than the week are stale. Fetches that come after their
    week has closed are dropped, as the watermark tells.
    """
    week = F.window(F.col("ts"), "7 days", "7 days", "4 days")  # epoch day 0 is a Thursday
    seen = observations.withWatermark("ts", delay).groupBy(week.alias("w"), "feed_id").agg(F.bool_or("ok").alias("ok"), F.max("item_date").alias("last_item"))
    seen = seen.select(F.to_date("w.start").alias("period_start"), "feed_id", "ok", "last_item")

    def report(batch: DataFrame, batch_id: int) -> None:
        closed = batch.persist()
        _keep(weekly_gate(feeds, closed, closed), path, batch_id)
        closed.unpersist()

    _batches(seen, checkpoint, "append", report)


def payload_stream(spark: SparkSession, landing: str, archive: str | None = None) -> DataFrame:
    """(feed_id, payload, content) of payload files as they land, each once; read ones move to ``archive``, if given."""
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return named_payloads(reader.load(landing))


def take_in(payloads: DataFrame, feeds: DataFrame, ingested_at: Column, path: str, checkpoint: str, max_items: int = 25) -> None:
    """Items and faults of streamed payloads: ``path``/items as ``feed_items`` gives them, ``path``/faults beside them.

    A payload is read once for both. A faulty one leaves a fault and no item, and stops nothing.
    """

    def both(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_payloads(batch, max_items).persist()
        _keep(items_of_entries(parsed, feeds, ingested_at), f"{path}/items", batch_id)
        _keep(parsed.where("error is not null").select("feed_id", "payload", "error"), f"{path}/faults", batch_id)
        parsed.unpersist()

    _batches(payloads, checkpoint, "append", both)


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table's Parquet files as a stream."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parquet*")  # the glob takes one file as well as a folder
