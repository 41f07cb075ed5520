"""The tracker: watch-listed symbols ranked by accumulated evidence."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factmill.functions import vocab
from factmill.functions.text import empty_as_null, weight
from factmill.operators.ordering import placed


def load_watchlist(raw: DataFrame) -> DataFrame:
    """Watchlist rows; research_status falls back to article_status where it is empty or missing."""
    have = [empty_as_null(F.col(c)) for c in ("research_status", "article_status") if c in raw.columns]
    text = lambda c: F.coalesce(F.col(c), F.lit("")) if c in raw.columns else F.lit("")
    return raw.select(F.upper(F.btrim("symbol")).alias("symbol"), text("name").alias("name"), text("bucket").alias("bucket"), F.coalesce(*have, F.lit("")).alias("research_status"), text("thesis").alias("thesis"), text("source_url").alias("source_url"))


def symbol_evidence(events: DataFrame, event_weights: Mapping[str, int] = vocab.EVENT_WEIGHTS, confidence_weights: Mapping[str, int] = vocab.CONFIDENCE_WEIGHTS) -> DataFrame:
    """For each symbol: score, count, latest event (by date, type, id) and which deciding types occur."""
    has = lambda t: F.bool_or(F.col("event_type") == t)
    return events.groupBy(F.col("symbol").alias("e_symbol")).agg(
        F.sum(weight(F.col("event_type"), event_weights) + weight(F.col("confidence"), confidence_weights)).alias("event_score"), F.count(F.lit(1)).alias("events"),
        F.max(F.struct("event_date", "event_type", "event_id")).alias("latest"), has("public_mention").alias("mention"), has("disclosure_buy").alias("disclosure"), has("policy_capital").alias("policy"),
    )


def trigger_status(status: Column) -> Column:
    mention, disclosure, policy = (F.coalesce(c, F.lit(False)) for c in ("mention", "disclosure", "policy"))
    return (
        F.when(mention & disclosure, "disclosure_plus_mention").when(policy, "policy_triggered").when(mention, "mentioned").when(disclosure, "disclosed")
        .otherwise(F.coalesce(empty_as_null(status), F.lit("watchlist")))
    )


def tracker_of(watchlist: DataFrame, evidence: DataFrame, bucket_weights: Mapping[str, int] = vocab.BUCKET_WEIGHTS) -> DataFrame:
    """One row for each watchlist row, with the evidence of its symbol (one row, as ``symbol_evidence`` gives)."""
    joined = watchlist.join(evidence, F.col("symbol") == F.col("e_symbol"), "left")
    return joined.select(
        "symbol", "name", "bucket", trigger_status(F.col("research_status")).alias("trigger_status"),
        (weight(F.col("bucket"), bucket_weights) + F.coalesce("event_score", F.lit(0))).cast("long").alias("priority_score"), F.coalesce("events", F.lit(0)).alias("event_count"),
        F.col("latest.event_date").alias("latest_event_date"), F.col("latest.event_type").alias("latest_event_type"), "source_url", "thesis",
    )


def build_tracker(watchlist: DataFrame, events: DataFrame, bucket_weights: Mapping[str, int] = vocab.BUCKET_WEIGHTS) -> DataFrame:
    """One row for each watchlist row. Events are summed by symbol before the join, so a hot symbol is one row there."""
    return tracker_of(watchlist, symbol_evidence(events), bucket_weights)


def ranked(tracker: DataFrame) -> DataFrame:
    """``tracker_rank``: place by falling score, then symbol and name. Symbols part the rows of one score, however many."""
    out = placed(tracker, [F.col("priority_score").desc(), F.col("symbol"), F.col("name")], "tracker_rank")
    return out.withColumn("tracker_rank", F.col("tracker_rank").cast("int"))
