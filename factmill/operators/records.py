"""Official records: validation, confidence tiers and normalized events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factmill.functions import vocab
from factmill.functions.text import confidence_of, is_government_url, is_https, slug, strict_date
from factmill.sources.files import read_rows, write_rows

RECORD_COLUMNS = ("record_id", "record_date", "symbol", "source_type", "event_type", "direction", "source_url", "summary", "entity_match_type", "match_evidence", "relationship_type")
EVENT_COLUMNS = ("event_id", "event_date", "symbol", "event_type", "direction", "confidence", "source_url", "notes", "entity_match_type", "match_evidence", "relationship_type")


def with_legacy_columns(records: DataFrame) -> DataFrame:
    """Adds what older files lack; a column that is there but blank is left blank."""
    added = {c: F.lit(d) for c, d in (("entity_match_type", "unverified"), ("match_evidence", ""), ("relationship_type", "unverified")) if c not in records.columns}
    return records.withColumns(added) if added else records


def record_error() -> Column:
    """The first fault of a record, null for none."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    source = text("source_type")
    return (
        F.when(strict_date(text("record_date")).isNull(), "record_date_invalid")
        .when(F.btrim(text("record_id")) == "", "record_id_blank")
        .when(F.btrim(text("symbol")) == "", "symbol_blank")
        .when(~text("entity_match_type").isin(*vocab.RELATIONSHIPS), "entity_match_type_invalid")
        .when(~text("relationship_type").isin(*vocab.RELATIONSHIPS), "relationship_type_invalid")
        .when(~text("event_type").isin(*vocab.EVENT_TYPES), "event_type_invalid")
        .when(source.isin(*vocab.GOVERNMENT_SOURCES), F.when(~is_government_url(text("source_url")), "government_url_invalid"))
        .when(source.isin(*vocab.ISSUER_SOURCES), F.when(~is_https(text("source_url")), "issuer_url_invalid"))
        .when(source.isin(*vocab.MEDIA_SOURCES), F.when(~is_https(text("source_url")), "media_url_invalid"))
        .otherwise("source_type_unsupported")
    )


def rejected_records(records: DataFrame) -> DataFrame:
    """Records with a fault, and its code."""
    return with_legacy_columns(records).withColumn("error_code", record_error()).where("error_code is not null")


def normalize_records(records: DataFrame, strict: bool = False) -> DataFrame:
    """Events of the sound records. strict: one faulty record fails the job; else they are left to ``rejected_records``."""
    checked = with_legacy_columns(records).withColumn("_error", record_error())
    if strict:
        checked = checked.where(F.when(F.col("_error").isNull(), True).otherwise(F.raise_error(F.concat(F.lit("invalid record: "), F.coalesce(F.col("record_id"), F.lit("")), F.lit(" "), "_error")).cast("boolean")))
    good = checked.where("_error is null")
    direction = F.coalesce(F.nullif(F.btrim("direction"), F.lit("")), F.lit("neutral"))
    return good.select(
        F.concat(F.lit("official-"), slug(F.col("source_type")), F.lit("-"), slug(F.col("record_id"))).alias("event_id"),
        strict_date(F.col("record_date")).alias("event_date"), F.upper(F.btrim("symbol")).alias("symbol"), "event_type", direction.alias("direction"),
        confidence_of(F.col("source_type")).alias("confidence"), "source_url", F.col("summary").alias("notes"), "entity_match_type", "match_evidence", "relationship_type",
    )


def sorted_events(events: DataFrame) -> DataFrame:
    """Events in the order in which they are published: by date, symbol, id."""
    return events.orderBy("event_date", "symbol", "event_id")


def import_official_events(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Reads official records from CSV, fails on the first faulty one, writes their events as CSV and returns them."""
    events = sorted_events(normalize_records(read_rows(spark, source), strict=True))
    write_rows(events, target, EVENT_COLUMNS)
    return events


def load_events(raw: DataFrame) -> DataFrame:
    """Events in analysis form from rows of text: strict date, upper symbol, missing optional columns as ''."""
    rows = raw.withColumns({c: F.lit("") for c in ("direction", "confidence", "source_url", "notes") if c not in raw.columns})
    day = F.coalesce(strict_date(F.col("event_date").cast("string")), F.raise_error(F.concat(F.lit("event without a valid date: "), F.coalesce("event_id", F.lit("")))).cast("date"))
    return rows.select("event_id", day.alias("event_date"), F.upper(F.btrim("symbol")).alias("symbol"), "event_type", "direction", "confidence", "source_url", "notes")
