"""Rendezvous hashing of record keys over weighted shards (built-in functions only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from factmill.llm.common import table

#: Buckets by which the rows of one shard are numbered in parallel.
SLOT_BUCKETS = 64


def _best(key: Column, weights: Sequence[float]) -> Column:
    """The shard with the greatest -weight / ln(u), u in (0, 1) from the hash of key and shard; ties: the lower shard."""
    entries = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(w)).alias("w")) for i, w in enumerate(weights) if w > 0])

    def score(e: Column) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(key, e["i"]), 11).cast("double") + 0.5) / F.lit(2.0**53)
        return F.struct((-e["w"] / F.ln(u)).alias("score"), (-e["i"]).alias("i"))

    return -F.array_max(F.transform(entries, score))["i"]


def rendezvous_shards(rows: DataFrame, key: Column, weights: Sequence[float], column: str = "shard") -> DataFrame:
    """Adds ``column``: the shard of ``key``, in proportion to ``weights`` (a weight of 0 closes a shard).

    Appending a shard moves rows only into it, and its share of them; removing one moves only its own rows. Null keys
    share one shard; so do repeated keys. No row is dropped and no text is shuffled: the choice is a projection.
    """
    if not any(w > 0 for w in weights):
        raise ValueError("at least one shard needs a positive weight")
    return rows.withColumn(column, _best(key, weights))


def number_slots(rows: DataFrame, group: str, order: Sequence[Column], slot: str = "slot", buckets: int = SLOT_BUCKETS) -> DataFrame:
    """Adds ``slot``: 0, 1, 2, ... without gaps in each ``group``, by hash bucket, then ``order``.

    A bucket is one task's work; the buckets' sizes are counted first (one row per group and bucket) and summed into
    starts, so no group is ordered by a single task. Ties get distinct slots in any order.
    """
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64(F.lit(97), *order), F.lit(buckets)).cast("int"))
    sizes = dealt.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select(
        F.col(group).alias("_g"), F.col("_bucket").alias("_b"),
        (F.sum("_n").over(W.partitionBy(group).orderBy("_bucket")) - F.col("_n")).alias("_start"),
    )
    ranked = dealt.withColumn("_r", F.row_number().over(W.partitionBy(group, "_bucket").orderBy(*order)) - 1)
    # one row per group and bucket: bounded by the number of shards times `buckets`
    joined = ranked.join(F.broadcast(starts), (ranked[group] == starts["_g"]) & (ranked["_bucket"] == starts["_b"]))
    return joined.withColumn(slot, (F.col("_start") + F.col("_r")).cast("long")).drop("_bucket", "_g", "_b", "_start", "_r")


def shard_documents(documents: DataFrame, shards: int = 40, weights: Sequence[float] | None = None) -> DataFrame:
    """Puts every row of ``documents`` into a shard by its doc_id and the shard count (law ``key``).

    Columns: doc_id, size (UTF-8 bytes of the text plus 16), text_crc32, law, shard, slot, grown_shard (the shard with
    one more shard of weight 1). Null texts count as empty, null ids share a shard, repeated rows keep a row each,
    other columns are ignored; an empty table gives an empty result.
    """
    weights = list(weights or [1.0] * shards)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        "doc_id", (F.octet_length(text).cast("long") + 16).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law")
    )
    rows = rendezvous_shards(rows, F.col("doc_id"), weights)
    rows = number_slots(rows, "shard", [F.col("doc_id"), F.col("text_crc32")])
    rows = rendezvous_shards(rows, F.col("doc_id"), [*weights, 1.0], "grown_shard")
    return rows.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op10_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), 40)
