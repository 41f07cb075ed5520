"""A corpus pipeline: toxic documents go, near copies go, benchmark leaks go, personal data is replaced, the rest is packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factmill.llm.common import bounded_broadcast, free_name, materialize, table
from factmill.llm.decontamination import contamination
from factmill.llm.packing import pack
from factmill.llm.pii import pseudonymize, surrogate_key
from factmill.llm.simhash import near_duplicates
from factmill.llm.tokens import vocabulary_path
from factmill.llm.toxicity import keep_clean


def _key():
    """What a row is known by: its doc_id (null ids after all others) and its text."""
    text = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), text.alias("text"))


def _name(key):
    """The key as a text, never null."""
    return F.concat_ws(":", key["none"].cast("string"), F.coalesce(key["id"].cast("string"), F.lit("")), key["text"])


def _without(docs: DataFrame, names: DataFrame) -> DataFrame:
    """``docs`` without the rows of these names."""
    gone = free_name(docs, "gone")
    names = materialize(names.select(F.col("name").alias(gone)).distinct(), "gone")
    return docs.join(bounded_broadcast(names), _name(_key()) == F.col(gone), "left_anti")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text scores as toxic go.

    Null and empty texts stay, as do rows with null ids and repeated rows whose text is clean; other columns are kept
    as they are, whatever their names; an empty table, or one without labels, gives what the unlearned grammar keeps.
    """
    return keep_clean(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the row with the least doc_id, then the least hash of its text, stays.

    Rows that share a doc_id but not their text are judged apart; of rows equal in both one is kept, whichever their
    other columns. Null ids come last. Null and empty texts are one group, of which one row stays. Other columns are
    kept as they are, whatever their names; an empty table gives an empty one.
    """
    near = near_duplicates(docs.select(_key().alias("doc_id"), "text"))
    near = materialize(near.select(_name(F.col("doc_id")).alias("name"), _name(F.col("component_id")).alias("first")), "near")
    kept = _without(docs, near.where("name <> first"))
    repeated = near.where("name = first").groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again_name, row_name = free_name(docs, "again"), free_name(docs, "row_name")
    repeated = materialize(repeated.select(F.col("name").alias(again_name)), "again")
    if repeated.isEmpty():
        return kept
    again, name = bounded_broadcast(repeated), _name(_key())
    single = kept.join(again, name == F.col(again_name), "left_anti")
    double = kept.join(again, name == F.col(again_name), "left_semi").withColumn(row_name, name)
    return single.unionByName(double.dropDuplicates([row_name]).drop(row_name))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a window of a benchmark item go, whatever their doc_id (null too); repeated rows go together.

    Null and empty texts hold none and stay, very long ones are read whole; other columns are kept as they are,
    whatever their names; an empty table gives an empty one.
    """
    found = contamination(docs.select(_name(_key()).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return _without(docs, found.where("contaminated").select(F.col("doc_id").alias("name")))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts becomes surrogates; n_chars, where there is one, follows the new text.

    Every row stays: null and empty texts as they are, null ids and repeated rows too, whole however long the text; other
    columns are kept, whatever their names (n_entities and n_distinct are not those of the operator); an empty table
    gives an empty one.
    """
    kept = {c: free_name(docs, f"kept_{c}") for c in docs.columns if c.lower() in ("n_entities", "n_distinct")}
    out = pseudonymize(docs.withColumnsRenamed(kept), surrogate_key(spark)).drop("n_entities", "n_distinct").withColumnsRenamed({v: k for k, v in kept.items()}).select(*docs.columns)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))
    return out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens.

    Null and empty texts are the end id alone; null ids, ties and repeated rows keep their pieces each; other columns are
    left out; an empty table gives an empty one.
    """
    return pack(docs, vocabulary_path())


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("packing", packing),
]
#: The learned grammar, XXH64 and the tokenizer have no DuckDB equivalent; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
