"""Benchmark decontamination by a prefix-filtered join of word shingles (built-in functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factmill.llm.common import ascii_lower, bounded_broadcast, is_small, materialize, table

#: What separates words: all ASCII characters but digits and lower-case letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
SHINGLE = 3


def words_of(text: Column) -> Column:
    """Words of the text after lower-casing A-Z; null has none."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), lambda w: w != "")


def _shingle(words: Column, at: Column, length: Column) -> Column:
    """Hash of ``length`` (1 to SHINGLE) words from ``at`` on; only a filter, what it lets through is compared in full."""
    parts = [F.when(length > i, F.get(words, at + i)) if i else F.get(words, at) for i in range(SHINGLE)]
    return F.xxhash64(length, *parts)


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows: wid, words, k, and the number of words of their shingles. Shorter items are one window."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("w"))
    items = items.withColumn("k", F.least(F.size("w"), F.lit(window))).where("k > 0")
    spread = items.select("item_id", "k", "w", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("k") + 1)).alias("p"))
    spread = spread.select("item_id", F.slice("w", F.col("p"), F.col("k")).alias("words"))
    return spread.select("item_id", "words", F.md5(F.concat_ws(" ", "words").cast("binary")).alias("wid"))


def _exploded(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """A row for each document word and shingle length: the word's place i, the length and the shingle's hash h."""
    n = len(lengths)
    places = F.when(F.size("w") > 0, F.sequence(F.lit(0), F.size("w") * n - 1))  # a filter on the words would split the text twice
    spread = docs.select("doc_id", "th", "w", F.explode(places).alias("j")) if n else docs.limit(0).withColumn("j", F.lit(0))
    length = F.get(F.array(*map(F.lit, lengths)), F.pmod("j", F.lit(n))) if n > 1 else F.lit(lengths[0] if lengths else 1)
    spread = spread.select("doc_id", "th", "w", F.floor(F.col("j") / max(1, n)).cast("int").alias("i"), length.alias("len"))
    return spread.withColumn("h", _shingle(F.col("w"), F.col("i"), F.col("len")))


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of ``documents``.

    A word is hit if any occurrence of a window (``window`` consecutive words of an item; the whole of a shorter item)
    covers it. The windows' shingles are counted in all documents; a window can only occur where its rarest shingle
    does, so that one is its whole prefix: windows with a shingle that occurs nowhere are dropped, the others are
    joined on it, bounded by position and length, and compared word by word. Frequent passages cost a row for each
    occurrence, never a pair of documents. With more prefixes than may be broadcast, what is shuffled for a word is its
    place and hash; the words themselves are joined back only for documents with candidates.

    Null texts have no words; null ids keep their rows; repeated rows keep a row each; an empty benchmark or one
    without words hits nothing; an empty ``documents`` gives an empty result; further columns are ignored.
    """
    members = materialize(item_windows(benchmark, window), "windows")
    windows = members.groupBy("wid").agg(F.first("words").alias("words")).withColumn("k", F.size("words"))
    windows = windows.withColumn("len", F.least("k", F.lit(SHINGLE)))
    lengths = sorted(r[0] for r in windows.select("len").distinct().collect())  # at most SHINGLE values
    grams = windows.select("wid", "words", "k", "len", F.explode(F.sequence(F.lit(0), F.col("k") - F.col("len"))).alias("o"))
    grams = grams.withColumn("h", _shingle(F.col("words"), F.col("o"), F.col("len")))

    docs = documents.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), words_of(F.col("text")).alias("w"))
    spread = _exploded(docs, lengths)
    wanted = bounded_broadcast(materialize(grams.select("h").distinct(), "shingles"))
    counts = spread.select("h").join(wanted, "h").groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    rare = grams.join(counts, "h", "left").groupBy("wid").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "h", "o", "words", "k")).alias("p")
    )
    prefixes = materialize(rare.where("p.n > 0").select("wid", F.col("p.h").alias("ph"), F.col("p.o").alias("o"), F.col("p.words").alias("words"), F.col("p.k").alias("k")), "prefixes")

    start = (F.col("i") - F.col("o")).alias("start")
    if is_small(prefixes):
        found = spread.join(F.broadcast(prefixes), F.col("h") == F.col("ph")).select("doc_id", "th", "w", start, "k", "words", "wid")
    else:
        slim = spread.select("doc_id", "th", "i", "h").join(prefixes, F.col("h") == F.col("ph")).where("i >= o").select("doc_id", "th", start, "k", "words", "wid").distinct()
        slim = materialize(slim, "candidates")
        whole = docs.select(F.col("doc_id").alias("w_doc"), F.col("th").alias("w_th"), "w")
        same_row = (F.col("th") == F.col("w_th")) & F.col("doc_id").eqNullSafe(F.col("w_doc"))
        whole = whole.join(slim.select("doc_id", "th").distinct(), same_row, "left_semi").dropDuplicates(["w_doc", "w_th"])
        found = slim.join(whole, same_row)
    same = (F.col("start") >= 0) & (F.col("start") + F.col("k") <= F.size("w")) & (F.slice("w", F.greatest("start", F.lit(0)) + 1, F.col("k")) == F.col("words"))
    spans = found.where(same).groupBy(F.col("doc_id").alias("s_doc"), F.col("th").alias("s_th")).agg(
        F.collect_set(F.struct(F.col("start").alias("s"), (F.col("start") + F.col("k")).alias("e"))).alias("spans"), F.collect_set("wid").alias("wids"),
    )
    spans = materialize(spans, "spans")
    per_doc = docs.select("doc_id", "th", F.size("w").cast("long").alias("n_words")).join(bounded_broadcast(spans), (F.col("th") == F.col("s_th")) & F.col("doc_id").eqNullSafe(F.col("s_doc")), "left")
    covered = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, s: F.struct(F.greatest(a["end"], s["e"]).alias("end"), (a["n"] + F.greatest(F.lit(0), s["e"] - F.greatest(a["end"], s["s"]))).alias("n")),
    )["n"]
    items = spans.select("s_doc", "s_th", F.explode("wids").alias("wid")).join(bounded_broadcast(members.select("wid", "item_id").distinct()), "wid")
    items = items.groupBy(F.col("s_doc").alias("i_doc"), F.col("s_th").alias("i_th")).agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    items = materialize(items, "items")
    joined = per_doc.join(bounded_broadcast(items), (F.col("th") == F.col("i_th")) & F.col("doc_id").eqNullSafe(F.col("i_doc")), "left")
    out = joined.select("doc_id", "n_words", F.when(F.col("spans").isNull(), F.lit(0)).otherwise(covered).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP3_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bk AS (SELECT item_id, w, least(len(w), 10) AS k FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, list_slice(w, p, p + k - 1) AS words FROM (SELECT item_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS p FROM bk)),
ks AS (SELECT DISTINCT k FROM win),
dw AS (SELECT doc_id, k, p, list_slice(w, p, p + k - 1) AS words FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS p FROM d, ks WHERE len(w) >= k)),
hit AS (SELECT dw.doc_id, dw.p, dw.k, win.item_id FROM dw JOIN win ON dw.k = win.k AND dw.words = win.words),
pos AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(generate_series(p, p + k - 1)) AS q FROM hit) GROUP BY 1),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM hit GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos ON d.doc_id = pos.doc_id LEFT JOIN it ON d.doc_id = it.doc_id
"""
