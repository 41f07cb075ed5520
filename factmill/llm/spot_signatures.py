"""Document fingerprints by spot signatures: chains of content words after common words (built-in functions only)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factmill.llm.common import free_name, materialize, table

# The anchors, common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be by for from has have he in is it its not of on or she than that the their then there they this to was we were what which who will with you"
    " auch auf aus bei das dass dem den der des die ein eine einem einen einer er es für haben hat ich im ist mit nach nicht noch nur oder sein sich sie sind über um und von war wie wird wir zu zum zur"
    " au aux avec ce ces cette dans de du elle en est et il ils je la le les leur lui mais ne nous ont ou par pas plus pour qu que qui sa se ses son sont sur un une vous y à"
    " al como con cuando del el ella ellas ellos era esta este esto fue ha han hay las lo los más muy no nos o para pero por porque se ser si sin sobre su sus también una uno unos"
).split()
NO_WORD = r"[^\p{L}\p{M}\p{N}]+"
#: Stands before common words in the text that chains are read from; no word holds it.
_MARK = "\x01"
#: Content words of a chain.
CHAIN = 2
#: Hexadecimal digits of a signature.
DIGITS = 8
#: Likenesses below this are told as 0; sets whose lengths alone rule it out are not compared.
FLOOR = 0.02


def _alternatives(words: list[str]) -> str:
    """A pattern of these words, by first letters, so that most words fail at once."""
    by: dict[str, list[str]] = {}
    for w in sorted(set(words)):
        by.setdefault(w[0], []).append(w[1:])
    return "|".join(f"{k}(?:{'|'.join(rest)})" for k, rest in by.items())


def with_signatures(rows: DataFrame, text: str, out: str, chain: int = CHAIN, anchors: list[str] = ANCHORS) -> DataFrame:
    """Adds ``out``: the distinct signatures of the column ``text`` (no nulls), sorted.

    Each common word begins a chain of the next ``chain`` content words, whatever common words stand between; a chain
    that the text's end cuts off is none. The text's beginning is an anchor too, of chains of every length up to
    ``chain``, so each text with a content word has signatures. A signature is the first digits of the MD5 of its anchor
    and content words. Each step is a projection of its own, so that none is computed twice.
    """
    marked, spots = free_name(rows, "_marked"), free_name(rows, "_spots")
    words = F.concat(F.lit(" "), F.btrim(F.regexp_replace(F.lower(text), NO_WORD, " ")), F.lit(" "))
    skipped, content = f"(?:{_MARK}[^ ]+ )*+", f"[^ {_MARK}]+ "
    begin = [F.regexp_extract(marked, f"^( )({(skipped + content) * n})", 2) for n in range(1, chain + 1)]
    begin = F.array_compact(F.array(*[F.when(c != "", F.concat(F.lit(" "), c)) for c in begin]))
    chains = F.regexp_extract_all(marked, F.lit(f"(?={_MARK}([^ ]+ {(skipped + content) * chain}))"), F.lit(1))
    out_of = F.transform(spots, lambda c: F.substring(F.md5(F.regexp_replace(c, f"{_MARK}[^ ]+ ", "").cast("binary")), 1, DIGITS))
    rows = rows.withColumn(marked, F.regexp_replace(words, f" (?=(?:{_alternatives(anchors)}) )", f" {_MARK}"))
    rows = rows.withColumn(spots, F.concat(chains, begin))
    return rows.withColumn(out, F.sort_array(F.array_distinct(out_of))).drop(marked, spots)


def length_class(size: Column, floor: float = FLOOR) -> Column:
    """The partition of a set by its length: sets whose partitions are neither one nor neighbours are less alike than ``floor``."""
    return F.floor(F.ln(F.greatest(size, F.lit(1)).cast("double")) / F.lit(-math.log(floor)))


def likeness(a: Column, b: Column, floor: float = FLOOR) -> Column:
    """Jaccard of two sets of signatures where it is ``floor`` or more, else 0; two empty sets are alike (1).

    Sets are intersected only if their length partitions are the same or neighbours and their lengths allow ``floor``.
    """
    few, many = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    apart = (F.abs(length_class(F.size(a), floor) - length_class(F.size(b), floor)) > 1) | (few < F.lit(floor) * many)
    shared = F.size(F.array_intersect(a, b))
    alike = shared / (F.size(a) + F.size(b) - shared)
    return F.when(many == 0, F.lit(1.0)).when(apart, F.lit(0.0)).otherwise(F.when(alike >= floor, alike).otherwise(F.lit(0.0)))


def _asked(rows: DataFrame) -> tuple[DataFrame, bool]:
    """For each distinct row (key): the row before it in the order (asker, its doc_id) and how many characters that one takes.

    Rows are ordered by doc_id, descending (null ids last), then key; the last is followed by the first. Ranges of the
    order are dealt to tasks and numbered there, so that a row's follower has the next number, and the driver sees two
    numbers of each range. Also whether rows are repeated.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("k")]
    narrow = rows.select("k", "doc_id", F.length("text").alias("n")).groupBy("k", "doc_id", "n").agg(F.count(F.lit(1)).alias("times"))
    ranged = narrow.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    ranged = materialize(ranged, "order")
    ranges = ranged.groupBy(F.shiftright("at", 33).alias("range")).agg(F.min("at").alias("first"), F.max("at").alias("last"), F.max("times").alias("times")).orderBy("range").collect()
    jumps = [(r.last, ranges[(i + 1) % len(ranges)].first) for i, r in enumerate(ranges)]
    schema = T.StructType([T.StructField("last", T.LongType()), T.StructField("to", T.LongType())])
    jumps = rows.sparkSession.createDataFrame(jumps, schema)  # one row for each range
    asks = ranged.join(F.broadcast(jumps), ranged["at"] == jumps["last"], "left")
    asks = asks.select(F.coalesce("to", F.col("at") + 1).alias("at"), F.col("k").alias("asker"), F.col("doc_id").alias("asker_id"), F.floor(F.col("n") / 3).cast("int").alias("take"))
    return materialize(ranged.select("at", "k").join(asks, "at").drop("at"), "asked"), any(r.times > 1 for r in ranges)


def fingerprints(documents: DataFrame) -> DataFrame:
    """Fingerprints of ``documents`` (doc_id, text), of edited texts, and how alike they are.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The edited text has
    its last third replaced by the beginning of the next document, descending doc_id; the first follows the last. A
    fingerprint is the text's sorted signatures, joined; near_* are likenesses of the signature sets.
    Null texts are empty; an empty text, or one of common words alone, has an empty fingerprint, and two of them are
    alike. Null ids come last, ties of an id go by a hash of id and text. Rows equal in id and text are one place in the
    order and get the same result, a row each. Texts are read whole, however long; other columns are ignored; an empty
    table gives an empty result; a single document follows itself.

    Texts are shuffled once, by a key of their own; what goes on to the asking row is the part of the text that it takes
    and the signatures, so nothing is keyed by anything that rows share.
    """
    text = F.coalesce("text", F.lit(""))
    named = F.concat_ws(":", F.col("doc_id").isNull().cast("string"), F.col("doc_id").cast("string"), text)
    rows = documents.select("doc_id", text.alias("text"), F.md5(named.cast("binary")).alias("k"))
    asked, repeated = _asked(rows)
    texts = rows.select("k", "text")  # both uses read the same columns, so Spark shuffles the texts once for both
    given = with_signatures(texts.join(asked, "k"), "text", "next_set")
    given = given.select("asker", "asker_id", F.expr("left(text, take)").alias("head"), "next_set")
    if repeated:
        given = given.dropDuplicates(["asker"])
    met = texts.join(given, F.col("k") == F.col("asker"))
    met = met.select(F.col("asker_id").alias("doc_id"), "text", "head", "next_set", F.length("text").cast("long").alias("n_chars"))
    met = with_signatures(met, "text", "own_set")
    kept = F.expr("left(text, cast(n_chars - floor(n_chars / 3) as int))")
    met = met.select("doc_id", "n_chars", "own_set", "next_set", F.concat(kept, "head").alias("edited"))
    met = with_signatures(met, "edited", "edited_set")
    return met.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), F.array_join("own_set", "").alias("fingerprint"), F.array_join("edited_set", "").alias("edited_fingerprint"),
        likeness(F.col("own_set"), F.col("edited_set")).alias("near_edited"), likeness(F.col("own_set"), F.col("next_set")).alias("near_next"),
    )


def op12_spot_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


_SQL_ANCHORS = ", ".join(f"'{w}'" for w in dict.fromkeys(ANCHORS))
OP12_SQL = rf"""
WITH o AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, row_number() OVER (ORDER BY doc_id DESC) AS r FROM documents),
nx AS (SELECT o.*, f.doc_id AS next_id, f.text AS next_text FROM o JOIN o AS f ON f.r = CASE WHEN o.r = (SELECT max(r) FROM o) THEN 1 ELSE o.r + 1 END),
ed AS (SELECT doc_id, next_id, n, text, substring(text, 1, n - n // 3) || substring(next_text, 1, n // 3) AS edited FROM nx),
src AS (SELECT doc_id, 'own' AS kind, text FROM ed UNION ALL SELECT doc_id, 'edited', edited FROM ed),
w AS (SELECT doc_id, kind, list_filter(string_split(regexp_replace(lower(text), '[^\p{{L}}\p{{M}}\p{{N}}]+', ' ', 'g'), ' '), lambda x: x <> '') AS ws FROM src),
p AS (SELECT doc_id, kind, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM w),
q AS (SELECT *, word IN ({_SQL_ANCHORS}) AS common FROM p),
c AS (SELECT *, CAST(sum(CASE WHEN common THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, kind ORDER BY pos) AS BIGINT) AS k FROM q),
content AS (SELECT doc_id, kind, word, k FROM c WHERE NOT common),
sig AS (
  SELECT DISTINCT doc_id, kind, substring(md5(chain), 1, {DIGITS}) AS s FROM (
    SELECT c.doc_id, c.kind, c.word || ' ' || a.word || ' ' || b.word || ' ' AS chain FROM c
      JOIN content a ON a.doc_id = c.doc_id AND a.kind = c.kind AND a.k = c.k + 1 JOIN content b ON b.doc_id = c.doc_id AND b.kind = c.kind AND b.k = c.k + 2 WHERE c.common
    UNION ALL SELECT doc_id, kind, ' ' || word || ' ' FROM content WHERE k = 1
    UNION ALL SELECT a.doc_id, a.kind, ' ' || a.word || ' ' || b.word || ' ' FROM content a JOIN content b ON a.doc_id = b.doc_id AND a.kind = b.kind AND a.k = 1 AND b.k = 2)),
fp AS (SELECT doc_id, kind, count(*) AS m, string_agg(s, '' ORDER BY s) AS f FROM sig GROUP BY 1, 2),
ie AS (SELECT a.doc_id, count(*) AS i FROM sig a JOIN sig b ON a.doc_id = b.doc_id AND a.kind = 'own' AND b.kind = 'edited' AND a.s = b.s GROUP BY 1),
inx AS (SELECT ed.doc_id, count(*) AS i FROM ed JOIN sig a ON a.doc_id = ed.doc_id AND a.kind = 'own' JOIN sig b ON b.doc_id = ed.next_id AND b.kind = 'own' AND a.s = b.s GROUP BY 1),
al AS (
  SELECT ed.doc_id, CAST(n AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256, coalesce(fo.f, '') AS fingerprint, coalesce(fe.f, '') AS edited_fingerprint,
         coalesce(fo.m, 0) AS a, coalesce(fe.m, 0) AS e, coalesce(fx.m, 0) AS x, coalesce(ie.i, 0) AS ei, coalesce(inx.i, 0) AS xi
  FROM ed LEFT JOIN fp fo ON fo.doc_id = ed.doc_id AND fo.kind = 'own' LEFT JOIN fp fe ON fe.doc_id = ed.doc_id AND fe.kind = 'edited'
  LEFT JOIN fp fx ON fx.doc_id = ed.next_id AND fx.kind = 'own' LEFT JOIN ie ON ie.doc_id = ed.doc_id LEFT JOIN inx ON inx.doc_id = ed.doc_id)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
       CASE WHEN greatest(a, e) = 0 THEN 1.0 WHEN CAST(ei AS DOUBLE) / (a + e - ei) >= {FLOOR} THEN CAST(ei AS DOUBLE) / (a + e - ei) ELSE 0.0 END AS near_edited,
       CASE WHEN greatest(a, x) = 0 THEN 1.0 WHEN CAST(xi AS DOUBLE) / (a + x - xi) >= {FLOOR} THEN CAST(xi AS DOUBLE) / (a + x - xi) ELSE 0.0 END AS near_next
FROM al
"""
