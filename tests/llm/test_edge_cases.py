"""Every operator on empty tables, nulls in all columns, empty and very long texts, ties, repeated rows and clashing extra columns."""

import hashlib
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from factmill.llm import class_ngrams, decontamination, html_extraction, packing, pii, sharding, simhash, token_files, toxicity, vector_graph
from factmill.llm.tokens import vocabulary_path

LONG = "lorem ipsum dolor sit amet " * 20_000
TEXTS = [(1, "one two three four five six seven eight nine ten eleven"), (2, ""), (3, None), (None, "one two three"), (4, "one two three"), (4, "one two three"), (5, " \n\t "), (6, LONG)]
#: Names that the operators use inside.
CLASH = ("row", "n_entities", "n_distinct", "n", "h", "w", "fp", "a", "b", "u", "v", "shard", "node", "class", "score", "text_crc32", "_id", "word", "k", "part", "n_entities", "attempts", "label", "th", "items", "rows", "component", "least", "key", "new_text", "_null", "absent", "attempts", "replaced", "gone", "again", "row_name", "_gone", "_again", "_name", "name", "spans", "s_doc", "h", "i", "start", "wid", "kept_n_distinct", "_absent")


def documents(spark, rows=TEXTS, clash=True):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({c: F.lit(7) for c in dict.fromkeys(CLASH)}) if clash else df


BENCH = "item_id long, text string"
LABELS = "doc_id long, quality int, toxic int"


def operators(spark):
    bench = spark.createDataFrame([(1, "two three four five six seven eight nine ten eleven"), (2, "one two"), (3, None), (None, "")], BENCH)
    labels = spark.createDataFrame([(1, 0, 0), (4, 0, 1), (None, None, None), (5, 1, None)], LABELS)
    return {
        "toxicity": lambda d: toxicity.score_documents(d, toxicity.fit(d, labels)),
        "decontamination": lambda d: decontamination.contamination(d, bench),
        "class_ngrams": class_ngrams.score_documents,
        "pii": lambda d: pii.pseudonymize(d, b"k"),
        "pii by shuffle": lambda d: pii.pseudonymize(d, b"k", broadcast_rows=-1),
        "simhash": simhash.near_duplicates,
        "tokens": lambda d: token_files.count_tokens(d, vocabulary_path()),
        "sharding": sharding.shard_documents,
        "packing": lambda d: packing.pack(d, vocabulary_path()),
    }


NAMES = ["toxicity", "decontamination", "class_ngrams", "pii", "pii by shuffle", "simhash", "tokens", "sharding", "packing"]


def simhash_of(text):
    words = (text or "").split()
    shingles = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    votes = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in shingles]
    return f"{sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in votes) > len(votes)):016x}"


def digest(items):
    return hashlib.sha256(items.encode()).hexdigest()


#: What each row of TEXTS must give, by its text alone.
WORDS = {text: len((text or "").split()) for _, text in TEXTS}
HITS = {TEXTS[0][1]: (11, 2, "1,2"), "one two three": (2, 1, "2")}
VALUES = {
    "toxicity": (lambda r: (0 <= r.score <= 1, r.predicted), lambda t: (True, 0)),
    "decontamination": (lambda r: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated), lambda t: (WORDS[t], *HITS.get(t, (0, 0))[:2], digest(HITS.get(t, (0, 0, ""))[2]), t in HITS)),
    "class_ngrams": (lambda r: (r.n_tokens, r.train_tokens), lambda t: (WORDS[t] + 1, 15)),
    "pii": (lambda r: (r.text, r.n_entities, r.n_distinct), lambda t: (t, 0, 0)),
    "simhash": (lambda r: r.fingerprint, simhash_of),
    "sharding": (lambda r: (r.size, r.text_crc32), lambda t: (len(t or "") + 16, zlib.crc32((t or "").encode()))),
}
VALUES["pii by shuffle"] = VALUES["pii"]


@pytest.mark.parametrize("name", sorted(VALUES))
def test_values_of_odd_rows(spark, name):
    of_row, of_text = VALUES[name]
    got = sorted(((r.doc_id or 0, of_row(r)) for r in operators(spark)[name](documents(spark)).collect()), key=repr)
    assert got == sorted(((i or 0, of_text(t)) for i, t in TEXTS), key=repr)


def test_tokens_of_odd_rows(spark):
    from tokenizers import Tokenizer

    of = Tokenizer.from_file(vocabulary_path())
    wanted = sorted((i or 0, len(of.encode(t or "", add_special_tokens=False).ids)) for i, t in TEXTS)
    assert sorted((r.doc_id or 0, r.n_tokens) for r in operators(spark)["tokens"](documents(spark)).collect()) == wanted
    pieces = operators(spark)["packing"](documents(spark)).collect()
    assert sorted((r.doc_id or 0, r.doc_tokens - 1) for r in pieces if r.start == 0) == wanted
    assert sum(r.length for r in pieces) == sum(n + 1 for _, n in wanted)


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(spark, name):
    rows = operators(spark)[name](documents(spark)).collect()
    if name == "packing":
        rows = [r for r in rows if r.start == 0]
    assert len(rows) == len(TEXTS)
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == [1, 2, 3, 4, 4, 5, 6]


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, name):
    assert operators(spark)[name](documents(spark, [])).collect() == []


def test_pages_odd_rows(spark):
    rows = [(1, "https://a/x", "<html><body><article><p>Some text &amp; more</p></article></body></html>"), (2, None, None), (3, "odd", ""), (None, "https://a/y", "plain text, no tags"), (4, "https://a/z", "<div" * 500), (4, "https://a/z", "<p>" + "x " * 50_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("host", "path", "votes", "text", "r")})
    got = {r.page_id: (r.text, r.n_chars) for r in html_extraction.extract_pages(pages).collect()}
    assert got[1] == ("Some text & more", 16) and got[2] == ("", 0) and got[3] == ("", 0) and got[None][0] == "plain text, no tags"
    assert html_extraction.extract_pages(pages.limit(0)).count() == 0


def test_vectors_odd_rows(spark):
    inf = float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [0.0, 0.0], 1), (5, None, 1), (6, [1.0, None], 1), (7, [inf, 0.0], 1), (8, [1.0, 0.0], None), (None, [1.0, 0.0], 1), (9, [], 1), (10, [1.0, 0.0, 0.0], 1), (11, [0.0, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({c: F.lit(1) for c in ("node", "group", "n", "mult", "cluster", "least")})
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in vector_graph.near_vectors(df).collect()), key=str)
    wanted = [(1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), (None, 0, None, False), *[(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11)]]
    assert got == sorted(wanted, key=str)
    assert vector_graph.near_vectors(df.limit(0)).count() == 0
