"""The pipeline's stages on a small corpus with planted cases."""

import random

import corpus_pipeline
from pyspark.sql import functions as F

from factmill.llm.tokens import vocabulary_path


def test_stages(spark, tmp_path):
    r = random.Random(1)
    syllables = ["ta", "mo", "ri", "ku", "se", "no", "pal", "ver"]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randrange(2, 5)))
    text = lambda n: " ".join(word() for _ in range(n))
    item = text(20)
    docs, labels = [], []
    for i in range(300):
        toxic = i % 6 == 0
        docs.append((i, text(900 if i == 1 else 60) + (" vile you scumbag indeed" if toxic else ""), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    near = docs[1][1]
    docs += [(400, near, "en", "s", 0), (401, near + " end", "en", "s", 0), (402, text(30) + " " + item + " " + text(30), "en", "s", 0), (403, text(30) + " write to ann@mail.example.com " + text(30), "en", "s", 0), (404, None, "en", "s", None), (None, text(50), None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    given, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        given = corpus_pipeline.materialize(stage(spark, given, str(tmp_path)), name)
        kept[name] = given.collect()
        if name != "packing":
            assert given.columns == [c.split()[0] for c in schema.split(", ")]
    ids = {name: {r.doc_id for r in rows} for name, rows in kept.items()}
    clean = {i for i in range(300) if i % 6}
    assert ids["toxicity"] == clean | {400, 401, 402, 403, 404, None}
    assert ids["simhash_near_dedup"] == clean | {402, 403, 404, None}
    assert ids["decontamination"] == clean | {403, 404, None} == ids["pii"] == ids["packing"]
    changed = next(r for r in kept["pii"] if r.doc_id == 403)
    assert "ann@mail" not in changed.text and changed.n_chars == len(changed.text)
    assert {(r.doc_id, r.start, r.length) for r in kept["packing"]} == {(r.doc_id, r.start, r.length) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert vocabulary_path()


def test_verdicts_go_by_row(spark, tmp_path):
    r = random.Random(2)
    text = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    item, near, own = text(20), text(900), [text(60) for _ in range(4)]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    leak, clean = f"{own[0]} {item}", own[1]
    # a leak and near copies without ids; one id for a clean text, a near copy and a leak; a row twice
    rows = [(None, leak), (None, near + " end"), (None, near), (5, near), (7, clean), (7, near), (7, leak + " more"), (8, own[2]), (8, own[2]), (None, own[3]), (None, own[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    unique = corpus_pipeline.materialize(corpus_pipeline.simhash_near_dedup(spark, docs, str(tmp_path)), "unique")
    wanted = {(5, near), (7, clean), (8, own[2]), (None, own[3])}
    got = [(x.doc_id, x.text) for x in unique.collect()]
    assert wanted <= set(got) and len(got) == len(set(got)) and not {t for i, t in got if (i, t) != (5, near)} & {near, near + " end"}
    left = corpus_pipeline.decontamination(spark, docs.where("doc_id is null or doc_id = 7"), str(tmp_path)).collect()
    assert not [x for x in left if item in x.text] and len(left) == 6


ODD = [(1, "one two three four five six seven eight nine ten eleven"), (1, "write to ann@mail.example.com"), (2, ""), (3, None), (None, "another text with other words"), (4, "write to bob@mail.example.com"), (4, "write to bob@mail.example.com"), (5, " \n\t "), (6, "lorem ipsum dolor sit amet " * 20_000)]
CLASH = ("gone", "again", "row_name", "new_text", "_null", "absent", "attempts", "name", "first", "n_entities", "n_distinct", "kept_n_entities", "component", "th", "w", "n", "score", "fp", "start", "length", "rank", "class")


def test_stages_on_odd_rows(spark, tmp_path):
    """Nulls, empty and very long texts, repeated rows and clashing columns: nothing is lost but what a stage is for."""
    spark.createDataFrame([(1, "two three four five six seven eight nine ten eleven"), (None, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(1, 0, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.createDataFrame(ODD, "doc_id long, text string").withColumns({c: F.lit(7) for c in CLASH}).withColumn("n_chars", F.length("text"))
    stage = dict(corpus_pipeline.STAGES)
    rows = lambda name, given=docs: corpus_pipeline.materialize(stage[name](spark, given, str(tmp_path)), "odd")
    every = sorted(map(repr, docs.select("doc_id", "text").collect()))
    for name in ("toxicity", "simhash_near_dedup", "decontamination", "pii"):
        out = rows(name)
        assert out.columns == docs.columns and all(r[c] == 7 for r in out.collect() for c in CLASH)
        assert rows(name, docs.limit(0)).count() == 0
        left = sorted(map(repr, out.select("doc_id", "text").collect()))
        if name == "toxicity":
            assert left == every
        elif name == "decontamination":
            assert left == [r for r in every if "seven" not in r]
        elif name == "simhash_near_dedup":
            assert len(left) == len(set(left)) and {r.doc_id for r in out.collect()} >= {None, 1, 4, 6} and not {3, 5} & {r.doc_id for r in out.collect()}
        else:
            assert len(left) == len(every) and all(r.n_chars == len(r.text) for r in out.collect() if r.text is not None) and not any("@mail.example.com" in r and ("ann" in r or "bob" in r) for r in left)
    packed = rows("packing").collect()
    assert len([r for r in packed if r.start == 0]) == len(ODD) and rows("packing", docs.limit(0)).count() == 0
