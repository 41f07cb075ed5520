import random

import pytest

from factmill.operators import mention_index as mi
from factmill.operators import mentions as mt

LONG = "a very long name of a company, " * 5


def frames(spark, texts, aliases):
    items = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "item_id string, text string")
    return items, mt.load_aliases(spark.createDataFrame(aliases, "symbol string, aliases string"))


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_equals_the_scan_on_any_alias_and_text(spark):
    r = random.Random(3)
    words = ["".join(r.choices("abkis.é-σ", k=r.randrange(1, 7))) for _ in range(150)]
    aliases = [(f"s{i}", f"{w}|{w} {words[i - 1]}") for i, w in enumerate(words)]
    texts = ["".join(r.choice([*words, " ", " $", "$", "K", "İ", "ſ", "Σ", "ς", "x", "\U0001f600", "\n"]) for _ in range(r.choice((8, 60, 200)))) for _ in range(40)]
    items, loaded = frames(spark, texts, aliases)
    wanted = rows(mt.mentions(items, loaded))
    assert rows(mi.indexed_mentions(items, loaded)) == wanted and len(wanted) > 100


@pytest.mark.parametrize("shapes, held", [(mi.SHAPES, mi.BROADCAST_BYTES), (7, 0)])
def test_places_at_the_edges_of_blocks_in_any_number_of_passes(spark, monkeypatch, shapes, held):
    monkeypatch.setattr(mi, "SHAPES", shapes)
    monkeypatch.setattr(mi, "BROADCAST_BYTES", held)
    texts = [" " * n + t for n in range(mi.STRIDE - 14, mi.STRIDE + 6) for t in ("$F,", "x$F", "$brk.b", "$$brk.b", "Name Of It", "f150")]
    items, loaded = frames(spark, texts, [("F", "F"), ("BRK.B", "BRK.B"), ("NOI", "name of it|other name|1"), ("UNSEEN", "not there at all"), ("O", "\U0001f600")])
    wanted = rows(mt.mentions(items, loaded))
    assert rows(mi.indexed_mentions(items, loaded)) == wanted and len({s for _, s in wanted}) == 3


def test_long_aliases_are_found_whole_only(spark):
    broken = LONG[:70] + "x" + LONG[71:]
    texts = [LONG.upper(), "y" * 99 + LONG + "y", broken, broken + LONG[:80], LONG[:64] + " " + LONG[64:], LONG * 2]
    items, loaded = frames(spark, texts, [("LNG", LONG.strip().replace(",", ";")), ("PLAIN", "company")])
    items = items.selectExpr("item_id", "replace(text, ',', ';') text")
    wanted = rows(mt.mentions(items, loaded))
    assert rows(mi.indexed_mentions(items, loaded)) == wanted and [i for i, s in wanted if s == "LNG"] == ["0", "1", "5"]


def test_odd_rows(spark):
    items = spark.createDataFrame([("1", None, 1), ("2", "", 2), (None, "abc", 3), ("4", "ABC", 4), ("4", "ABC", 4)], "item_id string, text string, symbol int")
    _, loaded = frames(spark, [], [("ABC", ""), ("ABC", "abc|abc")])
    assert sorted(mi.indexed_mentions(items, loaded).collect(), key=str) == [("4", "ABC"), ("4", "ABC"), (None, "ABC")]
    assert mi.indexed_mentions(items.limit(0), loaded).collect() == []
    assert mi.indexed_mentions(items, loaded.limit(0)).collect() == []


def test_ten_thousand_aliases_and_no_text_in_a_shuffle(spark):
    r = random.Random(5)
    names = [f"{r.choice('bcdfg')}{r.choice('aeiou')}{i:05d}" for i in range(10_000)]
    texts = [" ".join(r.choice(names) + r.choice(("", "x", ".", " inc")) for _ in range(30)) for _ in range(50)]
    items, loaded = frames(spark, texts, [(f"s{i}", f"{n}|{n} inc") for i, n in enumerate(names)])
    found = mi.indexed_mentions(items, loaded)
    wanted = rows(mt.mentions(items, loaded))
    assert rows(found) == wanted and len(wanted) > 500
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    shuffled = [line for line in plan.split("Final Plan")[-1].splitlines() if "Exchange hash" in line]
    assert shuffled and all("hashpartitioning(text_key" in line or "_text_key" in line or "_found_in" in line for line in shuffled)


@pytest.mark.parametrize("held", [mi.BROADCAST_BYTES, 3000, 0])
def test_words_are_found_whether_they_are_broadcast_or_not(spark, monkeypatch, held):
    """Only words too rare to be broadcast are shuffled; the rows are the scan's."""
    monkeypatch.setattr(mi, "BROADCAST_BYTES", held)
    texts = ["$one two, one", "two $$three Three", "a$one", "four-five $f $$f", "one two three four five six", "", "six.", "six."]
    items, loaded = frames(spark, texts, [(w, w) for w in ("one", "two", "four", "five")] + [("many", "three|six|four"), ("f", "f"), *((f"x{i}", "") for i in range(40))])
    wanted = rows(mt.mentions(items, loaded))
    found = mi.indexed_mentions(items, loaded)
    assert rows(found) == wanted and len(wanted) > 10
    assert {len(bytes(r[0])) for r in items.where("text <> ''").select(mi._text_key()).collect()} == {16}
