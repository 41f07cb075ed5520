"""Spot signatures against plain Python."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from factmill.llm import spot_signatures as ss

SCHEMA = "doc_id long, text string"


def spots(text):
    common = set(ss.ANCHORS)
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    chains = {" " + " ".join(c[:n]) + " " for c in [[w for w in words if w not in common]] for n in (1, 2) if len(c) >= n}
    after = []
    for w in reversed(words):
        if w in common and len(after) == 2:
            chains.add(" ".join([w, *after]) + " ")
        elif w not in common:
            after = [w, *after][:2]
    return {hashlib.md5(c.encode()).hexdigest()[: ss.DIGITS] for c in chains}


def alike(a, b):
    j = len(a & b) / len(a | b) if a or b else 1.0
    return j if j >= ss.FLOOR else 0.0


def brute(rows):
    """Rows of the result; ids are distinct and not null."""
    order = sorted(((i, t or "") for i, t in rows), reverse=True)
    out = {}
    for k, (i, text) in enumerate(order):
        after, n = order[(k + 1) % len(order)][1], len(text)
        edited = text[: n - n // 3] + after[: n // 3]
        own, other, nxt = spots(text), spots(edited), spots(after)
        out[i] = (n, hashlib.sha256(edited.encode()).hexdigest(), "".join(sorted(own)), "".join(sorted(other)), alike(own, other), alike(own, nxt))
    return out


def sample(seed, n):
    r = random.Random(seed)
    vocabulary = [*ss.ANCHORS[:12], *(f"Wört{k}" for k in range(40)), "été", "the,", "\n", "- -", "\U0001f600x", "12"]
    return [" ".join(r.choices(vocabulary, k=r.choice((0, 1, 2, 3, 30, 400)))) for _ in range(n)]


@pytest.mark.parametrize("partitions", [1, 7])
def test_against_brute_force(spark, partitions):
    rows = [(7 * i - 50, t) for i, t in enumerate([*sample(2, 60), None, "", "the of and", "one", "one two", "The quick brown fox", "of the quick brown fox jumps over the lazy dog " * 3000])]
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions).withColumns({c: F.lit(1) for c in ("k", "at", "asker", "take", "times", "head", "_marked", "_spots", "n", "next_set", "range", "last", "to")})
    got = {r.doc_id: tuple(r)[1:] for r in ss.fingerprints(df).collect()}
    assert got == brute(rows)


def test_equal_texts_and_edits(spark):
    rows = [(i, t) for i, t in enumerate(sample(9, 40) * 2)]
    got = ss.fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()
    by_text = {}
    for r in got:
        by_text.setdefault(rows[r.doc_id][1], set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())


def test_repeats_nulls_and_small_tables(spark):
    rows = [(1, "the red house stands here"), (1, "the red house stands here"), (1, "on a hill far away"), (None, "in the deep blue sea"), (None, None), (2, "a song of ice and fire")]
    got = sorted(map(tuple, ss.fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert len(got) == len(rows) and [g[0] for g in got] == [1, 1, 1, 2, None, None] and got[0][1:3] != got[2][1:3]
    assert len({g for g in got if g[0] == 1}) == 2
    (one,) = ss.fingerprints(spark.createDataFrame([(5, "the only text here")], SCHEMA)).collect()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"the only texthe on").hexdigest()
    assert ss.fingerprints(spark.createDataFrame([], SCHEMA)).collect() == []


def test_lengths_prune_only_what_is_less_alike(spark):
    sizes = [(a, b) for a in (0, 1, 2, 49, 50, 51, 2500, 2501) for b in (0, 1, 3, 50, 149, 2600)]
    df = spark.createDataFrame([(list(map(str, range(a))), list(map(str, range(b)))) for a, b in sizes], "a array<string>, b array<string>")
    got = [r[0] for r in df.select(ss.likeness(F.col("a"), F.col("b"))).collect()]
    assert got == [alike(set(range(a)), set(range(b))) for a, b in sizes]
