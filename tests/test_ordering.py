"""Global places and digest trees against plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from factmill.operators import ordering as od
from factmill.operators import tracker as tr

ROWS = "score long, name string, n int"


def sample(n, scores, seed=1):
    r = random.Random(seed)
    return [(r.choice(scores), f"s{r.randrange(10**6):06d}", i) for i in range(n)]


@pytest.mark.parametrize("scores", [[1, 2, 3, None], [7]])
def test_places(spark, scores):
    rows = sample(3000, scores)
    got = od.placed(spark.createDataFrame(rows, ROWS).repartition(5), [F.col("score").desc_nulls_last(), F.col("name"), F.col("n")]).collect()
    order = sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0), x[1], x[2]))
    assert [tuple(r)[:3] for r in sorted(got, key=lambda r: r.place)] == order and sorted(r.place for r in got) == list(range(1, 3001))
    assert od.placed(spark.createDataFrame([], ROWS), [F.col("n")]).collect() == []


def test_equal_rows_get_places_of_their_own(spark):
    got = od.placed(spark.createDataFrame([(1, "a", 1)] * 50 + [(0, "b", 2)], ROWS), [F.col("score")]).collect()
    assert sorted(r.place for r in got) == list(range(1, 52)) and next(r.place for r in got if r.score == 0) == 1


def test_one_score_is_many_ranges(spark, monkeypatch):
    """A tracker whose rows all share one score is sorted by several tasks, none of which gets most of them."""
    seen = []
    monkeypatch.setattr(od, "written", lambda df, label, put=od.written: seen.append(put(df, label)) or seen[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        watch = spark.createDataFrame([(f"s{i:05d}", "n", "other", "", "", "") for i in range(4000)], "symbol string, name string, bucket string, research_status string, thesis string, source_url string")
        events = spark.createDataFrame([], "event_id string, event_date date, symbol string, event_type string, confidence string")
        got = tr.ranked(tr.build_tracker(watch, events)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r.symbol for r in sorted(got, key=lambda r: r.tracker_rank)] == [f"s{i:05d}" for i in range(4000)]
    sizes = [r["count"] for r in seen[0].groupBy(F.shiftright("_at", 33)).count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 2000


def tree(lines, fan):
    """(level, node, first, rows, digest) in plain Python."""
    hashed, out, level = [(i + 1, 1, hashlib.sha256(x.encode()).hexdigest()) for i, x in enumerate(lines)], [], 0
    while hashed:
        hashed = [(part[0][0], sum(p[1] for p in part), hashlib.sha256("".join(p[2] for p in part).encode()).hexdigest()) for part in (hashed[k : k + fan] for k in range(0, len(hashed), fan))]
        out += [(level, i, *h) for i, h in enumerate(hashed)]
        if len(hashed) == 1:
            break
        level += 1
    return out


@pytest.mark.parametrize(("n", "fan"), [(500, 7), (64, 8), (3, 8), (1, 2), (0, 2)])
def test_tree_is_stable_and_exact(spark, n, fan):
    rows = sample(n, [1, 2])
    wanted = tree([f"{s}|{name}" for s, name, _ in sorted(rows)], fan)
    df = spark.createDataFrame(rows, ROWS)
    for dealt in (df, df.repartition(7, "name")):
        got = od.digest_tree(dealt, [F.col("score"), F.col("name"), F.col("n")], F.concat_ws("|", "score", "name"), fan)
        assert sorted(map(tuple, got.collect())) == sorted(wanted)


def test_changed_rows_are_located(spark):
    rows = [(i, f"r{i}", i) for i in range(300)]
    build = lambda some: od.digest_tree(spark.createDataFrame(some, ROWS), [F.col("score")], F.col("name"), 5)
    a = build(rows)
    assert od.differing_ranges(a, build(rows), 5).collect() == []
    changed = [(s, "x" if s in (0, 123, 299) else name, n) for s, name, n in rows]
    assert sorted(map(tuple, od.differing_ranges(a, build(changed), 5).collect())) == [(1, 5, 5), (121, 5, 5), (296, 5, 5)]
    assert sorted(map(tuple, od.differing_ranges(a, build(rows[:-1]), 5).collect())) == [(296, 5, 4)]
    assert sorted(r.first for r in od.differing_ranges(a, build(rows[:20]), 5).collect())[0] == 21
