"""Published files: all or nothing; and small functions that other tests pass by."""

import datetime

import pytest
from pyspark.sql import functions as F

from factmill.operators import event_study as es
from factmill.operators import feeds as fd
from factmill.operators import mentions as mt
from factmill.operators import quality as ql
from factmill.sources import files
from factmill.streaming import intake


def lines(folder):
    return [x for p in sorted(folder.glob("part-*")) for x in p.read_text().splitlines()]


def test_a_failing_task_leaves_the_old_files(spark, tmp_path):
    out = tmp_path / "rows"
    good = spark.range(100).select(F.col("id").cast("string").alias("value"))
    files.write_json_rows(good, str(out), "value")
    before = sorted(lines(out))
    assert before == sorted(map(str, range(100)))
    bad = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") == 900, F.raise_error(F.lit("broken row")).cast("string")).otherwise("new").alias("value"))
    with pytest.raises(Exception, match="broken row"):
        files.write_json_rows(bad, str(out), "value")
    assert sorted(lines(out)) == before and [p.name for p in tmp_path.iterdir()] == ["rows"]
    files.write_json_rows(bad.limit(0), str(out), "value")
    assert lines(out) == [] and [p.name for p in tmp_path.iterdir()] == ["rows"]


def test_parts_keep_the_order(spark, tmp_path):
    rows = spark.range(0, 5000, 1, 8).select(F.format_string("%05d", 4999 - F.col("id")).alias("k"))
    files.write_rows(rows.orderBy("k"), f"file:{tmp_path}/rows", ["k", "none"])
    found = [x for x in lines(tmp_path / "rows") if x != "k,none"]
    assert found == [f"{i:05d}," for i in range(5000)]


def test_shown_returns(spark):
    schema = "event_id string, base_close double, exit_close double, return_pct double, benchmark_return_pct double, abnormal_return_pct double"
    row = es.shown(spark.createDataFrame([("e", 1.0, 2.5, 12.3456789, None, -0.0000004)], schema)).first()
    assert (row.return_pct, row.benchmark_return_pct, row.base_close, row.abnormal_return_pct) == ("12.345679", "", "1.000000", "-0.000000")


def test_shown_returns_are_rounded_by_their_exact_values(spark):
    """Ties to even and shortest decimals that look like ties, as Python and the SQL's printf write them."""
    values = [0.1953125, -0.1953125, 0.5859375, 12029.9140625, 0.1234565, 12.3456785, 5e-07, -5e-07, 0.9999995, 1.9999999, -0.0, 1e-9, 84197.04, 4294967296.0000005, 2.0**60]
    names = ("base_close", "exit_close", "return_pct", "benchmark_return_pct", "abnormal_return_pct")
    got = es.shown(spark.createDataFrame([(v,) * 5 for v in values] + [(None,) * 5], ", ".join(f"{n} double" for n in names))).collect()
    assert [set(r) for r in got] == [{f"{v:.6f}"} for v in values] + [{""}]


def test_dates_of_matched_items_only(spark):
    items = spark.createDataFrame([("1", "2026-01-09T00:00:00Z", "$F up"), ("2", "soon", "$F up"), ("3", "never", "nothing")], "item_id string, published_at string, text string")
    items = items.withColumns({"source_type": F.lit("financial_media"), "source_url": F.lit("https://x"), "author": F.lit(None).cast("string")})
    aliases = mt.load_aliases(spark.createDataFrame([("F", "F")], "symbol string, aliases string"))
    assert [tuple(r) for r in mt.item_dates_invalid(items, aliases).collect()] == [("2-f", "soon")]


def test_first_items_and_frequencies(spark):
    items = spark.createDataFrame([("a", i) for i in (3, 1, 2)] + [("b", 9)], "feed_id string, pos int")
    assert sorted(map(tuple, fd.first_items(items, 2).collect())) == [("a", 1), ("a", 2), ("b", 9)] and fd.first_items(items, 0).count() == 0
    events = spark.createDataFrame([("high",), (" ",), (None,), ("high",), ("low",)], "confidence string")
    assert ql.frequency_map(events, "confidence").first().counts == {"high": 2, "low": 1, "unknown": 2}
    assert ql.frequency_map(events.limit(0), "confidence").first().counts == {}


def test_weekly_tumbling_weeks_begin_on_mondays(spark):
    rows = [(datetime.datetime(2026, 1, 4, 23, 59), "x"), (datetime.datetime(2026, 1, 5), "x"), (datetime.datetime(2026, 1, 11, 23), "x"), (datetime.datetime(2026, 1, 8), "y")]
    got = intake.weekly_tumbling(spark.createDataFrame(rows, "ts timestamp, k string"), "ts", ["k"]).collect()
    assert sorted((str(r.period_start), r.k, r.events) for r in got) == [("2025-12-29", "x", 1), ("2026-01-05", "x", 2), ("2026-01-05", "y", 1)]
