import datetime

import pytest
from pyspark.sql import functions as F

from factmill.operators import event_study as es

D = datetime.date


def frames(spark):
    prices = [("A", D(2026, 1, 5), 100.0), ("A", D(2026, 1, 6), 110.0), ("A", D(2026, 1, 7), 121.0), ("SPY", D(2026, 1, 5), 200.0), ("SPY", D(2026, 1, 6), 202.0)]
    events = [("e1", D(2026, 1, 3), "A", "public_mention"), ("e2", D(2026, 1, 8), "A", "public_mention"), ("e3", D(2026, 1, 5), "B", "public_mention"), ("e4", D(2026, 1, 5), "A", "procurement")]
    return spark.createDataFrame(events, "event_id string, event_date date, symbol string, event_type string"), spark.createDataFrame(prices, "symbol string, date date, close double")


def test_returns(spark):
    rows = {(r.event_id, r.window_days): r for r in es.event_returns(*frames(spark), [0, 1, 2]).collect()}
    assert set(rows) == {("e1", 0), ("e1", 1), ("e1", 2), ("e4", 0), ("e4", 1), ("e4", 2)}
    one = rows["e1", 1]
    assert one.base_date == D(2026, 1, 5) and one.return_pct == pytest.approx(10) and one.benchmark_return_pct == pytest.approx(1) and one.abnormal_return_pct == pytest.approx(9)
    assert rows["e1", 2].return_pct == pytest.approx(21) and rows["e1", 2].benchmark_return_pct is None and rows["e1", 2].abnormal_return_pct is None
    assert rows["e1", 0].return_pct == 0


def test_gaps(spark):
    assert sorted(r.event_id for r in es.coverage_gaps(*frames(spark)).collect()) == ["e2", "e3"]


def test_prices(spark):
    raw = spark.createDataFrame([("2026-01-05", "", "a", "1", 1), ("", "2026-01-05", "A", "2", 2)], "date string, as_of string, symbol string, close string, seq int")
    assert [tuple(r) for r in es.load_prices(raw, [F.col("seq")]).collect()] == [("A", D(2026, 1, 5), 2.0)]
    with pytest.raises(Exception, match="without a valid date"):
        es.load_prices(spark.createDataFrame([("", "", "A", "1", 1)], raw.schema), [F.col("seq")]).collect()


def test_windows():
    assert es.parse_windows("1, 5") == [1, 5]
    for bad in ("", "-1"):
        with pytest.raises(ValueError):
            es.parse_windows(bad)


def test_zero_price_fails(spark):
    events, prices = frames(spark)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        es.event_returns(events, prices.withColumn("close", F.lit(0.0)), [1]).collect()
