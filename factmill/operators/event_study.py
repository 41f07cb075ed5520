"""Event study: returns over trading-day windows after events, against a benchmark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from factmill.functions.text import empty_as_null, percent_return, six_decimals, strict_date


def parse_windows(value: str | Sequence[int]) -> list[int]:
    """Window lengths in trading days: at least one, none negative."""
    parts = value.split(",") if isinstance(value, str) else list(value)
    windows = [int(p) for p in parts if str(p).strip()]
    if not windows or min(windows) < 0:
        raise ValueError("windows must be non-negative integers")
    return windows


def load_prices(raw: DataFrame, precedence: Sequence[Column]) -> DataFrame:
    """symbol, date, close from raw rows with ``date`` or ``as_of``; of equal (symbol, date) the last by ``precedence`` wins.

    A row with neither date, or one that is no date, fails the job.
    """
    have = [empty_as_null(F.btrim(F.col(c).cast("string"))) for c in ("date", "as_of") if c in raw.columns]
    day = F.coalesce(*have) if have else F.lit(None).cast("string")
    day = F.coalesce(strict_date(day), F.raise_error(F.lit("price row without a valid date or as_of")).cast("date"))
    rows = raw.withColumns({"_day": day, "_symbol": F.upper(F.btrim("symbol"))})
    return last_wins(rows.withColumns({"date": F.col("_day"), "symbol": F.col("_symbol")}), precedence).select("symbol", "date", F.col("close").cast("double").alias("close"))


def last_wins(prices: DataFrame, precedence: Sequence[Column]) -> DataFrame:
    """One row of each (symbol, date): the greatest by ``precedence``. Partial maxima are combined before the shuffle."""
    rest = [c for c in prices.columns if c not in ("symbol", "date")]
    best = F.max_by(F.struct(*rest), F.struct(*precedence))
    return prices.groupBy("symbol", "date").agg(best.alias("r")).select("symbol", "date", "r.*")


def trading_calendar(prices: DataFrame, windows: Sequence[int]) -> DataFrame:
    """Prices with ``later``: for each window the (k, date, close) that many trading days on, null past the end."""
    order = W.partitionBy("symbol").orderBy("date")
    later = [F.struct(F.lit(k).alias("k"), F.lead(F.struct("date", "close"), k).over(order).alias("at")) for k in windows]
    return prices.withColumn("later", F.array(*later))


def first_trading_day(events: DataFrame, priced: DataFrame) -> DataFrame:
    """Forward as-of join: each distinct (symbol, event_date) with the first priced day on or after it (null: none).

    Both sides meet in one shuffle by symbol and a running window; event days are made distinct first, so many events
    on a symbol do not widen its partition.
    """
    days = events.select("symbol", F.col("event_date").alias("date")).distinct()
    kind = priced.select(F.struct(*[c for c in priced.columns if c != "symbol"]).alias("p")).schema["p"].dataType
    both = days.select("symbol", "date", F.lit(None).cast(kind).alias("p")).union(priced.select("symbol", "date", F.struct(*[c for c in priced.columns if c != "symbol"]).alias("p")))
    running = W.partitionBy("symbol").orderBy(F.desc("date"), F.col("p").isNotNull().desc()).rowsBetween(W.unboundedPreceding, 0)
    found = both.withColumn("base", F.last("p", ignorenulls=True).over(running)).where("p is null")
    return found.select(F.col("symbol").alias("b_symbol"), F.col("date").alias("b_date"), "base")


def event_returns(events: DataFrame, prices: DataFrame, windows: Sequence[int] = (1, 5, 20), benchmark: str = "SPY") -> DataFrame:
    """One row for each event and window that has a base and an exit day; benchmark columns null where it has no price.

    ``events``: event_id, event_date, symbol, event_type; ``prices``: unique (symbol, date), close.
    """
    windows = parse_windows(windows)
    base = first_trading_day(events, trading_calendar(prices, windows)).where("base is not null")
    spread = base.select("b_symbol", "b_date", F.col("base.date").alias("base_date"), F.col("base.close").alias("base_close"), F.inline("base.later"))
    spread = spread.where("at is not null").select("b_symbol", "b_date", "base_date", "base_close", F.col("k").alias("window_days"), F.col("at.date").alias("exit_date"), F.col("at.close").alias("exit_close"))
    level = prices.where(F.col("symbol") == benchmark).select(F.col("date").alias("l_date"), F.col("close").alias("l_close"))
    out = spread.join(level.select(F.col("l_date").alias("d0"), F.col("l_close").alias("c0")), F.col("base_date") == F.col("d0"), "left")
    out = out.join(level.select(F.col("l_date").alias("d1"), F.col("l_close").alias("c1")), F.col("exit_date") == F.col("d1"), "left")
    out = out.join(events, (F.col("symbol") == F.col("b_symbol")) & (F.col("event_date") == F.col("b_date")))
    own, market = percent_return(F.col("base_close"), F.col("exit_close")), F.when(F.col("c0").isNotNull() & F.col("c1").isNotNull(), percent_return(F.col("c0"), F.col("c1")))
    return out.select(
        "event_id", "event_date", "symbol", "event_type", "window_days", "base_date", "exit_date", "base_close", "exit_close", own.alias("return_pct"),
        F.lit(benchmark).alias("benchmark_symbol"), market.alias("benchmark_return_pct"), (own - market).alias("abnormal_return_pct"),
    )


def coverage_gaps(events: DataFrame, prices: DataFrame) -> DataFrame:
    """Events without a priced day on or after them."""
    base = first_trading_day(events, prices).where("base is not null")
    return events.join(base, (F.col("symbol") == F.col("b_symbol")) & (F.col("event_date") == F.col("b_date")), "left_anti")


def shown(returns: DataFrame) -> DataFrame:
    """The rows as text for a file: six decimals, empty for missing."""
    numbers = ("base_close", "exit_close", "return_pct", "benchmark_return_pct", "abnormal_return_pct")
    return returns.withColumns({c: F.coalesce(six_decimals(F.col(c)), F.lit("")) for c in numbers})
