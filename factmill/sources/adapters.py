"""Views of the star-schema, documents and pages tables as prices, events, watchlist, items, records, payloads and outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Documents of one feed payload.
FEED_SIZE = 10
SOURCE_TYPES = ("government_filing", "official_remarks", "financial_media", "issuer_release", "government_policy", "regulatory_action")
PHRASES = (" Great partner ACM-1 wins.", " New funding for $S7 plants.", " Contract award to Acme Robotics.", " Risk for the partner $F.", " Policy stake in Beta‑Works.", "", " nothing S77X here")
ALIASES = [("ACM", "ACM-1|Acme Robotics"), ("S7", ""), ("F", "F"), ("BETA", "Beta-Works,Beta-Works, "), ("THON", "thon"), ("TION", "tion the|S7")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each line item: symbol, date and the columns that decide between equal days."""
    rows = table(spark, sf_dir, "lineitem")
    return rows.select(F.concat(F.lit("S"), "l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("date"), F.col("l_extendedprice").alias("close"), "l_orderkey", "l_linenumber")


def prices(spark: SparkSession, sf_dir: str, benchmark: str = "SPY", sparse: bool = False) -> DataFrame:
    """Last-wins prices and a benchmark: each day's highest price (sparse: only days whose day number divides by 7)."""
    from factmill.operators.event_study import last_wins

    raw = raw_prices(spark, sf_dir)
    own = last_wins(raw, [F.col("l_orderkey"), F.col("l_linenumber"), F.col("close")]).select("symbol", "date", "close")
    market = raw.groupBy("date").agg(F.max("close").alias("close")).select(F.lit(benchmark).alias("symbol"), "date", "close")
    return own.union(market.where(F.pmod(F.unix_date("date"), F.lit(7)) == 0) if sparse else market)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_of(table(spark, sf_dir, "orders"), spark, sf_dir)


def events_of(orders: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, stored or streamed, as events of as many symbols as there are suppliers."""
    suppliers = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1)).alias("suppliers"))
    rows = orders.crossJoin(F.broadcast(suppliers))  # one row
    kind = F.element_at(F.array(*map(F.lit, ("public_mention", "policy_capital", "procurement", "disclosure_buy", "market_reaction"))), F.substring("o_orderpriority", 1, 1).cast("int"))
    tier = F.when(F.col("o_orderstatus") == "F", "high").when(F.col("o_orderstatus") == "O", "medium").otherwise("low")
    symbol = F.concat(F.lit("S"), F.col("o_custkey") % F.col("suppliers"))
    return rows.select(F.col("o_orderkey").alias("event_id"), F.to_date("o_orderdate").alias("event_date"), symbol.alias("symbol"), kind.alias("event_type"), tier.alias("confidence"))


def watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    bucket = F.element_at(F.array(*map(F.lit, ("named_mentioned", "policy_capital", "disclosed_holding", "drone_policy_watchlist", "other"))), (F.col("s_nationkey") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), "s_suppkey").alias("symbol"), F.col("s_name").alias("name"), bucket.alias("bucket"), F.when(F.col("s_suppkey") % 2 == 0, "").otherwise("researching").alias("research_status"),
        F.lit("").alias("thesis"), F.concat(F.lit("https://issuer.example/"), "s_suppkey").alias("source_url"),
    )


def source_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items_of(table(spark, sf_dir, "documents"))


def items_of(documents: DataFrame) -> DataFrame:
    """Source items of (stored or streamed) documents."""
    kind = F.element_at(F.array(*map(F.lit, SOURCE_TYPES)), (F.col("doc_id") % 6 + 1).cast("int"))
    phrase = F.element_at(F.array(*map(F.lit, PHRASES)), (F.col("doc_id") % 7 + 1).cast("int"))
    host = F.when(F.col("doc_id") % 6 == 2, "https://news.example/").when(F.col("doc_id") % 12 == 3, "http://issuer.example/").when(F.col("doc_id") % 6 == 3, "https://issuer.example/").otherwise("https://agency.gov/")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
    return documents.select(
        F.concat(F.lit("doc-"), "doc_id").alias("item_id"), F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T12:00:00Z")).alias("published_at"), kind.alias("source_type"),
        F.concat(host, "doc_id").alias("source_url"), F.col("source").alias("author"), F.concat(F.coalesce("text", F.lit("")), phrase).alias("text"),
    )


def aliases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ALIASES, "symbol string, aliases string")


def official_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.element_at(F.array(*map(F.lit, (*SOURCE_TYPES, "government_procurement", "blog"))), (F.col("page_id") % 8 + 1).cast("int"))
    event = F.element_at(F.array(*map(F.lit, ("disclosure_buy", "public_mention", "policy_capital", "procurement", "regulatory_action", "market_reaction", "rumour"))), (F.col("page_id") % 7 + 1).cast("int"))
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 300).cast("int")), "yyyy-MM-dd")
    url = F.when(F.col("page_id") % 3 != 1, F.concat(F.lit("https://agency"), "page_id", F.lit(".GOV/notice"))).otherwise(F.col("url"))
    return table(spark, sf_dir, "pages").select(
        F.concat(F.lit(" Page/"), "page_id", F.lit(" !")).alias("record_id"), F.when(F.col("page_id") % 50 == 49, "2024-13-01").otherwise(day).alias("record_date"),
        F.when(F.col("page_id") % 41 == 40, " ").otherwise(F.concat(F.lit("s"), F.col("page_id") % 50)).alias("symbol"), kind.alias("source_type"), event.alias("event_type"),
        F.when(F.col("page_id") % 2 == 0, "").otherwise("bullish").alias("direction"), url.alias("source_url"), F.col("url").alias("summary"),
        F.when(F.col("page_id") % 37 == 36, "rumour").otherwise("issuer").alias("entity_match_type"), F.lit("page").alias("match_evidence"), F.lit("issuer").alias("relationship_type"),
    )


def feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One configured feed for each FEED_SIZE documents."""
    number = F.floor(F.col("doc_id") / FEED_SIZE)
    rows = table(spark, sf_dir, "documents").select(number.alias("n")).distinct()
    return rows.select(F.concat(F.lit("feed-"), "n").alias("feed_id"), F.concat(F.lit("https://feeds.example/"), "n").alias("feed_url"), F.lit("financial_media").alias("source_type"), F.lit("desk").alias("author"))


def feed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RSS payloads of FEED_SIZE documents each, items in order of doc_id.

    Some items have elements of other namespaces before their own, marked-up titles, a guid or nothing in place of the
    link; the first item of every seventeenth feed has a date that is none.
    """
    safe = F.replace(F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int")), "dd MMM yyyy")
    undated = (F.floor(F.col("doc_id") / FEED_SIZE) % 17 == 5) & (F.col("doc_id") % FEED_SIZE == 0)
    link = F.when(F.col("doc_id") % 7 == 3, F.concat(F.lit("<guid>urn:doc:"), "doc_id", F.lit("</guid>"))).when(F.col("doc_id") % 7 == 4, "").otherwise(F.concat(F.lit("<link>https://news.example/"), "doc_id", F.lit("</link>")))
    item = F.concat(
        F.lit("<item>"), F.when(F.col("doc_id") % 4 == 1, "<media:title>another</media:title>").otherwise(""), F.when(F.col("doc_id") % 4 == 2, '<atom:link href="https://other.example/"/>').otherwise(""),
        F.lit("<title>Document "), "doc_id", F.when(F.col("doc_id") % 5 == 2, " &lt;b&gt;of&lt;/b&gt; A &amp;amp; B").otherwise(""), F.lit("</title>"), link,
        F.lit("<pubDate>"), F.when(undated, "not a date").otherwise(F.concat(day, F.lit(" 08:30:00 EST"))), F.lit("</pubDate><description>"), safe, F.lit("</description></item>"),
    )
    rows = table(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / FEED_SIZE).alias("n"), "doc_id", item.alias("item"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "item"))), lambda r: r["item"]), "")  # FEED_SIZE rows
    grouped = rows.groupBy("n").agg(body.alias("items"))
    head = '<rss version="2.0" xmlns:media="http://search.yahoo.com/mrss/" xmlns:atom="http://www.w3.org/2005/Atom"><channel><title>t</title>'
    return grouped.select(F.concat(F.lit("feed-"), "n").alias("feed_id"), F.concat(F.lit(head), "items", F.lit("</channel></rss>")).cast("binary").alias("content"))


def feed_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of feeds of FEED_SIZE documents: every ninth failed, every eleventh quarantined, every thirteenth left with raw control characters."""
    items = source_items(spark, sf_dir)
    number = F.floor(F.substring("item_id", 5, 20).cast("long") / FEED_SIZE)
    rows = items.withColumn("n", number).withColumn("text", F.when(F.col("n") % 13 == 5, F.col("text")).otherwise(F.regexp_replace("text", r"[\x00-\x1f]", " ")))
    fields = ("item_id", "published_at", "source_type", "source_url", "author", "text")
    grouped = rows.groupBy("n").agg(F.collect_list(F.struct(*fields)).alias("all"))  # FEED_SIZE rows
    state = F.when(F.col("n") % 9 == 4, "failed").when(F.col("n") % 11 == 6, "quarantined").otherwise("accepted")
    return grouped.withColumn("state", state).select(
        F.concat(F.lit("feed-"), "n").alias("feed_id"), F.concat(F.lit("https://feeds.example/"), "n").alias("feed_url"), F.when(F.col("n") % 2 == 0, "rss2").otherwise("atom").alias("kind"), "state",
        F.when(F.col("state") == "accepted", F.col("all")).otherwise(F.slice("all", 1, 0)).alias("rows"), F.when(F.col("state") == "failed", "http_error").when(F.col("state") == "quarantined", "empty_feed").alias("error_code"), "n",
    )
