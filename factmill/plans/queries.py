"""Registered queries over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factmill.functions.text import confidence_of, is_government_url, is_https, slug, stable_id, unescaped, utc_instant, without_tags
from factmill.operators import event_study as es
from factmill.operators import feeds as fd
from factmill.operators import mention_index as mi
from factmill.operators import mentions as mt
from factmill.operators import ordering as od
from factmill.operators import quality as ql
from factmill.operators import records as rc
from factmill.operators import tracker as tr
from factmill.operators import weekly as wk
from factmill.sources import adapters as ad
from factmill.sources import files
from factmill.sources.shared import shared_folder
from factmill.streaming import intake

WINDOWS = (1, 5, 20)
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
INGESTED = "2024-06-01T00:00:00Z"


def event_study(spark: SparkSession, sf_dir: str) -> DataFrame:
    return es.event_returns(ad.events(spark, sf_dir), ad.prices(spark, sf_dir), WINDOWS)


def event_study_sparse_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return es.event_returns(ad.events(spark, sf_dir), ad.prices(spark, sf_dir, sparse=True), WINDOWS)


def return_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event study as it is written to files, against the sparse benchmark, so that some cells are empty."""
    return es.shown(event_study_sparse_benchmark(spark, sf_dir)).select("event_id", "window_days", "base_close", "exit_close", "return_pct", "benchmark_return_pct", "abnormal_return_pct")


def event_coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events after the last price of their symbol; every third symbol is priced up to 1998 only."""
    prices = ad.prices(spark, sf_dir)
    number = F.substring("symbol", 2, 20).try_cast("long")
    prices = prices.where(~F.coalesce(number % 3 == 0, F.lit(False)) | (F.col("date") < "1999-01-01"))
    return es.coverage_gaps(ad.events(spark, sf_dir), prices).select("event_id", "event_date", "symbol")


def price_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return es.last_wins(ad.raw_prices(spark, sf_dir), [F.col("l_orderkey"), F.col("l_linenumber"), F.col("close")]).select("symbol", "date", "close")


def return_summary_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_study(spark, sf_dir)
    total = lambda c: F.sum(F.col(c).cast("decimal(28,6)")).cast("decimal(38,6)")
    return rows.groupBy("event_type", "window_days").agg(F.count(F.lit(1)).alias("returns"), total("return_pct").alias("return_sum"), total("abnormal_return_pct").alias("abnormal_sum"))


def normalize_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rc.normalize_records(ad.official_records(spark, sf_dir))


def rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rc.rejected_records(ad.official_records(spark, sf_dir)).select("record_id", "error_code")


def url_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.official_records(spark, sf_dir)
    return rows.select("record_id", is_https(F.col("source_url")).alias("https"), is_government_url(F.col("source_url")).alias("government"), slug(F.col("record_id")).alias("slug"), confidence_of(F.col("source_type")).alias("confidence"))


def strip_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.table(spark, sf_dir, "pages").select("page_id", unescaped(without_tags(F.col("html"))).alias("text"))


def stable_item_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.table(spark, sf_dir, "pages")
    return rows.select("page_id", stable_id(F.lit("pages"), F.col("url"), F.col("page_id").cast("string")).alias("item_id"))


def published_instant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mail dates with zones from documents, as UTC instants."""
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int")), "dd MMM yyyy")
    zone = F.element_at(F.array(*map(F.lit, (" GMT", " EST", " +0530", "", " PDT"))), (F.col("doc_id") % 5 + 1).cast("int"))
    clock = F.concat(F.lpad((F.col("doc_id") % 24).cast("string"), 2, "0"), F.lit(":"), F.lpad((F.col("doc_id") % 60).cast("string"), 2, "0"), F.lit(":09"))
    return ad.table(spark, sf_dir, "documents").select("doc_id", utc_instant(F.concat(day, F.lit(" "), clock, zone), F.lit(INGESTED)).alias("published_at"))


def faulty_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as CSV lines, some with a cell too many or too few: how many rows of each clerk are read and quarantined."""
    key, clerk = F.col("o_orderkey").cast("string"), F.concat(F.lit("clerk "), F.col("o_custkey") % 50)
    cells = F.when(F.col("o_orderkey") % 7 == 3, F.concat_ws(",", key, clerk)).when(F.col("o_orderkey") % 11 == 5, F.concat_ws(",", key, clerk, F.lit('"a, b"'), F.lit("more")))
    at = shared_folder(spark, "rows")
    ad.table(spark, sf_dir, "orders").select(F.coalesce(cells, F.concat_ws(",", key, clerk, F.lit('"says ""a, b"""'))).alias("value")).write.text(at)
    good, faulty = files.checked_rows(spark, at, ("key", "clerk", "note"), header=False)
    read = good.where("note = 'says \"a, b\"'").groupBy("clerk").agg(F.count(F.lit(1)).alias("rows"))
    kept = faulty.groupBy(F.split("line", ",")[1].alias("of")).agg(F.count(F.lit(1)).alias("faulty"))
    both = read.join(kept, F.col("clerk") == F.col("of"), "full_outer")
    return both.select(F.coalesce("clerk", "of").alias("clerk"), F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("faulty", F.lit(0)).alias("faulty"))


def published_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates of documents in 21 forms that feeds use: mail dates with comments, full names, dashes, dots, obsolete and unknown zones; ISO forms; none."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
    hour, minute = (F.col("doc_id") % 24).cast("string"), F.lpad((F.col("doc_id") % 60).cast("string"), 2, "0")
    of = lambda form: F.date_format(day, form)
    clock = lambda sep=":", h=F.lpad(hour, 2, "0"): F.concat(h, F.lit(sep), minute, F.lit(f"{sep}09"))
    forms = [
        F.concat(of("dd MMM yyyy "), clock(), F.lit(" +0000 (UTC)")), F.concat(of("EEEE, dd MMM yyyy "), clock(), F.lit(" GMT")), F.concat(of("dd MMMM yyyy "), clock(), F.lit(" GMT")),
        F.concat(of("d MMM yyyy "), clock(h=hour), F.lit(" GMT")), F.concat(of("dd-MMM-yyyy "), clock(), F.lit(" GMT")), F.concat(of("dd MMM yyyy "), clock(), F.lit(" CET")),
        F.concat(of("dd  MMM  yyyy  "), clock(), F.lit(" GMT")), F.concat(of("MMM dd, yyyy "), clock(), F.lit(" GMT")), F.concat(of("yyyyMMdd"), F.lit("T"), clock(""), F.lit("Z")),
        F.concat(of("yyyy-MM-dd"), F.lit("T"), F.lpad(hour, 2, "0"), F.lit("Z")), F.concat(of("yyyy-MM-dd "), clock()), F.concat(of("dd MMM yyyy "), clock(), F.lit(" +00:00")),
        F.concat(of("dd MMM yy "), F.lpad(hour, 2, "0"), F.lit(":"), minute, F.lit(" GMT")), F.concat(of("yyyy-MM-dd"), F.lit("T"), clock(), F.lit(".123456789+02:00")), F.concat(F.lower(of("EEE, dd MMM yyyy ")), clock(), F.lit(" pdt")),
        F.concat(of("dd MMM yyyy "), clock(), F.lit(" -0330")), of("yyyyMMdd"), F.concat(of("yyyy-MM-dd"), F.lit("T"), clock(), F.lit("-05:30")), F.concat(F.lit("published "), of("yyyy")), F.lit(" "), F.concat(of("dd MMM yyyy "), clock("."), F.lit(" GMT")),
    ]
    form = (F.col("doc_id") % len(forms)).cast("int")
    text = F.coalesce(*[F.when(form == i, f) for i, f in enumerate(forms)])
    return ad.table(spark, sf_dir, "documents").select("doc_id", utc_instant(text, F.lit(INGESTED)).alias("published_at"))


def alias_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aliases of the suppliers: their symbol, name and number."""
    rows = ad.table(spark, sf_dir, "supplier")
    raw = rows.select(F.concat(F.lit("s"), "s_suppkey").alias("symbol"), F.concat("s_name", F.lit("| |S"), "s_suppkey", F.lit(","), "s_name").alias("aliases"))
    return mt.load_aliases(raw).select("symbol", "alias", "kind")


def mention_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mt.mentions(ad.source_items(spark, sf_dir), mt.load_aliases(ad.aliases(spark)))


def mention_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A thousand aliases: the documents' most frequent words of 4 to 9 letters."""
    items = ad.source_items(spark, sf_dir)
    words = items.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), F.lit(0))).alias("word")).where("word rlike '^[a-z]{4,9}$'")
    most = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(1000)
    return mt.mentions(items, mt.load_aliases(most.select(F.col("word").alias("symbol"), F.col("word").alias("aliases"))))


def mention_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of 4 to 9 letters that documents hold as an alias, found by the inverted index."""
    items = ad.source_items(spark, sf_dir)
    words = items.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), F.lit(0))).alias("word")).where("word rlike '^[a-z]{4,9}$'").distinct()
    return mi.indexed_mentions(items, mt.load_aliases(words.select(F.col("word").alias("symbol"), F.col("word").alias("aliases"))))


def mention_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mt.mention_events(ad.source_items(spark, sf_dir), mt.load_aliases(ad.aliases(spark))).select("event_id", "event_date", "symbol", "event_type", "direction", "confidence", "source_url")


def item_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each source item by time and id."""
    rows = ad.source_items(spark, sf_dir).select("item_id", "published_at")
    return od.placed(rows, [F.col("published_at"), F.col("item_id")]).select("item_id", "place")


def watchlist_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watchlist rows of customers: a status of their own, or else that of the older column."""
    raw = ad.table(spark, sf_dir, "customer").select(
        F.concat(F.lit(" c"), "c_custkey", F.lit(" ")).alias("symbol"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 3 == 0, "").when(F.col("c_custkey") % 3 == 1, "active").alias("research_status"),
        F.when(F.col("c_custkey") % 2 == 0, "older").otherwise("").alias("article_status"),
    )
    return tr.load_watchlist(raw).select("symbol", "name", "bucket", "research_status")


def imported_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sound official records as a file without its three latest columns, imported, and the events of the file that this writes."""
    at = shared_folder(spark, "import")
    optional = ("entity_match_type", "match_evidence", "relationship_type")
    records = ad.official_records(spark, sf_dir).withColumns({"entity_match_type": F.lit("issuer"), "match_evidence": F.lit("page"), "relationship_type": F.lit("issuer")})
    sound = records.where(rc.record_error().isNull())
    files.write_rows(sound, f"{at}/records", [c for c in rc.RECORD_COLUMNS if c not in optional])
    rc.import_official_events(spark, f"{at}/records", f"{at}/events")
    return rc.load_events(files.read_rows(spark, f"{at}/events")).select("event_id", "event_date", "symbol", "event_type", "direction", "confidence", "source_url", "notes")


def tracker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.build_tracker(ad.watchlist(spark, sf_dir), ad.events(spark, sf_dir))


def tracker_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.ranked(tracker(spark, sf_dir)).select("symbol", "priority_score", "tracker_rank")


def event_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each event by date, symbol and id."""
    rows = ad.events(spark, sf_dir).select("event_id", "event_date", "symbol")
    return od.placed(rows, [F.col("event_date"), F.col("symbol"), F.col("event_id")]).select("event_id", "place")


def _row_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list, object]:
    """Accepted rows of all feeds, their order, and each as JSON with keys in order."""
    rows = ad.feed_outcomes(spark, sf_dir).where("state = 'accepted'").select(F.inline("rows"))
    keys = ("item_id", "published_at", "source_type", "source_url", "author", "text")
    return rows, [F.col(k) for k in keys], F.to_json(F.struct(*sorted(keys)))


def accepted_rows_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact digest of all accepted rows in order, as a tree."""
    return od.digest_tree(*_row_lines(spark, sf_dir), fan=64)


def accepted_rows_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the rows differ from themselves with one author in each three hundred changed."""
    rows, order, line = _row_lines(spark, sf_dir)
    changed = rows.withColumn("author", F.when(F.regexp_extract("item_id", "[0-9]+$", 0).cast("long") % 300 == 7, "x").otherwise(F.col("author")))
    return od.differing_ranges(od.digest_tree(rows, order, line, 64), od.digest_tree(changed, order, line, 64), 64)


def symbol_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ql.symbol_summary(ad.events(spark, sf_dir)).select("symbol_count", F.array_join("symbols", ",").alias("symbols"))


def confidence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ql.frequencies(ad.events(spark, sf_dir), "confidence")


def event_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ql.frequencies(ad.events(spark, sf_dir), "event_type")


def feed_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.feed_outcomes(spark, sf_dir).select((F.col("state") == "accepted").alias("ok"), F.size("rows").alias("item_count"))
    return ql.success_ratio(ql.feed_rollup(rows)).select("feed_count", "successful_feed_count", "failed_feed_count", "item_count", F.try_divide("successful_feed_count", "feed_count").alias("ratio"))


def feed_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.table(spark, sf_dir, "documents").select(F.col("source").alias("feed_id"), "doc_id")
    return fd.first_items(rows, 25, "doc_id")


def feed_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = fd.feed_items(ad.feed_payloads(spark, sf_dir), ad.feeds(spark, sf_dir), F.lit(INGESTED))
    return items.select("item_id", "published_at", "source_url", "author", "text", "feed_id", "pos")


def feed_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two payloads of each feed, the second without the feed's first item: a bad date there is a fault of the first alone."""
    first = ad.feed_payloads(spark, sf_dir)
    text = F.col("content").cast("string")
    second = first.withColumn("content", F.concat(F.substring_index(text, "<item>", 1), F.expr("substr(cast(content AS string), instr(cast(content AS string), '</item>') + 7)")).cast("binary"))
    both = first.withColumn("payload", F.lit("first")).unionByName(second.withColumn("payload", F.lit("second")))
    parsed = fd.parse_payloads(both)
    return parsed.groupBy("feed_id", "payload").agg(F.count("pos").alias("items"), F.coalesce(F.max("error"), F.lit("")).alias("error"))


def feed_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fd.fetch_statuses(ad.feed_payloads(spark, sf_dir), ad.feeds(spark, sf_dir))


def feed_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fd.feed_digests(ad.feed_outcomes(spark, sf_dir)).select("feed_id", "state", "accepted_row_count", "row_digest")


def accepted_rows_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fd.multiset_digest(ad.feed_outcomes(spark, sf_dir).select(F.inline("rows")))


def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    statuses = ad.feed_outcomes(spark, sf_dir).select((F.col("state") == "accepted").alias("ok"), F.size("rows").alias("item_count"))
    rows = ql.quality_summary(ad.events(spark, sf_dir), statuses)
    shown = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")
    return rows.select("symbol_count", shown("confidence_counts").alias("confidence_counts"), shown("event_type_counts").alias("event_type_counts"), "feed_count", "item_count")


def outcome_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.feed_outcomes(spark, sf_dir).withColumn("fault", fd.outcome_error()).groupBy("state", "fault").agg(F.count(F.lit(1)).alias("feeds"))


def publication_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over all feeds, faulty ones too."""
    return fd.publication_decision(ad.feed_outcomes(spark, sf_dir))


def group_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decision over each group of ten feeds."""
    return fd.publication_decisions(ad.feed_outcomes(spark, sf_dir).withColumn("group_id", F.floor(F.col("n") / 10)), "group_id")


def _statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statuses of ten feeds each, some of them tampered with by number."""
    digests = fd.feed_digests(ad.feed_outcomes(spark, sf_dir)).withColumn("status_id", F.floor(F.substring("feed_id", 6, 20).cast("long") / 10))
    fields = ("feed_id", "feed_url", "kind", "state", "accepted_row_count", "rejected_row_count", "row_digest", "error_code")
    grouped = digests.groupBy("status_id").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("feeds"))  # ten feeds
    count = lambda s: F.size(F.filter("feeds", lambda f: f["state"] == s)).cast("long")
    way = F.col("status_id") % 5
    broken = F.transform("feeds", lambda f: f.withField("accepted_row_count", F.lit(0).cast("long")).withField("row_digest", F.when(f["state"] == "accepted", f["row_digest"]).otherwise("x")))  # every feed, each in its way
    complete = (count("failed") == 0) & (count("quarantined") == 0)
    rows = F.aggregate("feeds", F.lit(0).cast("long"), lambda a, f: a + f["accepted_row_count"])
    size = F.size("feeds").cast("long")
    return grouped.select(
        "status_id", F.lit(fd.STATUS_VERSION).alias("status_version"), size.alias("configured_feed_count"), size.alias("feed_count"), (count("accepted") + F.when(way == 1, 1).otherwise(0)).alias("successful_feed_count"), count("failed").alias("failed_feed_count"),
        count("quarantined").alias("quarantined_feed_count"), rows.alias("accepted_row_count"), F.lit(0).cast("long").alias("rejected_row_count"), F.when(way == 2, ~complete).otherwise(complete).alias("publication_complete"),
        complete.alias("eligible_for_live_publication"), F.sha2(F.to_json("feeds").cast("binary"), 256).alias("aggregate_row_digest"), F.when(way == 3, F.reverse("feeds")).when(way == 4, broken).otherwise(F.col("feeds")).alias("feeds"),
    )


def status_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fd.audit_statuses(_statuses(spark, sf_dir))


def status_wire_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statuses of ten feeds each as text, sound or with faults of their own: a key too many or twice, at the top or in a feed, a space, another version."""
    rows = fd.status_wires(_statuses(spark, sf_dir))
    way, text = F.floor(F.col("status_id") / 5 + F.col("status_id")) % 8, F.col("status")
    edit = lambda old, new: F.replace(text, F.lit(old), F.lit(new))
    tampered = (
        F.when(way == 1, edit('"status_version"', '"state":1,"status_version"')).when(way == 2, F.concat(F.lit(" "), text)).when(way == 3, edit("feed_status.v1", "feed_status.v0"))
        .when(way == 4, edit('"failed_feed_count"', '"feed_count":1,"failed_feed_count"')).when(way == 5, edit('"kind":"atom"', '"kind":"atom","more":1')).when(way == 6, edit('"kind":"atom"', '"kind":"atom","kind":"atom"')).otherwise(text)
    )
    return fd.audit_status_wires(rows.withColumn("status", tampered))


def weekly_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wk.with_period(ad.events(spark, sf_dir).select("event_id", "event_date"), "event_date").select("event_id", "period_start", "period_end_exclusive", "as_of")


def weekly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wk.weekly_counts(ad.events(spark, sf_dir)).select("period_start", "event_type", "events")


def _artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = wk.with_period(ad.events(spark, sf_dir), "event_date").groupBy("period_start", "confidence").agg(F.count(F.lit(1)).alias("row_count"))
    return rows.select("period_start", F.concat(F.lit("events/"), "confidence", F.lit(".csv")).alias("path"), F.sha2(F.concat_ws("|", F.col("period_start").cast("string"), "confidence").cast("binary"), 256).alias("sha256"), "row_count")


def weekly_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = wk.weekly_snapshot(_artifacts(spark, sf_dir))
    listed = F.array_join(F.transform("source_artifacts", lambda a: F.concat_ws(":", a["path"], a["sha256"], a["row_count"].cast("string"))), ",")
    return rows.select("period_start", listed.alias("artifacts"), "duplicate_paths")


def weekly_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confidence tiers as feeds: a tier is read in a week that has its events, fails if it has under two, is stale never."""
    days = wk.with_period(ad.events(spark, sf_dir), "event_date")
    seen = days.groupBy("period_start", F.col("confidence").alias("feed_id")).agg((F.count(F.lit(1)) > 1).alias("ok"), F.max("event_date").alias("last_item"))
    tiers = days.select(F.col("confidence").alias("feed_id")).distinct()
    return wk.weekly_gate(tiers, seen, days)


def _weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot = wk.weekly_snapshot(_artifacts(spark, sf_dir))
    n = (F.datediff("period_start", F.lit("1994-12-26").cast("date")) / 7).cast("int")
    rows = snapshot.withColumn("n", n).withColumn("tiers", F.size("source_artifacts").cast("long"))
    zero = F.lit(0).cast("long")
    return rows.withColumns({
        "complete": F.lit(True), "failed_feed_count": zero, "feed_count": F.col("tiers"), "missing_feed_count": zero, "stale_feed_count": F.when(F.col("n") % 6 == 1, 1).otherwise(0).cast("long"),
        "successful_feed_count": F.col("tiers"), "generated_at": F.when(F.col("n") % 6 == 2, F.col("period_start").cast("timestamp")).otherwise(F.date_add("period_start", 8).cast("timestamp")),
        "producer_ref": F.when(F.col("n") % 6 == 3, F.lit("HEAD")).otherwise(F.sha1(F.col("period_start").cast("string").cast("binary"))), "run_mode": F.lit("scheduled"), "source_provenance": F.lit("star_schema"),
        "workflow_ref": F.lit("jobs/weekly@v1"), "source_run_id": (F.col("n") + 1).cast("string"), "source_snapshot_id": F.lit("events_weekly"),
        "source_snapshot_digest": F.sha2(F.to_json("source_artifacts").cast("binary"), 256),
    })


def contract_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = wk.contract_rows(_weeks(spark, sf_dir))
    n = (F.datediff("period_start", F.lit("1994-12-26").cast("date")) / 7).cast("int")
    tampered = F.when(n % 6 == 4, F.concat(F.lit(" "), "contract")).when(n % 6 == 5, F.replace("contract", F.lit('"run_mode":"scheduled"'), F.lit('"run_mode":"nightly"'))).otherwise(F.col("contract"))
    return wk.audit_contracts(rows.withColumn("contract", tampered)).select("period_start", "error_code")


def lock_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wk.audit_locks(wk.lock_rows(_weeks(spark, sf_dir))).select("period_start", "error_code")


def lock_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = _weeks(spark, sf_dir)
    actual = expected.where("n % 10 <> 7").withColumn("source_run_id", F.when(F.col("n") % 10 == 3, "1").otherwise(F.col("source_run_id")))
    return wk.reconcile(actual, expected.where("n % 10 <> 8"), "period_start", ["source_run_id", "source_snapshot_digest", "producer_ref"])


def weekly_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wk.manifest_rows(wk.contract_rows(_weeks(spark, sf_dir)))


def manifest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests of all weeks, some tampered with by number, beside the faults that their contracts have themselves."""
    n = (F.datediff("period_start", F.lit("1994-12-26").cast("date")) / 7).cast("int")
    text = (
        F.when(n % 7 == 1, F.replace("manifest", F.lit('"manifest_type"'), F.lit('"kind":1,"manifest_type"'))).when(n % 7 == 2, F.concat("manifest", F.lit(" ")))
        .when(n % 7 == 3, F.replace("manifest", F.lit("weekly_source_manifest"), F.lit("daily"))).when(n % 7 == 4, F.replace("manifest", F.lit('"manifest_type"'), F.lit('"contract":{},"manifest_type"')))
        .when(n % 7 == 5, F.replace("manifest", F.lit('"complete":true'), F.lit('"complete":true,"complete":true'))).when(n % 7 == 6, F.replace("manifest", F.lit('{"path"'), F.lit('{"more":1,"path"'))).otherwise(F.col("manifest"))
    )
    rows = wk.manifest_rows(wk.contract_rows(_weeks(spark, sf_dir))).withColumn("manifest", text)
    return wk.audit_manifests(rows).select("period_start", "error_code")


def manifest_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests against expected contracts: some of another run mode, some missing on either side."""
    contracts = wk.contract_rows(_weeks(spark, sf_dir)).withColumn("n", (F.datediff("period_start", F.lit("1994-12-26").cast("date")) / 7).cast("int"))
    mode = F.when(F.col("n") % 7 == 3, F.replace("contract", F.lit('"run_mode":"scheduled"'), F.lit('"run_mode":"manual"'))).otherwise(F.col("contract"))
    return wk.verify_manifests(wk.manifest_rows(contracts.where("n % 7 <> 4")), contracts.where("n % 7 <> 5").withColumn("contract", mode))


def live_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all tables' files, with their digests, row counts and the quality summary, as one JSON row."""
    counts = None
    for name in TABLES:
        one = ql.file_row_counts(ad.table(spark, sf_dir, name), sf_dir)
        counts = one if counts is None else counts.unionByName(one)
    statuses = ad.feed_outcomes(spark, sf_dir).select((F.col("state") == "accepted").alias("ok"), F.size("rows").alias("item_count"))
    return ql.live_manifest(spark, f"{sf_dir}/*.parquet", counts, ql.quality_summary(ad.events(spark, sf_dir), statuses), sf_dir)


def dataset_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ql.row_counts({t: ad.table(spark, sf_dir, t) for t in TABLES})


def stream_weekly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a stream: weekly counts of the weeks that the watermark (14 days) has closed."""
    at = shared_folder(spark, "stream")
    stream = intake.stream_table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("timestamp").alias("ts"), "o_orderpriority")
    counted = intake.weekly_tumbling(stream, "ts", ["o_orderpriority"])
    intake.run_available(counted, f"{at}/rows", f"{at}/checkpoint")
    return spark.read.schema(counted.schema).parquet(f"{at}/rows")


def stream_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a stream of items, once each, and their mentions."""
    at = shared_folder(spark, "stream")
    items = intake.new_items(ad.items_of(intake.stream_table(spark, sf_dir, "documents")))
    found = intake.stream_mentions(items, mt.load_aliases(ad.aliases(spark))).select("item_id", "symbol")
    intake.run_available(found, f"{at}/rows", f"{at}/checkpoint")
    return spark.read.schema(found.schema).parquet(f"{at}/rows")


def stream_tracker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a stream of events; the stream is started again once all is read, which changes nothing."""
    at = shared_folder(spark, "stream")
    for _ in range(2):
        intake.refresh_evidence(ad.events_of(intake.stream_table(spark, sf_dir, "orders"), spark, sf_dir), f"{at}/evidence", f"{at}/checkpoint")
    return intake.current_tracker(spark, ad.watchlist(spark, sf_dir), f"{at}/evidence")


def stream_weekly_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as fetches of five feeds and a sixth that never comes; some fail, and one feed's items are a year old."""
    at = shared_folder(spark, "stream")
    orders = intake.stream_table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    item = F.when(F.col("o_orderpriority").startswith("5") & (F.col("o_orderkey") % 4 > 0), F.date_sub(day, 365)).otherwise(day)
    fetches = orders.select(F.col("o_orderdate").cast("timestamp").alias("ts"), F.substring("o_orderpriority", 1, 1).alias("feed_id"), (F.col("o_orderkey") % 7 > 4).alias("ok"), item.alias("item_date"))
    feeds = spark.createDataFrame([(str(i),) for i in range(1, 7)], "feed_id string")
    intake.close_weeks(fetches, feeds, f"{at}/gates", f"{at}/checkpoint")
    return spark.read.parquet(f"{at}/gates").drop("batch")


def stream_feed_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads that land in two steps as a stream."""
    at = shared_folder(spark, "stream")
    payloads = ad.feed_payloads(spark, sf_dir)
    for half in (0, 1):
        payloads.where(F.pmod(F.crc32(F.col("feed_id").cast("binary")), F.lit(2)) == half).write.mode("append").parquet(f"{at}/landed")
        landed = spark.readStream.schema(payloads.schema).parquet(f"{at}/landed")
        intake.take_in(landed, ad.feeds(spark, sf_dir), F.lit(INGESTED), f"{at}/out", f"{at}/checkpoint")
    return spark.read.parquet(f"{at}/out/items").select("item_id", "published_at", "source_url", "author", "text", "feed_id", "pos")


QUERIES = {
    f.__name__: f
    for f in (
        event_study, event_study_sparse_benchmark, return_texts, event_coverage_gaps, price_last_wins, return_summary_by_type, normalize_records, rejected_records, url_predicates, strip_html, stable_item_id,
        published_instant, published_forms, faulty_rows, alias_kinds, mention_join, mention_many, mention_index, mention_events, item_order, watchlist_statuses, imported_events, tracker, tracker_rank, event_order, accepted_rows_tree, accepted_rows_changed, symbol_summary, confidence_counts, event_type_counts, feed_rollup, feed_top_n, feed_parse, feed_faults, feed_statuses,
        feed_digest, accepted_rows_digest, quality_summary, outcome_faults, publication_decision, group_decisions, status_audit, status_wire_audit, weekly_period, weekly_counts, weekly_snapshot, weekly_gate, contract_audit, lock_audit, lock_reconcile, weekly_manifest, manifest_audit, manifest_verify,
        live_manifest, dataset_inventory, stream_weekly_counts, stream_mentions, stream_tracker, stream_weekly_gate, stream_feed_parse,
    )
}
