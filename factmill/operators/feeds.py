"""Feeds: payloads to items, outcome validation, canonical digests, publication decisions and status audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from factmill.functions import vocab
from factmill.functions.wire import elements, has_keys, is_value, repeats_a_key
from factmill.functions.text import any_instant, joined_text, stable_id, unescaped, without_tags

RAW_ENTRIES = "array<struct<pos:int,title:string,body:string,link:string,published_at:string,error:string>>"
# Child elements by meaning, in order of preference, by their full names.
RSS_CHILDREN = {"title": ("title",), "body": ("description", vocab.CONTENT + "encoded"), "published": ("pubDate", vocab.DUBLIN_CORE + "date"), "link": ("link", "guid")}
ATOM_CHILDREN = {
    "title": (vocab.ATOM + "title", "title"), "body": (vocab.ATOM + "summary", vocab.ATOM + "content"),
    "published": (vocab.ATOM + "published", vocab.ATOM + "updated", "published", "updated"), "link": (vocab.ATOM + "id", "id"),
}
ROW_FIELDS = "array<struct<item_id:string,published_at:string,source_type:string,source_url:string,author:string,text:string>>"


class _Entries:
    """Collects the children of RSS items and Atom entries while expat reads; a document type or entity is refused.

    Of each child name the first element counts, and of that the text before any element inside it.
    """

    def __init__(self) -> None:
        from xml.parsers import expat

        self.path, self.rss, self.atom = [], [], []
        self.entry, self.depth, self.name = None, 0, None
        self.parser = p = expat.ParserCreate(namespace_separator="}")
        p.buffer_text = True
        p.StartElementHandler, p.EndElementHandler, p.CharacterDataHandler = self.start, self.end, self.text_found
        p.StartDoctypeDeclHandler = p.EntityDeclHandler = self.refuse

    def refuse(self, *_) -> None:
        raise ValueError("document types are refused")

    def start(self, name: str, attributes: dict) -> None:
        self.path.append("{" + name if "}" in name else name)
        self.name = None
        for found, below in ((self.rss, ["channel", "item"]), (self.atom, [vocab.ATOM + "entry"])):
            if self.path[1:] == below:
                self.entry, self.depth = {}, len(self.path)
                found.append(self.entry)
                return
        if self.entry is not None and len(self.path) == self.depth + 1:
            child = self.path[-1]
            if child.endswith("link") and attributes.get("href"):
                self.entry.setdefault("@href", attributes["href"])
            if child not in self.entry:
                self.entry[child], self.name = "", child

    def text_found(self, data: str) -> None:
        if self.name is not None:
            self.entry[self.name] += data

    def end(self, name: str) -> None:
        if len(self.path) == self.depth:
            self.entry, self.depth = None, 0
        self.name = None
        self.path.pop()


def _first(entry: dict, names: tuple[str, ...]) -> str:
    """The text of the first of these children that holds any."""
    return next((entry[n].strip() for n in names if entry.get(n)), "")


def _link(entry: dict, names: tuple[str, ...], rss: bool) -> str:
    """RSS: the text of link, or of guid where that is blank. Atom: the first link's target, or the id."""
    if not rss:
        return entry.get("@href") or _first(entry, names)
    return next((found for n in names if (found := _first(entry, (n,)))), "")


def _read(payload: bytes | None) -> tuple[list[tuple[str, str, str, str]], str | None]:
    """(title, body, link, published) of each entry, or an error code."""
    if payload is None:
        return [], "feed_xml_invalid"
    if len(payload) > vocab.MAX_PAYLOAD_BYTES:
        return [], "feed_xml_oversize"
    found = _Entries()
    try:
        found.parser.Parse(payload, True)
    except Exception:  # expat errors, unknown encodings and refusals end as one sanitized code
        return [], "feed_xml_invalid"
    names = RSS_CHILDREN if found.rss else ATOM_CHILDREN
    return [(_first(e, names["title"]), _first(e, names["body"]), _link(e, names["link"], bool(found.rss)), _first(e, names["published"])) for e in found.rss or found.atom], None


def _dated(entries: list[tuple[str, str, str, str]]) -> tuple[list[tuple[str, str, str, str | None]], str | None]:
    """The entries with their dates as instants (None where one has none), or an error code if any date is unreadable."""
    out = []
    for title, body, link, published in entries:
        moment = any_instant(published) if published else None
        if published and moment is None:
            return [], "feed_date_invalid"
        out.append((title, body, link, moment))
    return out, None


def _parser(max_items: int):
    """Not an Arrow function: a worker then holds some hundred payloads at a time, however many a partition has."""

    @F.udf(RAW_ENTRIES, useArrow=False)
    def run(payload: bytes | None) -> list[tuple]:
        entries, error = _read(payload)
        dated, error = _dated(entries[:max_items]) if error is None else ([], error)
        return [(None, None, None, None, None, error)] if error else [(pos, *entry, None) for pos, entry in enumerate(dated)]

    return run


def parse_payloads(payloads: DataFrame, max_items: int = 25) -> DataFrame:
    """Entries of (feed_id, content) payloads, the first ``max_items`` in document order, or one row with an error.

    RSS 2.0 and Atom. A payload over 1 MiB, with a document type, of an unknown encoding or not well-formed gives a code,
    and so does one with an unreadable date among these entries (``feed_date_invalid``). A fault is that of the payload it
    is in, never of others of its feed. ``payload`` names the payload, where the table has such a column (a landed
    file's path, say); published_at is null for an entry without a date.
    """
    name = F.col("payload").cast("string") if "payload" in payloads.columns else F.lit(None).cast("string")
    content, most = F.col("content").cast("binary"), vocab.MAX_PAYLOAD_BYTES
    content = F.when(F.octet_length(content) > most, F.substring(content, 1, most + 1)).otherwise(content)  # an oversize one is not read
    return payloads.select("feed_id", name.alias("payload"), _parser(max_items)(content).alias("_entries")).select("feed_id", "payload", F.inline("_entries"))


def _or_raise(parsed: DataFrame) -> DataFrame:
    """Fails the job at the first faulty payload, naming its feed and fault."""
    fault = F.concat(F.lit("feed "), F.coalesce("feed_id", F.lit("?")), F.lit(" failed: "), "error")
    return parsed.withColumn("error", F.when(F.col("error").isNotNull(), F.raise_error(fault).cast("string")))


def feed_items(payloads: DataFrame, feeds: DataFrame, ingested_at: Column, max_items: int = 25, stop_on_first: bool = False) -> DataFrame:
    """Source items of the payloads without fault, with ``pos``. A title is taken as it stands, a body without its tags.

    Faulty payloads are left out and show in ``fetch_statuses``; with ``stop_on_first`` the first of them fails the job.
    """
    parsed = parse_payloads(payloads, max_items)
    parsed = _or_raise(parsed) if stop_on_first else parsed
    return items_of_entries(parsed, feeds, ingested_at)


def items_of_entries(parsed: DataFrame, feeds: DataFrame, ingested_at: Column) -> DataFrame:
    """Source items of what ``parse_payloads`` gives."""
    raw = parsed.where("error is null").join(feeds.withColumnRenamed("feed_id", "f_id"), F.col("feed_id") == F.col("f_id"))
    return raw.select(
        stable_id(F.col("feed_id"), F.col("link"), F.col("title")).alias("item_id"), F.coalesce("published_at", ingested_at).alias("published_at"), "source_type", F.col("link").alias("source_url"),
        F.coalesce("author", F.lit("")).alias("author"), joined_text(F.col("title"), unescaped(without_tags(F.col("body")))).alias("text"), "feed_id", "pos", "payload",
    )


def payload_faults(payloads: DataFrame, max_items: int = 25) -> DataFrame:
    """(feed_id, payload, error) of each faulty payload."""
    return parse_payloads(payloads, max_items).where("error is not null").select("feed_id", "payload", "error")


def sorted_items(items: DataFrame) -> DataFrame:
    """Items in the order in which they are published: by time, then id."""
    return items.orderBy("published_at", "item_id")


def fetch_statuses(payloads: DataFrame, feeds: DataFrame, max_items: int = 25) -> DataFrame:
    """feed_id, feed_url, ok, item_count, error for each configured feed; one without a payload failed.

    A feed with several payloads counts the items of those without fault, and failed if any is faulty.
    """
    parsed = parse_payloads(payloads, max_items)
    seen = payloads.select(F.col("feed_id").alias("s_id")).distinct()
    by_feed = parsed.groupBy(F.col("feed_id").alias("p_id")).agg(F.count("pos").alias("n"), F.max("error").alias("e"))
    out = feeds.join(seen, F.col("feed_id") == F.col("s_id"), "left").join(by_feed, F.col("feed_id") == F.col("p_id"), "left")
    error = F.when(F.col("s_id").isNull(), F.lit("feed_missing")).otherwise(F.coalesce("e", F.lit("")))
    return out.select("feed_id", "feed_url", (error == "").alias("ok"), F.coalesce("n", F.lit(0)).cast("long").alias("item_count"), error.alias("error"))


def gate_all_failed(statuses: DataFrame) -> DataFrame:
    """The statuses; the job fails if no feed was read."""
    gate = statuses.agg(F.coalesce(F.bool_or("ok"), F.lit(False)).alias("any_ok")).select(F.when(F.col("any_ok"), True).otherwise(F.raise_error(F.lit("all feeds failed")).cast("boolean")).alias("gate"))
    return statuses.crossJoin(gate).where("gate").drop("gate")


def first_items(items: DataFrame, n: int = 25, position: str = "pos") -> DataFrame:
    """The first ``n`` items of each feed."""
    order = F.row_number().over(W.partitionBy("feed_id").orderBy(position))
    return items.withColumn("_r", order).where(F.col("_r") <= n).drop("_r")


def _bad_text(c: Column, may_be_empty: bool = False) -> Column:
    bad = c.isNull() | c.rlike(r"[\x00-\x1f]")
    return bad if may_be_empty else bad | (c == "")


def outcome_error() -> Column:
    """The first fault of a feed outcome (feed_id, feed_url, kind, state, rows, error_code), null for none."""
    row_bad = F.exists("rows", lambda r: F.expr("false") | _any([_bad_text(r[k], k == "author") for k in vocab.ROW_KEYS]))
    return (
        F.when(F.col("kind").isNull() | ~F.col("kind").isin(*vocab.FEED_KINDS), "feed_kind_invalid")
        .when(F.col("state").isNull() | ~F.col("state").isin(*vocab.FEED_STATES), "feed_state_invalid")
        .when(F.col("rows").isNull() | (F.size("rows") > vocab.MAX_ROWS_PER_FEED), "rows_invalid")
        .when(row_bad, "row_invalid")
        .when(F.col("error_code").isNotNull() & ~F.col("error_code").rlike(vocab.ERROR_CODE), "error_code_invalid")
        .when(F.col("state").isin("accepted", "quarantined") & (F.col("kind") == "unknown"), "feed_kind_invalid")
        .when((F.col("state") == "accepted") & ((F.size("rows") == 0) | F.col("error_code").isNotNull()), "outcome_invariant_invalid")
        .when((F.col("state") != "accepted") & ((F.size("rows") > 0) | F.col("error_code").isNull()), "outcome_invariant_invalid")
        .when(_bad_text(F.col("feed_id")) | _bad_text(F.col("feed_url")), "feed_invalid")
    )


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def row_digest(rows: Column) -> Column:
    """sha256 of the rows, sorted by their six fields, as JSON with keys in order and no spaces."""
    ordered = F.transform(F.array_sort(F.transform(rows, lambda r: F.struct(*[r[k].alias(k) for k in vocab.ROW_KEYS]))), lambda r: F.struct(*[r[k].alias(k) for k in sorted(vocab.ROW_KEYS)]))
    return F.sha2(F.to_json(ordered).cast("binary"), 256)


def feed_digests(outcomes: DataFrame) -> DataFrame:
    """feed_id, feed_url, kind, state, accepted_row_count, rejected_row_count, row_digest, error_code of each feed."""
    accepted = F.col("state") == "accepted"
    return outcomes.select(
        "feed_id", "feed_url", "kind", "state", F.when(accepted, F.size("rows")).otherwise(0).cast("long").alias("accepted_row_count"), F.lit(0).cast("long").alias("rejected_row_count"),
        F.when(accepted, row_digest(F.col("rows"))).otherwise(vocab.EMPTY_DIGEST).alias("row_digest"), "error_code",
    )


def multiset_digest(rows: DataFrame) -> DataFrame:
    """Row count and the sum of the rows' hashes: a digest of all accepted rows that needs neither an order nor one task.

    A row's hash is the first 60 bits of the md5 of its canonical JSON, so equal sets of rows, copies counted, agree.
    """
    line = F.to_json(F.struct(*[F.col(k) for k in sorted(vocab.ROW_KEYS)]))
    number = F.conv(F.substring(F.md5(line.cast("binary")), 1, 15), 16, 10).cast("decimal(20,0)")
    return rows.agg(F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum(number), F.lit(0)).cast("string").alias("hash_sum"))


def _totals() -> list[Column]:
    state = F.col("state")
    return [
        F.count(F.lit(1)).alias("feed_count"), F.count_if(state == "accepted").alias("successful_feed_count"), F.count_if(state == "failed").alias("failed_feed_count"),
        F.count_if(state == "quarantined").alias("quarantined_feed_count"), F.coalesce(F.sum(F.when(state == "accepted", F.size("rows"))), F.lit(0)).cast("long").alias("accepted_row_count"),
        F.min(F.when(F.col("fault").isNotNull(), F.struct("feed_id", "fault")))["fault"].alias("fault"),
    ]


def _decided(totals: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Decides over rows of totals and ``most``, how often a feed's id occurs at most."""
    error = F.when(F.col("feed_count") == 0, "feed_config_empty").when(F.col("fault").isNotNull(), F.col("fault")).when(F.col("most") > 1, "feed_duplicate")
    decision = F.when(F.col("error").isNotNull(), "invalid").when(F.col("failed_feed_count") > 0, "hard_fail").when(F.col("quarantined_feed_count") > 0, "quarantine").otherwise("success")
    complete = (F.col("failed_feed_count") == 0) & (F.col("quarantined_feed_count") == 0)
    return totals.withColumn("error", error).select(
        *keys, "feed_count", "successful_feed_count", "failed_feed_count", "quarantined_feed_count", "accepted_row_count", complete.alias("publication_complete"), "error", decision.alias("decision"),
    )


def publication_decision(outcomes: DataFrame) -> DataFrame:
    """One row: totals, completeness, the fault of the first faulty feed by id, and success, quarantine, hard_fail or invalid."""
    checked = outcomes.withColumn("fault", outcome_error())
    repeated = checked.groupBy("feed_id").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0)).alias("most"))
    return _decided(checked.agg(*_totals()).crossJoin(repeated))  # one row each


def publication_decisions(outcomes: DataFrame, key: str) -> DataFrame:
    """The decision over the feeds of each ``key``, for many configurations at once."""
    checked = outcomes.withColumn("fault", outcome_error())
    repeated = checked.groupBy(F.col(key).alias("_k"), "feed_id").agg(F.count(F.lit(1)).alias("n")).groupBy("_k").agg(F.max("n").alias("most"))
    return _decided(checked.groupBy(key).agg(*_totals()).join(repeated, F.col(key).eqNullSafe(F.col("_k"))), [key])


STATUS_VERSION = "feed_status.v1"
_FEED = "struct<accepted_row_count:bigint,error_code:string,feed_id:string,feed_url:string,kind:string,rejected_row_count:bigint,row_digest:string,state:string>"
#: Fields in alphabetical order, so that to_json is canonical.
STATUS_SCHEMA = (
    "accepted_row_count bigint, aggregate_row_digest string, configured_feed_count bigint, eligible_for_live_publication boolean, failed_feed_count bigint, feed_count bigint,"
    f" feeds array<{_FEED}>, publication_complete boolean, quarantined_feed_count bigint, rejected_row_count bigint, status_version string, successful_feed_count bigint"
)
STATUS_FIELDS = tuple(field.split()[0] for field in STATUS_SCHEMA.split(", "))
FEED_KEYS = tuple(field.split(":")[0] for field in _FEED[7:-1].split(","))
COUNTERS = ("configured_feed_count", "feed_count", "successful_feed_count", "failed_feed_count", "quarantined_feed_count", "accepted_row_count", "rejected_row_count")


def _number(c: Column) -> Column:
    return c.isNotNull() & c.between(0, vocab.MAX_SAFE_INTEGER)


def _listed(c: Column, values: tuple[str, ...]) -> Column:
    return F.coalesce(c.isin(*values), F.lit(False))


def _matches(c: Column, form: str) -> Column:
    return F.coalesce(c.rlike(form), F.lit(False))


def _feed_fault(feeds: Column, texts: Column | None = None):
    """For array functions over ``feeds``: the first fault of the i-th feed, given those before it, and the feeds' texts, if there are."""

    def fault(f: Column, i: Column) -> Column:
        before, last = F.slice(feeds, 1, i), F.get(feeds, i - 1)
        accepted, key = f["state"] == "accepted", lambda x: F.struct(x["feed_id"].alias("a"), x["feed_url"].alias("b"))
        rows = f["accepted_row_count"]
        return (
            F.when(F.lit(False) if texts is None else ~has_keys(F.get(texts, i), FEED_KEYS), "feed_invalid")
            .when(_bad_text(f["feed_id"]) | _bad_text(f["feed_url"]), "feed_invalid")
            .when(F.exists(before, lambda x: x["feed_id"] == f["feed_id"]), "feed_duplicate")
            .when((i > 0) & (key(f) <= key(last)), "feed_order_invalid")
            .when(~_listed(f["kind"], vocab.FEED_KINDS), "feed_kind_invalid")
            .when(~_listed(f["state"], vocab.FEED_STATES), "feed_state_invalid")
            .when((f["state"] != "failed") & (f["kind"] == "unknown"), "feed_kind_invalid")
            .when(~_number(rows) | ~_number(f["rejected_row_count"]) | (rows > vocab.MAX_ROWS_PER_FEED), "feed_counter_invalid")
            .when(f["rejected_row_count"] != 0, "rejected_count_invalid")
            .when(accepted != (rows > 0), "feed_state_invalid")
            .when(~_matches(f["row_digest"], vocab.DIGEST), "status_digest_invalid")
            .when(accepted == (f["row_digest"] == vocab.EMPTY_DIGEST), "empty_digest_invalid")
            .when(accepted & f["error_code"].isNotNull(), "feed_state_invalid")
            .when(~accepted & ~_matches(f["error_code"], vocab.ERROR_CODE), "feed_error_invalid")
        )

    return fault


def status_error(field=F.col, texts: Column | None = None) -> Column:
    """The first broken rule of a status, null if it is sound. ``field``: its fields by name, those of STATUS_SCHEMA.

    ``texts``: the feeds' JSON, where a status was read from text; their keys are then judged too.

    The feeds are judged one after another; totals, flags and digests are recomputed from them, all within the row.
    """
    feeds = field("feeds")
    of_feeds = F.get(F.filter(F.transform(feeds, _feed_fault(feeds, texts)), lambda e: e.isNotNull()), 0)
    n = F.size(feeds).cast("long")

    def total(state: str) -> Column:
        return F.size(F.filter(feeds, lambda f: f["state"] == state)).cast("long")

    rows = F.aggregate(feeds, F.lit(0).cast("long"), lambda a, f: a + f["accepted_row_count"])
    complete = total("accepted") == n
    return (
        F.when(~_listed(field("status_version"), (STATUS_VERSION,)), "status_version_invalid")
        .when(_any([~_number(field(c)) for c in COUNTERS]), "status_counter_invalid")
        .when(field("publication_complete").isNull() | field("eligible_for_live_publication").isNull(), "status_flag_invalid")
        .when(~_matches(field("aggregate_row_digest"), vocab.DIGEST), "status_digest_invalid")
        .when(feeds.isNull() | (n == 0), "feed_invalid")
        .when(of_feeds.isNotNull(), of_feeds)
        .when((field("configured_feed_count") != n) | (field("feed_count") != n), "status_counter_invalid")
        .when((field("successful_feed_count") != total("accepted")) | (field("failed_feed_count") != total("failed")), "status_counter_invalid")
        .when((field("quarantined_feed_count") != total("quarantined")) | (field("accepted_row_count") != rows), "status_counter_invalid")
        .when(field("rejected_row_count") != 0, "rejected_count_invalid")
        .when((rows == 0) != (field("aggregate_row_digest") == vocab.EMPTY_DIGEST), "empty_digest_invalid")
        .when((field("publication_complete") != complete) | (field("eligible_for_live_publication") != complete), "status_flag_invalid")
    )


def audit_statuses(statuses: DataFrame) -> DataFrame:
    """status_id and error_code of statuses in columns (status_id and the fields of STATUS_SCHEMA)."""
    return statuses.select("status_id", status_error().alias("error_code"))


def status_wires(statuses: DataFrame) -> DataFrame:
    """(status_id, status): the canonical JSON of statuses in columns."""
    feeds = F.transform("feeds", lambda f: F.struct(*[f[c].alias(c) for c in FEED_KEYS]))
    values = [(feeds if c == "feeds" else F.col(c)).alias(c) for c in STATUS_FIELDS]
    return statuses.select("status_id", F.to_json(F.struct(*values), {"ignoreNullFields": "false"}).alias("status"))


def audit_status_wires(wires: DataFrame) -> DataFrame:
    """status_id and error_code of statuses as JSON text (status_id, status): also other and repeated keys, the feeds' too, and any byte off the canonical form."""
    text, s = F.col("status"), F.col("_s")
    read = wires.withColumn("_s", F.from_json("status", STATUS_SCHEMA))
    error = (
        F.when(~is_value(text), "status_invalid")
        .when(repeats_a_key(text), "status_duplicate_key")
        .when(~has_keys(text, STATUS_FIELDS) | s.isNull(), "status_invalid")
        .otherwise(F.coalesce(status_error(lambda c: s[c], elements(text, "feeds")), F.when(F.to_json(s, {"ignoreNullFields": "false"}) != text, "status_noncanonical")))
    )
    return read.select("status_id", error.alias("error_code"))
