"""Weekly periods: snapshots, completeness gates, contract and lock rows, their audit and reconciliation, for many weeks at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factmill.functions import vocab
from factmill.functions.wire import elements, has_keys, is_value, part, repeats_a_key

CONTRACT_VERSION = "weekly_source.v1"
LOCK_VERSION = "weekly_period_lock.v1"
CALENDAR = "utc_iso_week_monday_sunday"
MANIFEST_TYPE = "weekly_source_manifest"
ARTIFACT = "struct<path:string,row_count:bigint,sha256:string>"
ARTIFACTS = f"array<{ARTIFACT}>"
STATUS_KEYS = ("complete", "failed_feed_count", "feed_count", "missing_feed_count", "stale_feed_count", "successful_feed_count")
#: Fields in alphabetical order, so that to_json is canonical.
CONTRACT_SCHEMA = (
    "as_of string, cadence string, contract_version string, feed_status struct<complete:boolean,failed_feed_count:bigint,feed_count:bigint,missing_feed_count:bigint,stale_feed_count:bigint,successful_feed_count:bigint>,"
    " generated_at string, period_end_exclusive string, period_start string, producer_ref string, run_mode string, schema_version string, source_artifacts " + ARTIFACTS + ", source_provenance string"
)
LOCK_SCHEMA = (
    "as_of string, calendar string, lock_version string, period_end_exclusive string, period_start string, producer_ref string, source_artifacts " + ARTIFACTS + ", source_attempt bigint,"
    " source_provenance string, source_run_id string, source_snapshot_digest string, source_snapshot_id string, workflow_ref string"
)
# Forms of the contract's fields.
SHA256, SHA1, IDENTIFIER, RUN_ID, WORKFLOW = r"^[0-9a-f]{64}\z", r"^[0-9a-f]{40}\z", r"^[a-z][a-z0-9]*(?:_[a-z0-9]+)*\z", r"^[1-9][0-9]*\z", r"^[A-Za-z0-9][A-Za-z0-9._/@-]*\z"
PATH, DAY, INSTANT = r"^[A-Za-z0-9][A-Za-z0-9._/-]*\z", r"^\d{4}-\d{2}-\d{2}\z", r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?Z\z"


def with_period(rows: DataFrame, day: str) -> DataFrame:
    """Adds period_start (Monday), period_end_exclusive and as_of (Sunday) of a date column."""
    start = F.to_date(F.date_trunc("week", F.col(day)))
    return rows.withColumn("period_start", start).withColumns({"period_end_exclusive": F.date_add("period_start", 7), "as_of": F.date_add("period_start", 6)})


def weekly_counts(events: DataFrame, day: str = "event_date") -> DataFrame:
    return with_period(events, day).groupBy("period_start", "period_end_exclusive", "as_of", "event_type").agg(F.count(F.lit(1)).alias("events"))


def weekly_snapshot(artifacts: DataFrame) -> DataFrame:
    """(period_start, source_artifacts sorted by path, duplicate_paths) from rows of period_start, path, sha256, row_count."""
    listed = F.array_sort(F.collect_list(F.struct("path", F.col("row_count").cast("long").alias("row_count"), "sha256")))
    out = artifacts.groupBy("period_start").agg(listed.alias("source_artifacts"))
    return out.withColumn("duplicate_paths", F.size(F.array_distinct(F.transform("source_artifacts", lambda a: a["path"]))) < F.size("source_artifacts"))


def weekly_gate(feeds: DataFrame, observed: DataFrame, weeks: DataFrame) -> DataFrame:
    """Feed completeness of each week. ``feeds``: feed_id; ``observed``: period_start, feed_id, ok, last_item (date).

    A configured feed without an observation is missing; one that was read but whose last item lies before the week is
    stale. A week is complete if every feed succeeded and none is stale or missing.
    """
    days = F.broadcast(weeks.select(F.col("period_start").alias("w")).distinct())  # the calendar bounds them; a product of two dealt tables would have a task for each pair of their parts
    wanted = feeds.select(F.col("feed_id").alias("f")).distinct().crossJoin(days)  # weeks x configured feeds is the report itself
    joined = wanted.join(observed, (F.col("w") == F.col("period_start")) & (F.col("f") == F.col("feed_id")), "left")
    missing = F.col("feed_id").isNull()
    stale = ~missing & F.col("ok") & (F.coalesce("last_item", F.to_date(F.lit("0001-01-01"))) < F.col("w"))
    out = joined.groupBy(F.col("w").alias("period_start")).agg(
        F.count(F.lit(1)).alias("feed_count"), F.count_if(~missing & F.col("ok") & ~stale).alias("successful_feed_count"), F.count_if(~missing & ~F.col("ok")).alias("failed_feed_count"),
        F.count_if(stale).alias("stale_feed_count"), F.count_if(missing).alias("missing_feed_count"),
    )
    return out.withColumn("complete", F.col("successful_feed_count") == F.col("feed_count"))


def _json(schema: str, values: dict[str, Column]) -> Column:
    return F.to_json(F.struct(*[values[n].alias(n) for n in _names(schema)]), {"ignoreNullFields": "false"})


def _top_fields(schema: str) -> list[str]:
    out, depth, at = [], 0, 0
    for i, c in enumerate(schema):
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            out.append(schema[at:i])
            at = i + 1
    return [*out, schema[at:]]


def contract_rows(weeks: DataFrame) -> DataFrame:
    """(period_start, contract): canonical JSON of weeks with period_start, source_artifacts, feed_status fields, generated_at, run_mode, producer_ref, source_provenance."""
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    status = F.struct(*[F.col(c).alias(c) for c in ("complete", "failed_feed_count", "feed_count", "missing_feed_count", "stale_feed_count", "successful_feed_count")])
    artifacts = F.transform(F.array_sort("source_artifacts"), lambda a: F.struct(a["path"].alias("path"), a["row_count"].alias("row_count"), a["sha256"].alias("sha256")))
    values = {
        "as_of": day(F.date_add("period_start", 6)), "cadence": F.lit("weekly"), "contract_version": F.lit(CONTRACT_VERSION), "feed_status": status,
        "generated_at": F.date_format("generated_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), "period_end_exclusive": day(F.date_add("period_start", 7)), "period_start": day(F.col("period_start")),
        "producer_ref": F.col("producer_ref"), "run_mode": F.col("run_mode"), "schema_version": F.lit("1"), "source_artifacts": artifacts, "source_provenance": F.col("source_provenance"),
    }
    return weeks.select("period_start", _json(CONTRACT_SCHEMA, values).alias("contract"))


def manifest_rows(contracts: DataFrame) -> DataFrame:
    """(period_start, manifest): each contract in its wrapper of two keys."""
    return contracts.select("period_start", _manifest(F.col("contract")).alias("manifest"))


def _manifest(contract: Column) -> Column:
    return F.concat(F.lit('{"contract":'), contract, F.lit(f',"manifest_type":"{MANIFEST_TYPE}"}}'))


def _safe_path(p: Column) -> Column:
    parts = F.split(p, "/")
    return p.rlike(PATH) & ~F.exists(parts, lambda x: x.isin("", ".", ".."))


def _artifacts_fault(text: Column) -> Column:
    """The fault of the first faulty artifact of a contract's or lock's text, null if all are sound."""
    items, true = elements(text, "source_artifacts"), lambda c: F.coalesce(c, F.lit(False))

    def fault(item: Column) -> Column:
        a = F.from_json(item, ARTIFACT)
        sound = a["sha256"].rlike(SHA256) & a["row_count"].between(0, vocab.MAX_SAFE_INTEGER)
        return F.when(~has_keys(item, ("path", "row_count", "sha256")), "source_artifact_invalid").when(~true(_safe_path(a["path"])), "source_artifact_path_invalid").when(~true(sound), "source_artifact_invalid")

    first = F.get(F.filter(F.transform(items, fault), lambda e: e.isNotNull()), 0)
    return F.when(items.isNull() | (F.size(items) == 0), "source_artifact_invalid").otherwise(first)


def _artifact_faults(text: Column) -> list[tuple[Column, Column | str]]:
    return [(_artifacts_fault(text).isNotNull(), _artifacts_fault(text))]


def _repeated_paths(artifacts: Column) -> Column:
    return F.size(F.array_distinct(F.transform(artifacts, lambda a: a["path"]))) < F.size(artifacts)


def _canonical(o: Column, schema: str, generated: Column | None = None) -> Column:
    """The text that a sound contract or lock is written as: artifacts by path, instants to the microsecond."""
    o = o.withField("source_artifacts", F.array_sort(o["source_artifacts"]))
    o = o if generated is None else o.withField("generated_at", F.date_format(generated, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    return F.to_json(F.struct(*[o[name].alias(name) for name in _names(schema)]), {"ignoreNullFields": "false"})


def _names(schema: str) -> list[str]:
    return [p.strip().split(" ")[0] for p in _top_fields(schema)]


def _period_faults(o: Column) -> list[tuple[Column, str]]:
    dates = [F.when(o[c].rlike(DAY), F.try_to_date(o[c], "yyyy-MM-dd")) for c in ("period_start", "period_end_exclusive", "as_of")]
    start, end, as_of = dates
    return [
        (start.isNull() | end.isNull() | as_of.isNull(), "date_invalid"),
        ((F.weekday(start) != 0) | (F.datediff(end, start) != 7) | (F.datediff(end, as_of) != 1), "period_invalid"),
    ]


def _first_fault(faults: Sequence[tuple[Column, Column | str]]) -> Column:
    out = F.when(F.coalesce(faults[0][0], F.lit(True)), faults[0][1])
    for condition, code in faults[1:]:
        out = out.when(F.coalesce(condition, F.lit(True)), code)
    return out


def _contract_faults(text: Column, o: Column) -> list[tuple[Column, Column | str]]:
    """Rules of a contract, its text and what CONTRACT_SCHEMA reads of it, in the order in which the first broken one counts."""
    status = o["feed_status"]
    counts = [status[c] for c in ("feed_count", "successful_feed_count", "failed_feed_count", "stale_feed_count", "missing_feed_count")]
    bad_count = F.lit(False)
    for c in counts:
        bad_count = bad_count | c.isNull() | ~c.between(0, vocab.MAX_SAFE_INTEGER)
    generated, (dates, period) = _generated(o), _period_faults(o)
    return [
        (~has_keys(text, _names(CONTRACT_SCHEMA)), "contract_shape_invalid"),
        ((o["schema_version"] != "1") | (o["contract_version"] != CONTRACT_VERSION) | (o["cadence"] != "weekly"), "contract_version_invalid"),
        (~o["run_mode"].isin("scheduled", "manual"), "run_mode_invalid"),
        *_artifact_faults(text),
        (~has_keys(part(text, "feed_status"), STATUS_KEYS) | bad_count | status["complete"].isNull(), "feed_status_invalid"),
        ((counts[0] <= 0) | (counts[1] != counts[0]) | (counts[2] + counts[3] + counts[4] > 0) | ~status["complete"], "feed_status_incomplete"),
        dates,
        (generated.isNull(), "generated_at_invalid"),
        period,
        (generated < F.try_to_date(o["period_end_exclusive"], "yyyy-MM-dd").cast("timestamp"), "generated_at_invalid"),
        (~o["producer_ref"].rlike(SHA1) | ~o["source_provenance"].rlike(IDENTIFIER), "provenance_invalid"),
        (_repeated_paths(o["source_artifacts"]), "source_artifact_duplicate"),
    ]


def _generated(o: Column) -> Column:
    return F.when(o["generated_at"].rlike(INSTANT), o["generated_at"].try_cast("timestamp"))


def audit_contracts(wires: DataFrame, column: str = "contract") -> DataFrame:
    """Adds error_code: the first fault of each row's contract text, null if it is sound and byte for byte canonical.

    Keys are judged at every depth: missing or extra ones are a fault of the object that they are in. The text is also
    written again from what the schema reads: repeated or reordered keys, artifacts out of order, short fractions of
    seconds and white space differ from what was given and end as ``noncanonical``.
    """
    o = F.col("_o")
    rows = wires.withColumn("_o", F.from_json(column, CONTRACT_SCHEMA))
    faults = [*_contract_faults(F.col(column), o), (_canonical(o, CONTRACT_SCHEMA, _generated(o)) != F.col(column), "noncanonical")]
    return rows.withColumn("error_code", _first_fault(faults)).drop("_o")


def audit_manifests(wires: DataFrame, column: str = "manifest") -> DataFrame:
    """Adds error_code of each row's manifest text: of the wrapper, then of its contract, then any byte off the canonical form.

    A key that an object at any depth has twice is ``manifest_duplicate_key``, whatever else is wrong. A contract whose
    content is sound but not written canonically leaves the manifest not canonical.
    """
    text, o = F.col(column), F.col("_o")
    rows = wires.withColumn("_c", part(text, "contract")).withColumn("_o", F.from_json("_c", CONTRACT_SCHEMA))
    error = _first_fault([
        (~is_value(text), "manifest_wire_invalid"),
        (repeats_a_key(text), "manifest_duplicate_key"),
        (~has_keys(text, ("contract", "manifest_type")) | ~part(text, "manifest_type").eqNullSafe(F.lit(MANIFEST_TYPE)), "manifest_shape_invalid"),
        (F.json_object_keys("_c").isNull(), "manifest_contract_invalid"),
        *_contract_faults(F.col("_c"), o),
        (_manifest(_canonical(o, CONTRACT_SCHEMA, _generated(o))) != text, "manifest_noncanonical"),
    ])
    return rows.withColumn("error_code", error).drop("_c", "_o")


def verify_manifests(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """(period_start, verdict) of manifests (period_start, manifest) against the expected contracts (period_start, contract).

    verdict: match, missing, unexpected, the manifest's own fault, or manifest_contract_mismatch.
    """
    a = audit_manifests(actual.select(F.col("period_start").alias("a_week"), "manifest"))
    e = expected.select(F.col("period_start").alias("e_week"), "contract")
    joined = a.join(e, F.col("a_week") == F.col("e_week"), "full_outer")
    verdict = (
        F.when(F.col("a_week").isNull(), "missing").when(F.col("e_week").isNull(), "unexpected").when(F.col("error_code").isNotNull(), F.col("error_code"))
        .when(F.col("manifest") != _manifest(F.col("contract")), "manifest_contract_mismatch").otherwise("match")
    )
    return joined.select(F.coalesce("a_week", "e_week").alias("period_start"), verdict.alias("verdict"))


def lock_rows(weeks: DataFrame) -> DataFrame:
    """(period_start, lock): canonical JSON locks of weeks with the lock's own columns."""
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    artifacts = F.transform(F.array_sort("source_artifacts"), lambda a: F.struct(a["path"].alias("path"), a["row_count"].alias("row_count"), a["sha256"].alias("sha256")))
    values = {
        "as_of": day(F.date_add("period_start", 6)), "calendar": F.lit(CALENDAR), "lock_version": F.lit(LOCK_VERSION), "period_end_exclusive": day(F.date_add("period_start", 7)), "period_start": day(F.col("period_start")),
        "source_artifacts": artifacts, "source_attempt": F.lit(1).cast("long"),
        **{c: F.col(c) for c in ("producer_ref", "source_provenance", "source_run_id", "source_snapshot_digest", "source_snapshot_id", "workflow_ref")},
    }
    return weeks.select("period_start", _json(LOCK_SCHEMA, values).alias("lock"))


def audit_locks(wires: DataFrame, column: str = "lock") -> DataFrame:
    """Adds error_code of each row's lock text, as ``audit_contracts`` does."""
    o, text = F.col("_o"), F.col(column)
    rows = wires.withColumn("_o", F.from_json(column, LOCK_SCHEMA))
    faults = [
        (~has_keys(text, _names(LOCK_SCHEMA)), "lock_shape_invalid"),
        ((o["lock_version"] != LOCK_VERSION) | (o["calendar"] != CALENDAR), "lock_version_invalid"),
        *_period_faults(o),
        (~o["workflow_ref"].rlike(WORKFLOW), "workflow_ref_invalid"),
        (~o["source_run_id"].rlike(RUN_ID), "source_run_id_invalid"),
        (o["source_attempt"] != 1, "source_attempt_invalid"),
        (~o["producer_ref"].rlike(SHA1), "producer_ref_invalid"),
        (~o["source_snapshot_id"].rlike(IDENTIFIER), "source_snapshot_id_invalid"),
        (~o["source_snapshot_digest"].rlike(SHA256), "source_snapshot_digest_invalid"),
        (~o["source_provenance"].rlike(IDENTIFIER), "source_provenance_invalid"),
        *_artifact_faults(text),
        (_repeated_paths(o["source_artifacts"]), "source_artifact_duplicate"),
        (_canonical(o, LOCK_SCHEMA) != text, "noncanonical"),
    ]
    return rows.withColumn("error_code", _first_fault(faults)).drop("_o")


def reconcile(actual: DataFrame, expected: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, verdict, differing): match, mismatch, missing or unexpected, and which columns differ (comma-joined)."""
    a = actual.select(F.col(key).alias("a_key"), F.struct(*columns).alias("a"))
    e = expected.select(F.col(key).alias("e_key"), F.struct(*columns).alias("e"))
    joined = a.join(e, F.col("a_key").eqNullSafe(F.col("e_key")), "full_outer")
    differ = F.filter(F.array(*[F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"e.{c}")), c) for c in columns]), lambda c: c.isNotNull())
    verdict = F.when(F.col("a").isNull(), "missing").when(F.col("e").isNull(), "unexpected").when(F.size(differ) > 0, "mismatch").otherwise("match")
    return joined.select(F.coalesce("a_key", "e_key").alias(key), verdict.alias("verdict"), F.when(verdict == "mismatch", F.array_join(differ, ",")).otherwise("").alias("differing"))
