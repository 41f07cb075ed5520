import datetime
import hashlib
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from factmill.functions import vocab
from factmill.operators import feeds as fd
from factmill.operators import quality as ql
from factmill.operators import tracker as tr
from factmill.operators import weekly as wk
from factmill.sources import files
from factmill.streaming import intake

RSS = b'<?xml version="1.0"?><rss><channel><item><title>A &amp; B</title><guid>https://x/1</guid><pubDate>Fri, 09 Jan 2026 08:30:00 GMT</pubDate><description><![CDATA[<b>c</b>  d]]></description></item><item><title>two</title></item></channel></rss>'
ATOM = b'<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>t</title><link href="https://y/1"/><updated>2026-01-09T10:00:00Z</updated><summary>s</summary></entry><entry><title>u</title><id>urn:2</id></entry></feed>'
DTD = b'<!DOCTYPE rss [<!ENTITY a "b">]><rss><channel><item><title>&a;</title></item></channel></rss>'


def payloads(spark, **content):
    return spark.createDataFrame([(k, bytearray(v)) for k, v in content.items()], "feed_id string, content binary")


def test_payloads(spark):
    big = b"<rss><channel></channel></rss>" + b" " * (1 << 20)
    rows = fd.parse_payloads(payloads(spark, rss=RSS, atom=ATOM, dtd=DTD, wide=DTD.decode().encode("utf-16"), ok16=RSS.decode().replace('<?xml version="1.0"?>', "").encode("utf-16"), cut=RSS[:60], odd=b'<?xml version="1.0" encoding="x-none"?><rss/>', big=big, none=b"<rss><channel/></rss>"), 25).collect()
    by = {}
    for r in rows:
        by.setdefault(r.feed_id, []).append(r)
    assert [r.title for r in by["rss"]] == ["A & B", "two"] and by["rss"][0].link == "https://x/1" and by["rss"][0].body == "<b>c</b>  d"
    assert [(r.title, r.link, r.published_at) for r in by["atom"]] == [("t", "https://y/1", "2026-01-09T10:00:00Z"), ("u", "urn:2", None)]
    assert {k: by[k][0].error for k in ("dtd", "wide", "cut", "odd", "big")} == {"dtd": "feed_xml_invalid", "wide": "feed_xml_invalid", "cut": "feed_xml_invalid", "odd": "feed_xml_invalid", "big": "feed_xml_oversize"}
    assert len(by["ok16"]) == 2 and "none" not in by


def test_items_and_statuses(spark):
    feeds = spark.createDataFrame([("rss", "https://f/rss", "financial_media", "d"), ("gone", "https://f/gone", "financial_media", "")], "feed_id string, feed_url string, source_type string, author string")
    given = payloads(spark, rss=RSS)
    first, second = sorted(fd.feed_items(given, feeds, F.lit("2026-02-01T00:00:00Z")).collect(), key=lambda r: r.pos)
    assert first.text == "A & B c d" and first.published_at == "2026-01-09T08:30:00Z" and first.item_id == "rss-" + hashlib.sha1(b"rss|https://x/1|A & B").hexdigest()[:12]
    assert second.source_url == "" and second.published_at == "2026-02-01T00:00:00Z"
    statuses = fd.fetch_statuses(given, feeds)
    assert {r.feed_id: (r.ok, r.item_count) for r in statuses.collect()} == {"rss": (True, 2), "gone": (False, 0)}
    assert ql.success_ratio(ql.feed_rollup(statuses)).first().feed_success_ratio == 0.5
    assert fd.gate_all_failed(statuses).count() == 2
    with pytest.raises(Exception, match="all feeds failed"):
        fd.gate_all_failed(statuses.where("not ok")).collect()


NAMESPACES = b'xmlns:media="http://m" xmlns:atom="http://www.w3.org/2005/Atom" xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:content="http://purl.org/rss/1.0/modules/content/"'


def test_names_and_faulty_dates(spark):
    item = b'<item><media:title>wrong</media:title><atom:link href="https://wrong"/><title> a &lt;i&gt;b&lt;/i&gt; &amp;amp; <b>c</b></title><link>https://r/1</link><dc:date>2026-01-09</dc:date><content:encoded>x &lt;p&gt;y</content:encoded></item>'
    rss = b"<rss " + NAMESPACES + b"><channel>" + item + b"<item><title></title><link> </link><guid>g</guid></item></channel></rss>"
    bad = b"<rss><channel><item><title>t</title><pubDate>not a date</pubDate></item><item><title>u</title></item></channel></rss>"
    atom = b'<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>t</title><link rel="self"/><link href=" https://y/2 "/><content>c</content></entry></feed>'
    feeds = spark.createDataFrame([(f, f"https://f/{f}", "financial_media", None) for f in ("rss", "bad", "atom")], "feed_id string, feed_url string, source_type string, author string")
    given = payloads(spark, rss=rss, bad=bad, atom=atom)
    rows = {(r.feed_id, r.pos): r for r in fd.feed_items(given, feeds, F.lit("2026-02-01T00:00:00Z")).collect()}
    assert set(rows) == {("rss", 0), ("rss", 1), ("atom", 0)}
    first = rows["rss", 0]
    assert (first.source_url, first.text, first.published_at) == ("https://r/1", "a <i>b</i> &amp; x y", "2026-01-09T00:00:00Z")
    assert first.item_id == "rss-" + hashlib.sha1(b"rss|https://r/1|a <i>b</i> &amp;").hexdigest()[:12]
    assert rows["rss", 1].source_url == "g" and rows["rss", 1].text == "" and rows["atom", 0].source_url == " https://y/2 "
    statuses = {r.feed_id: (r.ok, r.item_count, r.error) for r in fd.fetch_statuses(given, feeds).collect()}
    assert statuses == {"rss": (True, 2, ""), "atom": (True, 1, ""), "bad": (False, 0, "feed_date_invalid")}
    assert [r.item_id[:4] for r in fd.sorted_items(fd.feed_items(given, feeds, F.lit("2026-02-01T00:00:00Z"))).collect()][0] == "rss-"


def test_a_fault_is_that_of_its_payload(spark, tmp_path):
    """Three weeks of one feed, one with a bad date: two weeks' items stay. Files carry their path; stop-on-first fails instead."""
    week = "<rss><channel><item><title>w{0}</title><pubDate>{1}</pubDate></item><item><title>x{0}</title></item></channel></rss>"
    dates = ["Fri, 09 Jan 2026 08:30:00 GMT", "someday", "23 January 2026 8:30:00 +0000 (UTC)"]
    for i, date in enumerate(dates):
        (tmp_path / f"week{i}").mkdir()
        (tmp_path / f"week{i}" / "one.xml").write_text(week.format(i, date))
    (tmp_path / "week0" / "two.xml").write_bytes(ATOM)
    given = files.read_payloads(spark, f"{tmp_path}/*/*.xml")
    feeds = spark.createDataFrame([(f, f"https://f/{f}", "financial_media", "") for f in ("one", "two")], "feed_id string, feed_url string, source_type string, author string")
    items = fd.feed_items(given, feeds, F.lit("2026-02-01T00:00:00Z")).collect()
    assert sorted((r.feed_id, r.text.split()[0], r.published_at[:10]) for r in items) == [("one", "w0", "2026-01-09"), ("one", "w2", "2026-01-23"), ("one", "x0", "2026-02-01"), ("one", "x2", "2026-02-01"), ("two", "t", "2026-01-09"), ("two", "u", "2026-02-01")]
    assert [(r.feed_id, r.payload.split("/")[-2], r.error) for r in fd.payload_faults(given).collect()] == [("one", "week1", "feed_date_invalid")]
    assert {r.feed_id: (r.ok, r.item_count, r.error) for r in fd.fetch_statuses(given, feeds).collect()} == {"one": (False, 4, "feed_date_invalid"), "two": (True, 2, "")}
    with pytest.raises(Exception, match="feed one failed: feed_date_invalid"):
        fd.feed_items(given, feeds, F.lit(""), stop_on_first=True).collect()
    assert fd.feed_items(given.where("feed_id = 'two'"), feeds, F.lit(""), stop_on_first=True).count() == 2
    # only the items that are read are judged
    late = payloads(spark, one="".join(["<rss><channel>", *["<item><title>t</title></item>"] * 2, "<item><pubDate>bad</pubDate></item></channel></rss>"]).encode())
    assert fd.feed_items(late, feeds, F.lit(""), max_items=2).count() == 2 and fd.feed_items(late, feeds, F.lit(""), max_items=3).count() == 0


ROW = ("i1", "2026-01-01", "financial_media", "https://x", "", 'say "a\\b" </x> é')
OUTCOME = f"feed_id string, feed_url string, kind string, state string, rows {fd.ROW_FIELDS}, error_code string"


def test_digest_is_canonical(spark):
    rows = [ROW, ("i0", *ROW[1:])]
    df = spark.createDataFrame([("f", "u", "rss2", "accepted", rows, None), ("g", "u", "atom", "failed", [], "http_error")], OUTCOME)
    got = {r.feed_id: r.row_digest for r in fd.feed_digests(df).collect()}
    payload = json.dumps([dict(zip(vocab.ROW_KEYS, r, strict=True)) for r in sorted(rows)], ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()
    assert got == {"f": hashlib.sha256(payload).hexdigest(), "g": vocab.EMPTY_DIGEST}


@pytest.mark.parametrize(
    ("outcome", "code"),
    [
        (("f", "u", "rss2", "accepted", [ROW], None), None), (("f", "u", "x", "accepted", [ROW], None), "feed_kind_invalid"), (("f", "u", "rss2", "x", [], None), "feed_state_invalid"),
        (("f", "u", "rss2", "accepted", [("i", "d", "s", "u", "", "a\nb")], None), "row_invalid"), (("f", "u", "rss2", "accepted", [("", "d", "s", "u", "", "a")], None), "row_invalid"),
        (("f", "u", "rss2", "accepted", [], None), "outcome_invariant_invalid"), (("f", "u", "unknown", "quarantined", [], "e"), "feed_kind_invalid"), (("f", "u", "rss2", "failed", [], "Bad"), "error_code_invalid"), (("", "u", "rss2", "failed", [], "e"), "feed_invalid"),
    ],
)
def test_outcome_errors(spark, outcome, code):
    assert spark.createDataFrame([outcome], OUTCOME).select(fd.outcome_error().alias("e")).first().e == code


def test_decision(spark):
    good, quarantined, failed = ("a", "u", "rss2", "accepted", [ROW], None), ("b", "u", "atom", "quarantined", [], "e"), ("c", "u", "unknown", "failed", [], "e")
    for rows, wanted in (([good], "success"), ([good, quarantined], "quarantine"), ([good, quarantined, failed], "hard_fail"), ([good, good], "invalid"), ([], "invalid")):
        assert fd.publication_decision(spark.createDataFrame(rows, OUTCOME)).first().decision == wanted


def status(**changes):
    feeds = [{"feed_id": i, "feed_url": "u", "kind": "rss2", "state": s, "accepted_row_count": int(s == "accepted"), "rejected_row_count": 0, "row_digest": "a" * 64 if s == "accepted" else vocab.EMPTY_DIGEST, "error_code": None if s == "accepted" else "e"} for i, s in (("a", "accepted"), ("b", "failed"), ("c", "quarantined"))]
    for name, value in changes.items():
        if name[:2] in ("f0", "f1", "f2"):
            feeds[int(name[1])][name[3:]] = value
    row = {"status_version": fd.STATUS_VERSION, "configured_feed_count": 3, "feed_count": 3, "successful_feed_count": 1, "failed_feed_count": 1, "quarantined_feed_count": 1, "accepted_row_count": 1, "rejected_row_count": 0, "publication_complete": False, "eligible_for_live_publication": False, "aggregate_row_digest": "b" * 64, "feeds": feeds}
    return json.dumps(row | {k: v for k, v in changes.items() if k in row}, sort_keys=True, separators=(",", ":"))


@pytest.mark.parametrize("read", ["columns", "text"])
def test_status_audit(spark, read):
    cases = [
        ({}, None), ({"status_version": "x"}, "status_version_invalid"), ({"feed_count": -1}, "status_counter_invalid"), ({"publication_complete": None}, "status_flag_invalid"), ({"aggregate_row_digest": "x"}, "status_digest_invalid"), ({"feeds": []}, "feed_invalid"),
        ({"f0_feed_url": ""}, "feed_invalid"), ({"f1_feed_id": "a"}, "feed_duplicate"), ({"f1_feed_id": "Z"}, "feed_order_invalid"), ({"f1_kind": "x"}, "feed_kind_invalid"), ({"f0_state": "x"}, "feed_state_invalid"), ({"f0_kind": "unknown"}, "feed_kind_invalid"), ({"f1_kind": "unknown"}, None),
        ({"f0_accepted_row_count": 10_001}, "feed_counter_invalid"), ({"f0_rejected_row_count": 1}, "rejected_count_invalid"), ({"f0_accepted_row_count": 0}, "feed_state_invalid"), ({"f1_row_digest": "A" * 64}, "status_digest_invalid"), ({"f0_row_digest": vocab.EMPTY_DIGEST}, "empty_digest_invalid"),
        ({"f0_error_code": "e"}, "feed_state_invalid"), ({"f2_error_code": None}, "feed_error_invalid"), ({"feed_count": 2}, "status_counter_invalid"), ({"failed_feed_count": 2}, "status_counter_invalid"), ({"rejected_row_count": 1}, "rejected_count_invalid"), ({"aggregate_row_digest": vocab.EMPTY_DIGEST}, "empty_digest_invalid"),
        ({"eligible_for_live_publication": True}, "status_flag_invalid"), ({"f1_kind": "x", "f2_feed_id": ""}, "feed_kind_invalid"), ({"f0_error_code": "e", "f1_feed_url": "", "f2_feed_id": "a"}, "feed_state_invalid"),
    ]
    wires = spark.createDataFrame([(i, status(**c)) for i, (c, _) in enumerate(cases)], "status_id int, status string")
    audited = fd.audit_status_wires(wires) if read == "text" else fd.audit_statuses(wires.select("status_id", F.from_json("status", fd.STATUS_SCHEMA).alias("s")).select("status_id", "s.*"))
    assert {r.status_id: r.error_code for r in audited.collect()} == {i: e for i, (_, e) in enumerate(cases)}


def test_status_texts(spark):
    good = status()
    texts = {good: None, " " + good: "status_noncanonical", good.replace("{", '{"x":1,', 1): "status_invalid", good.replace("{", '{"feed_count":3,', 1): "status_duplicate_key", good[:-4]: "status_invalid", "[]": "status_invalid", good.replace('"kind":"rss2"', '"kind":"rss2","more":1', 1): "feed_invalid",
        good.replace('"kind":"rss2"', '"kind":"rss2","kind":"rss2"', 1): "status_duplicate_key", good.replace('"kind":"rss2",', "", 1): "feed_invalid", good + "x": "status_invalid", good.replace('"feeds":[', '"feeds":[1,', 1): "feed_invalid", good.replace('"feeds":[', '"feeds":[[{"a":1,"a":2}],', 1): "status_duplicate_key"}
    got = [r.error_code for r in fd.audit_status_wires(spark.createDataFrame(list(enumerate(texts)), "status_id int, status string")).orderBy("status_id").collect()]
    assert got == list(texts.values())
    columns = spark.createDataFrame([(1, good)], "status_id int, status string").select("status_id", F.from_json("status", fd.STATUS_SCHEMA).alias("s")).select("status_id", "s.*")
    assert fd.status_wires(columns).first().status == good


def test_manifests(spark):
    contract = wk.contract_rows(spark.createDataFrame([week()], WEEK))
    text = wk.manifest_rows(contract).first().manifest
    assert text == json.dumps(json.loads(text), sort_keys=True, separators=(",", ":")) and set(json.loads(text)) == {"contract", "manifest_type"}
    inner = json.loads(text)["contract"]
    texts = {
        text: None, " " + text: "manifest_noncanonical", text[:-3]: "manifest_wire_invalid", "[1]": "manifest_shape_invalid", text + "]": "manifest_wire_invalid", "": "manifest_wire_invalid", text.replace("{", '{"x":1,', 1): "manifest_shape_invalid", text.replace("{", '{"manifest_type":"a",', 1): "manifest_duplicate_key",
        text.replace(wk.MANIFEST_TYPE, "other"): "manifest_shape_invalid", json.dumps({"contract": 1, "manifest_type": wk.MANIFEST_TYPE}): "manifest_contract_invalid", text.replace('"run_mode":"manual"', '"run_mode":"x"'): "run_mode_invalid",
        json.dumps({"contract": inner, "manifest_type": wk.MANIFEST_TYPE}): "manifest_noncanonical", text.replace('"cadence":"weekly"', '"cadence":"weekly","more":1'): "contract_shape_invalid",
        text.replace('"cadence":"weekly"', '"cadence":"weekly","cadence":"weekly"'): "manifest_duplicate_key", text.replace('"complete":true', '"complete":true,"complete":true'): "manifest_duplicate_key", text.replace('{"path":"b.csv"', '{"path":"b.csv","path":"b.csv"'): "manifest_duplicate_key",
        text.replace('"complete":true', '"complete":true,"more":1'): "feed_status_invalid", text.replace('"stale_feed_count":0,', ""): "feed_status_invalid", text.replace('{"path":"b.csv"', '{"more":1,"path":"b.csv"'): "source_artifact_invalid", text.replace('"path":"a.csv",', ""): "source_artifact_invalid",
        text.replace('"run_mode":"manual"', '"run_mode":{"x":1,"x":1}'): "manifest_duplicate_key", text.replace(".000005Z", "Z"): "manifest_noncanonical", text.replace('"source_artifacts":[', '"source_artifacts":[5,'): "source_artifact_invalid",
        text.replace('"a.csv"', '"../a"').replace('{"path":"b.csv"', '{"more":1,"path":"b.csv"'): "source_artifact_path_invalid",
        json.dumps({"contract": inner | {"source_artifacts": inner["source_artifacts"][::-1]}, "manifest_type": wk.MANIFEST_TYPE}, sort_keys=True, separators=(",", ":")): "manifest_noncanonical",
    }
    got = {r.manifest: r.error_code for r in wk.audit_manifests(spark.createDataFrame([(t,) for t in texts], "manifest string")).collect()}
    assert got == texts
    day = datetime.date
    actual = spark.createDataFrame([(day(2026, 1, 5), text), (day(2026, 1, 12), text), (day(2026, 1, 19), "x")], "period_start date, manifest string")
    one = contract.first().contract
    expected = spark.createDataFrame([(day(2026, 1, 5), one), (day(2026, 1, 19), one), (day(2026, 1, 26), one)], "period_start date, contract string")
    assert {r.period_start.day: r.verdict for r in wk.verify_manifests(actual, expected).collect()} == {5: "match", 12: "unexpected", 19: "manifest_wire_invalid", 26: "missing"}
    other = expected.withColumn("contract", F.replace("contract", F.lit("manual"), F.lit("scheduled")))
    assert {r.verdict for r in wk.verify_manifests(actual, other).where("period_start = DATE '2026-01-05'").collect()} == {"manifest_contract_mismatch"}


def week(**changes):
    row = {
        "period_start": datetime.date(2026, 1, 5), "source_artifacts": [("b.csv", 2, "0" * 64), ("a.csv", 1, "f" * 64)], "complete": True, "failed_feed_count": 0, "feed_count": 2, "missing_feed_count": 0, "stale_feed_count": 0,
        "successful_feed_count": 2, "generated_at": datetime.datetime(2026, 1, 12, 0, 0, 0, 5), "run_mode": "manual", "producer_ref": "a" * 40, "source_provenance": "live_feed",
    }
    return tuple((row | changes).values())


WEEK = f"period_start date, source_artifacts {wk.ARTIFACTS}, complete boolean, failed_feed_count bigint, feed_count bigint, missing_feed_count bigint, stale_feed_count bigint, successful_feed_count bigint, generated_at timestamp, run_mode string, producer_ref string, source_provenance string"


def test_contract_is_canonical_json(spark):
    text = wk.contract_rows(spark.createDataFrame([week()], WEEK)).first().contract
    assert text == json.dumps(json.loads(text), sort_keys=True, separators=(",", ":"))
    assert json.loads(text)["source_artifacts"][0]["path"] == "a.csv" and '"2026-01-12T00:00:00.000005Z"' in text


@pytest.mark.parametrize(
    ("changes", "code"),
    [
        ({}, None), ({"period_start": datetime.date(2026, 1, 6)}, "period_invalid"), ({"source_artifacts": [("/abs", 1, "0" * 64)]}, "source_artifact_path_invalid"), ({"source_artifacts": [("a/../b", 1, "0" * 64)]}, "source_artifact_path_invalid"),
        ({"source_artifacts": [("a", 1, "A" * 64)]}, "source_artifact_invalid"), ({"source_artifacts": [("a", 2**53, "0" * 64)]}, "source_artifact_invalid"), ({"source_artifacts": [("a", 1, "0" * 64), ("a", 2, "0" * 64)]}, "source_artifact_duplicate"),
        ({"source_artifacts": []}, "source_artifact_invalid"), ({"stale_feed_count": 1}, "feed_status_incomplete"), ({"generated_at": datetime.datetime(2026, 1, 11)}, "generated_at_invalid"), ({"producer_ref": "x"}, "provenance_invalid"), ({"run_mode": "x"}, "run_mode_invalid"),
    ],
)
def test_contract_audit(spark, changes, code):
    assert wk.audit_contracts(wk.contract_rows(spark.createDataFrame([week(**changes)], WEEK))).first().error_code == code


def test_tampered_contracts(spark):
    text = wk.contract_rows(spark.createDataFrame([week()], WEEK)).first().contract
    wires = [" " + text, text.replace('"cadence":"weekly",', ""), text.replace("{", '{"x":1,', 1), text.replace('"cadence"', '"cadence":"weekly","cadence"'), text.replace('"row_count":1', '"row_count":"1"'), text[:-5]]
    got = [r.error_code for r in wk.audit_contracts(spark.createDataFrame([(w,) for w in wires], "contract string")).collect()]
    assert got == ["noncanonical", "contract_shape_invalid", "contract_shape_invalid", "noncanonical", "source_artifact_invalid", "contract_shape_invalid"]


LOCKED = "period_start date, source_artifacts " + wk.ARTIFACTS + ", producer_ref string, source_provenance string, source_run_id string, source_snapshot_digest string, source_snapshot_id string, workflow_ref string"


def test_lock_audit(spark):
    """Each rule of a lock, one broken at a time, and the first of two."""
    row = (datetime.date(2026, 1, 5), [("b.csv", 2, "0" * 64), ("a.csv", 1, "f" * 64)], "a" * 40, "live_feed", "12", "b" * 64, "events_weekly", "jobs/weekly@v1")
    text = wk.lock_rows(spark.createDataFrame([row], LOCKED)).first().lock
    assert text == json.dumps(json.loads(text), sort_keys=True, separators=(",", ":"))
    changes = {
        "lock_version_invalid": ('"calendar":"', '"calendar":"x'), "period_invalid": ('"as_of":"2026-01-11"', '"as_of":"2026-01-10"'), "date_invalid": ('"as_of":"2026-01-11"', '"as_of":"2026-1-11"'), "workflow_ref_invalid": ("jobs/weekly@v1", "-x"), "source_run_id_invalid": ('"12"', '"012"'),
        "source_attempt_invalid": ('"source_attempt":1', '"source_attempt":2'), "producer_ref_invalid": ("a" * 40, "A" * 40), "source_snapshot_id_invalid": ("events_weekly", "Events"), "source_snapshot_digest_invalid": ("b" * 64, "b" * 63), "source_provenance_invalid": ("live_feed", "live feed"),
        "source_artifact_path_invalid": ('"a.csv"', '"a//b"'), "source_artifact_invalid": ('"row_count":1,', '"row_count":1.5,'), "source_artifact_duplicate": ('"a.csv"', '"b.csv"'), "lock_shape_invalid": ('"calendar"', '"more":1,"calendar"'), "noncanonical": ('","calendar', '", "calendar'),
    }
    texts = [text, *(text.replace(*c, 1) for c in changes.values()), text.replace("jobs/weekly@v1", "-x").replace("live_feed", "live feed"), "no"]
    got = [r.error_code for r in wk.audit_locks(spark.createDataFrame([(t,) for t in texts], "lock string")).collect()]
    assert got == [None, *changes, "workflow_ref_invalid", "lock_shape_invalid"]


def test_reconcile(spark):
    a = spark.createDataFrame([(1, "x", 1), (2, "y", 1), (4, "z", 1)], "k int, v string, w int")
    e = spark.createDataFrame([(1, "x", 1), (2, "n", 2), (3, "m", 1)], "k int, v string, w int")
    assert {tuple(r) for r in wk.reconcile(a, e, "k", ["v", "w"]).collect()} == {(1, "match", ""), (2, "mismatch", "v,w"), (3, "missing", ""), (4, "unexpected", "")}


def test_streaming_equals_batch(spark, tmp_path):
    T = datetime.datetime
    rows = [("a", T(2026, 1, 4, 23, 59, 59)), ("a", T(2026, 1, 4, 23, 59, 59)), ("b", T(2026, 1, 5)), ("s", T(2030, 1, 1))]
    spark.createDataFrame([(i, t.strftime("%Y-%m-%dT%H:%M:%SZ")) for i, t in rows], "item_id string, published_at string").write.parquet(str(tmp_path / "in"))
    stream = intake.new_items(spark.readStream.schema("item_id string, published_at string").parquet(str(tmp_path / "in")))
    counted = stream.groupBy(F.window("published_ts", "7 days", "7 days", "4 days")).agg(F.count(F.lit(1)).alias("n")).select(F.to_date("window.start").alias("w"), "n")
    intake.run_available(counted, str(tmp_path / "out"), str(tmp_path / "check"))
    got = {(r.w, r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(datetime.date(2025, 12, 29), 1), (datetime.date(2026, 1, 5), 1)}


def test_files_round_trip(spark, tmp_path):
    rows = [("1", 'a "q", b\nc', None), ("2", "", "x")]
    files.write_rows(spark.createDataFrame(rows, "item_id string, text string, author string"), str(tmp_path / "rows"), files.ITEM_COLUMNS)
    got = {(r.item_id, r.text, r.author, r.source_url) for r in files.read_items(spark, str(tmp_path / "rows")).collect()}
    assert got == {("1", 'a "q", b\nc', "", ""), ("2", "", "x", "")}


def test_quality(spark):
    events = spark.createDataFrame([("a", "high", "x"), (" A ", "", "x"), ("", None, "y")], "symbol string, confidence string, event_type string")
    row = ql.quality_summary(events).first()
    assert row.symbols == ["A"] and row.confidence_counts == {"high": 1, "unknown": 2} and row.event_type_counts == {"x": 2, "y": 1}


def test_live_manifest(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, n in (("orders.csv", 2), ("my_orders.csv", 3), ("note.json", 0)):
        (tmp_path / "in" / name).write_text("id\n" + "".join(f"{i}\n" for i in range(n)))
    rows = ql.file_row_counts(spark.read.option("header", True).csv(str(tmp_path / "in" / "*.csv")), str(tmp_path))
    ql.write_live_manifest(spark, str(tmp_path / "in"), rows, spark.range(1).select(F.lit(5).alias("symbol_count")), str(tmp_path / "out"), str(tmp_path))
    got = json.loads(spark.read.text(str(tmp_path / "out")).first().value)
    assert got["artifact_count"] == 3 and got["data_quality"] == {"symbol_count": 5}
    assert {a["path"].rpartition("/")[2]: a.get("row_count") for a in got["artifacts"]} == {"orders.csv": 2, "my_orders.csv": 3, "note.json": None}
    assert [a["path"] for a in got["artifacts"]] == ["in/my_orders.csv", "in/note.json", "in/orders.csv"]
    assert all(a["sha256"] == hashlib.sha256((tmp_path / "in" / a["path"].rpartition("/")[2]).read_bytes()).hexdigest() for a in got["artifacts"])


def test_status_file_and_weekly_files(spark, tmp_path):
    statuses = spark.createDataFrame([("a", "u", True, 2, ""), ("b", "v", False, 0, "feed_missing")], "feed_id string, feed_url string, ok boolean, item_count bigint, error string")
    files.write_status(statuses, str(tmp_path / "status"))
    row = files.read_status(spark, str(tmp_path / "status")).first()
    assert (row.feed_count, row.successful_feed_count, row.failed_feed_count, row.item_count) == (2, 1, 1, 2) and [f.feed_id for f in row.feeds] == ["a", "b"]
    files.write_weekly(spark.createDataFrame([(datetime.date(2026, 1, 5), 1), (datetime.date(2026, 1, 12), 2)], "period_start date, n int"), str(tmp_path / "weeks"))
    assert spark.read.parquet(str(tmp_path / "weeks")).where("period_start = DATE '2026-01-12'").first().n == 2
    files.write_json_rows(spark.createDataFrame([("{}",)], "value string"), str(tmp_path / "lines"), "value")
    assert spark.read.text(str(tmp_path / "lines")).first().value == "{}"
    (tmp_path / "feeds.csv").write_text('feed_id,feed_url,source_type,author\na,https://u,financial_media,"x, y"\n')
    assert tuple(files.read_feeds(spark, str(tmp_path / "feeds.csv")).first()) == ("a", "https://u", "financial_media", "x, y")


def test_tracker_as_state_equals_the_batch(spark, tmp_path):
    """Events over several batches and starts, some delivered again; a batch that is tried again; the batch tracker of all of them."""
    schema = "event_id string, event_date date, symbol string, event_type string, confidence string"
    r = random.Random(3)
    kinds, tiers = ["public_mention", "disclosure_buy", "policy_capital", "odd"], ["high", "low", "odd"]
    rows = [(f"e{i}", datetime.date(2026, 1, 1 + r.randrange(28)), r.choice("ABCZ"), r.choice(kinds), r.choice(tiers)) for i in range(60)]
    watch = spark.createDataFrame([(x, x.lower(), "policy_capital", "", "", "") for x in "ABCD"] + [("A", "twice", "other", "new", "", "")], "symbol string, name string, bucket string, research_status string, thesis string, source_url string")
    at = {k: str(tmp_path / k) for k in ("in", "evidence", "check")}
    wanted = lambda some: sorted(map(str, tr.build_tracker(watch, spark.createDataFrame(some, schema)).collect()))
    for stop in (20, 40, 60):
        for part in (rows[stop - 20 : stop - 8], rows[max(0, stop - 30) : stop]):  # the second holds what the first and earlier files had
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(at["in"])
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(at["in"])
        intake.refresh_evidence(stream, at["evidence"], at["check"])
        assert sorted(map(str, intake.current_tracker(spark, watch, at["evidence"]).collect())) == wanted(rows[:stop])
    batches = sorted(os.listdir(at["evidence"]))
    assert len(batches) == 6
    # only symbols that a batch touched are written
    one = spark.createDataFrame([("new", datetime.date(2026, 2, 1), "B", "odd", "low")], schema)
    one.coalesce(1).write.mode("append").parquet(at["in"])
    intake.refresh_evidence(spark.readStream.schema(schema).parquet(at["in"]), at["evidence"], at["check"])
    assert [x.e_symbol for x in spark.read.parquet(f"{at['evidence']}/batch=6").collect()] == ["B"]
    again = spark.read.parquet(f"{at['evidence']}/batch=5").collect()
    intake._keep(spark.createDataFrame(again, spark.read.parquet(f"{at['evidence']}/batch=5").schema), at["evidence"], 5)
    assert sorted(map(str, intake.current_tracker(spark, watch, at["evidence"]).collect())) == wanted([*rows, *one.collect()])


def test_weeks_close_by_the_watermark(spark, tmp_path):
    """A week is reported once, when the watermark passes its end: late fetches within the delay count, later ones don't."""
    schema = "ts timestamp, feed_id string, ok boolean, item_date date"
    at, day = {k: str(tmp_path / k) for k in ("in", "gates", "check")}, datetime.datetime
    feeds = spark.createDataFrame([("a",), ("b",), ("c",)], "feed_id string")

    def land(*rows):
        spark.createDataFrame([(t, f, ok, i) for t, f, ok, i in rows], schema).coalesce(1).write.mode("append").parquet(at["in"])
        intake.close_weeks(spark.readStream.schema(schema).parquet(at["in"]), feeds, at["gates"], at["check"], "3 days")
        return {r.period_start.day: (r.successful_feed_count, r.failed_feed_count, r.stale_feed_count, r.missing_feed_count, r.complete) for r in spark.read.parquet(at["gates"]).collect()}

    item = datetime.date(2026, 1, 6)
    assert land((day(2026, 1, 6), "a", True, item), (day(2026, 1, 7), "b", False, item)) == {}
    assert land((day(2026, 1, 13), "a", True, item)) == {}
    assert land((day(2026, 1, 8), "b", True, item)) == {}  # late, within the delay: b was read after all
    first = {5: (2, 0, 0, 1, False)}
    assert land((day(2026, 1, 16), "c", True, datetime.date(2026, 1, 14))) == first
    assert land((day(2026, 1, 9), "c", True, item)) == first  # too late: its week is closed
    assert land((day(2026, 1, 26), "a", True, item)) == first | {12: (1, 0, 1, 1, False)}


def test_payloads_as_a_stream(spark, tmp_path):
    """Files land, are read once and archived; faults stand beside the items; the items are those of the batch function."""
    landing, archive, out = tmp_path / "landing", tmp_path / "archive", str(tmp_path / "out")
    landing.mkdir()
    feeds = spark.createDataFrame([(f, f"https://f/{f}", "financial_media", "") for f in ("rss", "atom")], "feed_id string, feed_url string, source_type string, author string")
    now = F.lit("2026-02-01T00:00:00Z")
    contents = [{"rss.xml": RSS, "atom.xml": ATOM}, {"dtd.xml": DTD, "rss.v2.xml": b"<rss>"}, {"atom.xml.later": ATOM}]
    items, faults = set(), set()
    for i, files_ in enumerate(contents):
        for name, data in files_.items():
            (landing / name).write_bytes(data)
        batch = files.read_payloads(spark, f"file:{landing}/*")
        items |= {(r.payload.rpartition("/")[2], *r[:6]) for r in fd.feed_items(batch, feeds, now).collect()}
        faults |= {(r.payload.rpartition("/")[2], r.error) for r in fd.payload_faults(batch).collect()}
        intake.take_in(intake.payload_stream(spark, f"file:{landing}", f"file:{archive}"), feeds, now, out, str(tmp_path / "check"))
    got = spark.read.parquet(f"{out}/items").collect()
    assert len(got) == len(items) and {(r.payload.rpartition("/")[2], *r[:6]) for r in got} == items
    assert {(r.payload.rpartition("/")[2], r.error) for r in spark.read.parquet(f"{out}/faults").collect()} == faults == {("dtd.xml", "feed_xml_invalid"), ("rss.v2.xml", "feed_xml_invalid")}
    assert any(p.name == "rss.xml" for p in archive.rglob("*"))


def test_weekly_gate(spark):
    day = datetime.date
    feeds = spark.createDataFrame([("a",), ("b",), ("c",)], "feed_id string")
    weeks = spark.createDataFrame([(day(2026, 1, 5),), (day(2026, 1, 12),)], "period_start date")
    seen = spark.createDataFrame([(day(2026, 1, 5), f, True, day(2026, 1, 6)) for f in "abc"] + [(day(2026, 1, 12), "a", True, day(2026, 1, 6)), (day(2026, 1, 12), "b", False, None)], "period_start date, feed_id string, ok boolean, last_item date")
    got = {r.period_start.day: (r.successful_feed_count, r.failed_feed_count, r.stale_feed_count, r.missing_feed_count, r.complete) for r in wk.weekly_gate(feeds, seen, weeks).collect()}
    assert got == {5: (3, 0, 0, 0, True), 12: (0, 1, 1, 1, False)}


def test_workers_hold_few_payloads_at_a_time(spark):
    """Payloads and texts reach Python in small batches, not as Arrow batches of a partition; an oversize payload is cut before."""
    big = b"<rss>" + b"x" * (vocab.MAX_PAYLOAD_BYTES + 9)
    payloads = spark.createDataFrame([("a", bytearray(RSS)), ("b", bytearray(big)), ("c", None), ("d", bytearray(b"<"))], "feed_id string, content binary")
    feeds = spark.createDataFrame([(f, "u", "financial_media", None) for f in "abcd"], "feed_id string, feed_url string, source_type string, author string")
    items = fd.feed_items(payloads, feeds, F.lit("2026-01-01T00:00:00Z"))
    plan = items._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and not any(x in plan for x in ("MapInPandas", "MapInArrow", "ArrowEvalPython"))
    assert {(r.feed_id, r.error) for r in fd.payload_faults(payloads).collect()} == {("b", "feed_xml_oversize"), ("c", "feed_xml_invalid"), ("d", "feed_xml_invalid")}
    assert [r.text for r in items.orderBy("pos").collect()] == ["A & B c d", "two"]


def test_weekly_gate_has_no_task_for_each_pair_of_parts(spark):
    """Streamed batches and tables of unknown size too: one side of the product is broadcast."""
    rows = spark.range(0, 40, 1, 4).selectExpr("DATE '2026-01-05' + INT(id % 2) * 7 AS period_start", "STRING(id % 3) AS feed_id", "true AS ok", "DATE '2026-01-12' AS last_item")
    seen = rows.rdd.toDF(rows.schema)  # its size is not known
    plan = wk.weekly_gate(seen.select("feed_id"), seen, seen)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" in plan


def test_group_decisions(spark):
    good, failed, twice = ("a", "u", "rss2", "accepted", [ROW], None), ("c", "u", "unknown", "failed", [], "e"), ("a", "w", "rss2", "accepted", [ROW], None)
    rows = [(1, *good), (2, *good), (2, *failed), (3, *good), (3, *twice), (4, "b", "u", "x", "failed", [], "e")]
    got = {r.k: (r.decision, r.error) for r in fd.publication_decisions(spark.createDataFrame(rows, "k int, " + OUTCOME), "k").collect()}
    assert got == {1: ("success", None), 2: ("hard_fail", None), 3: ("invalid", "feed_duplicate"), 4: ("invalid", "feed_kind_invalid")}
