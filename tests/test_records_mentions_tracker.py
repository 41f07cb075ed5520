import datetime
import random

import pytest

from factmill.operators import mentions as mt
from factmill.operators import records as rc
from factmill.operators import tracker as tr
from factmill.sources import files

SCHEMA = ", ".join(f"{c} string" for c in rc.RECORD_COLUMNS)
GOOD = ("Doc 1", "2026-01-10", "evt", "government_policy", "policy_capital", "", "https://a.gov/x", "note", "issuer", "", "issuer")


def record(**changes):
    return tuple(changes.get(c, v) for c, v in zip(rc.RECORD_COLUMNS, GOOD, strict=True))


def test_normalized(spark):
    row = rc.normalize_records(spark.createDataFrame([record()], SCHEMA)).first()
    assert (row.event_id, row.event_date, row.symbol, row.direction, row.confidence) == ("official-government-policy-doc-1", datetime.date(2026, 1, 10), "EVT", "neutral", "high")


@pytest.mark.parametrize(
    ("changes", "code"),
    [
        ({"record_date": "2026-13-01", "record_id": " "}, "record_date_invalid"), ({"record_id": " "}, "record_id_blank"), ({"symbol": ""}, "symbol_blank"), ({"entity_match_type": ""}, "entity_match_type_invalid"),
        ({"relationship_type": "x"}, "relationship_type_invalid"), ({"event_type": "x"}, "event_type_invalid"), ({"source_url": "https://a.com"}, "government_url_invalid"),
        ({"source_type": "issuer_release", "source_url": "http://a.com"}, "issuer_url_invalid"), ({"source_type": "financial_media", "source_url": "http://a.com"}, "media_url_invalid"), ({"source_type": "blog"}, "source_type_unsupported"),
    ],
)
def test_rejections(spark, changes, code):
    df = spark.createDataFrame([record(**changes)], SCHEMA)
    assert rc.rejected_records(df).first().error_code == code
    assert rc.normalize_records(df).count() == 0
    with pytest.raises(Exception, match="invalid record"):
        rc.normalize_records(df, strict=True).collect()


def test_legacy_columns(spark):
    df = spark.createDataFrame([record()], SCHEMA).drop("entity_match_type", "match_evidence", "relationship_type")
    assert rc.normalize_records(df).first().relationship_type == "unverified"


ALIASES = [("F", "F"), ("EVT1", "EVT1| |EVT1"), ("F150", "F-150"), ("BIG", "Example Motors Group"), ("TWO", "EVT1")]


@pytest.mark.parametrize("scan", [100_000, 2, 1])
def test_mentions(spark, monkeypatch, scan):
    monkeypatch.setattr(mt, "SCAN_ALIASES", scan)
    texts = {"1": "see $F now", "2": "C.F.R. and aF", "3": "$EVT1!", "4": "PREVT1 $$EVT1", "5": "an F‑150 truck", "6": "preexample motors groups", "7": None}
    items = spark.createDataFrame(list(texts.items()), "item_id string, text string")
    got = {tuple(r) for r in mt.mentions(items, mt.load_aliases(spark.createDataFrame(ALIASES, "symbol string, aliases string"))).collect()}
    assert got == {("1", "F"), ("3", "EVT1"), ("3", "TWO"), ("5", "F150"), ("6", "BIG")}
    assert mt.mentions(items, mt.load_aliases(spark.createDataFrame([], "symbol string, aliases string"))).collect() == []


@pytest.mark.parametrize("extra", [0, 2_000])
def test_equal_rows_keep_their_mentions(spark, extra):
    """The rows are the same beside few aliases and beside many, and no row meets another."""
    items = spark.createDataFrame([("1", "$F and F-150"), ("1", "$F and F-150"), ("2", "nothing")], "item_id string, text string")
    table = spark.createDataFrame([*ALIASES, *((f"X{i}", f"Other Name {i}|QX{i}é") for i in range(extra))], "symbol string, aliases string")
    found = mt.mentions(items, mt.load_aliases(table))
    assert sorted(map(tuple, found.collect())) == [("1", "F"), ("1", "F"), ("1", "F150"), ("1", "F150")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_many_aliases_against_every_pattern(spark):
    r = random.Random(8)
    words = ["".join(r.choices("abkis.é-", k=r.randrange(1, 6))) for _ in range(400)]
    loaded = mt.load_aliases(spark.createDataFrame([(f"s{i}", f"{w}|{w} {words[i - 1]}") for i, w in enumerate(words)], "symbol string, aliases string"))
    texts = ["".join(r.choice([*words, " ", " $", "$", "K", "\u0130", "x"]) for _ in range(8)) for _ in range(60)]
    items = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "item_id string, text string")
    wanted = {(x.item_id, x.symbol) for x in items.crossJoin(loaded).where("text rlike pattern").collect()}
    assert {tuple(x) for x in mt.mentions(items, loaded).collect()} == wanted and len(wanted) > 100


def test_mentions_without_case(spark):
    """The search for literals lets through whatever the patterns match."""
    aliases = [("KIS", "kis"), ("UBER", "Über Kis"), ("K", "k"), ("ASK", "ask kiss")]
    texts = ["\u212ai\u017f", "K\u0130S", "k\u0131s", "ÜBER KIS", "über kis!", "$\u212a", "kisx", "none", "xA\u017f\u212a k\u0131\u017fSy", "a\u017fk kis"]
    loaded = mt.load_aliases(spark.createDataFrame(aliases, "symbol string, aliases string"))
    items = spark.createDataFrame([(t, t) for t in texts], "item_id string, text string")
    wanted = {(r.item_id, r.symbol) for r in items.crossJoin(loaded).where("text rlike pattern").collect()}
    assert {tuple(r) for r in mt.mentions(items, loaded).collect()} == wanted and len(wanted) >= 7


def test_import_official_events(spark, tmp_path):
    rows = [record(), record(record_id="Doc 0", record_date="2026-01-09", summary='a "q", b')]
    files.write_rows(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "in"), rc.RECORD_COLUMNS)
    rc.import_official_events(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    events = rc.load_events(files.read_rows(spark, str(tmp_path / "out")))
    got = [(r.event_id, r.event_date, r.symbol, r.notes) for r in rc.sorted_events(events).collect()]
    assert got == [("official-government-policy-doc-0", datetime.date(2026, 1, 9), "EVT", 'a "q", b'), ("official-government-policy-doc-1", datetime.date(2026, 1, 10), "EVT", "note")]
    with pytest.raises(Exception, match="event without a valid date"):
        rc.load_events(spark.createDataFrame([("e", "x", "A", "t")], "event_id string, event_date string, symbol string, event_type string")).collect()


def test_tracker(spark):
    watch = spark.createDataFrame([("A", "a", "policy_capital", "", "legacy", "", ""), ("B", "b", "other", "", "", "", ""), ("C", "c", "named_mentioned", "new", "", "", "")], "symbol string, name string, bucket string, research_status string, article_status string, thesis string, source_url string")
    D = datetime.date
    events = spark.createDataFrame(
        [("1", D(2026, 1, 1), "B", "public_mention", "high"), ("2", D(2026, 1, 2), "B", "disclosure_buy", "low"), ("3", D(2026, 1, 2), "C", "odd", "odd")],
        "event_id string, event_date date, symbol string, event_type string, confidence string",
    )
    rows = {r.symbol: r for r in tr.ranked(tr.build_tracker(tr.load_watchlist(watch), events)).collect()}
    assert (rows["A"].trigger_status, rows["A"].priority_score, rows["A"].event_count, rows["A"].latest_event_date) == ("legacy", 4, 0, None)
    assert (rows["B"].trigger_status, rows["B"].priority_score, rows["B"].latest_event_type) == ("disclosure_plus_mention", 11, "disclosure_buy")
    assert (rows["C"].trigger_status, rows["C"].priority_score) == ("new", 4)
    assert [s for s, _ in sorted(((s, r.tracker_rank) for s, r in rows.items()), key=lambda x: x[1])] == ["B", "A", "C"]


def test_faulty_rows_are_quarantined(spark, tmp_path):
    (tmp_path / "rows.csv").write_text('a,b,c\n1,"x\ny",3\n1,2\n1,2,3,4\n,,\n"q ""z""",é,\n')
    good, faulty = files.checked_rows(spark, str(tmp_path / "rows.csv"), ("a", "b", "c"))
    assert [tuple(r) for r in good.collect()] == [("1", "x\ny", "3"), ("", "", ""), ('q "z"', "é", "")]
    assert [r.line for r in faulty.collect()] == ["1,2", "1,2,3,4"] and good.select("b").count() == 3 and faulty.select("line").count() == 2
    with pytest.raises(Exception, match="(?i)header"):
        files.checked_rows(spark, str(tmp_path / "rows.csv"), ("a", "c", "b"))[0].collect()
