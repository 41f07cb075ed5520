import datetime
import email.utils
import random

import pytest
from pyspark.sql import functions as F

from factmill.functions import text as tx


def values(spark, rows, *columns, schema="v string"):
    return [tuple(r) for r in spark.createDataFrame([(r,) for r in rows], schema).select(*columns).collect()]


def test_slug(spark):
    assert values(spark, [" A b/C ", "--", "", "Ünï-1"], tx.slug(F.col("v"))) == [("a-b-c",), ("record",), ("record",), ("n-1",)]


def test_urls(spark):
    rows = ["https://a.gov", "http://a.gov", " https://x.GOV/p", "https://a.gov:8080/", "https://user@x.gov", "https://evil.example/.gov", "https://", None]
    got = values(spark, rows, tx.is_https(F.col("v")), tx.is_government_url(F.col("v")))
    assert got == [(True, True), (False, False), (True, True), (True, False), (True, True), (True, False), (False, False), (False, False)]


def test_strict_date(spark):
    rows = ["2026-01-10", " 2026-01-10 ", "20260110", "2026-W02-6", "2026W026", "2026-W02", "2026-1-5", "2026", "2026-13-01", "2026-W00-1", "2026-W54-1", "2026-01-10T00:00", ""]
    day = datetime.date(2026, 1, 10)
    assert [r[0] for r in values(spark, rows, tx.strict_date(F.col("v")))] == [day, day, day, day, day, datetime.date(2026, 1, 5), None, None, None, None, None, None, None]


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        ("Fri, 09 Jan 2026 08:30:00 EST", "2026-01-09T13:30:00Z"), ("9 Jan 26 08:30 +0530", "2026-01-09T03:00:00Z"), ("09 Jan 2026 08:30:00", "2026-01-09T08:30:00Z"), ("2026-01-09", "2026-01-09T00:00:00Z"),
        ("2026-01-09T10:00Z", "2026-01-09T10:00:00Z"), ("2026-01-09T10:00:05.25+02:00", "2026-01-09T08:00:05Z"), ("31 Feb 2026 08:30:00 GMT", None), ("soon", None), ("", "now"),
    ],
)
def test_instants(spark, given, wanted):
    assert values(spark, [given], tx.utc_instant(F.col("v"), F.lit("now"))) == [(wanted,)]


FORMS = {
    "Sat, 27 Jun 2026 08:30:00 +0000 (UTC)": "2026-06-27T08:30:00Z", "Saturday, 27 Jun 2026 08:30:00 GMT": "2026-06-27T08:30:00Z", "27 June 2026 08:30:00 GMT": "2026-06-27T08:30:00Z", "27 Jun 2026 8:30:00 GMT": "2026-06-27T08:30:00Z",
    "27-Jun-2026 08:30:00 GMT": "2026-06-27T08:30:00Z", "27 Jun 2026 08:30:00 CET": "2026-06-27T08:30:00Z", "Sat,  27  Jun 2026  08:30:00 GMT": "2026-06-27T08:30:00Z", "Jun 27, 2026 08:30:00 GMT": "2026-06-27T08:30:00Z",
    "20260627T083000Z": "2026-06-27T08:30:00Z", "2026-06-27T08Z": "2026-06-27T08:00:00Z", "2026-W26-6T08:30:00Z": "2026-06-27T08:30:00Z", "27 Jun 2026 08:30:00 +00:00": "2026-06-27T08:30:00Z", "27 Jun 2026 08.30.00 GMT": "2026-06-27T08:30:00Z",
    "\u00a02026-06-27\u2003": "2026-06-27T00:00:00Z", "27 Jun 26 08:30 EDT": "2026-06-27T12:30:00Z", "27 Jun 2026 25:30:00 GMT": None, "0001-01-01T00:00:00+05:00": None, "2026-06-27T08:30:00 then": None, "(c)": None, ",": None,
}


def test_date_forms_of_feeds(spark):
    got = [r[0] for r in values(spark, list(FORMS), tx.utc_instant(F.col("v"), F.lit("now")))]
    assert dict(zip(FORMS, got, strict=True)) == FORMS


def test_generated_dates_read_as_the_rule_says(spark):
    """Mail dates first, then ISO text; naive ones are UTC: what the built-in functions read must not differ."""
    r = random.Random(12)
    days, months = ["", "Mon, ", "Tuesday, ", "wed ", "Thu,"], ["Jan", "feb", "March", "SEP", "Dec", "Foo"]
    zones = ["", " GMT", " +0530", " -0000", " EST", " Z", " CET", " +00:00", " (x)", " -9999", " utc"]
    mail = lambda: f"{r.choice(days)}{r.randrange(0, 33)}{r.choice(' -')}{r.choice(months)}{r.choice([' ', '-', '  '])}{r.choice(['2026', '26', '99', '0026', '126'])} {r.randrange(0, 26)}:{r.randrange(0, 61):02d}{r.choice(['', ':07', ':60', ':7'])}{r.choice(zones)}"
    iso = lambda: f"{r.choice(['2026', '0001', '9999'])}{r.choice(['-', ''])}{r.randrange(0, 14):02d}{r.choice(['-', ''])}{r.randrange(0, 33):02d}{r.choice(['', 'T08:30', ' 08:30:05', 'T083005', 'T08:30:05.5', 'T24:00', 'T08:30:05,25'])}{r.choice(['', 'Z', '+02:00', '-0530', '+02', ' Z', '+23:59'])}"
    texts = [r.choice([mail, iso])() for _ in range(10_000)]

    def rule(text):
        try:
            try:
                moment = email.utils.parsedate_to_datetime(text)
            except (TypeError, ValueError):
                moment = datetime.datetime.fromisoformat(text[:-1] + "+00:00" if text.endswith("Z") else text)
            moment = moment if moment.tzinfo else moment.replace(tzinfo=datetime.UTC)
            return moment.astimezone(datetime.UTC).strftime("%4Y-%m-%dT%H:%M:%SZ").zfill(20)
        except (ValueError, OverflowError):
            return None

    got = [x[0] for x in values(spark, texts, tx.utc_instant(F.col("v"), F.lit("now")))]
    wrong = [(t, g, rule(t)) for t, g in zip(texts, got, strict=True) if g != rule(t)]
    assert wrong == []


def test_html_text(spark):
    assert values(spark, ["<p>a &amp; <b>b</b>  \n c</p>"], tx.unescaped(tx.without_tags(F.col("v")))) == [("a & b c",)]


def test_direction_prefers_negative_terms(spark):
    assert values(spark, ["a great bank", "great news", "none"], tx.direction_of(F.col("v"))) == [("bearish",), ("bullish",), ("neutral",)]
