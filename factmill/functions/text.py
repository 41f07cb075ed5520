"""Column expressions for text, URLs, dates and ids."""

from __future__ import annotations

import html
from collections.abc import Mapping, Sequence
from datetime import UTC, datetime
from email.utils import parsedate_to_datetime

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from factmill.functions import vocab

#: White space as text means it in feeds: Java's own class lacks the separators and the information separators.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]+"
#: The same at either end of a text.
EDGES = rf"^{SPACE}|{SPACE}$"
DASHES = "‐‑‒–—−"
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
# Hours from UTC of the zone names that mail dates use.
ZONES = {"": 0, "GMT": 0, "UT": 0, "UTC": 0, "Z": 0, "EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7}


def empty_as_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def slug(c: Column) -> Column:
    """Lower case, other than letters and digits as single dashes, none at the ends; ``record`` if nothing is left."""
    dashed = F.btrim(F.regexp_replace(F.lower(F.btrim(c)), "[^a-zA-Z0-9]+", "-"), F.lit("-"))
    return F.coalesce(empty_as_null(dashed), F.lit("record"))


def _url(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"^[\x00-\x20]+", "")


def is_https(c: Column) -> Column:
    return _url(c).rlike(r"(?i)^https://[^/?#]+")


def is_government_url(c: Column) -> Column:
    """https, and the whole authority (port and user too) ends with .gov."""
    return F.lower(F.regexp_extract(_url(c), r"(?i)^https://([^/?#]+)", 1)).rlike(r"\.gov$")


def plain_dashes(c: Column) -> Column:
    return F.translate(c, DASHES, "-" * len(DASHES))


def has_any(c: Column, terms: Sequence[str]) -> Column:
    """Whether the text holds one of the terms, in any case and also inside words."""
    low, found = F.lower(c), F.lit(False)
    for t in terms:  # plain searches, far cheaper than an expression of alternatives
        found = found | F.contains(low, F.lit(t))
    return found


def event_type_of(source_type: Column, text: Column, procurement: Sequence[str] = vocab.PROCUREMENT_TERMS, policy: Sequence[str] = vocab.POLICY_TERMS) -> Column:
    return (
        F.when(source_type.isin(*vocab.MEDIA_SOURCES), "public_mention")
        .when(has_any(text, procurement), "procurement")
        .when(has_any(text, policy), "policy_capital")
        .otherwise("public_mention")
    )


def direction_of(text: Column, negative: Sequence[str] = vocab.NEGATIVE_TERMS, positive: Sequence[str] = vocab.POSITIVE_TERMS) -> Column:
    return F.when(has_any(text, negative), "bearish").when(has_any(text, positive), "bullish").otherwise("neutral")


def confidence_of(source_type: Column) -> Column:
    return F.when(source_type.isin(*vocab.GOVERNMENT_SOURCES), "high").when(source_type.isin(*vocab.MEDIA_SOURCES), "low").otherwise("medium")


def weight(c: Column, weights: Mapping[str, int]) -> Column:
    """The weight of a value, 0 for others."""
    pairs = [F.lit(x) for item in weights.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), F.lit(0))


def strict_date(c: Column) -> Column:
    """The date of trimmed ISO text (calendar, basic or week form), else null; nothing looser is accepted."""
    t = F.btrim(c)
    compact = F.concat_ws("-", F.substring(t, 1, 4), F.substring(t, 5, 2), F.substring(t, 7, 2))
    week = r"^(\d{4})(-?)W(\d{2})(?:\2([1-7]))?$"
    year, number = F.regexp_extract(t, week, 1).try_cast("int"), F.regexp_extract(t, week, 3).try_cast("int")
    day = F.coalesce(F.regexp_extract(t, week, 4).try_cast("int"), F.lit(1))
    monday = F.to_date(F.date_trunc("week", F.make_date(year, F.lit(1), F.lit(4))))
    last = F.weekofyear(F.make_date(year, F.lit(12), F.lit(28)))
    return (
        F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(t, "yyyy-MM-dd"))
        .when(t.rlike(r"^\d{8}$"), F.try_to_date(compact, "yyyy-MM-dd"))
        .when(t.rlike(week) & number.between(1, last), F.date_add(monday, ((number - 1) * 7 + day - 1).cast("int")))
    )


def any_instant(text: str) -> str | None:
    """The UTC instant of a mail date in any of its forms (comments, full names, dashes, obsolete zones), else of ISO
    text, as ``yyyy-MM-ddTHH:mm:ssZ``; a missing zone is UTC. None where it is neither, or lies outside years 1 to 9999."""
    try:
        try:
            moment = parsedate_to_datetime(text)
        except (TypeError, ValueError, IndexError):
            moment = datetime.fromisoformat(f"{text[:-1]}+00:00" if text.endswith("Z") else text)
        moment = moment.replace(tzinfo=UTC) if moment.tzinfo is None else moment.astimezone(UTC)
    except (ValueError, OverflowError):
        return None
    return moment.replace(microsecond=0, tzinfo=None).isoformat() + "Z"


def utc_instant(c: Column, ingested_at: Column) -> Column:
    """Feed dates (mail or ISO form) as ``yyyy-MM-ddTHH:mm:ssZ``; a missing zone is UTC, blank text is ``ingested_at``, others null.

    The usual forms are read by built-in functions; what they refuse, and nothing else, goes through ``any_instant``.
    """

    @F.pandas_udf("string")
    def refused(texts: pd.Series) -> pd.Series:
        return texts.map(any_instant, na_action="ignore")

    usual = F.get(F.transform(F.array(c), _usual_instant), 0)  # so that what c stands for is computed once, not for each use
    blank = F.coalesce(F.btrim(c), F.lit("")) == ""
    return F.when(blank, ingested_at).otherwise(F.coalesce(usual, refused(F.when(~blank & usual.isNull(), F.regexp_replace(c, EDGES, "")))))


def _usual_instant(c: Column) -> Column:
    t = F.btrim(c)
    mail = r"^(?:[A-Za-z]{3}, *)?(\d{1,2}) ([A-Za-z]{3}) (\d{2}|[1-9]\d{3}) (\d{2}):(\d{2})(?::(\d{2}))?(?: ([A-Za-z]+|[+-](?:[01]\d|2[0-3])[0-5]\d))?$"
    part = [F.regexp_extract(t, mail, i) for i in range(8)]
    months = F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS) for x in (m, i + 1)])
    zones = F.create_map(*[F.lit(x) for item in ZONES.items() for x in item])
    year = part[3].try_cast("int")
    year = F.when(F.length(part[3]) > 2, year).when(year < 69, year + 2000).otherwise(year + 1900)
    sign = F.when(part[7].startswith("-"), -1).otherwise(1)
    offset = F.when(part[7].rlike(r"^[+-]"), sign * (F.substring(part[7], 2, 2).try_cast("int") * 60 + F.substring(part[7], 4, 2).try_cast("int")))
    offset = offset.otherwise(F.try_element_at(zones, F.upper(part[7])) * 60)
    day = F.try_to_date(F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(F.try_element_at(months, F.lower(part[2])).cast("string"), 2, "0"), F.lpad(part[1], 2, "0")), "yyyy-MM-dd")
    seconds = F.unix_date(day).cast("long") * 86400 + part[4].try_cast("int") * 3600 + part[5].try_cast("int") * 60 + F.coalesce(part[6].try_cast("int"), F.lit(0)) - offset * 60
    in_range = (part[4].try_cast("int") < 24) & (part[5].try_cast("int") < 60) & (F.coalesce(part[6].try_cast("int"), F.lit(0)) < 60)
    from_mail = F.when(in_range, F.timestamp_seconds(seconds))
    # with a zone there must be a time: whatever follows a day alone is taken for the sign between day and time
    iso = r"^(\d{4}-\d{2}-\d{2})(?:[T ](\d{2}:\d{2})(?:(:\d{2})(?:[.,]\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"
    zone = F.regexp_replace(F.regexp_extract(t, iso, 4), r"^([+-]\d{2})(\d{2})$", "$1:$2")
    text = F.concat(
        F.regexp_extract(t, iso, 1), F.lit("T"), F.coalesce(empty_as_null(F.regexp_extract(t, iso, 2)), F.lit("00:00")),
        F.coalesce(empty_as_null(F.regexp_extract(t, iso, 3)), F.lit(":00")), F.coalesce(empty_as_null(zone), F.lit("Z")),
    )
    moment = F.when(t.rlike(mail), from_mail).when(t.rlike(iso), text.try_cast("timestamp"))
    years = (moment >= F.lit("0001-01-01T00:00:00Z").cast("timestamp")) & (moment < F.lit("+10000-01-01T00:00:00Z").cast("timestamp"))
    return F.when(years, F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def without_tags(c: Column) -> Column:
    """Tags as spaces, white space runs as one space, trimmed; character references stay (see ``unescaped``)."""
    return F.btrim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), SPACE, " "))


def unescaped(c: Column) -> Column:
    """Character references decoded; a Python UDF, as no built-in function knows them all.

    Only texts with an ampersand go there, some hundred at a time, so that what a worker holds does not grow with its partition.
    """
    decode = F.udf(lambda text: None if text is None else html.unescape(text), "string", useArrow=False)
    return F.coalesce(decode(F.when(F.contains(c, F.lit("&")), c)), c)


def stable_id(feed_id: Column, link: Column, title: Column) -> Column:
    return F.concat(feed_id, F.lit("-"), F.substring(F.sha1(F.concat_ws("|", feed_id, link, title)), 1, 12))


def joined_text(title: Column, body: Column) -> Column:
    return F.concat_ws(" ", empty_as_null(title), empty_as_null(body))


def percent_return(start: Column, end: Column) -> Column:
    """(end / start - 1) * 100 in this order; a start of 0 raises under ANSI mode."""
    return (end / start - F.lit(1.0)) * F.lit(100.0)


def six_decimals(c: Column) -> Column:
    """A double as text with six decimals, rounded by its exact value and ties to even, as C and Python do.

    ``format_string`` rounds the shortest decimal that names the double, and ties up. The two can differ only next to a
    tie; there the fraction is taken apart into integers. Beyond 2^53 a double has no fraction; beyond 2^63 its digits are
    ``format_string``'s.
    """
    units = F.abs(c) * 1e6
    near = (F.abs(units - F.floor(units) - 0.5) <= 1e-3 + units * 2.0**-50) | F.abs(c).between(2.0**32, 2.0**62)
    exact = F.get(F.transform(F.transform(F.transform(F.array(c), _taken_apart), _in_units), _spelled), 0)  # each step is computed once
    return F.when(c.isNotNull(), F.when(near & (F.abs(c) < 2.0**63), exact).otherwise(F.format_string("%.6f", c)))


def _taken_apart(c: Column) -> Column:
    """A double's sign, whole part, and its fraction as integers: 30 bits, 50 more bits, and whether there is anything below."""
    whole = F.floor(F.abs(c))
    high = (F.abs(c) - whole) * 2.0**30
    low = (high - F.floor(high)) * 2.0**50
    sign = F.when(F.format_string("%.0f", c).startswith("-"), "-").otherwise("")
    return F.struct(sign.alias("sign"), whole.alias("whole"), F.floor(high).alias("high"), F.floor(low).alias("low"), (low > F.floor(low)).alias("more"))


def _in_units(v: Column) -> Column:
    """The fraction in millionths, and in 2^-80 of them what is left."""
    n = v["high"].cast("decimal(10,0)") * F.lit(str(10**6 << 50)).cast("decimal(22,0)") + v["low"].cast("decimal(16,0)") * F.lit(10**6).cast("decimal(7,0)")
    one = F.lit(str(1 << 80)).cast("decimal(25,0)")
    return F.struct(v["sign"].alias("sign"), v["whole"].alias("whole"), F.floor((n - n % one) / one).cast("long").alias("units"), (n % one).alias("rest"), v["more"].alias("more"))


def _spelled(v: Column) -> Column:
    half = F.lit(str(1 << 79)).cast("decimal(24,0)")
    units = v["units"] + F.when((v["rest"] > half) | (v["rest"] == half) & (v["more"] | (v["units"] % 2 == 1)), 1).otherwise(0)
    return F.concat(v["sign"], (v["whole"] + F.floor(units / 1_000_000)).cast("string"), F.lit("."), F.lpad((units % 1_000_000).cast("string"), 6, "0"))
