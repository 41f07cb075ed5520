"""Company mentions: aliases, the matching join, and the records and events that follow."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factmill.functions.text import direction_of, event_type_of, plain_dashes, strict_date
from factmill.operators.records import normalize_records

#: Aliases that one scan of the texts looks for; a larger table is scanned for in parts.
SCAN_ALIASES = 100_000
# Letters that expressions without case take for an ASCII letter and lower() does not, and these ASCII letters.
ALNUM = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
FOLDED = "\u017f\u212a\u0130\u0131"
FOLDING = str.maketrans(FOLDED, "skii")


def load_aliases(raw: DataFrame) -> DataFrame:
    """symbol, alias, kind, pattern for each distinct alias of a row; the symbol itself is put first if it is not one."""
    symbol = F.upper(F.btrim("symbol"))
    given = F.array_distinct(F.filter(F.transform(F.split(F.coalesce("aliases", F.lit("")), r"[|,]"), lambda a: F.btrim(a)), lambda a: a != ""))
    every = F.when(F.array_contains(given, symbol), given).otherwise(F.concat(F.array(symbol), given))
    rows = raw.select(symbol.alias("symbol"), F.explode(every).alias("alias"))
    plain = plain_dashes(F.col("alias"))
    return rows.select("symbol", "alias", alias_kind(plain).alias("kind"), alias_pattern(plain).alias("pattern"))


def alias_kind(alias: Column) -> Column:
    return F.when(alias.rlike("^[A-Za-z]$"), "cashtag").when(alias.rlike(r"^[A-Za-z][A-Za-z0-9.\-]{0,9}$"), "ticker").otherwise("phrase")


def alias_pattern(alias: Column) -> Column:
    """A single letter needs its $; a ticker may have one and stands free; anything else matches anywhere."""
    quoted = F.regexp_replace(alias, r"([\\.\[\]{}()*+?^$|\-])", r"\\$1")
    kind = alias_kind(alias)
    return (
        F.when(kind == "cashtag", F.concat(F.lit(r"(?iu)(?<![A-Za-z0-9])\$"), quoted, F.lit("(?![A-Za-z0-9])")))
        .when(kind == "ticker", F.concat(F.lit(r"(?iu)(?<![A-Za-z0-9$])\$?"), quoted, F.lit("(?![A-Za-z0-9])")))
        .otherwise(F.concat(F.lit("(?iu)"), quoted))
    )


def _folded(text: str) -> str:
    """Lower case in which every ASCII letter stands wherever an expression without case would find it; as long as the text."""
    return (text.translate(FOLDING) if any(c in text for c in FOLDED) else text).lower()


def _held_by(alias: str, kind: str) -> str:
    """A run of ASCII characters that a folded text holds wherever the alias matches; '' if the alias has none."""
    low = ("$" if kind == "cashtag" else "") + _folded(alias)
    return max(re.findall(r"[\x00-\x7f]+", low), key=len, default="")


def _stands(folded: str, start: int, end: int, kind: str) -> bool:
    """Whether an alias of this kind that a folded text holds from ``start`` to ``end`` stands as it must."""
    if kind == "phrase":
        return True
    if kind == "ticker" and start and folded[start - 1] == "$":
        start -= 1
    before, after = folded[start - 1 : start], folded[end : end + 1]
    return after not in ALNUM and before not in ALNUM and not (kind == "ticker" and before == "$")


def _matcher(aliases: list[tuple[str, str, str]]):
    """Finds the symbols of texts. ``aliases``: (symbol, alias with plain dashes, kind).

    One automaton finds, in one pass over a text, where which runs are held. An alias of ASCII characters is such a run
    (a single letter with its $), and the characters beside it decide; others are tried by expression on texts that hold
    their run, or on every text where they have none.
    """
    by_run: dict[str, tuple[list, list]] = {}
    for row in aliases:
        by_run.setdefault(_held_by(*row[1:]), ([], []))[not row[1].isascii()].append(row)
    always = by_run.pop("", ([], []))[1]
    ready: list = []

    def tried(row: tuple[str, str, str], patterns: dict, text: str) -> bool:
        _, alias, kind = row
        if row not in patterns:
            before = {"cashtag": r"(?<![A-Za-z0-9])\$", "ticker": r"(?<![A-Za-z0-9$])\$?"}.get(kind, "")
            patterns[row] = re.compile(before + re.escape(alias) + ("(?![A-Za-z0-9])" if before else ""), re.IGNORECASE)
        return patterns[row].search(text) is not None

    @F.pandas_udf("array<string>")
    def find(texts: pd.Series) -> pd.Series:
        if not ready:  # once for each worker
            import ahocorasick

            automaton = ahocorasick.Automaton()
            for run, rows in by_run.items():
                automaton.add_word(run, (len(run), *rows))
            automaton.make_automaton()
            ready.extend([automaton, {}])
        automaton, patterns = ready
        out = []
        for text in texts:
            folded, found, asked = _folded(text), set(), {id(always): always}
            for last, (length, plain, others) in automaton.iter(folded) if by_run else ():
                for symbol, _, kind in plain:
                    if symbol not in found and _stands(folded, last + 1 - length, last + 1, kind):
                        found.add(symbol)
                if others:
                    asked[id(others)] = others
            found.update(row[0] for rows in asked.values() for row in rows if tried(row, patterns, text))
            out.append(sorted(found))
        return pd.Series(out, dtype=object)

    return find


def mentions(items: DataFrame, aliases: DataFrame, item_columns: tuple[str, ...] = ("item_id",)) -> DataFrame:
    """(item columns, symbol): each symbol once for every item row whose text matches one of its aliases.

    A text's symbols are found within its row by one scan for all aliases, so rows are neither joined nor shuffled, equal
    rows each keep their mentions, and the result is the same for one alias and for any number. Beyond SCAN_ALIASES
    aliases there is one scan for each part of the table, in the same pass over the rows. The alias table, which every
    worker holds, is read to the driver part by part.
    """
    text = plain_dashes(F.coalesce("text", F.lit("")))
    rows = aliases.select("symbol", plain_dashes(F.col("alias")).alias("alias"), "kind").distinct().orderBy("alias", "symbol")
    scans, part = [], []
    for r in rows.toLocalIterator():
        part.append(tuple(r))
        if len(part) == SCAN_ALIASES:
            scans.append(_matcher(part)(text))
            part = []
    if part:
        scans.append(_matcher(part)(text))
    if not scans:
        return items.select(*item_columns, F.lit("").alias("symbol")).limit(0)
    each = scans[0] if len(scans) == 1 else F.array_sort(F.array_distinct(F.flatten(F.array(*scans))))
    return items.select(*item_columns, F.explode(each).alias("symbol"))


def mention_records(items: DataFrame, aliases: DataFrame) -> DataFrame:
    """Records of the mentions; they stay unverified. The date of an item counts only if the item matched."""
    columns = ("item_id", "published_at", "source_type", "source_url", "author", "text")
    found = mentions(items, aliases, columns)
    author = F.coalesce("author", F.lit(""))
    return found.select(
        F.concat("item_id", F.lit("-"), F.lower("symbol")).alias("record_id"), F.substring_index("published_at", "T", 1).alias("record_date"), "symbol", "source_type",
        event_type_of(F.col("source_type"), F.col("text")).alias("event_type"), direction_of(F.col("text")).alias("direction"), "source_url",
        F.btrim(F.concat(author, F.lit(": "), "text"), F.lit(": ")).alias("summary"), F.lit("unverified").alias("entity_match_type"), F.lit("").alias("match_evidence"), F.lit("unverified").alias("relationship_type"),
    )


def mention_events(items: DataFrame, aliases: DataFrame, strict: bool = False) -> DataFrame:
    return normalize_records(mention_records(items, aliases), strict)


def item_dates_invalid(items: DataFrame, aliases: DataFrame) -> DataFrame:
    """Matched items whose date part is no date."""
    records = mention_records(items, aliases)
    return records.where(strict_date(F.col("record_date")).isNull()).select("record_id", "record_date")
