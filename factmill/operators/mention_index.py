"""Company mentions by an inverted index: alias tables of any size, by built-in functions and joins only.

Aliases and texts are folded alike, so that equal folded characters are equal without case. Each alias is a literal there, cut
into pieces if it is long, and each piece is filed under its rarest gram of three characters. Texts are read in
overlapping blocks; where a block holds a filed gram, the characters that a piece would take are compared with the pieces.
"""

from __future__ import annotations

import sys
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factmill.functions.text import plain_dashes
from factmill.sources.shared import written

#: Characters of a gram, most characters of a piece, and places of a block at which a piece may begin.
GRAM = 3
PIECE = 64
STRIDE = 128
#: Beside the sizes of grams, the kind of keys that are words.
WORD = 0
#: Most shapes that one pass broadcasts (a key and three small numbers each), and most bytes of pieces that are broadcast.
SHAPES = 500_000
BROADCAST_BYTES = 32 << 20

_ALNUM = "^[a-z0-9]$"
#: Pieces that a text holds as a whole word: a ticker of letters and digits, or a letter with its $.
_PLAIN = "kind <> 'phrase' AND piece RLIKE '^[$]?[a-z0-9]+$'"


@cache
def _canonical() -> tuple[str, str]:
    """Lower-case characters that share their upper case with another one, and that other one: a long s and an s."""
    odd = [(c, c.upper().lower()) for c in map(chr, range(sys.maxunicode + 1)) if c.upper().lower() != c == c.lower() and len(c.upper().lower()) == 1]
    return "".join(a for a, _ in odd), "".join(b for _, b in odd)


def folded(c: Column) -> Column:
    """As long as the text, and equal for texts that differ in case only."""
    return F.translate(F.lower(F.translate(plain_dashes(c), "İ", "i")), *_canonical())


def _text_key() -> Column:
    """16 bytes for each text."""
    return F.unhex(F.substring(F.sha2(F.col("text").cast("binary"), 256), 1, 32))


def _words(items: DataFrame, *keep: str | Column) -> DataFrame:
    """Each text's distinct words that stand as a ticker must, and letters with their $."""
    text = F.col("_folded")
    tickers = F.regexp_extract_all(text, F.lit(r"(?<![a-z0-9$])[$]?([a-z0-9]+)"), F.lit(1))
    cashtags = F.regexp_extract_all(text, F.lit(r"(?<![a-z0-9])([$][a-z])(?![a-z0-9])"), F.lit(1))
    rows = items.where("text <> ''").withColumn("_folded", folded(F.col("text")))
    return rows.select(*keep, F.explode(F.array_distinct(F.concat(tickers, cashtags))).alias("_word"))


def _frequent(plain: DataFrame, items: DataFrame) -> DataFrame:
    """(piece, n): the pieces in most texts, so many that their rows of ``plain`` may be broadcast."""
    counts = _words(items).groupBy(F.col("_word").alias("piece")).agg(F.count(F.lit(1)).alias("n"))
    rows = plain.groupBy("piece").agg(F.sum(_held()).alias("bytes")).join(counts, "piece")
    rows = written(rows.withColumn("size", F.floor(F.log2("n"))), "alias-counts")
    least, room = 64, BROADCAST_BYTES
    for r in rows.groupBy("size").agg(F.sum("bytes").alias("bytes")).orderBy(F.desc("size")).collect():  # at most 63
        if (room := room - r["bytes"]) < 0:
            break
        least = r["size"]
    return rows.where(F.col("size") >= least).select("piece")


def _held() -> Column:
    return F.octet_length("piece") + F.octet_length("symbol") + 100


def _word_hits(items: DataFrame, plain: DataFrame, item_columns: tuple[str, ...]) -> tuple[DataFrame, DataFrame | None]:
    """Rows of the result that words alone decide, and (text_key, symbol) of other such words.

    A symbol of a single literal is found once in a text, as its words are distinct; such rows are whole where the text
    is. Symbols of several literals, and words too rare to be broadcast, go by the text's key. Of the words, only rare ones are shuffled.
    """
    bytes_held = plain.agg(F.coalesce(F.sum(_held()), F.lit(0))).first()[0]
    table = plain.select("piece", "symbol", "single")
    common, rare = table, None
    if bytes_held > BROADCAST_BYTES:
        often = F.broadcast(_frequent(plain, items))
        common, rare = table.join(often, "piece", "left_semi"), table.join(often, "piece", "left_anti")
    near = F.broadcast(common.where("single").select(F.col("piece").alias("_of"), F.col("symbol").alias("_symbol")))
    whole = _words(items, *item_columns).join(near, F.col("_word") == F.col("_of"))
    keyed = _words(items, _text_key().alias("text_key")).withColumnRenamed("_word", "piece")
    found = keyed.join(F.broadcast(common.where("NOT single").select("piece", "symbol")), "piece").select("text_key", "symbol")
    if rare is not None:
        others = keyed.join(F.broadcast(common.select("piece").distinct()), "piece", "left_anti")
        found = found.unionByName(others.join(rare.select("piece", "symbol").hint("merge"), "piece").select("text_key", "symbol"))
    return whole.select(*item_columns, F.col("_symbol").alias("symbol")), found


def _blocks(items: DataFrame, longest: int) -> DataFrame:
    """(text_key, block_no, block) of all texts; a block goes on for as long as a piece that begins in it may."""
    cut = rf"(?s)(?=(.{{1,{STRIDE + 3 + longest}}})).{{1,{STRIDE}}}"
    texts = items.where("text <> ''").select(_text_key().alias("text_key"), folded(F.col("text")).alias("folded"))
    return texts.select("text_key", F.posexplode(F.regexp_extract_all("folded", F.lit(cut), F.lit(1))).alias("block_no", "block"))


def _each(rows: DataFrame, text: str, ahead: str, *keep: str) -> DataFrame:
    """For each place of the text what the expression finds from there on, if it finds anything."""
    found = rows.select(*keep, F.posexplode(F.regexp_extract_all(text, F.lit(f"(?s)(?=({ahead}|))."), F.lit(1))).alias("place", "key"))
    return found.where("key <> ''")


def _keys(rows: DataFrame, text: str, kinds: list[int], *keep: str) -> DataFrame:
    """Where the text holds a key, by the kinds of keys in use: grams of 1 to GRAM characters, and words (WORD)."""
    parts = []
    for kind in kinds:
        ahead = "(?<![a-z0-9])[a-z0-9]+" if kind == WORD else f".{{{kind}}}"
        parts.append(_each(rows, text, ahead, *keep).withColumn("by", F.lit(kind)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def alias_pieces(aliases: DataFrame) -> DataFrame:
    """(symbol, kind, literal_key, pieces, offset, piece): folded literals in pieces of at most PIECE characters.

    The last piece of a long literal is its last PIECE characters. An empty alias has no piece.
    """
    literal = F.concat(F.when(F.col("kind") == "cashtag", "$").otherwise(""), folded(F.col("alias")))
    rows = aliases.select("symbol", "kind", literal.alias("literal")).where("literal <> ''").distinct()
    last = F.char_length("literal") - PIECE
    offsets = F.when(last <= 0, F.array(F.lit(0))).otherwise(F.array_distinct(F.concat(F.sequence(F.lit(0), F.greatest(last, F.lit(0)), F.lit(PIECE)), F.array(last))))
    cut = rows.withColumn("_offsets", offsets).select("symbol", "kind", F.sha2(F.col("literal").cast("binary"), 256).alias("literal_key"), "literal", F.size("_offsets").alias("pieces"), F.explode("_offsets").alias("offset"))
    return cut.withColumn("piece", F.expr(f"substring(literal, offset + 1, {PIECE})")).drop("literal")


def _key_kinds(df: DataFrame) -> list[int]:
    return sorted(r[0] for r in df.select("by").distinct().collect())  # at most GRAM + 1


def filed(pieces: DataFrame, items: DataFrame) -> DataFrame:
    """(by, key, at, length): under which key, and where in it, the pieces are filed: the rarest of theirs in all texts.

    A ticker stands free, so its runs of letters and digits are whole words of the text, and it is filed under one of
    them; a phrase may begin inside a word and is filed under a gram. Occurrences are counted before they are joined, so
    the counts of distinct keys are all that is shuffled.
    """
    free = F.col("kind") != "phrase"
    by = F.when(free, WORD).otherwise(F.least(F.lit(GRAM), F.char_length("piece")))
    distinct = pieces.select("piece", by.alias("by")).distinct()
    words = _each(distinct.where(f"by = {WORD}"), "piece", "(?<![a-z0-9])[a-z0-9]+", "piece", "by")
    grams = distinct.where(f"by <> {WORD}").select("piece", "by", F.posexplode(F.expr("transform(sequence(0, char_length(piece) - by), p -> substring(piece, p + 1, by))")).alias("place", "key"))
    # A block's own places, with the two characters before them that tell a word's beginning.
    own = _keys(_blocks(items, PIECE), "block", _key_kinds(distinct), "block_no").where(f"place < {STRIDE + 2} AND (place >= 2 OR block_no = 0)")
    counts = own.groupBy("by", "key").agg(F.count(F.lit(1)).alias("n"))
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("place").alias("at"), "key")).alias("r")
    best = words.unionByName(grams).join(counts, ["by", "key"], "left").groupBy("piece", "by").agg(rarest)
    return best.select("by", "r.key", "r.at", F.char_length("piece").alias("length")).distinct()


def _places(blocks: DataFrame, shapes: DataFrame, kinds: list[int]) -> DataFrame:
    """(text_key, start, piece, ticker, cashtag): the characters of a shape around its key, and which kinds may stand so."""
    q, block = F.col("place") - F.col("at"), F.col("block")
    one = lambda back: F.when(F.col("q") >= back, F.substring(block, F.col("q") - (back - 1), 1)).otherwise("")
    found = _keys(blocks, "block", kinds, "text_key", "block_no", "block").join(F.broadcast(shapes), ["by", "key"]).withColumn("q", q)
    # A place has its block: two characters before it are there too, and what begins in a block's last characters is the next one's.
    own = found.where(f"q < {STRIDE + 2} AND (q >= 2 OR block_no = 0 AND q >= 0)").withColumns({
        "piece": F.substring(block, F.col("q") + 1, F.col("length")), "b1": one(1), "b2": one(2), "after": F.substring(block, F.col("q") + F.col("length") + 1, 1),
    })
    free = ~F.col("after").rlike(_ALNUM)
    word = lambda c: F.col(c).rlike(_ALNUM)
    ticker = free & F.when(F.col("b1") == "$", ~word("b2") & (F.col("b2") != "$")).otherwise(~word("b1"))
    start = F.col("block_no").cast("long") * STRIDE + F.col("q")
    return own.select("text_key", start.alias("start"), "piece", ticker.alias("ticker"), (free & ~word("b1")).alias("cashtag"))


def indexed_mentions(items: DataFrame, aliases: DataFrame, item_columns: tuple[str, ...] = ("item_id",)) -> DataFrame:
    """(item columns, symbol): the rows of ``mentions``, for alias tables that no worker could hold.

    Equal rows each keep their mentions; null and empty texts, and empty aliases, have none. No text is shuffled: places
    are found where the text is, and what is shuffled is a digest of the text with the piece found (at most PIECE
    characters), then with the symbol. The index is a written table. Its shapes (key, place, length) are broadcast, in one pass over the
    texts for each SHAPES of them; its pieces only up to BROADCAST_BYTES, else they are joined. Texts are read once for
    the counts of keys, once for each pass, and once for the rows of the result, whose digests meet their symbols.
    """
    items = items.withColumn("text", F.coalesce("text", F.lit("")))
    pieces = written(alias_pieces(aliases), "alias-pieces")
    literals = pieces.groupBy(F.col("symbol").alias("_of")).agg((F.count_distinct("kind", "literal_key") == 1).alias("single"))
    plain = written(pieces.where(_PLAIN).join(literals, F.col("symbol").eqNullSafe(F.col("_of"))).drop("_of"), "alias-words")
    pieces = pieces.where(f"NOT ({_PLAIN})")
    rows = items.where("text <> ''").select(*item_columns, _text_key().alias("_text_key"))
    whole, found = _word_hits(items, plain, item_columns)
    others = _place_hits(items, pieces)
    return whole.unionByName(_by_text(rows, found if others is None else found.unionByName(others), item_columns))


def _by_text(rows: DataFrame, found: DataFrame, item_columns: tuple[str, ...]) -> DataFrame:
    found = found.distinct().withColumnsRenamed({"text_key": "_found_in", "symbol": "_found"})
    return rows.join(found, F.col("_text_key") == F.col("_found_in")).select(*item_columns, F.col("_found").alias("symbol"))


def _place_hits(items: DataFrame, pieces: DataFrame) -> DataFrame | None:
    """(text_key, symbol) of phrases and of tickers with a dot or dash, found by the keys that they are filed under."""
    held = pieces.agg(F.coalesce(F.sum(_held()), F.lit(0)), F.coalesce(F.max(F.char_length("piece")), F.lit(0)), F.coalesce(F.max("pieces"), F.lit(0))).first()
    bytes_held, longest, most = held
    if not longest:
        return None
    shapes = written(filed(pieces, items), "alias-grams")
    number = shapes.count()
    kinds = _key_kinds(shapes)
    passes = -(-number // SHAPES)
    blocks = _blocks(items, longest)
    # A key's shapes are dealt by all their columns, so that parts stay even where many are under one key.
    part = F.pmod(F.xxhash64("by", "key", "at", "length"), F.lit(passes))
    places = None
    for i in range(passes):
        some = shapes if passes == 1 else shapes.where(part == i)
        one = _places(blocks, some, kinds)
        places = one if places is None else places.unionByName(one)
    table = F.broadcast(pieces) if bytes_held <= BROADCAST_BYTES else pieces
    stands = (F.col("kind") == "phrase") | (F.col("kind") == "ticker") & F.col("ticker") | (F.col("kind") == "cashtag") & F.col("cashtag")
    hits = places.join(table, "piece").where(stands)
    found = hits.where("pieces = 1").select("text_key", "symbol")
    if most > 1:
        whole = hits.where("pieces > 1").groupBy("text_key", "literal_key", "symbol", (F.col("start") - F.col("offset")).alias("begin"), "pieces").agg(F.count_distinct("offset").alias("have"))
        found = found.unionByName(whole.where("have = pieces").select("text_key", "symbol"))
    return found
