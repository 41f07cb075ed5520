"""Packing of whole documents into fixed-length sequences by cutting-stock patterns."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from factmill.llm.common import map_texts, materialize, table
from factmill.llm.cutting_stock import solve_patterns
from factmill.llm.sharding import number_slots
from factmill.llm.tokens import encoder, vocabulary_path

LENGTH = 2048
END = 1
#: The linear program's grid: lengths are rounded up to multiples of this many tokens, at most LENGTH / GRAIN sizes.
GRAIN = 16
#: Pieces of at most LENGTH / GRAIN tokens go in bundles of one length; sequences of such bundles alone hold as many
#: pieces as would fit without a grid, but for this share.
SLACK = 0.02


def _pieces(path: str, length: int, end: int):
    def cut(texts: list[str]) -> tuple:
        codec, last = encoder(path), np.asarray([end], "<u4").tobytes()
        index, starts, lengths, sums, totals = [], [], [], [], []
        for i, text in enumerate(texts):
            ids = codec.encode(text) + last
            total = len(ids) // 4
            for at in range(0, total, length):
                piece = ids[4 * at : 4 * (at + length)]
                index.append(i)
                starts.append(at)
                lengths.append(len(piece) // 4)
                sums.append(zlib.crc32(piece))
                totals.append(total)
        return index, [starts, lengths, sums, totals]

    return cut


def pieces(documents: DataFrame, path: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """A document's ids and ``end``, cut into pieces of ``length`` and one of the rest."""
    fields = [(c, "long") for c in ("start", "length", "ids_crc32", "doc_tokens")]
    return map_texts(documents.select("doc_id", "text"), _pieces(path, length, end), fields)


def _bundle(size: int, length: int, grain: int) -> int:
    """How many pieces of ``size`` go together: the fewest that keep to SLACK. Long pieces go alone."""
    if size > length // grain:
        return 1
    most = length // size
    return next(k for k in range(1, most + 1) if length // grain // -(-k * size // grain) * k >= (1 - SLACK) * most)


def _items(histogram: dict[int, int], length: int, grain: int) -> tuple[dict[int, int], dict[int, tuple]]:
    """Items to be packed: how many there are of each grid size, and how the pieces of a length become items.

    For each length: its bundle, the pieces in bundles, (grid size, first item) of the bundles and of what is left over.
    """
    demand: dict[int, int] = {}
    made = {}
    for size, n in histogram.items():
        k = _bundle(size, length, grain)
        kinds = []
        for pieces_of_item, items in ((k, n // k), (1, n % k)):
            cells = -(-pieces_of_item * size // grain)
            kinds.append((cells, demand.get(cells, 0)))
            demand[cells] = demand.get(cells, 0) + items
        made[size] = (k, n // k * k, *kinds)
    return {cells: n for cells, n in demand.items() if n}, made


def _seats(plan: list[tuple[list[int], int]], classes: list[int]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each grid size: first item, first sequence, items of the size in a sequence, and its first seat there."""
    seats: dict[int, list[tuple[int, int, int, int]]] = {c: [] for c in classes}
    items, sequence = dict.fromkeys(classes, 0), 0
    for pattern, times in plan:
        seat = 0
        for c, n in zip(classes, pattern, strict=True):
            if n:
                seats[c].append((items[c], sequence, n, seat))
                items[c] += n * times
                seat += n
        sequence += times
    return {c: tuple(np.asarray(v, np.int64) for v in zip(*rows, strict=True)) for c, rows in seats.items() if rows}


def _seat_of(seats: dict, made: dict):
    def seated(cells: int, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, base, n, seat0 = seats[cells]
        k = np.searchsorted(first, items, side="right") - 1
        copy, place = np.divmod(items - first[k], n[k])
        return base[k] + copy, seat0[k] + place

    @F.pandas_udf("struct<sequence_id:bigint,seat:bigint,place:bigint>")
    def seat_of(sizes: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        kind, rank = sizes.to_numpy(), ranks.to_numpy()
        sequence, seat, place = (np.zeros(len(kind), np.int64) for _ in range(3))
        for size in np.unique(kind):
            k, together, (cells, item), (left_cells, left_item) = made[int(size)]
            for at, c, items, sub in (
                ((kind == size) & (rank < together), cells, item + rank // k, rank % k),
                ((kind == size) & (rank >= together), left_cells, left_item + rank - together, 0 * rank),
            ):
                if at.any():
                    sequence[at], seat[at] = seated(c, items[at])
                    place[at] = sub[at]
        return pd.DataFrame({"sequence_id": sequence, "seat": seat, "place": place})

    return seat_of


def pack(documents: DataFrame, path: str, length: int = LENGTH, end: int = END, grain: int = GRAIN) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset for every piece of every document.

    Only documents longer than a sequence are cut: full pieces are sequences of their own, the rest of a document is
    packed. The histogram of lengths (at most 2 * length / grain) is all that reaches the driver, where short pieces of
    one length are bundled and a linear program makes patterns. Documents are ranked in their length; a rank fixes the
    bundle, the pattern, its copy and the seat.

    Null and empty texts are the end id alone; null ids, ties and repeated rows keep a piece each; other columns are
    ignored; an empty table gives an empty result.
    """
    if length % grain:
        raise ValueError("grain must divide length")
    size = F.when(F.col("length") <= length // grain, F.col("length")).otherwise(F.ceil(F.col("length") / F.lit(grain)) * grain)
    cut = materialize(pieces(documents, path, length, end).withColumn("size", size.cast("int")), "pieces")
    histogram = {r["size"]: r["n"] for r in cut.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each size
    demand, made = _items(histogram, length, grain)
    classes = sorted(demand, reverse=True)
    plan = solve_patterns(classes, [demand[c] for c in classes], length // grain)
    ranked = number_slots(cut, "size", [F.col("doc_id"), F.col("start"), F.col("ids_crc32")], "rank", buckets=256)
    seat_of = _seat_of(_seats(plan, classes), made)
    seated = ranked.withColumn("at", seat_of("size", "rank")).select("*", "at.sequence_id", "at.seat", "at.place")
    before = F.sum("length").over(W.partitionBy("sequence_id").orderBy("seat", "place")) - F.col("length")
    return seated.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", before.alias("offset"))


def op7_cutting_stock_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary_path())
