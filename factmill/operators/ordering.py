"""Places in a global order, and exact digests of ordered rows, without a task that sorts or reads them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factmill.sources.shared import written

#: Children of a node of a digest tree.
FAN = 1024


def placed(rows: DataFrame, order: Sequence[Column], place: str = "place") -> DataFrame:
    """Adds ``place``: 1, 2, 3, ... of each row in ``order``; rows that tie go by a hash of all their columns.

    Sampled ranges of the order are dealt to tasks, sorted and numbered there; the driver sees each range's first number
    and count, and adds what lies before it. Many rows of one leading value are many ranges, as later columns part them.
    """
    order = [*order, F.xxhash64(*rows.columns)]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ranged = written(ranged, "order")
    ranges = ranged.groupBy(F.shiftright("_at", 33).alias("part")).agg(F.min("_at").alias("first"), F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    starts, before = [], 0
    for r in ranges:
        starts.append((r.part, before - r["first"] + 1))
        before += r.n
    starts = rows.sparkSession.createDataFrame(starts, "_part bigint, _shift bigint")  # one row for each range
    return ranged.join(F.broadcast(starts), F.shiftright("_at", 33) == F.col("_part")).withColumn(place, F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def digest_tree(rows: DataFrame, order: Sequence[Column], line: Column, fan: int = FAN) -> DataFrame:
    """(level, node, first, rows, digest): a tree of sha256 over the lines of ``rows`` in rising ``order``.

    A leaf block (level 0) covers ``fan`` consecutive places and digests its lines' digests in order; each level above
    covers ``fan`` nodes of the one below, up to one root. ``first``: the first place covered. Blocks go by place, so the
    tree is the same however the rows are dealt; no task holds more than ``fan`` lines. Without rows there is no node.
    """
    if fan < 2:
        raise ValueError("a node needs two children or more")
    keys = [F.col(f"_o{i}") for i in range(len(order))]
    lines = placed(rows.select(F.sha2(line.cast("binary"), 256).alias("digest"), *[c.alias(f"_o{i}") for i, c in enumerate(order)]), keys)
    level = lines.select((F.col("place") - 1).alias("node"), F.col("place").alias("first"), F.lit(1).cast("bigint").alias("rows"), "digest")
    out, height = None, 0
    while True:
        joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node", "digest"))), lambda c: c["digest"]), "")
        grouped = level.groupBy(F.floor(F.col("node") / fan).alias("above")).agg(F.min("first").alias("first"), F.sum("rows").alias("rows"), F.sha2(joined.cast("binary"), 256).alias("digest"))
        level = written(grouped.select(F.col("above").alias("node"), "first", "rows", "digest"), "digests")
        named = level.select(F.lit(height).alias("level"), "node", "first", "rows", "digest")
        out = named if out is None else out.unionByName(named)
        if level.count() <= 1:
            return out
        height += 1


def differing_ranges(a: DataFrame, b: DataFrame, fan: int = FAN) -> DataFrame:
    """(first, a_rows, b_rows): the leaf blocks, by first place, in which two trees of this fan differ.

    Only nodes under differing nodes are compared, level by level, so equal parts end at their uppermost node. A row that
    one side lacks moves all later places, so from there on all blocks differ. Trees of unlike height differ from the
    top of the lower one down.
    """
    heights = [t.agg(F.max("level")).first()[0] for t in (a, b)]
    differing = None
    for level in range(min(h or 0 for h in heights), -1, -1):
        sides = [t.where(F.col("level") == level).select("node", F.col("first").alias(f"{n}_first"), F.col("rows").alias(f"{n}_rows"), F.col("digest").alias(f"{n}_digest")) for t, n in ((a, "a"), (b, "b"))]
        if differing is not None:
            sides = [t.join(differing, F.floor(F.col("node") / fan) == F.col("above"), "left_semi") for t in sides]
        both = sides[0].join(sides[1], "node", "full_outer").where(~F.col("a_digest").eqNullSafe(F.col("b_digest")))
        differing = both.select(F.col("node").alias("above"))
    return both.select(F.coalesce("a_first", "b_first").alias("first"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("a_rows", "b_rows")])
