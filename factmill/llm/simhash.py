"""SimHash near-duplicates: BK-tree shards over 64-bit fingerprints, then connected components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factmill.llm.common import LOWER_BYTES, map_texts, materialize, table
from factmill.llm.components import connected_components

SHINGLE = 4
SEED = 42
RADIUS = 4
#: Most nodes of one tree; a larger shard is dealt to several trees, each of which meets all the shard's queries.
TREE_NODES = 4096
#: Distinct fingerprints from which shards agree on two blocks of bits instead of one, to keep them small.
WIDE = 20_000_000
_PAIRS = 1 << 20


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the text's word shingles (XXH64, seed 42), as an unsigned integer; 0 without words."""
    import xxhash

    words = (text or "").encode().translate(LOWER_BYTES).split()
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)), np.uint64, len(words) - k + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        block = hashes[at : at + 8192].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    bits = counts * 2 > len(hashes)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def _fingerprints(texts: list[str]) -> tuple:
    return None, [np.fromiter((fingerprint(t) for t in texts), np.uint64, len(texts)).view(np.int64)]


def fingerprints(documents: DataFrame) -> DataFrame:
    """(doc_id, fp) for every row; fp is the 64-bit fingerprint as a signed long."""
    return map_texts(documents.select("doc_id", "text"), _fingerprints, [("fp", "long")])


class BKForest:
    """BK-trees, one for each key, as flat arrays. A node's children are keyed by their integer distance to it.

    All trees grow together: in each step every item not yet placed is compared with its current parent; the first of
    a distance becomes the child of that edge, the others go below it.
    """

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.values = values
        roots, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        self.keys, self.root = roots, first
        parents, edges, nodes = [], [], []
        waiting = np.setdiff1d(np.arange(len(values)), first)
        parent = first[inverse[waiting]]
        while len(waiting):
            slot = parent * 65 + np.bitwise_count(values[waiting] ^ values[parent]).astype(np.int64)
            taken, at, inverse = np.unique(slot, return_index=True, return_inverse=True)
            child = waiting[at]
            parents.append(taken // 65)
            edges.append(taken % 65)
            nodes.append(child)
            below = np.ones(len(waiting), bool)
            below[at] = False
            parent = child[inverse[below]]
            waiting = waiting[below]
        empty = np.empty(0, np.int64)
        slots = np.concatenate([p * 65 + e for p, e in zip(parents, edges, strict=True)] or [empty])
        order = np.argsort(slots, kind="stable")
        self.slots, self.nodes = slots[order], np.concatenate(nodes or [empty])[order]

    def within(self, keys: np.ndarray, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query index, node index) of all within ``radius``; follows only edges of d - radius to d + radius."""
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        here = np.flatnonzero(self.keys[at] == keys) if len(self.keys) else np.empty(0, np.int64)
        stack = [(here, self.root[at[here]])]
        while stack:
            query, node = stack.pop()
            if len(query) > _PAIRS:
                half = len(query) // 2
                stack += [(query[half:], node[half:]), (query[:half], node[:half])]
                continue
            distance = np.bitwise_count(queries[query] ^ self.values[node]).astype(np.int64)
            hit = distance <= radius
            if hit.any():
                yield query[hit], node[hit]
            low = np.searchsorted(self.slots, node * 65 + np.maximum(distance - radius, 0))
            high = np.searchsorted(self.slots, node * 65 + np.minimum(distance + radius, 64), side="right")
            many = high - low
            if total := int(many.sum()):
                start = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many)
                stack.append((np.repeat(query, many), self.nodes[start + np.arange(total)]))


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the classes of a[i] and b[i]; label[i] is the least index of i's class afterwards."""
    while True:
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            return
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def _local_links(keys: np.ndarray, values: np.ndarray, roles: np.ndarray, radius: int) -> pd.DataFrame:
    """Links that join whatever is within ``radius`` in each key: every value to the least of its class there."""
    order = np.argsort(values, kind="stable")
    keys, values, roles = keys[order], values[order], roles[order]
    trees, asks = np.flatnonzero(roles != 1), np.flatnonzero(roles != 0)
    label = np.arange(len(values))
    forest = BKForest(keys[trees], values[trees].view(np.uint64))
    for q, n in forest.within(keys[asks], values[asks].view(np.uint64), radius):
        _merge(label, asks[q], trees[n])
    linked = label != np.arange(len(values))
    return pd.DataFrame({"a": values[linked], "b": values[label[linked]]}).drop_duplicates()


def _linker(radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The rows are sorted by key; those of the last key of a batch wait for the next batch."""
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            last = batch["key"].iat[-1]
            done = batch[batch["key"] != last]
            if len(done) or (held and held[-1]["key"].iat[-1] != last):
                whole = pd.concat([*held, done])
                held = [batch[batch["key"] == last]]
                yield _local_links(whole["key"].to_numpy(), whole["fp"].to_numpy(), whole["role"].to_numpy(), radius)
            else:
                held.append(batch)
        if held:
            whole = pd.concat(held)
            yield _local_links(whole["key"].to_numpy(), whole["fp"].to_numpy(), whole["role"].to_numpy(), radius)

    return run


def _shard_keys(radius: int, agree: int) -> list[list[tuple[int, int]]]:
    """Sets of (first bit, width). Of radius + agree blocks, two values within the radius agree on at least ``agree``."""
    blocks = radius + agree
    bounds = [round(64 * i / blocks) for i in range(blocks + 1)]
    return [[(bounds[i], bounds[i + 1] - bounds[i]) for i in chosen] for chosen in combinations(range(blocks), agree)]


def fingerprint_links(values: DataFrame, radius: int = RADIUS, tree_nodes: int = TREE_NODES) -> DataFrame:
    """Links (a, b) whose connected components are those of all pairs within ``radius``. ``values``: distinct fp.

    Values that agree on a block of bits share a shard, so every pair within the radius meets in at least one. A shard
    is a BK-tree; one of more than ``tree_nodes`` values is dealt to several trees by hash and each tree's task gets
    its own queries and those of one other part, until all parts have met. Tasks return links to the least value of a
    class, never all pairs.
    """
    agree = 1 if values.count() < WIDE else 2
    keys = []
    for n, parts in enumerate(_shard_keys(radius, agree)):
        bits = [F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << width) - 1)) for at, width in parts]
        keys.append(F.xxhash64(F.lit(n), *bits))
    shards = values.select("fp", F.explode(F.array(*keys)).alias("shard"))
    sizes = shards.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    shards = shards.join(sizes, "shard").withColumn("parts", F.ceil(F.col("n") / F.lit(tree_nodes)).cast("int"))
    mine = F.pmod(F.xxhash64(F.lit(5), "fp"), F.col("parts")).cast("int")
    dealt = shards.select("fp", "shard", mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    role = F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") == low, 0).otherwise(1)
    tasks = dealt.select("fp", F.xxhash64("shard", low, high).alias("key"), role.cast("int").alias("role"))
    return tasks.repartition("key").sortWithinPartitions("key").mapInPandas(_linker(radius), "a long, b long").distinct()


def near_duplicates(documents: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the least doc_id reachable over links) for every row.

    Texts without words (null too) have fingerprint zero and link like any other. Rows of one fingerprint are one
    node, so copies cost nothing; null ids keep their rows and never name a component unless all its ids are null.
    Repeated rows keep a row each, other columns are ignored, an empty table gives an empty result.
    """
    prints = materialize(fingerprints(documents), "prints")
    # nodes go by their least doc_id (nulls last), so a component's name is its least node
    name = F.struct(F.min("doc_id").isNull().alias("none"), F.min("doc_id").alias("id"), F.col("fp").alias("fp"))
    nodes = materialize(prints.groupBy("fp").agg(name.alias("name")), "nodes")
    one, two = nodes.select(F.col("fp").alias("a"), F.col("name").alias("na")), nodes.select(F.col("fp").alias("b"), F.col("name").alias("nb"))
    links = materialize(fingerprint_links(nodes.select("fp"), radius), "near")
    member = connected_components(links.join(one, "a").join(two, "b").select(F.col("na").alias("a"), F.col("nb").alias("b")))
    member = member.select(F.col("node.fp").alias("m_fp"), F.col("component.id").alias("component_id"))
    classes = nodes.join(member, F.col("fp") == F.col("m_fp"), "left").select("fp", F.when(F.col("m_fp").isNull(), F.col("name.id")).otherwise(F.col("component_id")).alias("component_id"))
    return prints.join(classes, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
