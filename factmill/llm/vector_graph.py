"""Near-duplicates of embeddings by range search on a flat, robust-pruned graph built over overlapping cluster shards.

Vectors that crowd within half the threshold's angle of one of them are one cell (all their pairs link, none has to be
compared), so the graph is over cells. Cells are dealt to overlapping balls around leaders, a ball to overlapping leaf
shards; pruned lists of all shards are united; every cell searches from medoids of its ball, over the edges that leave
the ball too; what it finds is verified, recall is audited, and where it is low, all pairs are compared instead.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factmill.llm.common import materialize, table
from factmill.llm.components import connected_components

THRESHOLD = 0.93
#: Nodes that a ball should hold, most balls of all labels together, balls of each node, and most nodes of a ball in a task.
BALL = 2000
LEADERS = 4096
OVERLAP = 2
PART = 20_000
#: Nodes that are covered together, least members of a cell, and rounds in which cells of large balls are merged.
CHUNK = 2000
CELL = 4
COVERS = 3
#: Nodes of a leaf shard, in which all pairs are known while lists are built, and leaf shards of each node.
LEAF = 400
FANOUT = 3
#: The graph: edges of a node in a shard, pool that is pruned, far candidates, and slack of the pruning.
DEGREE = 8
POOL = 24
FAR = 4
ALPHA = 1.2
#: The search: beam, nodes opened at a time, medoids of a ball, queries that walk together.
BEAM = 20
OPEN = 4
MEDOIDS = 24
QUERIES = 256
#: Bits of the sketch by which a node outside the ball is judged, and standard deviations that it may be off.
BITS = 128
SIGMAS = 3.5
#: Members that are compared at a time where radii leave a pair of cells undecided.
BLOCK = 1000
#: Nodes of each stratum that are compared with their whole label to measure recall; of the nodes asked, those with links
#: that an estimate needs (else AUDIT_MORE are asked); links found from which a node is in the dense stratum.
AUDIT = 2_000
AUDIT_LINKED = 50
AUDIT_MORE = 16_000
DENSE = 16
#: The least recall of any stratum that is returned, and searches, each wider, before all pairs are compared.
RECALL = 0.95
TRIES = 2
#: Pairs within labels up to which comparing all is cheaper than a wider search.
EXACT_PAIRS = 20_000_000_000
#: Nodes of a part that meets other parts, and times that all nodes are shuffled in one round of comparing all.
EXACT_PART = 1500
EXACT_COPIES = 32


def _unit(vectors) -> np.ndarray:
    x = np.array(list(vectors), np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # neither tiny nor huge components leave the range
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _reach(threshold: float) -> float:
    """Half the angle of the threshold: two vectors so near to a third link."""
    return math.acos(threshold) / 2 - 1e-9


# --- cells


def cover(x: np.ndarray, radius: np.ndarray, reach: float, least: int = CELL) -> tuple[np.ndarray, np.ndarray]:
    """(into, bound): the row that each row joins (itself: none) and the angle within which all it stands for lie of it.

    The row with most others within reach takes them in, then the next, while one takes at least ``least`` - 1.
    """
    m = len(x)
    into, bound = np.arange(m), radius.copy()
    similar, inside = x @ x.T, np.zeros((m, m), bool)

    def angle(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(similar[a, b], -1, 1)) + radius[b]

    a, b = np.nonzero(similar >= math.cos(reach))
    inside[a, b] = (a != b) & (angle(a, b) <= reach)
    free = np.ones(m, bool)
    crowd = np.flatnonzero(inside.sum(axis=1) >= least - 1)
    while len(crowd):
        counts = inside[crowd][:, free].sum(axis=1)
        best = int(counts.argmax())
        if counts[best] < least - 1:
            break
        row = crowd[best]
        taken = np.flatnonzero(inside[row] & free)
        into[taken], bound[taken] = row, angle(row, taken)
        free[taken] = free[row] = False
        crowd = crowd[free[crowd]]
    return into, bound


def _coverer(reach: float, least: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("nid")
        into, bound = cover(_unit(group["vector"]), group["r"].to_numpy(), reach, least)
        moved, nid = np.flatnonzero(into != np.arange(len(into))), group["nid"].to_numpy()
        return pd.DataFrame({"nid": nid[moved], "into": nid[into[moved]], "bound": bound[moved]})

    return run


def make_cells(nodes: DataFrame, threshold: float, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Members (nid, cell) of all nodes, and cells (nid, r): their representatives and radii.

    ``nodes``: nid, group, balls, vector. Chunks of a ball are covered each on its own; while a ball has several
    chunks, the cells are covered again, so a crowd of any size ends in few cells.
    """
    reach, sparse = _reach(threshold), CELL
    cells = nodes.select("nid", "group", F.col("balls")[0].alias("ball"), "vector").withColumn("r", F.lit(0.0))
    members = nodes.select("nid", F.col("nid").alias("cell"))
    for i in range(COVERS):
        sizes = cells.groupBy(F.col("group").alias("g"), F.col("ball").alias("c")).agg(F.ceil(F.count(F.lit(1)) / F.lit(chunk)).cast("int").alias("parts"))
        dealt = cells.join(sizes, (F.col("group") == F.col("g")) & (F.col("ball") == F.col("c"))).withColumn("part", F.pmod(F.xxhash64(F.lit(i), "nid"), F.col("parts")))
        if i:
            dealt, sparse = dealt.where("parts > 1 or r > 0"), 2
        moved = dealt.select("group", "ball", "part", "nid", "vector", "r").groupBy("group", "ball", "part").applyInPandas(_coverer(reach, sparse), "nid long, into long, bound double")
        moved = materialize(moved, "moved")
        if moved.isEmpty():
            break
        grown = moved.groupBy(F.col("into").alias("g_nid")).agg(F.max("bound").alias("bound"))
        cells = cells.join(moved.select(F.col("nid").alias("m_nid")), F.col("nid") == F.col("m_nid"), "left_anti").join(grown, F.col("nid") == F.col("g_nid"), "left")
        cells = materialize(cells.select("nid", "group", "ball", "vector", F.coalesce(F.greatest("r", "bound"), "r").alias("r")), "cells")
        members = members.join(moved.select(F.col("nid").alias("m_nid"), "into"), F.col("cell") == F.col("m_nid"), "left")
        members = materialize(members.select("nid", F.coalesce("into", "cell").alias("cell")), "members")
        if sizes.where("parts > 1").isEmpty():
            break
    return members, cells.select("nid", "r")


# --- balls


def _leaders(nodes: DataFrame, reach: float) -> dict[str, np.ndarray]:
    """For each label of more than one ball: leaders, nodes drawn by hash; of two within reach the second is left out."""
    sizes = nodes.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.sum(F.ceil(F.col("n") / BALL)).alias("k")).first()["k"] or 0
    per = BALL * max(1.0, total / LEADERS)
    sizes = sizes.select(F.col("group").alias("g"), F.ceil(F.col("n") / F.lit(per)).cast("long").alias("k"), "n").where("k > 1")
    drawn = nodes.select("group", "nid", "vector").join(sizes, F.col("group") == F.col("g"))
    drawn = drawn.where(F.pmod(F.xxhash64(F.lit(3), "nid"), F.col("n")) < F.col("k")).select("group", "vector")  # about k of each label
    out: dict[str, list] = {}
    for r in drawn.toLocalIterator():  # about LEADERS at most
        out.setdefault(r["group"], []).append(r["vector"])
    kept = {}
    for g, vectors in out.items():
        x = _unit(vectors)
        near = np.tril(x @ x.T >= math.cos(reach), -1)
        kept[g] = x[~near.any(axis=1)]
    return kept


def _assign(leaders: dict[str, np.ndarray], overlap: int):
    @F.pandas_udf("array<int>")
    def nearest(group: pd.Series, vector: pd.Series) -> pd.Series:
        out = pd.Series([[0]] * len(group), dtype=object)
        codes = pd.factorize(group)
        for i, g in enumerate(codes[1]):
            if g in leaders:
                at = np.flatnonzero(codes[0] == i)
                best = np.argsort(-(_unit(vector.iloc[at]) @ leaders[g].T), axis=1, kind="stable")[:, :overlap]
                for j, b in zip(at, best.tolist(), strict=True):
                    out.iat[j] = b
        return out

    return nearest


def _tasks(nodes: DataFrame, part: int) -> DataFrame:
    """A row for each task of a node: its label and ball, and the two parts of the ball that meet."""
    spread = nodes.withColumn("ball", F.explode("balls"))
    sizes = spread.groupBy(F.col("group").alias("g"), F.col("ball").alias("c")).agg(F.ceil(F.count(F.lit(1)) / F.lit(part)).cast("int").alias("parts"))
    spread = spread.join(sizes, (F.col("group") == F.col("g")) & (F.col("ball") == F.col("c")))
    spread = spread.withColumn("mine", F.pmod(F.xxhash64(F.lit(11), "nid"), F.col("parts")).cast("int"))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return spread.withColumns({"low": F.least("mine", "other"), "high": F.greatest("mine", "other")}).drop("g", "c", "parts", "other")


TASK = ["group", "ball", "low", "high"]


# --- the graph


def robust_prune(similar: np.ndarray, degree: int = DEGREE, pool: int = POOL, far: int = FAR, alpha: float = ALPHA) -> np.ndarray:
    """Out-edges (-1 where there are fewer) of each row of a similarity matrix.

    A node's candidates are its nearest rows and some far ones; the nearest left becomes an edge and removes those that
    are nearer to it, by the factor alpha, than to the node.
    """
    m = len(similar)
    if m < 2:
        return np.full((m, 1), -1)
    own = similar.copy()
    np.fill_diagonal(own, -np.inf)
    near = min(pool, m - 1)
    candidates = np.argpartition(-own, near - 1, axis=1)[:, :near]
    step = (np.arange(1, far + 1) * 7919 + np.arange(m)[:, None] * 104729) % m
    candidates = np.concatenate([candidates, step], axis=1)
    rows = np.arange(m)[:, None]
    candidates = np.take_along_axis(candidates, np.argsort(-own[rows, candidates], axis=1, kind="stable"), axis=1)
    distance = np.sqrt(np.maximum(2 - 2 * similar[rows, candidates], 0))
    alive = candidates != rows
    edges = np.full((m, min(degree, candidates.shape[1])), -1)
    for k in range(edges.shape[1]):
        first = alive.argmax(axis=1)
        has = alive[np.arange(m), first]
        if not has.any():
            break
        chosen = candidates[np.arange(m), first]
        edges[has, k] = chosen[has]
        between = np.sqrt(np.maximum(2 - 2 * similar[chosen[:, None], candidates], 0))
        alive &= (alpha * between > distance) & (candidates != chosen[:, None])
    return edges


def leaf_shards(x: np.ndarray, leaf: int = LEAF, fanout: int = FANOUT) -> list[np.ndarray]:
    """Overlapping shards of at most ``leaf`` rows: each row goes to its nearest leaders, at first ``fanout`` of them."""
    out, stack = [], [(np.arange(len(x)), fanout)]
    while stack:
        at, copies = stack.pop()
        if len(at) <= leaf:
            out.append(at)
            continue
        k = min(64, max(copies + 1, -(-len(at) * copies * 3 // (leaf * 2))))
        leaders = at[np.linspace(0, len(at) - 1, k).astype(int)]
        similar = x[at] @ x[leaders].T
        top = np.argpartition(-similar, copies - 1, axis=1)[:, :copies]
        parts = [at[(top == j).any(axis=1)] for j in range(k)]
        if max(map(len, parts)) == len(at):  # rows that no leader tells apart
            out += [at[i : i + leaf] for i in range(0, len(at), leaf)]
            continue
        stack += [(p, 1) for p in parts if len(p)]
    return out


def pruned_lists(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (from, to), both ways, of the lists of all leaf shards, united."""
    pairs = [np.empty(0, np.int64)]
    for at in leaf_shards(x):
        edges = robust_prune(x[at] @ x[at].T)
        source, k = np.nonzero(edges >= 0)
        a, b = at[source], at[edges[source, k]]
        pairs += [a * len(x) + b, b * len(x) + a]
    united = np.unique(np.concatenate(pairs))
    return united // max(1, len(x)), united % max(1, len(x))


def sketches(x: np.ndarray) -> np.ndarray:
    """BITS signs of random projections as unsigned longs; the share in which two differ follows their angle."""
    planes = np.random.default_rng(BITS).normal(size=(x.shape[1], BITS))
    return np.packbits(x @ planes > 0, axis=1).view(np.uint64).reshape(len(x), BITS // 64)


def _build(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("nid")
    x, nid, r = _unit(group["vector"]), group["nid"].to_numpy(), group["r"].to_numpy()
    source, target = pruned_lists(x)
    words, ends = sketches(x).view(np.int64), np.searchsorted(source, np.arange(1, len(x)))
    columns = {"near": nid, "near_r": r, "near_0": words[:, 0], "near_1": words[:, 1]}
    return pd.DataFrame({"nid": nid} | {c: np.split(v[target], ends) for c, v in columns.items()})


LISTS = ("near", "near_r", "near_0", "near_1")


# --- the search


def medoids(x: np.ndarray, count: int = MEDOIDS) -> np.ndarray:
    """Of each of ``count`` groups of rows around spread leaders the row nearest to the group's mean."""
    leaders = x[np.linspace(0, len(x) - 1, min(count, len(x))).astype(int)]
    near = (x @ leaders.T).argmax(axis=1)
    out = []
    for c in range(len(leaders)):
        at = np.flatnonzero(near == c)
        if len(at):
            out.append(at[(x[at] @ x[at].mean(axis=0)).argmax()])
    return np.unique(out)


def range_search(x: np.ndarray, near: np.ndarray, starts: np.ndarray, asked: np.ndarray, inside, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """(hits, opened), a row for each row of ``asked``: greedy search from ``starts``, widened while it finds rows inside.

    ``near``: (m, width), -1 where there are fewer; ``inside(q, n, s)``: whether rows n are in the range of rows q.
    All queries walk at the same time, each comparing with a row at most once.
    """
    q, m = len(asked), len(x)
    seen, hits, opened = np.zeros((q, m), bool), np.zeros((q, m), bool), np.zeros((q, m), bool)
    own = x[asked]

    def compare(row: np.ndarray, node: np.ndarray) -> np.ndarray:
        s = np.einsum("ij,ij->i", own[row], x[node])
        hits[row, node] = inside(asked[row], node, s)
        return s

    def fresh(row: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The neighbours of the nodes that each row has not seen yet."""
        opened[row, node] = True
        lists = near[node]
        at, k = np.nonzero((lists >= 0) & ~seen[row[:, None], lists])
        pairs = np.unique(row[at] * m + lists[at, k])
        seen.reshape(-1)[pairs] = True
        return pairs // m, pairs % m

    width = max(beam, OPEN)
    ids, sims, todo = np.zeros((q, width), np.int64), np.full((q, width), -np.inf), np.zeros((q, width), bool)

    def take(row: np.ndarray, node: np.ndarray, s: np.ndarray) -> None:
        """Puts rows into the beams, in which the nearest stay. ``row`` is sorted."""
        if not len(row):
            return
        rows, first = np.unique(row, return_index=True)
        place = np.arange(len(row)) - np.repeat(first, np.diff([*first, len(row)]))
        slot = np.searchsorted(rows, row)
        new_ids, new_sims = np.zeros((len(rows), place.max() + 1), np.int64), np.full((len(rows), place.max() + 1), -np.inf)
        new_ids[slot, place], new_sims[slot, place] = node, s
        all_ids, all_sims = np.concatenate([ids[rows], new_ids], axis=1), np.concatenate([sims[rows], new_sims], axis=1)
        all_todo = np.concatenate([todo[rows], new_sims > -np.inf], axis=1)
        keep = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
        ids[rows], sims[rows], todo[rows] = (np.take_along_axis(v, keep, axis=1) for v in (all_ids, all_sims, all_todo))

    row, node = np.repeat(np.arange(q), len(starts)), np.tile(starts, q)
    seen[row, node] = True
    take(row, node, compare(row, node))
    while True:
        open_sims = np.where(todo, sims, -np.inf)
        best = np.argpartition(-open_sims, OPEN - 1, axis=1)[:, :OPEN] if width > OPEN else np.tile(np.arange(width), (q, 1))
        row, k = np.nonzero(np.take_along_axis(open_sims, best, axis=1) > -np.inf)
        if not len(row):
            break
        at = best[row, k]
        todo[row, at] = False
        row, node = fresh(row, ids[row, at])
        take(row, node, compare(row, node))
    while True:
        row, node = np.nonzero(hits & ~opened)
        if not len(row):
            return hits, opened
        for at in range(0, len(row), 20_000):
            r, n = fresh(row[at : at + 20_000], node[at : at + 20_000])
            compare(r, n)


def _bits_within(angle: np.ndarray) -> np.ndarray:
    """The most bits in which sketches of vectors within ``angle`` differ, but for chance beyond SIGMAS."""
    p = np.minimum(angle / np.pi, 1.0)
    return BITS * p + SIGMAS * np.sqrt(BITS * p * (1 - p))


def _searcher(threshold: float, beam: int):
    theta = math.acos(threshold)

    def bound(r: np.ndarray) -> np.ndarray:
        return np.cos(np.minimum(theta + r, np.pi))

    def search(group: pd.DataFrame) -> pd.DataFrame:
        """Pairs (a, b) of cells whose members may link: with their cosine, or without one where b is in other balls."""
        group = group.sort_values("nid")
        x, nid, r = _unit(group["vector"]), group["nid"].to_numpy(), group["r"].to_numpy()
        size = group["near"].map(lambda v: 0 if v is None else len(v)).to_numpy()
        source = np.repeat(np.arange(len(x)), size)
        near, near_r, *words = (np.concatenate([np.empty(0, t), *(v for v in group[c] if v is not None)]).astype(t) for c, t in zip(LISTS, (np.int64, np.float64, np.int64, np.int64), strict=True))
        place = np.minimum(np.searchsorted(nid, near), len(nid) - 1)
        here = nid[place] == near
        pairs = np.unique(source[here] * len(x) + place[here])
        a, b = pairs // len(x), pairs % len(x)
        first = np.searchsorted(a, a)
        lists = np.full((len(x), int((np.arange(len(a)) - first).max(initial=0)) + 1), -1)
        lists[a, np.arange(len(a)) - first] = b
        _, once = np.unique(np.stack([source[~here], near[~here]]), axis=1, return_index=True) if (~here).any() else (None, np.empty(0, np.int64))
        away = np.flatnonzero(~here)[once]  # sorted by source
        from_, ends = source[away], np.searchsorted(source[away], np.arange(len(x) + 1))
        own, far = sketches(x), np.stack([w[away] for w in words], axis=1).view(np.uint64)
        single, starts = x.astype(np.float32), medoids(x)
        asked = np.flatnonzero(((group["home"] == group["ball"]) & ((group["low"] == group["high"]) | (group["mine"] == group["low"]) | (group["mine"] == group["high"]))).to_numpy())

        def inside(q: np.ndarray, n: np.ndarray, s: np.ndarray) -> np.ndarray:
            return s >= bound(r[q] + r[n]) - 1e-5

        out = []
        for k in range(0, len(asked), QUERIES):
            some = asked[k : k + QUERIES]
            hits, opened = range_search(single, lists, starts, some, inside, beam)
            q, n = np.nonzero(hits)
            q = some[q]
            s = np.einsum("ij,ij->i", x[q], x[n])
            good = (q != n) & (s >= np.where(r[q] + r[n] == 0, threshold, bound(r[q] + r[n]) - 1e-12))
            out.append(pd.DataFrame({"a": nid[q[good]], "b": nid[n[good]], "sim": s[good]}))
            q, n = np.nonzero(opened)
            many = ends[n + 1] - ends[n]
            e = np.repeat(ends[n] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
            q = some[np.repeat(q, many)]
            differ = np.bitwise_count(own[q] ^ far[e]).sum(axis=1)
            close = differ <= _bits_within(theta + r[q] + near_r[away[e]])
            cross = np.unique(np.stack([nid[q[close]], near[away[e[close]]]]), axis=1)
            out.append(pd.DataFrame({"a": cross[0], "b": cross[1], "sim": np.nan}))
        found = pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "sim": []})
        return pd.DataFrame({"a": np.minimum(found["a"], found["b"]).astype(np.int64), "b": np.maximum(found["a"], found["b"]).astype(np.int64), "sim": found["sim"]}).drop_duplicates()

    return search


def _verified(candidates: DataFrame, cells: DataFrame, threshold: float) -> DataFrame:
    """(a, b, sim) of the candidates (a, b) whose cosine is within their radii's reach of the threshold."""
    theta = math.acos(threshold)

    @F.pandas_udf("double")
    def cosine(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(np.einsum("ij,ij->i", _unit(a), _unit(b)) if len(a) else [], dtype="float64")

    one = cells.select(F.col("nid").alias("a"), F.col("vector").alias("va"), F.col("r").alias("ra"))
    two = cells.select(F.col("nid").alias("b"), F.col("vector").alias("vb"), F.col("r").alias("rb"))
    both = candidates.join(one, "a").join(two, "b").withColumn("sim", cosine("va", "vb"))
    radii = F.col("ra") + F.col("rb")
    return both.where(F.col("sim") >= F.when(radii == 0, F.lit(threshold)).otherwise(F.cos(F.least(F.lit(theta) + radii, F.lit(math.pi))))).select("a", "b", "sim")


def graph_links(cells: DataFrame, leaders: dict, threshold: float, overlap: int, beam: int, part: int) -> DataFrame:
    """(a, b, sim), a < b, of the pairs of cells that searches over the graph find, each verified in double precision."""
    placed = materialize(cells.withColumn("balls", _assign(leaders, overlap)("group", "vector")), "placed")
    tasks = _tasks(placed.withColumn("home", F.col("balls")[0]), part)
    kinds = ("array<long>", "array<double>", "array<long>", "array<long>")
    lists = tasks.groupBy(*TASK).applyInPandas(_build, "nid long, " + ", ".join(f"{c} {k}" for c, k in zip(LISTS, kinds, strict=True)))
    union = lists.groupBy("nid").agg(F.collect_list(F.struct(*LISTS)).alias("l")).select("nid", *[F.flatten(f"l.{c}").alias(c) for c in LISTS])
    joined = tasks.join(materialize(union, "graph"), "nid", "left")
    found = materialize(joined.groupBy(*TASK).applyInPandas(_searcher(threshold, beam), "a long, b long, sim double"), "found")
    here = found.where("sim is not null").groupBy("a", "b").agg(F.max("sim").alias("sim"))
    across = found.where("sim is null").select("a", "b").distinct().join(here.select(F.col("a").alias("x"), F.col("b").alias("y")), (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")), "left_anti")
    return materialize(here.unionByName(_verified(across, cells, threshold)), "links")


def _all_pairs(threshold: float):
    theta = math.acos(threshold)

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        mine, low, high = group["mine"].to_numpy(), group["low"].iat[0], group["high"].iat[0]
        x, nid, r = _unit(group["vector"]), group["nid"].to_numpy(), group["r"].to_numpy()
        i, j = np.flatnonzero(mine == low), np.flatnonzero(mine == high)
        s, radii = x[i] @ x[j].T, r[i][:, None] + r[j][None, :]
        q, n = np.nonzero((s >= np.where(radii == 0, threshold, np.cos(np.minimum(theta + radii, np.pi)))) & (nid[i][:, None] != nid[j][None, :]))
        a, b = nid[i[q]], nid[j[n]]
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "sim": s[q, n]}).drop_duplicates(["a", "b"])

    return compare


def exact_links(cells: DataFrame, threshold: float, part: int = EXACT_PART) -> DataFrame:
    """(a, b, sim) of all pairs of cells: every two parts of a label meet in a task, in rounds that bound what is shuffled."""
    nodes = cells.withColumn("balls", F.array(F.lit(0)))
    largest = nodes.groupBy("group").count().agg(F.max("count")).first()[0] or 0
    rounds, out = max(1, -(-largest // (part * EXACT_COPIES))), None
    for i in range(rounds):
        tasks = _tasks(nodes, part).where(F.pmod(F.xxhash64(F.lit(29), "low", "high"), F.lit(rounds)) == i)
        found = materialize(tasks.groupBy(*TASK).applyInPandas(_all_pairs(threshold), "a long, b long, sim double"), "exact")
        out = found if out is None else out.unionByName(found)
    return out


# --- links of members


def _block_counter(threshold: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        """Links of the members of one block with those of another cell's; and the cells with which there is any."""
        own, other = group[group["side"] == 0], group[group["side"] == 1]
        if not len(own) or not len(other):
            return pd.DataFrame({"nid": [], "n": [], "cell": [], "other": []}).astype("int64")
        near = _unit(own["vector"]) @ _unit(other["vector"]).T >= threshold
        n = near @ other["mult"].to_numpy()
        touched = other["other"].to_numpy()[near.any(axis=0)]
        cell = group["cell"].iat[0]
        counts = pd.DataFrame({"nid": own["nid"].to_numpy(), "n": n.astype(np.int64), "cell": cell, "other": -1})
        edges = pd.DataFrame({"nid": -1, "n": 0, "cell": cell, "other": np.unique(touched)})
        return pd.concat([counts[counts["n"] > 0], edges]).astype("int64")

    return run


def member_links(nodes: DataFrame, links: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(nid, n): how many rows each node links with besides its own copies; (a, b): cells between whose members is a link.

    ``nodes``: nid, vector, mult, cell, r, least; ``links``: (a, b, sim) of cells within their radii of the threshold.
    Radii decide most pairs of cells: all their members link. Only where they don't are members compared, in blocks.
    """
    theta = math.acos(threshold)
    cells = materialize(nodes.groupBy("cell").agg(F.sum("mult").alias("w"), F.count(F.lit(1)).alias("size"), F.max("r").alias("r")), "sizes")
    both = links.select(F.col("a").alias("cell"), F.col("b").alias("other"), "sim").union(links.select("b", "a", "sim"))
    both = both.join(cells.select("cell", F.col("r").alias("r0"), F.col("size").alias("size0")), "cell")
    both = both.join(cells.select(F.col("cell").alias("other"), F.col("r").alias("r1"), F.col("w").alias("w1"), F.col("size").alias("size1")), "other")
    radii = F.col("r0") + F.col("r1")
    whole = F.when(radii == 0, F.col("sim") >= threshold).otherwise(F.col("sim") >= F.cos(F.lit(theta) - radii) + 1e-12)
    both = materialize(both.withColumn("whole", whole), "pairs")
    of_cell = both.where("whole").groupBy("cell").agg(F.sum("w1").alias("n"))
    out = nodes.join(cells.select("cell", "w"), "cell").join(of_cell, "cell", "left").select("nid", (F.col("w") - F.col("mult") + F.coalesce("n", F.lit(0))).alias("n"))
    edges, open_ = both.where("whole").select(F.col("cell").alias("a"), F.col("other").alias("b")), both.where("not whole")
    if not open_.isEmpty():
        blocks = open_.groupBy("cell").agg(F.ceil(F.max("size0") / BLOCK).cast("int").alias("xs"), F.ceil(F.sum("size1") / BLOCK).cast("int").alias("ys"))
        one = nodes.join(blocks, "cell").select("cell", "nid", "vector", "mult", F.lit(-1).cast("long").alias("other"), F.lit(0).alias("side"), F.pmod(F.xxhash64(F.lit(1), "nid"), F.col("xs")).cast("int").alias("x"), F.explode(F.sequence(F.lit(0), F.col("ys") - 1)).alias("y"))
        two = open_.select("cell", "other").join(nodes.select("nid", "vector", "mult", F.col("cell").alias("c")), F.col("other") == F.col("c")).join(blocks, "cell")
        two = two.select("cell", "nid", "vector", "mult", "other", F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0), F.col("xs") - 1)).alias("x"), F.pmod(F.xxhash64(F.lit(2), "nid"), F.col("ys")).cast("int").alias("y"))
        found = one.unionByName(two).groupBy("cell", "x", "y").applyInPandas(_block_counter(threshold), "nid long, n long, cell long, other long")
        found = materialize(found, "blocks")
        more = found.where("nid >= 0").groupBy(F.col("nid").alias("m_nid")).agg(F.sum("n").alias("more"))
        out = out.join(more, F.col("nid") == F.col("m_nid"), "left").select("nid", (F.col("n") + F.coalesce("more", F.lit(0))).alias("n"))
        edges = edges.union(found.where("nid < 0").select("cell", "other"))
    return materialize(out, "counts"), edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


# --- the audit


def _ask(asked: list, nodes: DataFrame, found: DataFrame, threshold: float) -> tuple[int, float | None]:
    """How many of the asked nodes have links, and the mean over these of the share of a node's links that was found."""
    if not asked:
        return 0, None
    ids = np.array([r["nid"] for r in asked])
    groups: dict[str, list[int]] = {}
    for i, r in enumerate(asked):
        groups.setdefault(r["group"], []).append(i)
    unit = {g: _unit([asked[i]["vector"] for i in at]) for g, at in groups.items()}

    def compare(batches):
        for batch in batches:
            true = np.zeros(len(ids), np.int64)
            for g, rows in batch.groupby("group"):
                if g in unit:
                    at = groups[g]
                    near = (unit[g] @ _unit(rows["vector"]).T >= threshold) & (ids[at][:, None] != rows["nid"].to_numpy()[None, :])
                    true[at] += (near * rows["mult"].to_numpy()).sum(axis=1)
            yield pd.DataFrame({"nid": ids[true > 0], "true": true[true > 0]})

    true = nodes.select("nid", "group", "vector", "mult").mapInPandas(compare, "nid long, true long").groupBy("nid").agg(F.sum("true").alias("true"))
    share = F.least("true", F.coalesce("n", F.lit(0))) / F.col("true")
    row = true.join(found, "nid", "left").agg(F.count(F.lit(1)).alias("linked"), F.avg(share).alias("share")).first()
    return row["linked"], row["share"]


def audit(nodes: DataFrame, found: DataFrame, threshold: float, sample: int = AUDIT) -> float | None:
    """Recall of ``found`` (nid, n) in its worst stratum, a mean over nodes that have links; None if no node asked has any.

    Nodes with at least DENSE links found are one stratum, all others (pairs, small groups, nothing found) the other, so
    a large group cannot hide what is lost elsewhere. Of each a bounded sample is compared with every node of its label.
    """
    judged = nodes.select("nid", "group", "vector").join(found, "nid", "left")
    dense, worst = F.coalesce("n", F.lit(0)) >= DENSE, None
    for stratum in (dense, ~dense):
        linked, recall, asked = 0, None, []
        for most in (sample, max(sample, AUDIT_MORE)):
            if linked >= AUDIT_LINKED or (asked and len(asked) < sample):
                break
            asked = judged.where(stratum).orderBy(F.xxhash64(F.lit(23), "nid")).limit(most).select("nid", "group", "vector").collect()
            linked, recall = _ask(asked, nodes, found, threshold)
        worst = min((x for x in (worst, recall) if x is not None), default=None)
    return worst


def vector_links(nodes: DataFrame, threshold: float = THRESHOLD, overlap: int = OVERLAP, beam: int = BEAM, part: int = PART) -> tuple[DataFrame, DataFrame, DataFrame, list[float | None]]:
    """(nid, n), (nid, cell), links (a, b) of cells, and the measured recall of each search (None where no node that was asked has links).

    ``nodes``: nid, group, vector, mult (rows that the node stands for). While the audit finds less than RECALL in any
    stratum, the graph is searched with a wider beam over more balls; after TRIES searches, or at once where it is
    cheaper, all pairs of cells of a label are compared instead, whose recall is 1.
    """
    leaders = _leaders(nodes, _reach(threshold))
    placed = materialize(nodes.withColumn("balls", _assign(leaders, 1)("group", "vector")), "nodes_placed")
    members, radii = make_cells(placed, threshold)
    whole = materialize(nodes.join(members, "nid").join(radii.select(F.col("nid").alias("cell"), "r"), "cell"), "whole")
    cells = whole.where("nid = cell").select("nid", "group", "vector", "r")
    pairs = cells.groupBy("group").count().agg(F.sum(F.col("count").cast("double") * F.col("count") / 2)).first()[0] or 0
    recalls: list[float | None] = []
    for attempt in range(TRIES):
        counts, edges = member_links(whole, graph_links(cells, leaders, threshold, overlap, beam, part), threshold)
        recalls.append(audit(nodes, counts, threshold))
        if recalls[-1] is None or recalls[-1] >= RECALL:
            break
        if pairs <= EXACT_PAIRS or attempt == TRIES - 1:
            counts, edges = member_links(whole, exact_links(cells, threshold), threshold)
            recalls.append(1.0)
            break
        overlap, beam = overlap + 1, beam * 3
    return counts, members, edges, recalls


def link_vectors(embeddings: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, list[float | None]]:
    """vec_id, n_links, component_id, kept for every row, and the recall that each search's audit measured (None: nothing to judge).

    Equal vectors of a label are one node and link with each other. Rows whose label, vec_id or vector is null, or
    whose vector is empty, zero or holds a null or non-finite component, link with nothing and keep themselves (with a
    null vec_id: component null, not kept). Vectors of different lengths are not compared. Rows that repeat a vec_id
    keep a row each. Other columns are ignored; an empty table gives an empty result.
    """
    vector = F.col("embedding")
    if not isinstance(embeddings.schema["embedding"].dataType.elementType, T.FloatType):
        vector = F.transform(vector, lambda v: v.cast("double"))
    rows = embeddings.select("vec_id", "label", vector.alias("vector"))
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
    sound &= F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("vector", lambda v: v != 0)
    key = F.when(F.coalesce(sound, F.lit(False)), F.md5(F.concat_ws(":", F.col("label").cast("string"), F.col("vector").cast("string")).cast("binary")))
    rows = rows.withColumn("key", key)
    nodes = rows.where("key is not null").groupBy("key").agg(
        F.first(F.concat_ws(":", F.col("label").cast("string"), F.size("vector").cast("string"))).alias("group"), F.first("vector").alias("vector"),
        F.count(F.lit(1)).alias("mult"), F.min("vec_id").alias("least"),
    )
    nodes = materialize(nodes.withColumn("nid", F.monotonically_increasing_id()), "nodes")
    counts, members, edges, recalls = vector_links(nodes.select("nid", "group", "vector", "mult"), threshold)
    # cells go by the least id of their members, so a component's name is its least node
    named = materialize(nodes.select("nid", "least").join(members, "nid").groupBy("cell").agg(F.min("least").alias("least")).select("cell", F.struct("least", "cell").alias("name")), "named")
    one, two = named.select(F.col("cell").alias("a"), F.col("name").alias("na")), named.select(F.col("cell").alias("b"), F.col("name").alias("nb"))
    reached = connected_components(edges.join(one, "a").join(two, "b").select(F.col("na").alias("a"), F.col("nb").alias("b")))
    reached = reached.select(F.col("node.cell").alias("r_cell"), F.col("component.least").alias("component_id"))
    cells = named.join(reached, F.col("cell") == F.col("r_cell"), "left").select("cell", F.coalesce("component_id", "name.least").alias("component_id"))
    classes = nodes.select("nid", "key", "mult").join(counts, "nid").join(members, "nid").join(cells, "cell")
    classes = classes.select(F.col("key").alias("c_key"), (F.col("n") + F.col("mult") - 1).alias("n_links"), "component_id")
    key = F.coalesce("key", F.concat(F.lit("-"), F.col("vec_id").cast("string")))  # rows without a node don't meet in one task
    out = rows.select("vec_id", key.alias("key")).join(classes, F.col("key") == F.col("c_key"), "left")
    component = F.coalesce("component_id", "vec_id")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
    return out, recalls


def near_vectors(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``link_vectors``."""
    return link_vectors(embeddings, threshold)[0]


def op4_graph_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
