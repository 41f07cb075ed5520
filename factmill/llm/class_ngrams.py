"""Brown class bigrams: exchange clustering of words into classes, smoothed transitions and emissions."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factmill.llm.common import LOWER_BYTES, TEXTS_AT_ONCE, id_remainder, materialize, table

#: Most frequent words that workers hold in memory; the counts of all others are joined.
HEAD = 60_000
#: Units of the first exchange, on the driver: the most frequent words each, and all others by their shape.
WORDS = 1664
SHAPES = 384
CLASSES = 48
#: Most rounds of the first exchange; rounds in which Spark exchanges all other words of the HEAD.
ROUNDS = 10
REFINED = 1
#: Words whose neighbours are counted in one table, and groups in which such tables are summed before they meet.
BLOCK = 1000
SALTS = 64
#: Weight of a class's own frequency in the transitions to it.
PRIOR = 50.0
#: Distinct words that a task counts before it hands them on.
FLUSH = 250_000

END = b" "  # no word holds a space, so the end token has a name of its own


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(LOWER_BYTES).split()


def shape(word: bytes) -> int:
    """The unit of a word outside the exchanged ones: by its last two bytes and whether it is all ASCII letters."""
    return (word[-1] * 131 + (word[-2] if len(word) > 1 else 0) * 17 + (not word.isalpha())) % SHAPES


def _texts(batches: Iterator) -> Iterator[list[str]]:
    for batch in batches:
        column = batch.column(batch.schema.get_field_index("text"))
        for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
            yield column.slice(at, TEXTS_AT_ONCE).to_pylist()


def _count_words(batches: Iterator) -> Iterator:
    import pyarrow as pa

    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    counts: Counter = Counter()
    for texts in _texts(batches):
        for text in texts:
            counts.update(words_of(text))
        counts[END] += len(texts)
        if len(counts) > FLUSH:
            yield rows(counts)
            counts = Counter()
    if counts:
        yield rows(counts)


def _count_shapes(batches: Iterator) -> Iterator:
    import pyarrow as pa

    counts: Counter = Counter()
    for batch in batches:
        counts.update(map(shape, batch.column(0).to_pylist()))
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())], names=["shape", "n"])


def _count_pairs(units: dict[bytes, int], size: int):
    """Counts of neighbouring units; the end stands before a text's first word and after its last."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        end, counts, get = size - 1, np.zeros(size * size, np.int32), units.get
        for texts in _texts(batches):
            line = [end]
            for text in texts:
                for w in words_of(text):
                    u = get(w)
                    line.append(u if u is not None else WORDS + shape(w))
                line.append(end)
            ids = np.asarray(line, np.int64)
            np.add.at(counts, ids[:-1] * size + ids[1:], 1)
        found = np.flatnonzero(counts)
        for at in range(0, len(found), 100_000):
            some = found[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array((some // size).astype(np.int32)), pa.array((some % size).astype(np.int32)), pa.array(counts[some].astype(np.int64))], names=["a", "b", "n"])

    return run


def _classes_of(words: list[bytes], index: dict[bytes, int], classes: np.ndarray, shapes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place in the HEAD (-1: none) and the class of each word."""
    at = np.fromiter((index.get(w, -1) for w in words), np.int64, len(words))
    out = classes[at]
    for i in np.flatnonzero(at < 0).tolist():
        out[i] = shapes[shape(words[i])]
    return at, out


def _lines(batches: Iterator, shared) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and classes of many texts' words on end, the end token before, between and after them."""
    index, classes, shapes, end = shared.value
    for texts in _texts(batches):
        places, line = [[-1]], [[end]]
        for text in texts:
            at, own = _classes_of(words_of(text), index, classes, shapes)
            places += [at, [-1]]
            line += [own, [end]]
        yield np.concatenate(places).astype(np.int64), np.concatenate(line).astype(np.int64)


def _count_joint(shared):
    """Counts of neighbouring classes, one row for each task."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        size = shared.value[3] + 1
        counts = np.zeros(size * size, np.int64)
        for _, line in _lines(batches, shared):
            counts += np.bincount(line[:-1] * size + line[1:], minlength=size * size)
        pairs = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array((pairs // size).astype(np.int32)), pa.array((pairs % size).astype(np.int32)), pa.array(counts[pairs])], names=["a", "b", "n"])

    return run


def _count_contexts(shared):
    """For each HEAD word: how often each class follows it, comes before it, and how often it follows itself; a packed table for each BLOCK of words."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        index, _, _, end = shared.value
        wide = 2 * (end + 1) + 1
        counts = np.zeros(len(index) * wide, np.int32)
        for places, line in _lines(batches, shared):
            known = np.flatnonzero(places >= 0)  # never the first or the last
            own = places[known] * wide
            np.add.at(counts, own + line[known + 1], 1)
            np.add.at(counts, own + end + 1 + line[known - 1], 1)
            np.add.at(counts, own[places[known + 1] == places[known]] + wide - 1, 1)
        salt = TaskContext.get().partitionId() % SALTS
        for block in range(-(-len(index) // BLOCK)):
            table = counts[block * BLOCK * wide : (block + 1) * BLOCK * wide]
            if table.any():
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([salt], pa.int32()), pa.array([zlib.compress(table.astype(np.int64).tobytes(), 1)])], names=["block", "salt", "data"])

    return run


def _summed(data: pd.Series) -> np.ndarray:
    total = None
    for d in data:
        table = np.frombuffer(zlib.decompress(d), np.int64)
        total = table.copy() if total is None else total + table
    return total


def _sum_tables(group: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"block": group["block"].iloc[:1], "data": [zlib.compress(_summed(group["data"]).tobytes(), 1)]})


def _move_words(joint: np.ndarray, classes: np.ndarray, fixed: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        """The class that raises the likelihood most for each word of a block; the first ``fixed`` words keep theirs."""
        size, first = len(joint), int(group["block"].iat[0]) * BLOCK
        tables = _summed(group["data"]).reshape(-1, 2 * size + 1).astype(np.float64)
        best = classes[first : first + len(tables)].copy()
        for i in range(max(0, fixed - first), len(tables)):
            if tables[i].any():
                values = move_values(joint, best[i], tables[i, :size], tables[i, size:-1], tables[i, -1])
                to = int(values.argmax())
                if values[to] > values[best[i]] + 1e-6:
                    best[i] = to
        return pd.DataFrame({"block": group["block"].iloc[:1], "classes": [best.astype(np.int32).tobytes()]})

    return run


def _dense_row(size: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        row = np.zeros(size)
        row[group["b"]] = group["n"]
        return pd.DataFrame({"a": group["a"].iloc[:1], "row": [row.tobytes()]})

    return run


def _h(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def move_values(joint: np.ndarray, s: int, right: np.ndarray, left: np.ndarray, own: float) -> np.ndarray:
    """Log likelihood, but for a constant, with a unit of class s in each class.

    joint: counts of class pairs; right[c], left[c]: how often the unit precedes or follows class c, itself included
    in class s; own: how often it follows itself. The last class is the end's and takes no words.
    """
    targets = len(joint) - 1
    right, left = right.copy(), left.copy()
    right[s] -= own
    left[s] -= own
    rest = joint.copy()
    rest[s, :] -= right
    rest[:, s] -= left
    rest[s, s] -= own
    h = _h(rest)
    rows = (_h(rest[:targets] + right) - h[:targets]).sum(axis=1)
    cols = (_h(rest[:, :targets] + left[:, None]) - h[:, :targets]).sum(axis=0)
    both = np.diagonal(rest)[:targets]
    base = _h(both)
    r, q = right[:targets], left[:targets]
    corner = _h(both + r + q + own) - base - (_h(both + r) - base) - (_h(both + q) - base)
    mass = right.sum() + own
    totals = joint.sum(axis=1)[:targets]
    totals[s] -= mass
    return rows + cols + corner - 2 * (_h(totals + mass) - _h(totals))


def exchange(counts: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The class of each unit and the counts of class pairs. counts[a, b]: how often unit b follows unit a.

    Every unit in turn, the most frequent first, moves to the class that raises the likelihood of the class bigrams
    most, until a round moves few. The last unit is the end, in a class of its own. The matrix is as large as the
    parameters say, whatever the corpus.
    """
    size = len(counts)
    totals = counts.sum(axis=1)
    order = np.argsort(-totals[: size - 1], kind="stable")
    assigned = np.full(size, classes)
    assigned[order] = np.arange(size - 1) % classes
    after, before = np.zeros((size, classes + 1)), np.zeros((size, classes + 1))
    for c in range(classes + 1):
        at = np.flatnonzero(assigned == c)
        after[:, c], before[:, c] = counts[:, at].sum(axis=1), counts[at].sum(axis=0)
    joint = np.zeros((classes + 1, classes + 1))
    np.add.at(joint, assigned, after)
    for _ in range(rounds):
        moved = 0
        for u in order.tolist():
            if totals[u] == 0:
                continue
            s, own = assigned[u], float(counts[u, u])
            values = move_values(joint, s, after[u], before[u], own)
            t = int(values.argmax())
            if t == s or values[t] <= values[s] + 1e-6:
                continue
            right, left = after[u].copy(), before[u].copy()
            right[s] -= own
            left[s] -= own
            joint[s] -= right
            joint[:, s] -= left
            joint[s, s] -= own
            joint[t] += right
            joint[:, t] += left
            joint[t, t] += own
            after[:, s] -= counts[:, u]
            after[:, t] += counts[:, u]
            before[:, s] -= counts[u]
            before[:, t] += counts[u]
            assigned[u] = t
            moved += 1
        if moved * 200 < size:
            break
    return assigned, joint


class Model:
    """Class bigrams: log10 P(class | class before) + log10 (c(word) + 1) / (N(class) + V(class) + 1)."""

    def __init__(self, head: dict[bytes, int], word_class: np.ndarray, shape_class: np.ndarray, joint: np.ndarray, kinds: np.ndarray, tokens: int, vocabulary: int) -> None:
        """head: word -> count; word_class: their classes; shape_class: those of all others by shape; kinds: distinct training words of each class."""
        self.index = {w: i for i, w in enumerate(head)}
        self.log_count = np.log10(np.array([c + 1.0 for c in head.values()] or [1.0]))
        self.word_class = word_class if len(word_class) else np.zeros(1, np.int64)
        self.shape_class = shape_class
        self.end = len(joint) - 1
        self.end_log_count = np.log10(joint.sum(axis=0)[self.end] + 1.0)
        totals = joint.sum(axis=0)
        share = (totals + 1.0) / (totals.sum() + len(totals))
        self.transition = np.log10((joint + PRIOR * share) / (joint.sum(axis=1, keepdims=True) + PRIOR))
        self.log_size = np.log10(totals + kinds + 1.0)
        self.tokens, self.log_base = tokens, float(np.log10(tokens + vocabulary + 1.0))

    def local(self, text: str) -> tuple[int, int, float, float, Counter]:
        """Tokens, known head tokens, what base and model get from this text alone, and the words whose counts are elsewhere."""
        words = words_of(text)
        at, inner = _classes_of(words, self.index, self.word_class, self.shape_class)
        classes = np.concatenate([[self.end], inner, [self.end]]).astype(np.int64)
        known = at >= 0
        tail = Counter(words[i] for i in np.flatnonzero(~known).tolist())
        counted = float(self.log_count[at[known]].sum() + self.end_log_count)
        n = len(words) + 1
        model = float(self.transition[classes[:-1], classes[1:]].sum() - self.log_size[classes[1:]].sum()) + counted
        return n, int(known.sum()), counted - n * self.log_base, model, tail


def _scorer(shared, end_known: bool):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        model, row = shared.value, TaskContext.get().partitionId() << 40
        entry = pa.struct([("word", pa.binary()), ("k", pa.int32())])
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                found = [model.local(t) for t in part.column(1).to_pylist()]
                tails = pa.array([[{"word": w, "k": k} for w, k in t.items()] for *_, t in found], pa.list_(entry))
                columns = [[n for n, *_ in found], [k + end_known for _, k, *_ in found], [b for _, _, b, _, _ in found], [m for _, _, _, m, _ in found]]
                ids = pa.array(range(row, row + part.num_rows), pa.int64())
                row += part.num_rows
                yield pa.RecordBatch.from_arrays([part.column(0), ids, pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), *map(pa.array, columns[2:]), tails], names=["doc_id", "row", "n_tokens", "known", "base", "model", "tail"])

    return run


def _least_count(counts: DataFrame, wanted: int) -> int:
    """A power of two that at least ``wanted`` words reach (1 if there are fewer), so that tasks send few more than that."""
    sizes = {int(r["b"]): r["words"] for r in counts.groupBy(F.floor(F.log2("n")).alias("b")).agg(F.count(F.lit(1)).alias("words")).collect()}  # at most 63 rows
    reached = 0
    for b in sorted(sizes, reverse=True):
        reached += sizes[b]
        if reached > wanted:
            return 1 << b
    return 1


def fit(training: DataFrame) -> tuple[Model, DataFrame]:
    """The model of the texts in ``training`` (doc_id, text) and the counts (word, n) of all their tokens."""
    counts = training.select("text").mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    top = [(bytes(r["word"]), r["n"]) for r in counts.where((F.col("word") != F.lit(END)) & (F.col("n") >= _least_count(counts, HEAD))).orderBy(F.desc("n"), "word").limit(HEAD).collect()]
    units = {w: i for i, (w, _) in enumerate(top[:WORDS])}
    size = WORDS + SHAPES + 1
    pairs = training.select("text").mapInArrow(_count_pairs(units, size), "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    matrix = np.zeros((size, size))
    rows = materialize(pairs.groupBy("a").applyInPandas(_dense_row(size), "a int, row binary"), "pairs")
    for r in rows.toLocalIterator():  # one row of `size` numbers for each unit, whatever the corpus
        matrix[r["a"]] = np.frombuffer(r["row"], np.float64)
    unit_class, joint = exchange(matrix, CLASSES, ROUNDS)
    head, shape_class = dict(top), unit_class[WORDS : WORDS + SHAPES]
    word_class = np.array([unit_class[units.get(w, WORDS + shape(w))] for w in head], np.int64)
    word_class, joint = refine(training, head, word_class, shape_class, joint, len(units))
    kinds = np.zeros(CLASSES + 1)
    kinds[CLASSES] = 1
    np.add.at(kinds, word_class, 1)
    shapes = counts.where(F.col("word") != F.lit(END)).select("word").mapInArrow(_count_shapes, "shape int, n long").groupBy("shape").agg(F.sum("n").alias("n")).collect()
    by_shape = np.zeros(SHAPES)
    for r in shapes:  # at most SHAPES rows
        by_shape[r["shape"]] = r["n"]
    for w in head:
        by_shape[shape(w)] -= 1
    np.add.at(kinds, shape_class, by_shape)
    return Model(head, word_class, shape_class, joint, kinds, int(total["n"]), int(total["v"])), counts


def refine(training: DataFrame, head: dict[bytes, int], word_class: np.ndarray, shape_class: np.ndarray, joint: np.ndarray, fixed: int, rounds: int = REFINED) -> tuple[np.ndarray, np.ndarray]:
    """Exchanges all HEAD words but the first ``fixed``, whose classes stand, and counts class pairs anew over all texts.

    Spark counts the classes around each word; tasks move each word of their block to the class that raises the
    likelihood most, given the class pairs so far. The words of a round move together: each is a small part of its
    class. What reaches the driver are the classes of at most HEAD words and class pairs, whatever the corpus.
    """
    spark, index = training.sparkSession, {w: i for i, w in enumerate(head)}
    if len(head) <= fixed:
        return word_class, joint
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((index, word_class, shape_class, len(joint) - 1))  # bounded by HEAD
        tables = training.select("text").mapInArrow(_count_contexts(shared), "block int, salt int, data binary")
        tables = tables.groupBy("block", "salt").applyInPandas(_sum_tables, "block int, data binary")
        moved = tables.groupBy("block").applyInPandas(_move_words(joint, word_class, fixed), "block int, classes binary")
        word_class = word_class.copy()
        for r in materialize(moved, "moved").toLocalIterator():  # HEAD / BLOCK rows
            new = np.frombuffer(r["classes"], np.int32)
            word_class[r["block"] * BLOCK : r["block"] * BLOCK + len(new)] = new
        shared = spark.sparkContext.broadcast((index, word_class, shape_class, len(joint) - 1))
        pairs = training.select("text").mapInArrow(_count_joint(shared), "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
        joint = np.zeros_like(joint)
        for r in pairs.collect():  # at most (CLASSES + 1) squared rows
            joint[r["a"], r["b"]] = r["n"]
    return word_class, joint


def score_documents(documents: DataFrame, remainder: int = 2, folds: int = 7) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Learns from all rows but those whose crc32(doc_id as text) mod ``folds`` is ``remainder``. A word's class is its
    own among the HEAD words, all of which are exchanged, else that of its shape, so transitions need no join; the counts of words outside
    the HEAD most frequent ones are joined by word, which spreads them evenly, since no frequent word is among them.

    Null and empty texts are the end token alone; a null id counts as the empty text in the fold; repeated rows keep
    a row each; with nothing to learn from, all counts are 0; an empty table gives an empty result.
    """
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    held_out = id_remainder(F.col("doc_id"), folds) == remainder
    model, counts = fit(rows.where(~held_out))
    shared = documents.sparkSession.sparkContext.broadcast(model)  # bounded by HEAD
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, row long, n_tokens long, known long, base double, model double, tail array<struct<word:binary,k:int>>"
    scored = materialize(rows.mapInArrow(_scorer(shared, model.tokens > 0), schema), "scored")
    tail = scored.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.k").join(counts, "word")
    tail = tail.groupBy(F.col("row").alias("r")).agg(F.sum(F.col("k") * F.log10(F.col("n") + 1.0)).alias("more"), F.sum("k").alias("found"))
    out = scored.select("doc_id", "row", "n_tokens", "known", "base", "model").join(tail, F.col("row") == F.col("r"), "left")
    more = F.coalesce("more", F.lit(0.0))
    return out.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", (F.col("known") + F.coalesce("found", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"), (F.col("model") + more).alias("score"),
    )


def op5_class_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
