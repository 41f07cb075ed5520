"""Codes of vectors from codebooks of whole numbers: exact k-means on parts, its products by limbs in float64."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factmill.llm.common import bounded_broadcast, materialize, table

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Distances of one multiplication that a worker holds at a time.
CELLS = 1 << 20
#: Sums leave a task in limbs of so many bits, so that Spark adds them as longs however wide they are.
SUM_BITS = 40
LONGEST = 2**63 - 1


def limb_bits(width: int) -> int:
    """Bits of a limb: a sum of ``width`` products of two limbs stays below 2**53, so float64 holds it exactly."""
    return (53 - max(1, width).bit_length()) // 2


def limbs(numbers: np.ndarray, bits: int) -> list[np.ndarray]:
    """``numbers`` (int64) as sum of limb * 2**(bits * place); the last limb is signed, all others are not negative."""
    out = []
    while numbers.size and (numbers.min() < -(1 << bits) or numbers.max() >= 1 << bits):
        out.append((numbers & ((1 << bits) - 1)).astype(np.float64))
        numbers = numbers >> bits
    return [*out, numbers.astype(np.float64)]


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of int64 matrices, exact where the result and its partial sums fit into int64."""
    bits = limb_bits(a.shape[1])
    out = np.zeros((len(a), len(b)), np.int64)
    right = limbs(b, bits)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(right):
            out += (x @ y.T).astype(np.int64) << (bits * (i + j))
    return out


def _widest(m: np.ndarray) -> int:
    return max(abs(int(m.min())), abs(int(m.max()))) if m.size else 0


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, list[int] | np.ndarray]:
    """The nearest entry of each row by squared Euclidean distance (ties: the lower index), and that distance.

    Numbers whose distances may leave int64 (or object arrays of them) are compared in Python's own integers.
    """
    if parts.dtype != object and book.dtype != object and parts.shape[1] * (_widest(parts) + _widest(book)) ** 2 <= LONGEST // 2:
        far = (book * book).sum(1)[None, :] - 2 * exact_products(parts, book)
        best = far.argmin(1)
        return best, far[np.arange(len(parts)), best] + (parts * parts).sum(1)
    best, errors, entries = np.zeros(len(parts), np.int64), [], [[int(c) for c in e] for e in book]
    for i, row in enumerate(parts):
        row = [int(x) for x in row]
        error, best[i] = min((sum((x - c) ** 2 for x, c in zip(row, e, strict=True)), k) for k, e in enumerate(entries))
        errors.append(error)
    return best, errors


def whole(m: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of finite floats as int64, or as an object array where int64 could not hold it."""
    if not m.size or np.abs(m).max() < 2.0**62 / SCALE:
        return np.floor(m * SCALE).astype(np.int64)
    # a float of 2**53 or more is a whole number, and SCALE times it need not be a float
    as_int = np.frompyfunc(lambda x: int(x) * SCALE if abs(x) >= 2.0**53 else int(np.floor(x * SCALE)), 1, 1)
    return as_int(m)


def _bounds(width: int, parts: int) -> list[int]:
    return [width * i // parts for i in range(parts + 1)]


def _kept(column, width: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Rows of a list column that hold ``width`` finite numbers, these numbers, and the rows that hold another number of finite ones."""
    import pyarrow.compute as pc

    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)  # NaN for null
    here = np.flatnonzero(lengths == width)
    m = column.take(here).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(here), width)
    fine = np.isfinite(m).all(1)
    others = [i for i in np.flatnonzero((lengths != width) & (lengths >= 0)).tolist() if all(x is not None and np.isfinite(x) for x in column[i].as_py())]
    return here[fine], m[fine], others


def _slices(batch, width: int, entries: int) -> Iterator:
    step = max(1, CELLS // max(1, width, entries))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def _sums(books: list[np.ndarray], width: int):
    """Adds up, in each task, the parts that each entry got."""
    bounds = _bounds(width, len(books))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        totals = [np.zeros(b.shape, np.int64) for b in books]
        wide: list[dict[tuple[int, int], int]] = [{} for _ in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            for part in _slices(batch, width, len(books[0])):
                _, m, _ = _kept(part.column("embedding"), width)
                numbers = whole(m)
                for p, book in enumerate(books):
                    x = numbers[:, bounds[p] : bounds[p + 1]]
                    best, _ = nearest(x, book)
                    counts[p] += np.bincount(best, minlength=len(book))
                    small = x.dtype != object and _widest(x) < 2**SUM_BITS and _widest(totals[p]) < 2**62
                    if small:
                        order = np.argsort(best, kind="stable")
                        entries, firsts = np.unique(best[order], return_index=True)
                        if len(entries) and x.shape[1]:
                            totals[p][entries] += np.add.reduceat(x[order], firsts, axis=0)
                    else:
                        for e, row in zip(best.tolist(), x, strict=True):
                            for k, v in enumerate(row):
                                wide[p][e, k] = wide[p].get((e, k), 0) + int(v)
        rows: list[tuple[int, int, int, int, int]] = []
        for p in range(len(books)):
            for e in np.flatnonzero(counts[p]).tolist():
                rows.append((p, e, -1, 0, int(counts[p][e])))
                for k, v in enumerate(totals[p][e].tolist()):
                    v, place = v + wide[p].get((e, k), 0), 0
                    while True:
                        last = -(1 << SUM_BITS) <= v < 1 << SUM_BITS
                        rows.append((p, e, k, place, v if last else v & ((1 << SUM_BITS) - 1)))
                        if last:
                            break
                        v, place = v >> SUM_BITS, place + 1
        columns = zip(*rows, strict=True) if rows else ((),) * 5
        types = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["part", "entry", "place", "limb", "total"])

    return run


def _updated(books: list[np.ndarray], found) -> list[np.ndarray]:
    """Each used entry becomes the floor of its parts' mean; others stay."""
    counts: dict[tuple[int, int], int] = {}
    sums: dict[tuple[int, int, int], int] = {}
    for p, e, k, limb, total in zip(*(found.column(c).to_pylist() for c in ("part", "entry", "place", "limb", "total")), strict=True):
        if k < 0:
            counts[p, e] = total
        else:
            sums[p, e, k] = sums.get((p, e, k), 0) + (total << (SUM_BITS * limb))
    out = []
    for p, book in enumerate(books):
        rows = [[sums[p, e, k] // counts[p, e] for k in range(book.shape[1])] if (p, e) in counts else [int(x) for x in entry] for e, entry in enumerate(book)]
        out.append(_matrix(rows, book.shape))
    return out


def _matrix(rows: list[list[int]], shape: tuple[int, int]) -> np.ndarray:
    small = all(abs(x) < 2**62 for row in rows for x in row)
    return np.array(rows, np.int64 if small else object).reshape(shape)


def _finite(c: Column) -> Column:
    """Whether an array is there and all its components are finite (NaN is above infinity for Spark)."""
    return c.isNotNull() & F.forall(c, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))


def first_books(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> tuple[list[np.ndarray], int] | None:
    """The parts of the ``entries`` smallest vec_ids (null last; ties by components) and the vectors' width; None without vectors."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding")]
    kept = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(_finite(F.col("embedding")))
    first = kept.orderBy(*order).first()
    if first is None:
        return None
    width = len(first.embedding)
    rows = [r.embedding for r in kept.where(F.size("embedding") == width).orderBy(*order).limit(entries).collect()]
    numbers, bounds = whole(np.array(rows, np.float64).reshape(len(rows), width)), _bounds(width, parts)
    return [numbers[:, bounds[p] : bounds[p + 1]] for p in range(parts)], width


def train(vectors: DataFrame, books: list[np.ndarray], width: int, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Rounds of assignment and update. Tasks send one row for each entry, place and limb, never vectors; what reaches
    the driver is as large as the codebooks, whatever the input."""
    for _ in range(rounds):
        found = vectors.select("embedding").mapInArrow(_sums(books, width), "part int, entry int, place int, limb int, total long")
        books = _updated(books, found.groupBy("part", "entry", "place", "limb").agg(F.sum("total").alias("total")).toArrow())
    return books


def _codes(books: list[np.ndarray], width: int):
    bounds = _bounds(width, len(books))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part in _slices(batch, width, len(books[0])):
                here, m, others = _kept(part.column("embedding"), width)
                numbers = whole(m)
                best, errors = zip(*(nearest(numbers[:, bounds[p] : bounds[p + 1]], book) for p, book in enumerate(books)), strict=True)
                digits = ["%02x" % e for e in range(len(books[0]))]
                codes = ["".join([digits[e] for e in row]) for row in zip(*(b.tolist() for b in best), strict=True)]
                if any(isinstance(e, list) for e in errors):
                    sums = [sum(map(int, row)) for row in zip(*errors, strict=True)]
                else:  # each is at most a quarter of what int64 holds
                    sums = [int(a) for a in np.sum(np.stack([np.asarray(e, object) for e in errors]), 0)] if len(errors) > 1 else errors[0].tolist()
                fits = [s <= LONGEST for s in sums]
                chosen = np.concatenate([here, np.array(others, np.int64)]).astype(np.int64)
                none = [None] * len(others)
                columns = [part.column("vec_id").take(chosen), part.column("label").take(chosen), pa.array(codes + none, pa.string())]
                columns += [pa.array([s if f else None for s, f in zip(sums, fits, strict=True)] + none, pa.int64()), pa.array([not f for f in fits] + [False] * len(others), pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error", "beyond"])

    return run


def books_digest(books: list[np.ndarray]) -> str:
    numbers = ",".join(str(int(x)) for book in books for entry in book for x in entry)
    return hashlib.sha256(numbers.encode()).hexdigest()


def encode_vectors(vectors: DataFrame, books: list[np.ndarray], width: int) -> DataFrame:
    """(vec_id, label, code, error, beyond) of each vector whose components are finite; beyond: its error is no long."""
    kinds = {f.name: f.dataType for f in vectors.schema.fields}
    schema = T.StructType([T.StructField("vec_id", kinds["vec_id"]), T.StructField("label", kinds["label"])] + [T.StructField(n, t) for n, t in (("code", T.StringType()), ("error", T.LongType()), ("beyond", T.BooleanType()))])
    return vectors.select("vec_id", "label", "embedding").mapInArrow(_codes(books, width), schema)


def compress_vectors(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Codes of ``vectors`` (vec_id, embedding, label) from codebooks of their own.

    Components become floor(1024 * x); each of ``parts`` consecutive parts gets ``entries`` entries, at most 256, moved
    ``rounds`` times. Columns: vec_id, code, error, label_error, codebooks_sha256.
    Vectors that are null or hold null, NaN or infinite components are dropped. The width is that of the smallest kept
    vec_id (null ids last); finite vectors of another width keep a row with null code and error and teach nothing. A
    width that parts don't divide is cut as evenly as it goes. Repeated ids and rows keep a row each; fewer vectors than
    entries make fewer entries. An error, or a label's sum of errors, that no long holds is null. Null labels form one
    group, other columns are ignored, and an empty table gives an empty result.

    The source is read anew in each round, which costs less than a written copy of it; only codes are written.
    """
    if not 1 <= entries <= 256 or parts < 1:
        raise ValueError("a part's index has two hex digits: 1 to 256 entries")
    vectors = vectors.select("vec_id", "embedding", "label")
    begun = first_books(vectors, parts, entries)
    if begun is None:
        books, width = [np.zeros((0, 0), np.int64)] * parts, -1
        coded = vectors.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"), F.lit(False).alias("beyond")).limit(0)
    else:
        books, width = begun
        books = train(vectors, books, width, rounds)
        coded = materialize(encode_vectors(vectors, books, width), "codes")
    summed = F.when(~F.bool_or("beyond"), F.coalesce(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(0))).try_cast("long")
    sums = coded.groupBy(F.col("label").alias("of")).agg(summed.alias("label_error"))
    if begun is not None:
        sums = bounded_broadcast(materialize(sums, "label-errors"))
    out = coded.join(sums, coded["label"].eqNullSafe(sums["of"]), "left")
    return out.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


def op13_limb_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress_vectors(table(spark, sf_dir, "embeddings"))
