"""Vector codes against Python's own integers."""

import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from factmill.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, parts=4, entries=256, rounds=4):
    """(vec_id, code, error, label_error, digest) in plain Python; all vectors of one width that parts divide."""
    kept = [(i, [math.floor(1024 * x) for x in v], l) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * w : (p + 1) * w]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            got = {}
            for _, v, _ in kept:
                got.setdefault(near(cut(v, p), books[p])[1], []).append(cut(v, p))
            books[p] = [[sum(c) // len(c) for c in zip(*got[k], strict=True)] if k in got else e for k, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    last = [(i, [near(cut(v, p), books[p]) for p in range(parts)], l) for i, v, l in kept]
    errors = [sum(d for d, _ in found) for _, found, _ in last]
    by_label = {}
    for (_, _, l), e in zip(last, errors, strict=True):
        by_label[l] = by_label.get(l, 0) + e
    return sorted(((i, "".join(f"{k:02x}" for _, k in found), e, by_label[l], digest) for (i, found, l), e in zip(last, errors, strict=True)), key=str)


def test_products_of_limbs_are_exact():
    r = random.Random(1)
    for width, most in ((1, 10), (16, 2**20), (64, 2**26), (700, 2**26), (3, 2**30)):
        a = np.array([[r.randrange(-most, most + 1) for _ in range(width)] for _ in range(9)], np.int64)
        b = np.array([[r.choice((-most, most, r.randrange(-most, most))) for _ in range(width)] for _ in range(7)], np.int64)
        wanted = [[sum(int(x) * int(y) for x, y in zip(u, v, strict=True)) for v in b] for u in a]
        assert vc.exact_products(a, b).tolist() == wanted
        best, errors = vc.nearest(a, b)
        brute_near = [min((sum((int(x) - int(y)) ** 2 for x, y in zip(u, v, strict=True)), k) for k, v in enumerate(b)) for u in a]
        assert list(zip(map(int, errors), best.tolist(), strict=True)) == brute_near


def test_limbs_stay_below_what_float64_holds():
    for width in (1, 2, 16, 255, 256, 4096, 10**6):
        assert width * ((1 << vc.limb_bits(width)) ** 2) < 2**53


def test_codes_against_plain_integers(spark):
    r = random.Random(5)
    rows = [(3 * i, [r.gauss(0, 1) for _ in range(8)], r.choice((None, 1, 2))) for i in range(700)]
    rows += [(5, None, 1), (6, [1.0] * 7 + [None], 1), (7, [float("nan")] * 8, 1), (8, [float("-inf")] * 8, None), (3, rows[0][1], 1), (3, rows[0][1], 1), (None, [0.5] * 8, 2)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({c: F.lit(1) for c in ("part", "entry", "code", "of", "beyond")})
    assert sorted(map(tuple, vc.compress_vectors(df).collect()), key=str) == brute(rows)


def test_few_vectors_and_ties(spark):
    rows = [(i, [float(i % 2), 0.0, -0.0005, 1.0], None) for i in range(6)]
    assert sorted(map(tuple, vc.compress_vectors(spark.createDataFrame(rows, SCHEMA)).collect()), key=str) == brute(rows)


def test_wide_numbers_stay_exact(spark):
    r = random.Random(6)
    rows = [(i, [r.choice((1e12, -3e15, 7e9, 0.25)) * r.random() for _ in range(4)], i % 2) for i in range(40)]
    got = {x.vec_id: (x.code, x.error, x.label_error) for x in vc.compress_vectors(spark.createDataFrame(rows, SCHEMA), entries=8).collect()}
    wanted = {i: (code, e if e < 2**63 else None, s) for i, code, e, s, _ in brute(rows, entries=8)}
    assert {i: v[:2] for i, v in got.items()} == {i: v[:2] for i, v in wanted.items()}
    over = {i % 2 for i, v in wanted.items() if v[1] is None}
    assert all(got[i][2] is None for i in got if i % 2 in over)
    huge = [(1, [1e308, -1e308, 1.0, 2.0], 1), (2, [1e300, 5.0, 1.0, 2.0], 1)]
    assert [(x.vec_id, x.code, x.error) for x in vc.compress_vectors(spark.createDataFrame(huge, SCHEMA)).orderBy("vec_id").collect()] == [(1, "00000000", 0), (2, "01010000", 0)]


def test_other_widths_and_empty_tables(spark):
    rows = [(1, [1.0, 2.0, 3.0], 1), (2, [1.0], 1), (3, [], None), (4, [1.0, 2.0, 4.0], 1), (5, [1.0, None], 1)]
    got = {x.vec_id: (x.code, x.error, x.label_error) for x in vc.compress_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: ("00000000", 0, 0), 2: (None, None, 0), 3: (None, None, 0), 4: ("00000001", 0, 0)}
    assert [x.code for x in vc.compress_vectors(spark.createDataFrame([(1, [], 1)], SCHEMA)).collect()] == ["00000000"]
    assert vc.compress_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
    assert vc.compress_vectors(spark.createDataFrame([(1, None, 1)], SCHEMA)).collect() == []
