import hashlib
import math
import random

import numpy as np
from haulframe.llm import vector_codes


def by_brute_force(rows, parts=8, entries=16, rounds=6):
    kept = []
    for vec_id, vector, label in rows:
        if vector is not None and all(v is not None and math.isfinite(v) for v in vector):
            kept.append((vec_id, [math.floor(4096 * float(np.float32(v))) for v in vector], label))
    if not kept:
        return []
    sizes = [len(v) for _, v, _ in kept]
    size = max(set(sizes), key=lambda s: (sizes.count(s), s))
    used = [k for k in kept if len(k[1]) == size]
    at = [i * size // parts for i in range(parts + 1)]
    used.sort(key=lambda k: (k[0] is None, k[0] or 0, k[1]))
    books = [[v[at[p] : at[p + 1]] for _, v, _ in used[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, v, _ in used:
                x = v[at[p] : at[p + 1]]
                groups.setdefault(nearest(x, books[p])[1], []).append(x)
            for e, xs in groups.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    coded = []
    for vec_id, v, label in used:
        found = [nearest(v[at[p] : at[p + 1]], books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        coded.append((vec_id, label, "".join(f"{e:02x}" for _, e in found), error))
    totals = {}
    for _, label, _, error in coded:
        totals[label] = totals.get(label, 0) + error
    short = lambda n: n if n < 2**63 else None
    out = [(i, c, short(e), None if any(x[3] >= 2**63 for x in coded if x[1] == la) else short(totals[la]), digest) for i, la, c, e in coded]
    return sorted([*out, *[(i, None, None, None, digest) for i, v, _ in kept if len(v) != size]], key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


def test_nearest_entry_by_equal_averages():
    rng = np.random.default_rng(3)
    for spread in (2, 50, 5000):
        x, book = rng.integers(-spread, spread, (400, 5)), rng.integers(-spread, spread, (16, 5))
        book[7] = book[3]
        apart = ((x[:, None] - book[None]) ** 2).sum(2)
        for kind in (np.int64, object):
            entry, distance = vector_codes.nearest(x.astype(kind), book.astype(kind))
            assert (entry == apart.argmin(1)).all() and (distance == apart.min(1)).all()


def test_random_vectors(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(16)], rng.choice([1, 2, None])) for i in range(150)]
    assert rows_of(vector_codes.coded(table(spark, rows).repartition(3))) == by_brute_force(rows)


def test_ties_lengths_and_small_books(spark):
    rng = random.Random(4)
    rows = [(i // 2, [float(rng.randrange(-1, 2)) for _ in range(11)], 1) for i in range(60)]
    assert rows_of(vector_codes.coded(table(spark, rows))) == by_brute_force(rows)
    few = [(3, [1.0, -2.0], None), (3, [0.5, 0.25], None), (None, [0.0, 0.0], 4), (1, [-1.0, -1.00001], None)]
    assert rows_of(vector_codes.coded(table(spark, few), parts=2, entries=2)) == by_brute_force(few, 2, 2)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1), (5, [None, 1.0], 1), (6, [0.0, 0.0], None), (7, [1.0, 2.0], None),
        (7, [1.0, 2.0], None), (8, [3e38, -3e38], 2), (9, [1e20, -1e20], 2), (10, [1.0, 2.0, 3.0], 2), (11, [-0.0001, 0.0001], 5),
    ]
    assert rows_of(vector_codes.coded(table(spark, rows))) == by_brute_force(rows)
    assert rows_of(vector_codes.coded(table(spark, rows), entries=3)) == by_brute_force(rows, entries=3)
    assert vector_codes.coded(table(spark, [])).count() == 0
    assert vector_codes.coded(table(spark, [(1, None, 1)])).count() == 0


def test_clashing_columns(spark):
    rows = [(i, [float(i), float(-i)], "a", "x", 1) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<double>, label string, code string, error int")
    assert rows_of(vector_codes.coded(df)) == by_brute_force([(i, v, la) for i, v, la, _, _ in rows])
