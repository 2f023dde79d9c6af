"""Vector codes: each part of a vector becomes the number of its nearest codebook entry.

Vectors are integers (components times SCALE, rounded down) and all arithmetic is exact. The nearest entry
is found by equal-average search: by Cauchy-Schwarz the squared distance of two parts of d components is at
least the squared gap of their component sums over d. So entries are put in order of their sums, the search
starts at the part's own sum and goes outward on both sides, and a side is given up once the squared gap over
d strictly exceeds the best distance; an entry as near as the best one is still seen, so ties go to the
lower number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulframe.llm.landed import landed
from haulframe.operators.joins import lookup

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
LARGEST = 3.5e38  # sizes of single precision; beyond it a component counts as not finite
SLICE_ROWS = 8192
LIMB = 10**20  # totals travel as two decimals
MOST_LONG = 2**63 - 1


def cuts(size: int, parts: int) -> list[int]:
    """Where the parts of a vector begin and end; parts are equal, up to one component where they cannot be."""
    return [i * size // parts for i in range(parts + 1)]


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest entry and its squared distance for every row; whole numbers, or Python ints of any size."""
    d = x.shape[1]
    sums = book.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    sums = sums[order]
    own = x.sum(axis=1)
    right = np.searchsorted(sums, own)
    left = right - 1
    found = np.full(len(x), -1, np.int64)
    best = np.zeros(len(x), x.dtype)
    at = np.arange(len(x))
    while len(at):
        below, above = left[at], right[at]
        gap_below = own[at] - sums[np.maximum(below, 0)]
        gap_above = sums[np.minimum(above, len(sums) - 1)] - own[at]
        bound = best[at] * d
        unset = found[at] < 0
        low = (below >= 0) & (unset | (gap_below * gap_below <= bound).astype(bool))
        high = (above < len(sums)) & (unset | (gap_above * gap_above <= bound).astype(bool))
        going = low | high
        take_low = (low & (~high | (gap_below <= gap_above).astype(bool)))[going]
        at, below, above = at[going], below[going], above[going]
        entry = order[np.where(take_low, below, above)]
        apart = x[at] - book[entry]
        distance = (apart * apart).sum(axis=1)
        better = (found[at] < 0) | (distance < best[at]).astype(bool)
        better |= (distance == best[at]).astype(bool) & (entry < found[at])
        found[at[better]], best[at[better]] = entry[better], distance[better]
        left[at[take_low]] -= 1
        right[at[~take_low]] += 1
    return found, best


def _whole(vectors: pa.Array, size: int, largest: int) -> np.ndarray:
    """Scaled components as whole numbers; Python ints where products of 64-bit ones could overflow."""
    flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE).reshape(-1, size)
    most = max(largest, int(np.abs(flat).max(initial=0.0)))
    if most * max(1, size) < 2**29:
        return flat.astype(np.int64)
    return np.array([[int(v) for v in row] for row in flat], object).reshape(flat.shape)


def _parts(batch: pa.RecordBatch, books: list[np.ndarray], size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """First row of a slice, part, its components, the nearest entries and distances, over a whole batch."""
    largest = max((abs(int(v)) for book in books for v in book.ravel()), default=0)
    at = cuts(size, len(books))
    for first in range(0, batch.num_rows, SLICE_ROWS):
        x = _whole(batch.column("embedding").slice(first, SLICE_ROWS), size, largest)
        for p, book in enumerate(books):
            part = x[:, at[p] : at[p + 1]]
            yield first, p, part, *nearest(part, book.astype(part.dtype))


def _totals(books: list[np.ndarray], size: int) -> Callable:
    """Per task and entry: how many parts chose it (place -1), and their sums by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b), object) for b in books]
        sums = [np.zeros(b.shape, object) for b in books]
        for batch in batches:
            for _, p, part, entry, _ in _parts(batch, books, size):
                for e in np.unique(entry):
                    mine = part[entry == e]
                    counts[p][e] += len(mine)
                    sums[p][e] += mine.sum(axis=0).astype(object)
        rows = []
        for p in range(len(books)):
            for e in np.flatnonzero(counts[p]):
                places = [(-1, counts[p][e]), *enumerate(sums[p][e])]
                rows += [(p, int(e), i, int(v) // LIMB, int(v) % LIMB) for i, v in places]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0), pa.decimal128(38, 0)]
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array([Decimal(v) for v in c] if i > 2 else list(c), k) for i, (c, k) in enumerate(zip(columns, kinds, strict=True))],
            ["part", "entry", "place", "high", "low"],
        )

    return run


def _coded(books: list[np.ndarray], size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.zeros((batch.num_rows, len(books)), np.uint8)
            errors = np.zeros(batch.num_rows, object)
            for first, p, _, entry, distance in _parts(batch, books, size):
                codes[first : first + len(entry), p] = entry
                errors[first : first + len(entry)] += distance.astype(object)
            texts = pa.array([row.tobytes().hex() for row in codes], pa.string())
            sizes = pa.array([int(e) if e <= MOST_LONG else None for e in errors], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), texts, sizes], ["vec_id", "label", "code", "error"])

    return run


def _usable(vector: str) -> Column:
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) <= LARGEST), F.lit(False)))


def fitted(rows: DataFrame, size: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks: the parts of the first vectors by id, then ``rounds`` of assignment and rounded-down means.

    ``rows`` holds vec_id and embedding, all of ``size`` usable components. Sums come back as one row per
    part, entry and place, so the driver sees as many numbers as the books hold.
    """
    firsts = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).collect()
    start = np.array([[int(np.floor(float(v) * SCALE)) for v in r["embedding"]] for r in firsts], object).reshape(len(firsts), size)
    at = cuts(size, parts)
    books = [start[:, at[p] : at[p + 1]].copy() for p in range(parts)]
    for _ in range(rounds if firsts else 0):
        sums = rows.mapInArrow(_totals(books, size), "part int, entry int, place int, high decimal(38,0), low decimal(38,0)")
        totals = sums.groupBy("part", "entry", "place").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
        total = {(r["part"], r["entry"], r["place"]): int(r["high"]) * LIMB + int(r["low"]) for r in totals}
        for (p, e, place), v in total.items():
            if place >= 0:
                books[p][e, place] = v // total[p, e, -1]
    return books


def books_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(v)) for book in books for v in book.ravel()).encode()).hexdigest()


def coded(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Per row of ``embeddings`` (``vec_id``, ``embedding``, ``label``): vec_id, code, error, label_error, codebooks_sha256.

    Rows whose vector is null or holds null or non-finite components are left out. The code gives two hex
    digits per part, ``error`` the squared distances to the chosen entries, ``label_error`` their sum over equal
    labels (nulls are one label). Vectors of another length than most have (ties: the longer) cannot share
    the books: their code and errors are null. Rows with one vec_id are rows of their own; a null id comes last
    where the first vectors are picked, equal ids by their vectors. With fewer vectors than entries, the
    books are shorter. Lengths that the parts do not divide give parts one component apart. Errors beyond a
    64-bit number are null. Every round reads the vectors again and sends back one total per task and place;
    nothing is kept between rounds but the books.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits per part")
    rows = embeddings.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").alias("label")
    ).where(_usable("embedding"))
    sizes = rows.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    size = sizes[0]["size"] if sizes else 0
    fitting = rows.where(F.size("embedding") == size)
    books = fitted(fitting.select("vec_id", "embedding"), size, parts, entries, rounds)
    kind = T.StructType([
        T.StructField("vec_id", T.LongType()), T.StructField("label", rows.schema["label"].dataType),
        T.StructField("code", T.StringType()), T.StructField("error", T.LongType()),
    ])
    codes = landed(fitting.mapInArrow(_coded(books, size), kind), "vector-codes")
    total = F.when(F.count("error") == F.count("*"), F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint"))
    labels = codes.groupBy("label").agg(total.alias("label_error"))
    digest = F.lit(books_digest(books)).alias("codebooks_sha256")
    out = lookup(codes, labels, ["label"], null_safe=True).select("vec_id", "code", "error", "label_error", digest)
    none = F.lit(None).cast("bigint")
    others = rows.where(F.size("embedding") != size)
    return out.unionByName(others.select("vec_id", F.lit(None).cast("string").alias("code"), none.alias("error"), none.alias("label_error"), digest))


def coded_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The rows of ``coded`` over ``embeddings`` whose vectors have one length that the parts divide."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""pieces AS MATERIALIZED (
  SELECT r, vec_id, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS x
  FROM kept, (SELECT unnest(range({parts})) AS p))""",
        f"""b0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c
  FROM pieces QUALIFY e < {entries})""",
    ]
    for k in range(rounds + 1):
        steps.append(
            f"""a{k} AS MATERIALIZED (
  SELECT r, p, any_value(x) AS x, min({entries} * list_sum(list_transform(list_zip(x, c), lambda t: (t[1] - t[2]) * (t[1] - t[2]))) + e) AS m
  FROM pieces JOIN b{k} USING (p) GROUP BY r, p)"""
        )
        if k < rounds:
            steps.append(
                f"""b{k + 1} AS MATERIALIZED (
  WITH s AS (SELECT p, m % {entries} AS e, i, sum(x[i]) AS s, count(*) AS n FROM a{k}, (SELECT unnest(range(1, 1 + (SELECT max(len(x)) FROM a{k}))) AS i) GROUP BY ALL),
  means AS (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM s GROUP BY p, e)
  SELECT b.p, b.e, coalesce(means.c, b.c) AS c FROM b{k} b LEFT JOIN means ON means.p = b.p AND means.e = b.e)"""
            )
    return (
        "WITH "
        + ",\n".join(steps)
        + f""",
codes AS (
  SELECT r, string_agg(printf('%02x', CAST(m % {entries} AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(m // {entries}) AS BIGINT) AS error
  FROM a{rounds} GROUP BY r),
books AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN codes USING (r), books"""
    )
