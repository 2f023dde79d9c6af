"""Near-duplicate embeddings: all pairs over a cosine threshold, by cover trees and dual traversal.

Unit vectors at cosine c are sqrt(2 - 2c) apart, so the threshold is a distance. Every block of vectors
gets a cover tree: the radius halves from level to level, every point of a node lies within the
radius of one of the node's children, and each node keeps the radius it really needs. Two trees
are walked together; a pair of nodes is given up when their centres are further apart than both radii
and the threshold. What is left is compared exactly, in double precision.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulframe.llm.landed import landed
from haulframe.llm.links import components

THRESHOLD = 0.93
BLOCK_ROWS = 4096  # vectors of one tree; a label with more has several trees, and every two of them meet
LEAF_ROWS = 48
CENTRES = 64  # tried at a time while a level is laid out
SLACK = 1e-6  # for rounding in distances; it only keeps node pairs


class Node:
    """Points of a block below one centre."""

    __slots__ = ("centre", "radius", "rows", "children", "centres", "radii")

    def __init__(self, points: np.ndarray, rows: np.ndarray, centre: np.ndarray, level: float):
        self.centre, self.rows, self.children = centre, rows, []
        self.radius = float(np.sqrt(np.maximum(0.0, _squares(points[rows], centre[None])).max()))
        level = min(level, self.radius / 2)
        while len(rows) > LEAF_ROWS and level > 1e-3 and len(self.children) < 2:
            self.children = [Node(points, rows[part], points[rows[at]], level / 2) for at, part in _net(points[rows], level)]
            level /= 2
        if len(self.children) < 2:
            self.children = []
        self.centres = np.array([c.centre for c in self.children])
        self.radii = np.array([c.radius for c in self.children])


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2.0 * (a @ b.T)


def _net(points: np.ndarray, radius: float) -> list[tuple[int, np.ndarray]]:
    """Centres more than ``radius`` apart and the points of each, all within ``radius``."""
    left, out = np.arange(len(points)), []
    while len(left):
        tried = left[:CENTRES]
        near = _squares(points[tried], points[left]) <= radius * radius
        near[np.arange(len(tried)), np.arange(len(tried))] = True
        used = np.zeros(len(left), bool)
        for k in range(len(tried)):
            if used[k]:
                continue
            mine = near[k] & ~used
            used |= mine
            out.append((int(tried[k]), left[mine]))
        left = left[~used]
    return out


def leaf_pairs(a: Node, b: Node, limit: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row sets of two trees that cannot be told apart by their radii. Trees may be the same."""
    stack = [(a, b)]
    while stack:
        x, y = stack.pop()
        if not x.children and not y.children:
            yield x.rows, y.rows
            continue
        xs, xc, xr = (x.children, x.centres, x.radii) if x.children else ([x], x.centre[None], np.array([x.radius]))
        ys, yc, yr = (y.children, y.centres, y.radii) if y.children else ([y], y.centre[None], np.array([y.radius]))
        apart = np.sqrt(np.maximum(0.0, _squares(xc, yc)))
        keep = apart <= xr[:, None] + yr[None] + limit + SLACK
        if x is y:
            keep &= np.triu(np.ones_like(keep))
        stack.extend((xs[i], ys[j]) for i, j in zip(*np.nonzero(keep), strict=True))


def _block_links(threshold: float):
    """Per block pair: how many vectors each one links with, and links that connect what is linked."""
    limit = float(np.sqrt(max(0.0, 2.0 - 2.0 * threshold)))

    def run(group: pa.Table) -> pa.Table:
        node, copies, piece = (group[c].to_numpy() for c in ("node", "copies", "piece"))
        vectors = np.stack([np.frombuffer(x.as_buffer(), np.float64) for x in group["unit"]])
        p, q = group["p"][0].as_py(), group["q"][0].as_py()
        rows = [np.flatnonzero(piece == s) for s in ((p,) if p == q else (p, q))]
        trees = [Node(vectors, r, vectors[r[0]], 1.0) for r in rows if len(r)]
        counts = np.zeros(len(node), np.int64)
        root = np.arange(len(node))
        links = []
        for a, b in leaf_pairs(trees[0], trees[-1], limit) if len(trees) == len(rows) else ():
            near = vectors[a] @ vectors[b].T >= threshold
            if a is b:
                near = np.triu(near, 1)
            counts[a] += near @ copies[b]
            counts[b] += copies[a] @ near
            for i in np.flatnonzero(near.any(axis=1)):
                others = b[near[i]]
                for other in others[root[others] != root[a[i]]]:
                    if root[other] != root[a[i]]:
                        links.append((a[i], other))
                        root[root == root[other]] = root[a[i]]
        some = np.flatnonzero(counts)
        edges = np.array(links, np.int64).reshape(-1, 2)
        return pa.table(
            {
                "node": pa.array(np.concatenate([node[some], node[edges[:, 0]]])),
                "links": pa.array(np.concatenate([counts[some], np.zeros(len(edges), np.int64)])),
                "other": pa.array([None] * len(some) + list(node[edges[:, 1]]), pa.int64()),
            }
        )

    return run


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vector, its length and a digest of the vector; null where a vector cannot link."""
    for batch in batches:
        units, sizes, digests = [], [], []
        for value in batch.column("embedding").to_pylist():
            x = np.array([np.nan if v is None else v for v in value], np.float64) if value else np.zeros(0)
            norm = np.sqrt((x * x).sum()) if np.isfinite(x).all() else 0.0
            if norm > 0 and not np.isfinite(norm) or 0 < norm < 1e-150:
                x = x / np.abs(x).max()
                norm = np.sqrt((x * x).sum())
            good = len(x) > 0 and norm > 0
            units.append((x / norm).tobytes() if good else None)
            sizes.append(len(x))
            digests.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest() if good else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()), pa.array(units, pa.binary())],
            ["vec_id", "label", "size", "digest", "unit"],
        )


def near_vectors(embeddings: DataFrame, threshold: float = THRESHOLD, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per row of ``embeddings`` (``vec_id``, ``embedding``, ``label``): vec_id, n_links, component_id, kept.

    Vectors link when their labels are equal and their cosine reaches the threshold. Vectors that are
    null, empty, zero, of another length, or hold nulls or non-finite numbers link with nothing, and so
    do rows with a null label or vec_id (the latter have a null component and are kept). Equal vectors
    of a label are one point of the search with a number of copies. Rows with one vec_id are one node
    of the components. A label's points are dealt over blocks of ``block_rows``; every two blocks meet
    in a task that returns counts and connecting links, never all pairs.
    """
    rows = embeddings.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("bigint").alias("label")
    )
    rows = landed(
        rows.mapInArrow(_units, "vec_id bigint, label bigint, size int, digest binary, unit binary"), "units"
    )
    able = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND digest IS NOT NULL")
    key = ["label", "size", "digest"]
    points = landed(
        able.groupBy(*key).agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.first("unit").alias("unit")), "points"
    )
    # points are told apart by a number of their own: ids may repeat
    points = points.withColumn("node", F.xxhash64("label", "size", "digest"))
    labels = points.groupBy("label", "size").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("pieces"))
    placed = points.join(labels, ["label", "size"]).withColumn("piece", F.pmod(F.xxhash64("digest"), F.col("pieces")).cast("int"))
    placed = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    placed = placed.select(
        "node", "label", "size", "copies", "unit", "piece", F.least("piece", "with").alias("p"), F.greatest("piece", "with").alias("q")
    )
    found = landed(
        placed.groupBy("label", "size", "p", "q").applyInArrow(_block_links(threshold), "node bigint, links bigint, other bigint"), "found"
    )
    counts = found.where("other IS NULL").groupBy("node").agg(F.sum("links").alias("links"))
    named = points.select("node", "first")
    links = found.where("other IS NOT NULL").join(named.withColumnRenamed("first", "a"), "node")
    links = links.join(named.withColumnsRenamed({"node": "other", "first": "b"}), "other").select("a", "b")
    owned = able.select("vec_id", *key).join(points.select(*key, "first", "copies", "node"), key)
    own = owned.join(counts, "node", "left").select(
        "vec_id", "label", "size", "digest", "first", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    own = landed(own, "own")
    grouped = landed(components(links.unionByName(own.select(F.col("first").alias("a"), F.col("vec_id").alias("b")))), "groups")
    rest = rows.where("vec_id IS NULL OR label IS NULL OR digest IS NULL")
    every = own.select("vec_id", "n_links").unionByName(rest.select("vec_id", F.lit(0).cast("bigint").alias("n_links")))
    out = every.join(grouped.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id", "n_links", component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept")
    )
