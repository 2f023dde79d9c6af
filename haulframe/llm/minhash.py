"""Near-duplicate documents by MinHash with tensored banding.

Two small collections of half keys are taken from each document, HALVES of WIDTH minhashes each. A
table key is a pair of half keys, one of each collection, so 2 x HALVES x WIDTH minhashes give
HALVES x HALVES tables of 2 x WIDTH minhashes. Two documents of similarity s meet in a table with
probability (1 - (1 - s^WIDTH)^HALVES)^2: 0.9996 at 0.8 and more above. Every pair that is tried is
confirmed on its full sets of shingles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulframe.llm.landed import columns_of, landed, numbered
from haulframe.llm.links import components
from haulframe.llm.words import distinct_shingles, mixed

HALVES = 12
WIDTH = 3
SEED = 20_240_229
SPLIT_BYTES = 2_000_000  # of 32-bit sets in one half of a block pair


def _signatures(size: int, seed: int):
    """Per row: number of distinct shingles, digest of the set, and the half keys of both collections."""
    functions = 2 * HALVES * WIDTH
    rng = np.random.default_rng(seed)
    factors = rng.integers(0, 1 << 63, functions, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 1 << 63, functions, dtype=np.uint64)

    def half_keys(shingles: np.ndarray) -> np.ndarray:
        lows = np.empty(functions, np.uint64)
        for at in range(functions):
            x = shingles * factors[at] + shifts[at]
            lows[at] = (x ^ (x >> np.uint64(32))).min()
        keys = np.zeros(2 * HALVES, np.uint64)
        for row in lows.reshape(2 * HALVES, WIDTH).T:
            keys = mixed(keys * np.uint64(31) + row + np.uint64(1))
        return keys.view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, left, right = [], [], [], []
            for shingles in distinct_shingles(batch.column("text"), size):
                counts.append(len(shingles))
                digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                keys = half_keys(shingles) if len(shingles) else np.zeros(0, np.int64)
                left.append(keys[:HALVES])
                right.append(keys[HALVES:])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(left, pa.list_(pa.int64())),
                    pa.array(right, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "digest", "left_keys", "right_keys"],
            )

    return run


def _confirm(size: int, percent: int):
    """Pairs whose full sets reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(
                distinct_shingles(batch.column("text_a"), size),
                distinct_shingles(batch.column("text_b"), size),
                strict=True,
            ):
                common = len(a) + len(b) - len(np.union1d(a, b))
                keep.append(100 * common >= percent * (len(a) + len(b) - common) and common > 0)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def confirmed_links(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` that are similar enough. Only texts of documents in a pair are moved."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = texts.join(wanted, "doc_id", "left_semi")
    both = pairs.join(texts.withColumnsRenamed({"doc_id": "a", "text": "text_a"}), "a")
    both = both.join(texts.withColumnsRenamed({"doc_id": "b", "text": "text_b"}), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_confirm(size, percent), "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, size: int = 4, percent: int = 80, seed: int = SEED) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): doc_id, n_shingles, component_id, kept.

    Documents with equal sets are one class, of which the smallest doc_id takes part in the search.
    Candidates are tried in three passes, each leaving out pairs already in one component: every
    document with the smallest member of all its buckets; with the smallest member of each bucket; and,
    block by block, what shares a bucket and is still apart. So a large group of near copies makes a few
    rows per member, and no pair of a bucket is left out unless its members are linked already.

    Null or empty texts, and texts of white space, have no shingles and stay alone. A null doc_id is
    returned with a null component and kept. Rows with one doc_id are one node of the graph: it is
    linked if any of its texts is. Other columns are not read.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = landed(
        slim.mapInArrow(
            _signatures(size, seed),
            "doc_id bigint, n_shingles bigint, digest binary, left_keys array<bigint>, right_keys array<bigint>",
        ),
        "signatures",
    )
    usable = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    # All rows of a class have the same keys, so any of them will do.
    classes = landed(
        usable.groupBy("n_shingles", "digest").agg(
            F.min("doc_id").alias("node"),
            F.first("left_keys").alias("left_keys"),
            F.first("right_keys").alias("right_keys"),
        ),
        "classes",
    )
    buckets = landed(_buckets(classes), "buckets")
    texts = slim.join(classes.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")

    first = buckets.groupBy("node").agg(F.min("pivot").alias("a")).where("a < node").select("a", F.col("node").alias("b"))
    links = landed(confirmed_links(first, texts, size, percent), "links")
    found = landed(components(links), "found")

    apart = _apart(buckets.where("pivot < node").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct(), found)
    more = landed(confirmed_links(apart.join(first, ["a", "b"], "left_anti"), texts, size, percent), "links")
    found = _joined(found, more)

    named = buckets.join(found, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("c"))
    mixed_up = named.groupBy("bucket").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high")
    apart = landed(named.join(mixed_up.select("bucket"), "bucket", "left_semi").select("node", "c").distinct(), "apart")
    rest = _links_in_blocks(apart, classes, texts, size, percent)
    found = _joined(found, landed(confirmed_links(rest, texts, size, percent), "links"))

    # A class is a link between its smallest doc_id and each of its rows; repeated doc_ids may join classes.
    owner = usable.join(classes.select("n_shingles", "digest", "node"), ["n_shingles", "digest"]).select("doc_id", "node")
    placed = owner.join(found, "node", "left").select("doc_id", F.coalesce("component", "node").alias("component"))
    crossing = placed.groupBy("doc_id").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count("*").alias("n"))
    crossing = landed(crossing, "placed")
    bridges = crossing.where("a < b").select("a", "b")
    # A doc_id on three or more components of its own needs every one of them on the bridge.
    many = placed.join(crossing.where("a < b").select("doc_id", "a"), "doc_id").select("a", F.col("component").alias("b"))
    if not bridges.isEmpty():
        joined = components(many.where("a <> b"))
        crossing = crossing.join(
            joined.withColumnsRenamed({"node": "a", "component": "wider"}), "a", "left"
        ).select("doc_id", F.coalesce("wider", "a").alias("a"))
    result = signed.select("doc_id", "n_shingles").join(crossing.select("doc_id", "a"), "doc_id", "left")
    component = F.coalesce("a", "doc_id")
    return result.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, size: int, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group of rows, the one with the smallest doc_id.

    Rows without doc_id, or with one that other rows have too, take part under numbers above all
    doc_ids, so each is judged by its own text and at most one row of a group stays. Texts without
    words are no copies of one another and stay. Columns come back as they are.
    """
    repeated = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    repeated = landed(repeated.select("doc_id"), "repeated-ids")
    highest = docs.agg(F.max(F.col("doc_id").cast("bigint"))).first()[0]
    own = docs.where("doc_id IS NOT NULL").join(repeated, "doc_id", "left_anti").select(columns_of(docs))
    others = docs.join(repeated, "doc_id", "left_semi").select(columns_of(docs))
    others, row = numbered(docs.where("doc_id IS NULL").unionByName(others), 0 if highest is None else highest + 1)
    nodes = own.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    nodes = nodes.unionByName(others.select(F.col(row).alias("doc_id"), "text"))
    kept = near_duplicates(nodes, size=size, percent=percent).where("kept").select("doc_id")
    kept = landed(kept, "kept").hint("merge")  # most ids of the input, which as a broadcast take many times their file
    rest = others.join(kept.withColumnRenamed("doc_id", row), row, "left_semi").select(columns_of(docs))
    return own.join(kept, "doc_id", "left_semi").select(columns_of(docs)).unionByName(rest)


def _buckets(classes: DataFrame) -> DataFrame:
    """``bucket``, ``node`` and ``pivot`` (the smallest node of the bucket) of all buckets with two nodes or more.

    A half key that no other class has can be in no such bucket, so table keys are made from shared half
    keys only. Both counts are aggregates, combined before their shuffle, and are written; the rows then
    meet them in joins that adaptive execution splits, so a half key or bucket held by a third of all
    classes is never one task.
    """
    one = ["node", "n_shingles", "digest"]  # rows of one doc_id may be several classes
    halves = classes.select(*one, F.posexplode(F.concat("left_keys", "right_keys")).alias("half", "x"))
    shared = halves.groupBy("half", "x").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    shared = landed(shared.where("low < high").select("half", "x"), "shared-halves")
    half = F.struct("half", "x")
    live = (
        halves.join(shared, ["half", "x"])
        .groupBy(*one)
        .agg(  # HALVES entries in either list at most
            F.collect_list(F.when(F.col("half") < HALVES, half)).alias("lefts"),
            F.collect_list(F.when(F.col("half") >= HALVES, half)).alias("rights"),
        )
        .where("size(lefts) > 0 AND size(rights) > 0")
    )
    live = landed(live, "live-halves")
    keyed = live.select("node", "rights", F.explode("lefts").alias("l")).select("node", "l", F.explode("rights").alias("r"))
    keyed = keyed.select("node", F.xxhash64("l.half", "l.x", "r.half", "r.x").alias("bucket"))
    ends = keyed.groupBy("bucket").agg(F.min("node").alias("pivot"), F.max("node").alias("top"))
    ends = landed(ends.where("pivot < top").select("bucket", "pivot"), "pivots")
    # never broadcast: Spark would take HALVES x HALVES rows of a class for a part of its row in the file
    return keyed.hint("merge").join(ends, "bucket").select("bucket", "node", "pivot")


def _short_sets(size: int):
    """Per document, its set with 32 bits per shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique((x >> np.uint64(32)).astype(np.uint32)).tobytes() for x in distinct_shingles(batch.column("text"), size)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], ["node", "short"])

    return run


def _block_links(percent: int):
    """Likely links between the documents of one pair of splits of one half key."""

    def run(group: pa.Table) -> pa.Table:
        node = group["node"].to_numpy()
        piece, counts = group["piece"].to_numpy(), group["n_shingles"].to_numpy()
        left = np.array(group["left_keys"].to_pylist(), np.int64)
        right = np.array(group["right_keys"].to_pylist(), np.int64)
        i, p, q = (group[c][0].as_py() for c in ("i", "p", "q"))
        component = np.unique(group["c"].to_numpy(), return_inverse=True)[1]
        sets = [np.frombuffer(x.as_py(), np.uint32) for x in group["short"]]
        at = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
        values, owner_value = np.unique(np.concatenate(sets), return_inverse=True)
        marked = np.zeros(len(values), bool)
        out_a, out_b = [], []
        for k in range(len(node)):
            near = (component != component[k]) & (100 * np.minimum(counts, counts[k]) >= percent * np.maximum(counts, counts[k]))
            near &= (piece == q) & (piece[k] == p) if p != q else np.arange(len(node)) > k
            near &= (right == right[k]).any(axis=1)
            # a pair that shares several left keys is looked at under the first of them
            near &= (left == left[k]).argmax(axis=1) == i
            if not near.any():
                continue
            mine = owner_value[at[k] : at[k + 1]]
            marked[mine] = True
            for other in np.flatnonzero(near):
                if component[other] == component[k]:
                    continue
                common = int(np.count_nonzero(marked[owner_value[at[other] : at[other + 1]]]))
                # short hashes only bring sets closer; what passes is confirmed on full sets
                if 100 * (common + 1) >= percent * (counts[k] + counts[other] - common - 1):
                    out_a.append(node[k])
                    out_b.append(node[other])
                    if 100 * common >= (percent + 1) * (counts[k] + counts[other] - common):
                        component[component == component[other]] = component[k]
            marked[mine] = False
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    return run


def _links_in_blocks(apart: DataFrame, classes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Likely links between documents that share a table and are in different components still.

    A half key of the left collection is cut into splits of about SPLIT_BYTES, and every two splits
    meet as one block pair. In there, all pairs that share a half key of either collection are compared
    on their sets; only links come out, so no list of pairs is ever made.
    """
    data = apart.join(classes.select("node", "n_shingles", "left_keys", "right_keys"), "node")
    spread = data.select("node", "c", "n_shingles", F.posexplode("left_keys").alias("i", "x"))
    keys = spread.groupBy("i", "x").agg(
        F.min("c").alias("low"), F.max("c").alias("high"), F.ceil(F.sum("n_shingles") * 4 / SPLIT_BYTES).cast("int").alias("splits")
    )
    keys = keys.where("low < high").select("i", "x", "splits")
    placed = spread.select("node", "i", "x").join(keys, ["i", "x"])
    placed = placed.withColumn("piece", F.pmod(F.xxhash64("node"), F.col("splits")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)))
    placed = placed.select("node", "i", "x", "piece", F.least("piece", "other").alias("p"), F.greatest("piece", "other").alias("q"))
    wanted = texts.join(apart.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
    short = wanted.mapInArrow(_short_sets(size), "node bigint, short binary")
    rows = placed.join(data, "node").join(short, "node")
    return rows.groupBy("i", "x", "p", "q").applyInArrow(_block_links(percent), "a bigint, b bigint").distinct()


def _joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components after further links; what is found already is not gone through link by link again."""
    if links.isEmpty():
        return found
    stars = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return landed(components(stars.unionByName(links)), "found")


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs whose members are not in one component yet."""
    a = found.withColumnsRenamed({"node": "a", "component": "ca"})
    b = found.withColumnsRenamed({"node": "b", "component": "cb"})
    named = pairs.join(a, "a", "left").join(b, "b", "left")
    return named.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
