import numpy as np
from haulframe.llm import cover_tree


def by_brute_force(rows, threshold=0.93):
    usable = []
    for vec_id, values, label in rows:
        x = np.array([np.nan if v is None else v for v in values or []], float)
        ok = len(x) and np.isfinite(x).all() and x.any() and vec_id is not None and label is not None
        usable.append((vec_id, x / np.linalg.norm(x) if ok else None, label))
    root = {i: i for i, _, _ in usable if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    counts = [0] * len(rows)
    for n, (i, a, la) in enumerate(usable):
        for m, (j, b, lb) in enumerate(usable):
            if m != n and a is not None and b is not None and la == lb and len(a) == len(b) and a @ b >= threshold:
                counts[n] += 1
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return sorted(
        ((i, c, None if i is None else find(i), i is None or find(i) == i) for (i, _, _), c in zip(usable, counts, strict=True)), key=str
    )


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def clustered(seed=5, n=300, size=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, size))
    rows = []
    for k in range(n):
        x = centres[rng.integers(12)] + rng.normal(size=size) * rng.choice([0.05, 0.2, 0.35])
        rows.append((int(k), [float(np.float32(v)) for v in x], int(rng.integers(3))))
    return rows


def test_clusters_in_one_and_several_blocks(spark):
    rows = clustered()
    want = by_brute_force(rows)
    assert rows_of(cover_tree.near_vectors(table(spark, rows))) == want
    assert rows_of(cover_tree.near_vectors(table(spark, rows), block_rows=20)) == want


def test_odd_vectors(spark):
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 1), (3, [0.0, 1.0], 1), (4, [0.0, 3.0], 1), (5, None, 1), (6, [], 1),
        (7, [0.0, 0.0], 1), (8, [float("nan"), 1.0], 1), (9, [float("inf"), 1.0], 1), (10, [None, 1.0], 1), (11, [1.0, 0.0], None),
        (None, [1.0, 0.0], 1), (12, [1.0, 0.0], 2), (13, [1.0, 0.0, 0.0], 1), (13, [1.0, 0.0, 0.0], 1), (14, [-1.0, 0.0], 1),
    ]
    assert rows_of(cover_tree.near_vectors(table(spark, rows))) == by_brute_force(rows)
    assert cover_tree.near_vectors(table(spark, [])).count() == 0


def test_tree_covers_and_prunes_nothing_needed():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 6))
    x /= np.linalg.norm(x, axis=1)[:, None]
    tree = cover_tree.Node(x, np.arange(500), x[0], 1.0)

    def check(node):
        assert (np.linalg.norm(x[node.rows] - node.centre, axis=1) <= node.radius + 1e-6).all()
        if node.children:
            assert sorted(np.concatenate([c.rows for c in node.children])) == sorted(node.rows)
            for child in node.children:
                check(child)

    check(tree)
    met = np.zeros((500, 500), bool)
    for a, b in cover_tree.leaf_pairs(tree, tree, 0.3):
        met[np.ix_(a, b)] = met[np.ix_(b, a)] = True
    assert met[np.linalg.norm(x[:, None] - x[None], axis=2) <= 0.3].all() and not met.all()


def test_whole_table(spark, sf_dir):
    from haulframe.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert rows_of(QUERIES["op7_embedding_dedup"](spark, sf_dir)) == by_brute_force(rows)
