import random
import re

import pytest
from haulframe.llm import minhash
from haulframe.llm.links import components


def shingle_set(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def by_brute_force(rows, percent=80):
    sets = [(i, shingle_set(t)) for i, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if i is None or j is None or not a & b:
                continue
            if 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return sorted(
        ((i, len(s), None if i is None else find(i), i is None or find(i) == i) for i, s in sets), key=str
    )


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows, base = [], []
    for k in range(40):
        base.append([rng.choice(vocabulary) for _ in range(rng.randint(4, 120))])
        rows.append((len(rows), " ".join(base[-1])))
    for words in base[:12]:
        for _ in range(6):
            near = list(words)
            for _ in range(max(1, len(near) // 50)):
                near[rng.randrange(len(near))] = rng.choice(vocabulary)
            rows.append((len(rows), "\t".join(near).upper()))
    rng.shuffle(rows)
    return rows


def test_matches_brute_force(documents):
    rows = [*corpus(), (900, None), (901, ""), (902, " \n\t"), (903, "one two"), (904, "ONE  two"), (905, "one two three")]
    assert rows_of(minhash.near_duplicates(documents(rows))) == by_brute_force(rows)


def test_repeated_and_null_ids(documents):
    long = " ".join(f"x{k}" for k in range(60))
    other = " ".join(f"y{k}" for k in range(60))
    rows = [(5, long), (5, other), (7, long), (9, other), (9, other), (None, long), (3, "z z z z z")]
    assert rows_of(minhash.near_duplicates(documents(rows))) == by_brute_force(rows)


def test_buckets_are_those_of_all_pairs_of_half_keys(spark):
    """Few distinct half keys, one of them held by a third of the classes; two classes share a doc_id."""
    rng = random.Random(7)
    rows = [
        (min(k, 58), k, bytes([k]), *([0 if k % 3 == 0 else rng.randrange(90) for _ in range(minhash.HALVES)] for _ in "lr"))
        for k in range(60)
    ]
    held = {}
    for node, _, _, left, right in rows:
        for i, x in enumerate(left):
            for j, y in enumerate(right):
                held.setdefault((i, x, j, y), []).append(node)
    want = sorted((min(v), node) for v in held.values() if min(v) < max(v) for node in v)
    schema = "node bigint, n_shingles bigint, digest binary, left_keys array<bigint>, right_keys array<bigint>"
    got = minhash._buckets(spark.createDataFrame(rows, schema))
    assert sorted((r.pivot, r.node) for r in got.collect()) == want and len(want) > 400
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()


def test_empty_table(documents):
    assert minhash.near_duplicates(documents([])).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_links(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 130)]
    root = {x: x for pair in links for x in pair}
    for _ in range(200):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    want = sorted((x, root[x]) for x in {x for a, b in links if a != b for x in (a, b)})
    assert rows_of(components(spark.createDataFrame(links, "a bigint, b bigint"))) == sorted(want, key=str)


def test_whole_tables(spark, sf_dir):
    from haulframe.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(QUERIES["op10_minhash_dedup"](spark, sf_dir)) == by_brute_force([tuple(r) for r in docs])


def test_settled_links_are_checked_in_one_step(spark, monkeypatch):
    links = spark.createDataFrame([(2, 1), (3, 1)], "a bigint, b bigint")
    checks, is_empty = [], type(links).isEmpty
    monkeypatch.setattr(type(links), "isEmpty", lambda df: checks.append(df) or is_empty(df))
    assert sorted(tuple(r) for r in components(links).collect()) == [(1, 1), (2, 1), (3, 1)]
    assert len(checks) == 1


def _joins(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_table_keys_are_not_held_by_the_driver(spark):
    """They are many rows of a small file."""
    rng = random.Random(3)
    rows = [(k, k, bytes([k]), *([rng.randrange(9) for _ in range(minhash.HALVES)] for _ in "lr")) for k in range(60)]
    schema = "node bigint, n_shingles bigint, digest binary, left_keys array<bigint>, right_keys array<bigint>"
    by_size = minhash._buckets(spark.createDataFrame(rows, schema))
    assert "SortMergeJoin" in _joins(by_size) and "Broadcast" not in _joins(by_size)
    assert not by_size.isEmpty()


def test_kept_ids_are_not_held_by_the_driver(spark):
    text = " ".join(f"x{k}" for k in range(60))
    docs = spark.createDataFrame([(1, text), (2, text), (3, "a b c d e f"), (None, text), (4, None)], "doc_id bigint, text string")
    out = minhash.one_of_each(docs, size=5)
    assert _joins(out).count("SortMergeJoin") >= 2
    assert sorted((r.doc_id for r in out.collect()), key=str) == [1, 3, 4]
