import hashlib
import random
import re
from fractions import Fraction

import pytest
from haulframe.llm import mixing


def shares(children, budget):
    """Parts of a budget by weight under limits, by pouring: every round fills the open ones, to the limit at most."""
    got = dict.fromkeys(children, Fraction(0))
    left, still = Fraction(budget), set(children)
    while left > 0 and still:
        total = sum(children[c][1] for c in still)
        part = {c: left * children[c][1] / total for c in still}
        full = {c for c in still if got[c] + part[c] >= children[c][0]}
        if not full:
            for c in still:
                got[c] += part[c]
            break
        for c in full:
            left -= children[c][0] - got[c]
            got[c] = Fraction(children[c][0])
        still -= full
    return got


def poured(leaves, percent, epochs, weights):
    def weight(level, name):
        return weights[level].get(name, mixing.OTHER)

    def down(prefix, budget):
        depth = len(prefix)
        if depth == 3:
            return {prefix: budget}
        room = {}
        for leaf, tokens in leaves.items():
            if leaf[:depth] == prefix:
                room[leaf[depth]] = room.get(leaf[depth], 0) + tokens * epochs
        level = mixing.LEVELS[depth]
        out = {}
        for name, got in shares({c: (r, weight(level, c)) for c, r in room.items()}, budget).items():
            out |= down((*prefix, name), got)
        return out

    return down((), sum(leaves.values()) * percent // 100)


@pytest.mark.parametrize("seed, percent", [(1, 80), (2, 250), (3, 400), (4, 7), (5, 0)])
def test_budgets_against_pouring(spark, seed, percent):
    rng = random.Random(seed)
    leaves = {
        (d, g, s): rng.randrange(1, 10 ** rng.randrange(1, 7))
        for d in ("crawl", "curated", "community")
        for g in rng.sample(["en", "de", "fr", "xx"], 3)
        for s in rng.sample(["src1", "src12", "src3", "src4"], 2)
    }
    df = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "domain string, lang string, source string, tokens bigint")
    got = {r[:3]: r.got for r in mixing.budgets(df, percent, 4, mixing.WEIGHTS).collect()}
    want = poured(leaves, percent, 4, mixing.WEIGHTS)
    assert sum(got.values()) == sum(leaves.values()) * percent // 100
    # whole tokens are dealt at three levels; each level moves a share by less than one
    assert all(abs(got[k] - want[k]) < 4 for k in leaves) and all(got[k] <= 4 * leaves[k] for k in leaves)


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars int, epochs string, row int")


def test_prefix_of_a_seeded_epoch(spark):
    rows = [(i, "a b  c\td\n" * (i % 5), "en", "src1", 9, "own", i) for i in range(40)] + [(7, "x y z", "en", "src1", 5, "own", 1)] * 2
    docs = rows_of(spark, rows)
    got = mixing.drawn(docs, percent=150).collect()
    total = sum(len(r[1].split()) for r in rows)
    budget = total * 150 // 100

    def key(doc_id, text):
        return hashlib.md5(f"17:1:{doc_id}:{hashlib.md5(text.encode()).hexdigest()}".encode()).hexdigest()

    left, want = budget - total, {}
    for k in sorted({key(r[0], r[1]) for r in rows if r[1].strip()}):
        same = [r for r in rows if key(r[0], r[1]) == k]
        size = sum(len(r[1].split()) for r in same)
        want[k] = len(same[0][1].split()) if size <= left else max(0, left) // len(same)
        left -= size
    for r in got:
        assert r.n_tokens == len(r.row.text.split()) and r.epochs == (1 if r.n_tokens else 0)
        assert r.take == want.get(key(r.row.doc_id, r.row.text), 0)


def test_mixture_keeps_columns_and_cuts_one_text(spark):
    rows = [(i, f"w{i} " * (10 + i), "en", "src1", None, None, i) for i in range(30)]
    docs = rows_of(spark, rows)
    out = mixing.mixed(docs, percent=50)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    got = out.collect()
    total = sum(10 + i for i in range(30))
    assert sum(len(r.text.split()) for r in got) == total // 2
    cut = [r for r in got if len(r.text.split()) != 10 + r.doc_id]
    assert len(cut) <= 1 and all(r.n_chars == len(r.text) for r in cut)


def test_odd_rows(spark):
    rows = [(None, None, None, None, None, None, None), (1, "", "en", None, 0, "", 0), (2, "only words here", None, "src9", 1, "", 0)]
    got = {r.row.doc_id: (r.epochs, r.take) for r in mixing.drawn(rows_of(spark, rows), percent=100).collect()}
    assert got == {None: (0, 0), 1: (0, 0), 2: (1, 0)}
    assert mixing.drawn(rows_of(spark, [])).count() == 0 and mixing.mixed(rows_of(spark, [])).count() == 0


def test_native_only(spark, sf_dir):
    from haulframe.llm.queries import QUERIES

    for name in ("op1_mix_sources", "op3_url_filter"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
