import random

import pytest
from haulframe.llm import decontaminate
from haulframe.llm.decontaminate import folded, masks_of, nearest


def distance(pattern, text):
    """Least edits of the pattern against any part of the text, by the plain table."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        above, row = row, [0]
        for i, p in enumerate(pattern, start=1):
            row.append(min(above[i - 1] + (p != c), above[i] + 1, row[-1] + 1))
        best = min(best, row[-1])
    return best


def edited(text, edits, rng):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("abcdefg")
        elif kind == 1:
            out.insert(at, rng.choice("abcdefg"))
        else:
            del out[at]
    return "".join(out)


def test_bit_parallel_distance():
    rng = random.Random(4)
    for _ in range(200):
        pattern = "".join(rng.choice("abc ") for _ in range(rng.randint(12, 90)))
        text = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 120)))
        if rng.random() < 0.5:
            text += edited(pattern, rng.randint(0, 9), rng) + text[:20]
        edits, end = nearest(masks_of(pattern), len(pattern), text)
        assert edits == distance(pattern, text)
        assert distance(pattern, text[:end]) == edits


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id bigint, text string")


def test_quotations_against_brute_force(documents, items):
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz    "

    def text(n):
        return "".join(rng.choice(letters) for _ in range(n))

    bench = [(k, text(rng.randint(20, 200))) for k in range(12)]
    rows = []
    for k in range(60):
        item = rng.choice(bench)[1]
        inner = edited(item, rng.randint(0, len(item) // 9), rng) if k % 3 else ""
        rows.append((k, text(rng.randint(0, 80)) + " " + inner.upper() + " " + text(60)))
    want = set()
    for i, a in rows:
        for j, b in bench:
            b = folded(b)
            if distance(b, folded(a)) <= len(b) * decontaminate.PERCENT // 100:
                want.add((i, j))
    found = decontaminate.quoted(documents(rows), items(bench)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want
    for r in found:
        part = folded(dict(rows)[r.doc_id])[r.start : r.end]
        assert distance(folded(dict(bench)[r.item_id]), part) == r.edits
    assert {r.doc_id for r in decontaminate.clean(documents(rows), items(bench)).collect()} == {i for i, _ in rows} - {i for i, _ in want}


def test_odd_rows_and_blocks(documents, items, monkeypatch):
    item = "the quick brown fox jumps over the lazy dog near the river bank"
    rows = [(1, f"x {item} y"), (1, f"x {item} y"), (2, None), (3, ""), (None, item), (4, "!!!"), (5, item.replace(" ", "###\n").upper())]
    bench = [(1, item), (1, item), (2, None), (3, ""), (4, "?"), (None, item)]
    want = sorted(((i, j) for i in (1, 1, None, 5) for j in (1, 1, None)), key=str)
    for size in (decontaminate.BLOCK_CHARS, 40):
        monkeypatch.setattr(decontaminate, "BLOCK_CHARS", size)
        got = decontaminate.quoted(documents(rows), items(bench)).collect()
        assert sorted(((r.doc_id, r.item_id) for r in got), key=str) == want
    assert {r.doc_id for r in decontaminate.clean(documents(rows), items(bench)).collect()} == {2, 3, 4}
    assert decontaminate.quoted(documents([]), items(bench)).count() == 0
    assert decontaminate.quoted(documents(rows), items([])).count() == 0


def test_whole_tables_hold_every_exact_quotation(spark, sf_dir):
    from haulframe.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    want = {(d.doc_id, b.item_id) for d in docs for b in bench if d.text and folded(b.text) in folded(d.text)}
    got = {(r.doc_id, r.item_id): r for r in QUERIES["op6_decontaminate"](spark, sf_dir).collect()}
    assert want <= set(got) and {k for k, r in got.items() if r.edits == 0} == want


def test_adjacent_quotations_are_rows_of_their_own(documents, items):
    found = decontaminate.quoted(documents([(1, "ab " * 400), (2, "x " * 50 + "ab " * 85)]), items([(7, "ab " * 40)])).collect()
    by_doc = {i: sorted((r.start, r.end, r.edits) for r in found if r.doc_id == i) for i in (1, 2)}
    assert len(by_doc[1]) == 10 and all(r[2] <= 1 for r in by_doc[1])
    assert all(a[1] <= b[0] for rows in by_doc.values() for a, b in zip(rows, rows[1:], strict=False))
    assert [(r[0] // 100, r[2]) for r in by_doc[2]] == [(1, 0), (2, 0)]


def test_recall_of_edited_quotations(documents, items):
    """Every quotation within the budget is found, whatever its edits."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    bench = [(i, " ".join(rng.choice(words) for _ in range(30))) for i in range(20)]
    rows, want = [], set()
    for n in range(200):
        i, item = rng.choice(bench)
        edits = len(item) * (1 + n % 8) // 100
        inner = edited(item, edits, rng)
        rows.append((n, " ".join([rng.choice(words) for _ in range(20)] + [inner] + [rng.choice(words) for _ in range(20)])))
        want.add((n, i))
    got = {(r.doc_id, r.item_id) for r in decontaminate.quoted(documents(rows), items(bench)).collect()}
    missed = {(n, i) for n, i in want - got if distance(folded(bench[i][1]), folded(rows[n][1])) <= len(folded(bench[i][1])) * 8 // 100}
    assert not missed and len(want & got) >= 190
