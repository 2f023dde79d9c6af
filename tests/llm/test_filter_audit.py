from itertools import permutations

import pytest
from haulframe.llm import filter_audit


def by_brute_force(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for doc_id, text, source in docs:
        t = text or ""
        words, word = [], ""
        for ch in t + " ":
            if ch in " \t\n\x0b\x0c\r":
                words += [word] if word else []
                word = ""
            else:
                word += ch
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * sum("A" <= ch <= "Z" for ch in t) > 2 * len(t):
            fails.add("C")
        if any(ch in "#$%&*|" for ch in t):
            fails.add("D")
        if doc_id is not None and any(j is not None and j < doc_id and (u or "") == t for j, u, _ in docs):
            fails.add("E")
        rows.append((doc_id, source or "", fails))
    out = []
    for part in {p for _, p, _ in rows}:
        mine = [(i, f) for i, p, f in rows if p == part]
        made, sums = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [i for i, f in left if letter in f]
                redundant = sum(letter in f for _, f in mine) - len(gone)
                left = [(i, f) for i, f in left if letter not in f]
                sums[letter] += len(gone)
                unique = sum(f == {letter} for _, f in mine)
                made.append((letter, (part, "".join(order), step, len(left), len(gone), redundant, unique, sum(i in good for i in gone), sum(i in toxic for i in gone))))
        out += [(*row, sums[letter]) for letter, row in made]
    return sorted(out)


def rows_of(df):
    assert df.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return sorted(tuple(r) for r in df.collect())


LONG = " ".join(f"w{i}" for i in range(250))
DOCS = [
    (1, LONG, "a"), (2, LONG, "a"), (3, LONG, "b"), (3, LONG, "b"), (None, LONG, "a"), (4, None, "a"), (5, "", None), (6, "", ""), (7, "ABC", "b"),
    (8, "x " * 300, "b"), (9, "X " * 300 + "#", "b"), (10, LONG + " %", "a"), (11, "a b\x85c", "c"), (12, "\t\x0b\x0c\r\n ", "c"), (None, None, None),
    (13, LONG + " " + "Q" * 40, "a"), (14, "one|two " * 200, "a"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (7, 0, 1), (8, None, 1), (None, 1, 1), (10, 1, None), (99, 1, 1)]


def frames(spark, docs, labels):
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string, source string"),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )


def test_all_orders(spark):
    got = rows_of(filter_audit.audit(*frames(spark, DOCS, LABELS)))
    assert got == by_brute_force(DOCS, LABELS)
    assert len(got) == 4 * 600


@pytest.mark.parametrize("labels", [[], LABELS])
def test_empty_tables(spark, labels):
    assert rows_of(filter_audit.audit(*frames(spark, [], labels))) == []
    assert rows_of(filter_audit.audit(*frames(spark, DOCS[:4], []))) == by_brute_force(DOCS[:4], [])


def test_clashing_columns(spark):
    docs = spark.createDataFrame(
        [(i, t, s, "A", 1, True) for i, t, s in DOCS], "doc_id int, text string, source string, letter string, id int, good boolean"
    )
    labels = spark.createDataFrame([(*r, "x") for r in LABELS], "doc_id int, quality int, toxic int, part string")
    assert rows_of(filter_audit.audit(docs, labels)) == by_brute_force(DOCS, LABELS)


def test_other_filters(spark):
    from pyspark.sql import functions as F

    docs, labels = frames(spark, DOCS, LABELS)
    out = filter_audit.audit(docs, labels, {"S": F.length(F.coalesce("text", F.lit(""))) < 10})
    assert {r["filter_order"] for r in out.collect()} == {"ES", "SE"}


def test_labels_are_not_held_by_the_driver(spark, monkeypatch, folder):
    """Their file is small, but not sixteen copies of every row in memory."""
    joined, lookup = [], filter_audit.lookup
    monkeypatch.setattr(filter_audit, "lookup", lambda *a, **b: joined.append(lookup(*a, **b)) or joined[-1])
    docs, labels = frames(spark, DOCS, LABELS)
    labels.write.parquet(at := folder("labels"))
    assert rows_of(filter_audit.audit(docs, spark.read.parquet(at))) == by_brute_force(DOCS, LABELS)
    plan = joined[0]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
