import random
import zlib

import pytest
from haulframe.llm import toxicity

rng = random.Random(6)
PLAIN = [f"{a}{b}{c}" for a in "bdfglmnprst" for b in "aeiou" for c in ("n", "r", "st", "ld")]


def sentence(n, *extra):
    words = [rng.choice(PLAIN) for _ in range(n)]
    for w in extra:
        words.insert(rng.randrange(len(words) + 1), w)
    return " ".join(words)


@pytest.fixture(scope="module")
def model(spark):
    rows, labels = [], []
    for k in range(900):
        bad = k % 6 == 0
        text = sentence(60, *rng.sample(["vilefool", "dirtclod", "slimeball"], 2)) if bad else sentence(60)
        if k % 6 == 1:
            text += " the vilefool award"
        rows.append((k, text))
        labels.append((k, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return toxicity.fitted(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))


def scores(spark, model, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r.doc_id: r for r in toxicity.scored(df, model).collect()}


def test_folding():
    assert toxicity.folded("V1LEFO0L ѕl!m3bаll dırt​clod") == "vilefool slimeball dirtclod"
    assert toxicity.folded("in 1999, 3 of 4! ÉTÉ") == "in 1999, 3 of 4! ete"


def test_words_disguises_and_exceptions(spark, model):
    assert {"dirtclod", "slimeball"} <= set(model.weights) and "award" not in model.weights
    texts = [
        sentence(50, "dirtclod", "slimeball"),
        sentence(50, "D1RTCL0D", "ѕlimeball"),
        sentence(50),
        sentence(50, "dirtclods", "undirtclod"),
        sentence(50, "vilefool award", "the vilefool"),
        "",
        None,
    ]
    got = scores(spark, model, texts)
    assert [got[k].predicted for k in range(7)] == [1, 1, 0, 0, 0, 0, 0]
    assert got[5].score == got[6].score == min(r.score for r in got.values()) and got[3].matches == 0
    assert any("vilefool" in phrase for phrase in model.exceptions) and got[4].matches < 2


def test_length_normalises(spark, model):
    got = scores(spark, model, [sentence(20, "dirtclod"), sentence(5000, "dirtclod")])
    assert got[0].score > got[1].score


def test_held_out_rows_and_odd_tables(spark, model):
    df = spark.createDataFrame([(k, "x") for k in range(50)] + [(None, "x"), (3, "x")], "doc_id bigint, text string")
    rows = toxicity.scored(df, model).collect()
    assert len(rows) == 52
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    nothing = spark.createDataFrame([], "doc_id bigint, toxic int")
    empty = toxicity.fitted(df, nothing)
    assert empty.weights == {} and {r.predicted for r in toxicity.scored(df, empty).collect()} == {0}
    odd = spark.createDataFrame([(None, 1), (1, None), (2, 1), (2, 0), (2, 1)], "doc_id bigint, toxic int")
    assert toxicity.acceptable(df, odd).count() == 52
    assert toxicity.scored(df.where("doc_id < 0"), model).count() == 0


def test_toxic_rows_go_whatever_their_id(spark):
    """Rows without id, and rows that share one, are judged by their own text; columns come back as they are."""
    rows = [(k, sentence(60, "dirtclod", "slimeball") if k % 6 == 0 else sentence(60)) for k in range(600)]
    labels = spark.createDataFrame([(k, int(k % 6 == 0)) for k in range(600)], "doc_id bigint, toxic int")
    odd = [(None, rows[6][1]), (None, rows[7][1]), (7, rows[12][1]), (8, rows[8][1]), (None, None)]
    docs = spark.createDataFrame(rows + odd, "doc_id bigint, text string").selectExpr("*", "1 AS score", "'x' AS `a.b`")
    kept = toxicity.acceptable(docs, labels)
    want = [r for r in rows if r[0] % 6] + [odd[1], odd[3], odd[4]]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)
    assert kept.dtypes == docs.dtypes


def test_copies_do_not_make_lexicon_words(spark):
    passage = sentence(40)
    rows = [(k, sentence(20) + " " + passage) for k in range(200)] + [(200 + k, sentence(60)) for k in range(600)]
    labels = spark.createDataFrame([(k, int(k < 200)) for k in range(800)], "doc_id bigint, toxic int")
    model = toxicity.fitted(spark.createDataFrame(rows, "doc_id bigint, text string"), labels)
    assert len(model.weights) <= 2


def test_held_out_accuracy(spark, sf_dir):
    from haulframe.llm.queries import QUERIES

    folder = sf_dir.replace("sf0.001", "sf0.1")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op4_toxicity"](spark, folder).collect() if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in rows)
    toxic = [r for r in rows if labels[r.doc_id]]
    assert right >= 0.97 * len(rows) and sum(r.predicted for r in toxic) >= 0.9 * len(toxic)


def plain_measure(text, model):
    """Total weight and number of words that stand free and in no exception, every word against every phrase."""
    text = toxicity.folded(text)

    def places(word):
        out, at = [], text.find(word)
        while at >= 0:
            end = at + len(word)
            if not (at and text[at - 1].isalnum()) and not (end < len(text) and text[end].isalnum()):
                out.append((at, end))
            at = text.find(word, at + 1)
        return out

    excused = [p for phrase in model.exceptions for p in places(phrase)]
    hits = [(p, w) for word, w in model.weights.items() for p in places(word) if not any(a <= p[0] and p[1] <= b for a, b in excused)]
    return sum(w for _, w in hits), len(hits)


def test_matches_and_exceptions_against_brute_force():

    import numpy as np

    rng = random.Random(12)
    model = toxicity.Model({"bad": 1.0, "worse": 2.5, "not": 0.5, "a": 0.25}, ["not bad", "bad a", "a worse not", "not bad at"])
    automaton = model.automaton()
    for _ in range(300):
        text = " ".join(rng.choice(["bad", "worse", "not", "a", "at", "badly", "fine", "bad."]) for _ in range(rng.randrange(30)))
        total, count = plain_measure(text, model)
        got = toxicity.measures(text, automaton)
        assert got[2] == count and (not count or abs(got[0] - float(np.log1p(total))) < 1e-9)


def test_many_matches_take_linear_time():
    import time

    automaton = toxicity.Model({"bad": 1.0}, ["not bad"]).automaton()
    start = time.perf_counter()
    assert toxicity.measures("bad not bad " * 90_000, automaton)[2] == 90_000
    assert time.perf_counter() - start < 10
