import random

import numpy as np
import pyarrow as pa
from haulframe.llm import passages

rng = random.Random(11)
VOCABULARY = [f"w{k}" for k in range(3000)]


def words(n):
    return [rng.choice(VOCABULARY) for _ in range(n)]


def changed(text, every):
    return [rng.choice(VOCABULARY) if k % every == every - 1 else w for k, w in enumerate(text)]


def test_planted_passages(documents):
    shared, fuzzy, short = words(60), words(90), words(35)
    near = changed(fuzzy, 14)
    del near[40]
    rows = [
        (1, " ".join(words(80) + shared + words(50))),
        (2, " ".join(words(30) + fuzzy + words(20) + short)),
        (3, " ".join(w.upper() for w in words(10) + shared + words(200))),
        (4, "\n".join(short + words(40) + near)),
        (5, " ".join(words(300))),
        (6, " é ".join(shared)),
        (7, " ".join(words(5) + shared)),
    ]
    got = {(r.doc_id, r.other_id): r for r in passages.repeated_passages(documents(rows)).collect()}
    assert set(got) == {(3, 1), (4, 2), (7, 1)}
    texts = dict(rows)
    for (a, b), r in got.items():
        own, other = texts[a][r.start : r.end].lower().split(), texts[b][r.other_start : r.other_end].split()
        assert 50 <= len(own) == r.words and len(other) >= 50
    r = got[3, 1]
    assert texts[3][r.start : r.end].lower() == texts[1][r.other_start : r.other_end] == " ".join(shared)
    assert got[4, 2].words >= 85 and got[4, 2].same_words >= 80


def test_groups_of_copies_make_one_row_each(documents):
    text = " ".join(words(120))
    rows = [(k, text) for k in range(40)] + [(40, None), (41, ""), (None, text), (42, "few words only")]
    got = passages.repeated_passages(documents(rows)).collect()
    assert sorted((r.doc_id, r.other_id, r.words) for r in got) == [(k, 0, 120) for k in range(1, 40)]
    assert passages.repeated_passages(documents([])).count() == 0


def chain_score(chain):
    return len(chain) - sum(passages.GAP_COST * (u - x + v - y) for (x, y), (u, v) in zip(chain, chain[1:]))


def test_chains_against_quadratic_search():
    for seed in range(20):
        local = random.Random(seed)
        matches = {(local.randrange(200), local.randrange(200)) for _ in range(60)} | {(k, k + 7) for k in range(0, 100, 9)}
        ordered = sorted(matches)
        best = {}
        for u, v in ordered:
            before = [best[x, y] - passages.GAP_COST * (u - x + v - y) for x, y in ordered if x < u and y < v]
            best[u, v] = 1.0 + max([0.0, *before])
        found = passages.chained(list(matches))
        assert abs(chain_score(found[0]) - max(best.values())) < 1e-9
        assert sorted(m for c in found for m in c) == ordered


def test_minimizers_and_alignment():
    values = np.array([5, 3, 9, 3, 8, 7, 6, 5, 4, 9, 9, 1], np.uint64)
    want = sorted({i + int(np.argmin(values[i : i + 4])) for i in range(9)})
    assert passages.minimizers(values, 4).tolist() == want
    a, b = np.array([1, 2, 3, 4, 5, 6], np.uint64), np.array([1, 9, 3, 5, 6], np.uint64)
    assert passages._common(a, b) == 4


def test_whole_table_against_exact_runs(spark, sf_dir):
    """Every run of 60 words that two documents share lies in a reported passage of the later one."""
    from haulframe.llm.queries import QUERIES

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if r.text}
    found = QUERIES["op2_repeated_passages"](spark, sf_dir).collect()
    spans = {}
    for r in found:
        assert r.other_id < r.doc_id
        spans.setdefault(r.doc_id, []).append((r.start, r.end))
    first, lost = {}, 0
    for doc_id in sorted(docs):
        text, at, places = docs[doc_id], 0, []
        for w in text.split():
            at = text.index(w, at)
            places.append((at, at + len(w)))
            at += len(w)
        lowered = [text[a:b].lower() for a, b in places]
        mine = set()
        for k in range(len(places) - 59):
            run = hash(tuple(lowered[k : k + 60]))
            mine.add(run)
            if run in first and not any(s <= places[k][0] and places[k + 59][1] <= e for s, e in spans.get(doc_id, [])):
                lost += 1
        for run in mine:
            first.setdefault(run, doc_id)
    assert lost == 0


def test_seeds_of_earlier_parts_do_not_hide_the_whole(documents):
    """A passage of two parts, each of which stands alone in an earlier document, is found in the nearest holder."""
    one, two = words(30), words(30)
    rows = [(1, one), (2, two), (3, one + two), (4, one + two), (5, words(20) + one + two + words(9))]
    got = passages.repeated_passages(documents([(k, " ".join(w)) for k, w in rows])).collect()
    assert sorted((r.doc_id, r.words) for r in got) == [(4, 60), (5, 60)] and {r.other_id for r in got} <= {3, 4}


def test_passages_with_one_word_in_six_changed(documents):
    """Runs of five words between changed ones are enough, and so is one match."""
    rows = []
    for k in range(40):
        own = words(60)
        rows += [(2 * k, " ".join(words(30) + own + words(30))), (2 * k + 1, " ".join(words(50) + changed(own, 6) + words(10)))]
    got = {(r.doc_id, r.other_id) for r in passages.repeated_passages(documents(rows)).collect()}
    assert len(got) >= 38 and got <= {(2 * k + 1, 2 * k) for k in range(40)}


def test_passages_that_meet_share_no_words(documents):
    """Two passages side by side here and far apart there, the word after the first agreeing with that before the second."""
    one, two = words(70), words(60)
    rows = [(1, words(9) + one + two[:1] + words(150) + two + words(9)), (2, words(20) + one + two + words(20))]
    got = passages.repeated_passages(documents([(k, " ".join(w)) for k, w in rows])).collect()
    assert sorted((r.doc_id, r.other_id, r.words) for r in got) == [(2, 1, 59), (2, 1, 71)]
    rows = [(1, words(9) + one + two[:1] + words(150) + two[:50] + words(9)), (2, words(20) + one + two[:50] + words(20))]
    got = passages.repeated_passages(documents([(k, " ".join(w)) for k, w in rows])).collect()
    assert sorted((r.doc_id, r.other_id, r.words) for r in got) == [(2, 1, 50), (2, 1, 71)]


def test_holders_of_parts_do_not_hide_a_holder_of_the_whole(documents):
    """Both parts stand in earlier documents, first and nearest, while a third one holds the whole."""
    whole = words(80)
    rows = [(1, whole[:45]), (2, whole[35:]), (3, whole), (4, whole[:45]), (5, whole[35:]), (6, whole)]
    got = passages.repeated_passages(documents([(k, " ".join(w)) for k, w in rows])).collect()
    assert [(r.doc_id, r.other_id, r.words) for r in got] == [(6, 3, 80)]


def test_seeds_that_stand_elsewhere_too(documents):
    """The runs of a passage stand in another order before the passage itself."""
    own = words(70)
    parts = [own[k : k + 5] for k in range(0, 66)]
    rng.shuffle(parts)
    rows = [(1, [w for part in parts for w in part] + own), (2, words(20) + own + words(20))]
    got = passages.repeated_passages(documents([(k, " ".join(w)) for k, w in rows])).collect()
    assert [(r.doc_id, r.other_id, r.words) for r in got] == [(2, 1, 70)]


def test_matched_places_of_a_line_repeated_often():
    line = np.array([3, 1, 4, 1, 5, 9, 2, 6], np.uint64)
    many = np.tile(line, 400)
    found = passages.matched_places(many, many)
    assert len(found) <= 2 * len(many) and all(many[x] == many[y] for x, y in found)
    assert {x for x, y in found if x == y} == set(passages.seeds_of(many)[0].tolist())


def test_every_holder_of_a_changed_passage_is_tried(documents):
    """First and nearest holders of all its seeds hold parts only, and no run of 50 words is left; with few holders and with many."""
    for parts in (1, 7):
        whole = words(80)
        halves = [whole[:45], whole[35:]] * parts
        rows = list(enumerate([*halves, whole, *halves, words(9) + changed(whole, 14) + words(9)]))
        got = passages.repeated_passages(documents([(k, " ".join(w)) for k, w in rows])).collect()
        found = [(r.doc_id, r.other_id) for r in got if r.words > 70]
        assert found == [(4 * parts + 1, 2 * parts)]


def test_a_line_repeated_a_few_times_stays_on_one_diagonal(documents):
    line = words(12)
    rows = [(1, " ".join(line * 5)), (2, " ".join(line * 5))]
    got = passages.repeated_passages(documents(rows)).collect()
    assert [(r.doc_id, r.other_id, r.words) for r in got] == [(2, 1, 60)]


def test_texts_without_enough_words_in_common_are_not_matched(monkeypatch):
    import pyarrow as pa

    rng = random.Random(9)
    line = " ".join(f"s{k}" for k in range(12))
    texts = [" ".join(f"{name}{rng.random()}" for _ in range(80)) + " " + line for name in "ab"]
    batch = pa.RecordBatch.from_pydict({"doc_id": [2], "other_id": [1], "text": texts[:1], "other_text": texts[1:]})
    monkeypatch.setattr(passages, "_matches", lambda *_: (np.zeros(0, int), 1 / 0))
    (found,) = passages._verified(passages.SEED_WORDS, passages.MIN_WORDS, passages.PERCENT)(iter([batch]))
    assert found.num_rows == 0


def test_a_document_met_by_many_is_read_once(monkeypatch):
    text, other = " ".join(f"w{k}" for k in range(80)), " ".join(f"v{k}" for k in range(80))
    texts = [("a " + text, text), ("b " + text, text), (other, text), ("c " + other, other), ("d " + text, text)]
    rows = [(k, t, 10 + (o == other), o) for k, (t, o) in enumerate(texts)]
    batch = pa.RecordBatch.from_pylist([dict(zip(("doc_id", "text", "other_id", "other_text"), r, strict=True)) for r in rows])
    read, row_words = [], passages._row_words
    monkeypatch.setattr(passages, "_row_words", lambda x: read.append(len(x)) or row_words(x))
    (out,) = passages._verified(passages.SEED_WORDS, 50, 80)(iter([batch]))
    assert [(r["doc_id"], r["other_id"], r["first_word"], r["words"], r["same_words"]) for r in out.to_pylist()] == [
        (0, 10, 1, 80, 80), (1, 10, 1, 80, 80), (3, 11, 1, 80, 80), (4, 10, 1, 80, 80)
    ]
    assert read == [5, 3]


def test_straight_stretches_are_counted_as_gap_by_gap(monkeypatch):
    rng = random.Random(5)
    for _ in range(200):
        a = np.array([rng.randrange(1 << 40) for _ in range(120)], np.uint64)
        b = np.concatenate([a[:7], a]) if rng.random() < 0.3 else a.copy()
        for k in rng.sample(range(len(b)), rng.choice([0, 0, 1, 4])):
            b[k] += np.uint64(1)
        for chain in passages.chained(passages.matched_places(a, b))[:2]:
            for part in passages.unbroken(chain):
                got = passages.aligned(a, b, part, passages.SEED_WORDS)
                with monkeypatch.context() as m:
                    m.setattr(passages, "_straight", lambda *_: 0)
                    assert passages.aligned(a, b, part, passages.SEED_WORDS) == got
