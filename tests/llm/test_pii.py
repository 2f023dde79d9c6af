import hashlib
import re
import time

from haulframe.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, span):
    digits = re.sub("[^0-9]", "", span)
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in span.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def plain_base(text):
    found = [
        (m.start(), n, m.end())
        for n, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text)
        if holds(kind, m.group())
    ]
    return sorted(found)


ODD = [
    "",
    "@a.b c@d.e.f. x@y z@1.2..3",
    "a@b.c@d.e",
    "1.2.3.4.5.6.7.8 999.1.1.1 1.2.3 007.08.09.10",
    "4111 1111 1111 1111 4111-1111-1111-1112  41111111111111114111",
    "+1 (017) 555-7713 +12 +1--------- +4 20 7946 0958 123+1 2",
    "é 1.1.1.1 ü a@b.cc +44 20 7946 0958",
    "9" * 3000 + " " + "1." * 500 + "a" * 3000 + "@" + "b." * 400,
]


def test_base_spans_are_those_of_the_patterns(spark, sf_dir):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    for text in ODD + texts:
        assert pii.base_spans(text or "") == plain_base(text or "")


def test_added_spans_and_odd_rows(spark, documents, sf_dir):
    weights = pii.trained(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    text = "é call (415) 555-0199 now, or mail john.smith [at] example dot com; see 10.0.0.1"
    rows = [(1, text), (1, text), (2, None), (3, ""), (None, "x")]
    got = pii.personal_data(documents(rows), weights).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == 5 and by_id[2].spans == by_id[3].spans == by_id[None].spans == ""
    spans = {(k, text[int(a) : int(b)]) for k, a, b in (x.split(":") for x in by_id[1].spans.split(","))}
    assert spans == {("phone", "(415) 555-0199"), ("email", "john.smith [at] example dot com"), ("ip", "10.0.0.1")}
    base = f"ip:{text.index('10.0.0.1')}:{len(text)}"
    assert by_id[1].base_sha256 == hashlib.sha256(base.encode()).hexdigest() and by_id[1].n_ip == 1 and by_id[1].n_phone == 0


def test_spelled_addresses():
    for good in ("a@b.c", "john.smith [at] example dot com", "a at b dot c", "a(at)b[dot]c", "a at bdot c", "a at b dotcom", "a at bdotc", "a @ b . c"):
        assert pii.spelled_address(good), good
    for bad in ("a@b", "at b dot c", "a at b c", "a at b dot", "a at dot", "johnatb", "a b@c.d", "a@b..c", "a at b  dot c"):
        assert not pii.spelled_address(bad), bad


def test_whole_addresses(spark, sf_dir):
    weights = pii.trained(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    for address in ("christopher.anderson at mailserver dot com", "anna (at) mail.department.university.example.edu"):
        text = f"please write to {address} before noon, or come by"
        assert [text[s:e] for s, _, e in pii.spans_of(text, weights)[1]] == [address]


def test_stretches_hold_whole_entities():
    text = "x " * 200 + "5" + " y" * 200 + "\nno\n" + "a@b\n7"
    parts = pii.stretches(text)
    assert [text[a:b] for a, b in parts] == ["x " * 13 + "5" + " y" * 13, "a@b", "7"]
    assert pii.stretches("") == pii.stretches("none") == []


def test_long_texts_take_linear_time():
    weights = {"O": 0.1, "0b": 0.2, "3b": 0.2}
    seconds = []
    for n in (4_000, 16_000):
        start = time.perf_counter()
        for unit in ("a@xdotxdotxdotxdotxdot1", "xdot1", "a@b.cc ", "a at bdot ", "1.2.3.4 ", "(at)", "+1 ( "):
            pii.spans_of(unit * (n // len(unit)), weights)
        pii.spans_of("a@" + "xdotxdotxdotxdotxdot1" * 40 + "x%b", weights)
        seconds.append(time.perf_counter() - start)
    assert seconds[1] < 8 * seconds[0] + 1


def test_clean_numbers_are_left_alone(spark, sf_dir):
    weights = pii.trained(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    for text in ("version 3.0.1", "the order 4111111111111112 is", "on 2024-05-01 at 12:30:45", 'token = "24be64439e3e49cf46b2d7c90f36"'):
        assert pii.spans_of(text, weights)[1] == []


def test_nothing_to_learn_from(documents):
    assert pii.trained(documents([])) == {}
    assert pii.personal_data(documents([(1, "no data")])).first().spans == ""
    assert pii.personal_data(documents([])).count() == 0


def test_whole_table(spark, sf_dir):
    from haulframe.llm.queries import QUERIES

    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op8_personal_data"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = plain_base(docs[r.doc_id])
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[1] == k for x in base) for k in range(4)]
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))
