import pytest
from haulframe.llm import url_templates
from haulframe.llm.queries import URL_RULES


@pytest.fixture
def judged(spark):
    def run(urls, rules=URL_RULES):
        df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
        return {r.page_id: r for r in url_templates.judged(df, rules).collect()}

    return run


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        ("http://a.example.org/x?y#z", "a.example.org", "/x", "org/", "allow"),
        ("HTTP://EXAMPLE.ORG/es/1", "example.org", "/es/1", "example.org/es/", "block"),
        ("http://example.org/en/17", "example.org", "/en/17", "example.org/en/1", "block"),
        ("http://m.example.org/en/2", "m.example.org", "/en/2", "org/", "allow"),
        ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
        ("x://y.com/fr/://org/", "y.com", "/fr/://org/", "com/fr/", "allow"),
        ("http://É.com/de/?a", "É.com", "/de/", "com/de/", "block"),
        ("http://example.org?q=/es/", "example.org", "", None, None),
        ("http://example.org#/es/", "example.org", "", None, None),
        ("http://com/fr", "com", "/fr", None, None),
        ("no scheme/org/", "", "", None, None),
        (None, "", "", None, None),
        ("", "", "", None, None),
        ("://", "", "", None, None),
        ("a://org\n/x", "org\n", "/x", None, None),
    ],
)
def test_hosts_paths_and_rules(judged, url, host, path, rule, verdict):
    row = judged([url])[0]
    assert (row.host, row.path, row.rule) == (host, path, rule)
    assert row.verdict in ("allow", "block") and (verdict is None or row.verdict == verdict)


RULES = [("allow", "h.net/good/1"), ("block", "h.net/bad/1")]


def test_templates_learn_from_labelled_pages(judged):
    urls = [f"http://h.net/{kind}/{n}/p{n * 7}" for kind in ("good", "bad") for n in range(100)]
    got = judged([*urls, "http://h.net/bad/zzz", "http://other.net/bad/5", *[None] * 20], RULES)
    by_url = {u: got[k] for k, u in enumerate(urls)}
    assert all(by_url[u].verdict == ("block" if "/bad/" in u else "allow") for u in urls)
    assert by_url["http://h.net/bad/5/p35"].template == "h.net/bad/*/*"
    assert got[200].verdict == "block" and got[200].template == "h.net/bad/*"
    assert got[201].verdict == "allow" and got[201].template == "other.net/*/*"


def test_alike_branches_are_merged(judged):
    urls = [f"http://h.net/{part}/{kind}/{n}" for part in ("a", "b") for kind in ("good", "bad") for n in range(30)]
    rules = [(v, f"h.net/{p}/{k}/1") for p in ("a", "b") for v, k in (("allow", "good"), ("block", "bad"))]
    got = judged(urls, rules)
    assert {r.template for r in got.values()} == {"h.net/*/good/*", "h.net/*/bad/*"}


def test_odd_tables(spark, judged):
    assert judged([]) == {}
    df = spark.createDataFrame([(None, "http://a.org/"), (1, "http://a.org/"), (1, "http://a.org/")], "page_id bigint, url string")
    assert url_templates.judged(df.selectExpr("*", "'x' AS template", "1 AS salt", "2 AS n"), URL_RULES).count() == 3
    deep = "http://h.net/" + "/".join("abcdefghij" * 300)
    assert judged([deep])[0].template.endswith("/**")


@pytest.mark.parametrize("blocked", [20, 99, 100])
def test_a_small_branch_stays_apart_whatever_its_share(judged, blocked):
    """Pages of a branch that differs never change the verdicts of its large siblings."""
    urls = [f"http://shop.com/en/{i}" for i in range(4750)] + [f"http://shop.com/fr/{i}" for i in range(150)]
    rows = judged(urls + [f"http://shop.com/de/{i}" for i in range(blocked)])
    assert {r.verdict for r in rows.values() if r.path.startswith("/en/")} == {"allow"}
    assert {r.verdict for r in rows.values() if r.path.startswith("/de/")} == {"block"}
