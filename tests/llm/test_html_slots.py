import html
import re

import pytest
from haulframe.llm import html_slots


def article_text(page):
    """The article of the given pages by plain replacing, for pages that have one and no furniture in it."""
    body = re.search(r"<article>(.*?)</article>", page, re.DOTALL)
    text = re.sub(r"</?(?:p|h1|br|li|ul|div)[^>]*>", " ", body[1]) if body else ""
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", text)).split())


def page(main, host="a.example.com", n=0):
    furniture = f"<header><h1>Site {n}</h1></header><nav><ul><li>one<li>two {n}</ul></nav>"
    return (n, f"http://{host}/{n}", f"<html><head><title>t</title><style>p{{}}</style></head><body>{furniture}{main}<footer>f</footer>")


@pytest.fixture
def texts(spark):
    def run(rows):
        df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
        return {r.page_id: r.text for r in html_slots.main_texts(df).collect()}

    return run


def test_furniture_is_left_out(texts):
    main = (
        '<div class="cookie-notice">We use cookies</div><article><h1>T&amp;T</h1><p>fir<b>st</b>\n one<br>x'
        '<div class="ad">buy</div><script>var a="</p>";</script><!-- no --><p>second &lt;b&gt;</p>'
        "<form><input><button>send</button></form><section class=comments><p>I agree</p></section></article>"
        '<aside>more</aside>'
    )
    assert texts([page(main, n=n) for n in range(3)]) == dict.fromkeys(range(3), "T&T first one x second <b>")


def test_host_template_finds_the_slot(texts):
    def main(n):
        return f"<div id=intro>short</div><div class=story><p>{'long text ' * 40}{n}</p><div><p>deeper {n}</p></div></div>"

    rows = [page(main(n), n=n) for n in range(5)] + [page("<div class=story><p>tiny</p></div><div id=intro>" + "x" * 600 + "</div>", n=9)]
    got = texts(rows)
    assert got[1] == " ".join(f"{'long text ' * 40}1 deeper 1".split()) and got[9] == "tiny"


def test_odd_pages(texts):
    rows = [
        (1, None, "<p>no url</p>"),
        (2, "http://x/", None),
        (3, "http://x/", ""),
        (4, "http://x/", "only text & more < 3"),
        (5, "http://x/", "<article>cut off <b>he"),
        (6, "http://x/", "<p title='never closed>" + "<a b=\"" * 50),
        (7, "no url", "<nav><ul><li>left open<article><p>still found</p></article>"),
        (8, "http://y/", "<!-- open comment <article>gone</article>"),
    ]
    got = texts(rows)
    assert got[1] == "no url" and got[2] == got[3] == got[8] == "" and got[4] == "only text & more < 3"
    assert got[5] == "cut off he" and got[7] == "still found"


def test_long_page_in_linear_time(texts):
    assert len(texts([(1, "http://x/", "<article>" + "<p>word <b>" * 100_000)])[1]) == 5 * 100_000 - 1


def test_repeated_rows_and_empty_table(spark):
    rows = [page("<article>same</article>", n=1)] * 3
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert [r.text for r in html_slots.main_texts(df).collect()] == ["same"] * 3
    assert html_slots.main_texts(df.where("page_id < 0")).count() == 0


def test_whole_table(spark, sf_dir):
    from haulframe.llm.queries import QUERIES

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = QUERIES["op9_main_text"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == article_text(pages[r.page_id]) and r.n_chars == len(r.text)


def test_template_text_inside_the_slot_is_left_out(texts):
    """Text that stands on most pages of a host goes, whatever its class is called; text of few pages stays."""

    def main(n):
        boxes = "<div class=xq7><p>Call us now</p></div><div class=zz>All rights kept</div>"
        return f"<div class=story><p>{'long text ' * 40}{n}</p>{boxes}<p>own end {n % 3}</p></div>"

    got = texts([page(main(n), n=n) for n in range(6)])
    assert got == {n: " ".join(f"{'long text ' * 40}{n} own end {n % 3}".split()) for n in range(6)}


@pytest.mark.parametrize("opening", ['<article class="post-share-analysis">', "<article id=comments role=search>"])
def test_names_never_mark_an_article(texts, opening):
    rows = [page(f"{opening}<p>story {n}</p></article>", n=n) for n in range(4)]
    assert texts(rows) == {n: f"story {n}" for n in range(4)}


def test_names_that_say_more_than_furniture(texts):
    inner = '<section id=related-work><p>earlier studies</p></section><div class="ad-box">buy</div><div class="shareButtons">tell</div>'
    assert texts([page(f"<article><p>story</p>{inner}</article>")]) == {0: "story earlier studies"}


def test_form_around_the_page(texts):
    def wrapped(inner, n):
        return n, f"http://f.example.com/{n}", f"<body><form id=aspnetForm><div class=menu>menu</div>{inner}<button>go</button></form></body>"

    assert texts([wrapped("<article>story</article>", 1)]) == {1: "story"}
    got = texts([wrapped(f"<div class=story><p>{'long text ' * 9}{n}</p></div>", n) for n in range(3)])
    assert got[2] == "long text " * 9 + "2"
    assert texts([page("<div class=story>the story of the day</div><form><div>your name</div></form>")]) == {0: "the story of the day"}


def test_deep_containers_are_told_apart(texts):
    def main(n):
        return "<div>" * 60 + f"<div class=story><p>{'long text ' * 9}{n}</p></div><div class=beside>{n} other</div>"

    assert texts([page(main(n), n=n) for n in range(3)])[1] == "long text " * 9 + "1"


def test_unmatched_end_tags_in_linear_time(texts):
    many = 50_000
    got = texts([(1, "http://x/", "<p><body>" + "<div>" * many + "</x>" * many + "<b>" * many + "</p>" * many + "<i>end")])
    assert got[1] == "end"


def test_a_common_sentence_stays_beside_other_text(texts):
    def main(n):
        return f"<div class=story><p>{'long text ' * 9}{n}</p><p>This is news.</p><div class=k2><p>All rights kept</p></div></div>"

    assert texts([page(main(n), n=n) for n in range(4)])[3] == "long text " * 9 + "3 This is news."


def test_nested_class_of_records_is_left_out(texts):
    """Turns of a class with a fixed text behind the story go, whatever they are called; turns that the story goes on behind stay."""

    def turn(n, k):
        return f"<div class=turn><div class=said>says {n} {k}</div><div class=act>Reply</div></div>"

    def main(n, after=""):
        return f"<div class=story><p>{'long text ' * 20}{n}</p>{''.join(turn(n, k) for k in range(1 + n % 3))}{after}</div>"

    got = texts([page(main(n), n=n) for n in range(6)])
    assert got == {n: "long text " * 20 + str(n) for n in range(6)}
    got = texts([page(main(n, f"<p>end {n}</p>"), n=n) for n in range(6)])
    assert got[0] == "long text " * 20 + "0 says 0 0 Reply end 0"


def test_class_out_of_order_is_no_template(texts):
    """Records whose turns are not in the order of the host's other pages are text."""

    def main(n):
        said, reply = f"<div class=said>says {n}</div>", "<div class=act>Reply</div>"
        turn = f"<div class=turn>{reply + said if n == 5 else said + reply}</div>"
        return f"<div class=story><p>{'long text ' * 20}{n}</p>{turn * (1 + n % 3)}</div>"

    got = texts([page(main(n), n=n) for n in range(6)])
    assert got[4] == "long text " * 20 + "4" and got[5] == "long text " * 20 + "5" + " Reply says 5" * 3


def test_copies_of_a_page_keep_their_text(texts):
    rows = [page("<div class=story><p>same text of both</p><div class=k>more of it</div></div>", n=n) for n in range(2)]
    assert set(texts(rows).values()) == {"same text of both more of it"}
