"""Main text of web pages by template deduction.

A page is a sequence of tokens: containers, known by their role (the chain of containers around them with their
classes), and whole texts of containers, known by role and content. Over the pages of a host, tokens with the same
occurrence vector (how often on which page) form an equivalence class; classes on most pages are the host's template.
A class is used on a page only if it is ordered there, that is its tokens come in the order of the host's pages, once
or again and again. Classes nest: what lies between the tokens of one is a slot, and may hold others.

The slot with the most text, leaving out furniture (menus, adverts, comments, ...), is the host's main slot; a page's
text is what it has there, without

* containers whose whole text is a token of a template class. A sentence that many pages have in common stays where
  its container has other text too;
* records: a class nested in the slot that repeats on a page and has a fixed text in each turn, such as the "Reply"
  of reader comments, if no other text of the slot follows its records.

Article and main elements are slots of which nothing but furniture is left out, as their text is asked for as it is. A
page without the host's slot, or of a host without a template, is judged by its own roles alone. Texts that differ from
page to page can only be known as adverts or notices by the names that elements bear; a name counts if furniture is all
that it says (``ad-box``, not ``share-analysis``), and never on an article or main element.

Occurrence vectors are never built: a class is known by the sum of a hash of (page, count), which
Spark adds up in parts, so a host with any share of the pages is not gathered in one place.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulframe.llm.landed import landed
from haulframe.llm.url_templates import host_of

SALTS = 16
TEMPLATE_SHARE = 0.5  # of the host's pages that have a template role
ARTICLE_WEIGHT = 10  # an article or main element counts for so many plain ones

# Element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg math select title object canvas video audio".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td"
    " tfoot th thead title tr ul".split()
)
CONTAINER = frozenset("html body div article section main nav header footer aside form table ul ol dl td".split())
FURNITURE = frozenset("head nav header footer aside menu dialog button label fieldset select option".split())
CLOSES_P = BLOCK - {"br", "html", "body", "head", "option"}
#: Words of a class, id or role that mark furniture.
FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu"
    " breadcrumb breadcrumbs sidebar side footer header masthead topbar cookie cookies consent gdpr notice alert popup modal"
    " overlay newsletter subscribe signup login search comment comments disqus respond reply replies discussion related"
    " recommended share sharing social widget toolbar pagination pager complementary contentinfo skip".split()
)
#: Words that say nothing against furniture beside them.
NEUTRAL_WORDS = frozenset(
    "area article bar block blog body bottom box btn button buttons col column container content feed field first fixed form global"
    " group icons inner item items last left link links list main module outer page panel post primary right row secondary section"
    " site sticky tab text title top unit user view wrap wrapper zone".split()
)
PAGE = "page"  # stands for the page itself among tokens
TEXT = "text "  # begins the token of a container's whole text
_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_CLOSING = {name: re.compile(f"</{name}(?=[\\s/>])", re.IGNORECASE) for name in RAW}
_WORDS = re.compile(r"[a-z]+")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")


def marked_up(page: str) -> Iterator[tuple[str, str, str]]:
    """('text', '', text), ('open', name, attributes) and ('close', name, '') in page order."""
    at, size, quotes = 0, len(page), True
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            yield "text", "", page[at:]
            return
        if lt > at:
            yield "text", "", page[at:lt]
        following = page[lt + 1 : lt + 2]
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = size if end < 0 else end + 3
        elif following in ("!", "?"):
            end = page.find(">", lt)
            at = size if end < 0 else end + 1
        elif following == "/" or (following.isascii() and following.isalpha()):
            m = _TAG.match(page, lt) if quotes else None
            if m:
                close, name, attributes, at = m[1], m[2].lower(), m[3], m.end()
            else:
                quotes = False  # a quote is open to the end of the page; tags end at the next bracket from here on
                end = page.find(">", lt)
                if end < 0:
                    return
                inner = page[lt + 1 : end]
                close, at = ("/", end + 1) if inner.startswith("/") else ("", end + 1)
                name, _, attributes = inner.strip("/").partition(" ")
                name = name.lower()
            if close:
                yield "close", name, ""
            else:
                yield "open", name, attributes
                if name in RAW and not attributes.endswith("/"):
                    end_tag = _CLOSING[name].search(page, at)
                    at = size if end_tag is None else end_tag.start()
        else:
            yield "text", "", "<"
            at = lt + 1


def _attributes(text: str) -> list[str]:
    """The names in class, id and role, such as ``post-list``."""
    if "=" not in text:
        return []
    return [name for _, a, b, c in _ATTRIBUTE.findall(text) for name in _HUMP.sub("-", a or b or c).lower().split()]


def _says_furniture(names: list[str]) -> bool:
    """Whether a name says that its element is furniture, and nothing else."""
    for name in names:
        words = set(_WORDS.findall(name))
        if words & FURNITURE_WORDS and words <= FURNITURE_WORDS | NEUTRAL_WORDS:
            return True
    return False


def _digest(*parts: str) -> str:
    return hashlib.blake2b("\n".join(parts).encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()


@dataclass
class Page:
    """The containers of a page, each after the one around it, the page itself first; its text blocks without furniture."""

    parents: list[int] = field(default_factory=lambda: [0])
    roles: list[str] = field(default_factory=lambda: [""])
    outer: list[int] = field(default_factory=lambda: [-1])  # outermost article or main element around, or -1
    blocks: list[tuple[int, str]] = field(default_factory=list)  # container, text with single spaces

    def place(self, node: int) -> int:
        """The container whose slot a block is in: the outermost article around it, else its own."""
        return self.outer[node] if self.outer[node] >= 0 else node

    def inside(self, slot: str) -> list[bool]:
        """For each container, whether it lies in one with the role ``slot``."""
        out: list[bool] = []
        for node, role in enumerate(self.roles):
            out.append(role == slot or node > 0 and out[self.parents[node]])
        return out

    def whole_texts(self) -> dict[int, str]:
        """Tokens of the texts of containers outside of articles: a digest of the digests of what they hold."""
        held: list[list[str]] = [[] for _ in self.roles]
        articles = [False] * len(self.roles)
        own: list[list[tuple[int, str]]] = [[] for _ in self.roles]
        for node, text in self.blocks:
            if self.outer[node] >= 0:
                articles[self.outer[node]] = True
            else:
                own[node].append((0, text))
        out: dict[int, str] = {}
        for node in range(len(self.roles) - 1, 0, -1):
            parent = self.parents[node]
            if articles[node]:
                articles[parent] = True
            elif held[node] or own[node]:
                digest = _digest(self.roles[node], *(t for _, t in own[node]), "", *reversed(held[node]))
                out[node] = TEXT + digest
                held[parent].append(digest)
        return out


class _Open:
    """Open elements, with the places of those of each name, so that an end tag need not look for its start."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int, bool, int]] = []  # name, container, furniture, outermost form or -1
        self.places: dict[str, list[int]] = {}
        self.containers: list[int] = []

    def push(self, name: str, node: int, furniture: bool, form: int) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        if name in CONTAINER:
            self.containers.append(len(self.stack))
        self.stack.append((name, node, furniture, form))

    def pop(self) -> None:
        name = self.stack.pop()[0]
        self.places[name].pop()
        if name in CONTAINER:
            self.containers.pop()

    def top(self) -> tuple[str, int, bool, int]:
        return self.stack[-1] if self.stack else ("", 0, False, -1)

    def close(self, name: str) -> None:
        """End the last open element of this name and all inside; a paragraph is not looked for outside its container."""
        places = self.places.get(name)
        if places and not (name == "p" and self.containers and self.containers[-1] > places[-1]):
            at = places[-1]
            while len(self.stack) > at:
                self.pop()


def parsed(page: str) -> Page:
    """Containers and text blocks in page order.

    Missing end tags are made up as browsers do: a block ends an open paragraph, an item the item
    before, an end tag everything inside. An article or main element ends menus and headers left open.
    A form is furniture unless it is wrapped around an article, or around most text of a page that has none.
    """
    out = Page()
    found: list[tuple[int, bool, int, str]] = []
    opened = _Open()
    forms, holding, article_outside = 0, set(), False
    in_article = [False]  # of each container, whether an article element is around it
    parts: list[str] = []

    def flush() -> None:
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            parts.clear()
            if text:
                _, node, furniture, form = opened.top()
                found.append((node, furniture, form, text))

    for kind, name, value in marked_up(page):
        if kind == "text":
            parts.append(value)
            continue
        if name in BLOCK or name in RAW:
            flush()
        if kind == "close":
            if name not in VOID:
                opened.close(name)
            continue
        if name in CLOSES_P:
            opened.close("p")
        if name in ("li", "tr", "td", "th", "dt", "dd", "option") and opened.top()[0] == name:
            opened.pop()
        if name in ("article", "main"):
            while opened.top()[0] in ("nav", "header", "footer", "ul", "ol", "li", "a", "h1", "h2", "menu", "head"):
                opened.pop()
        if name == "body":
            opened.close("head")
        if name in VOID or value.endswith("/") and name not in BLOCK:
            continue
        _, node, furniture, form = opened.top()
        if name == "form" and form < 0:
            form, forms = forms, forms + 1
        names = _attributes(value) if name not in ("a", "b", "i", "em", "strong", "span", "p") else []
        if name in ("article", "main"):
            if form >= 0 and not furniture:
                holding.add(form)
            article_outside = article_outside or form < 0 and not furniture
        elif name not in ("html", "body"):
            furniture = furniture or _says_furniture(names)
        if name in RAW or name in FURNITURE and not (name == "header" and in_article[node]):
            furniture = True
        if name in CONTAINER:
            words = sorted(set(_WORDS.findall(" ".join(names))))
            out.parents.append(node)
            out.roles.append(_digest(out.roles[node], name, *words))
            here = len(out.roles) - 1
            out.outer.append(out.outer[node] if out.outer[node] >= 0 else here if name in ("article", "main") else -1)
            in_article.append(in_article[node] or name == "article")
            node = here
        opened.push(name, node, furniture, form)
    flush()
    mass: dict[int, int] = {}
    for _, furniture, form, text in found:
        if not furniture:
            mass[form] = mass.get(form, 0) + len(text)
    if not article_outside and not holding:
        holding = {form for form in mass if 2 * mass[form] > sum(mass.values())}
    out.blocks = [(node, text) for node, furniture, form, text in found if not furniture and (form < 0 or form in holding)]
    return out


def _weight(page: Page, node: int) -> int:
    return ARTICLE_WEIGHT if page.outer[node] >= 0 else 1


def _main_role(page: Page) -> str | None:
    """The role of a single page with the most text in it, deeper ones counting as their own."""
    mass: dict[str, int] = {}
    for node, text in page.blocks:
        role = page.roles[page.place(node)]
        mass[role] = mass.get(role, 0) + len(text) * _weight(page, node)
    return min(mass, key=lambda r: (-mass[r], r)) if mass else None


def _tokens(page: Page) -> list[tuple[str, int, int]]:
    """(token, place, weighted characters) of the containers around text, outside of articles, and of their whole texts.

    A token's place is twice the number of its container, and one more for texts.
    """
    chars: dict[int, int] = {}
    for node, text in page.blocks:
        place = page.place(node)
        chars[place] = chars.get(place, 0) + len(text) * _weight(page, node)
    for node in range(len(page.roles) - 1, 0, -1):
        if node in chars:
            chars.setdefault(page.parents[node], 0)
    out = [(page.roles[node], 2 * node, n) for node, n in chars.items()]
    return sorted(out + [(token, 2 * node + 1, 0) for node, token in page.whole_texts().items()], key=lambda t: t[1])


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, page, token, how often, first place, weighted characters) per page and token, and for the page."""
    for batch in batches:
        out: list[list] = [[], [], [], [], [], []]
        for host, page, text in zip(batch.column("host").to_pylist(), batch.column("page").to_pylist(), batch.column("html"), strict=True):
            text = text.as_py()
            if not text:
                continue
            seen: dict[str, list[int]] = {PAGE: [1, 0, 0]}
            for token, place, chars in _tokens(parsed(text)):
                own = seen.setdefault(token, [0, place, 0])
                own[0] += 1
                own[2] += chars
            for token, (count, place, chars) in seen.items():
                for column, value in zip(out, (host, page, token, count, place, chars), strict=True):
                    column.append(value)
        types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(out, types, strict=True)], ["host", "page", "token", "n", "first", "chars"]
        )


def _template(page: Page, classes: list[dict], inside: list[bool], slot: str) -> tuple[set[int], list[list[int]]]:
    """Containers of fixed text, and the outermost containers of records per nested class, strictly inside the slot.

    Classes that are out of order on the page, or whose turns do not lie in one slot each, are passed over.
    """
    of = {token: k for k, c in enumerate(classes) for token in c["tokens"]}
    turns: dict[int, list[tuple[str, int]]] = {}
    for token, place, _ in _tokens(page):
        if token in of:
            turns.setdefault(of[token], []).append((token, place // 2))
    fixed: set[int] = set()
    records: list[list[int]] = []
    for k, met in turns.items():
        order = classes[k]["tokens"]
        times = len(met) // len(order)
        if [token for token, _ in met] != order * times:
            continue
        nodes = [[node for _, node in met[i : i + len(order)]] for i in range(0, len(met), len(order))]
        if not classes[k]["repeated"]:
            fixed.update(node for token, node in met if token.startswith(TEXT))
            continue
        tops = [[n for n in dict.fromkeys(turn) if page.parents[n] not in set(turn)] for turn in nodes]
        nested = all(len({page.parents[n] for n in top}) == 1 for top in tops)
        if nested and all(inside[page.parents[n]] for top in tops for n in top):
            records.append([n for top in tops for n in top])
    return {n for n in fixed if inside[page.parents[n]]}, records


def _spread(page: Page, nodes: set[int]) -> list[bool]:
    """For each container, whether it is one of ``nodes`` or lies in one."""
    out: list[bool] = []
    for node in range(len(page.roles)):
        out.append(node in nodes or node > 0 and out[page.parents[node]])
    return out


def _slot_text(page: Page, slot: str, classes: list[dict]) -> str:
    inside = page.inside(slot)
    slotted = [(node, text) for node, text in page.blocks if inside[node]]
    known = {token for c in classes for token in c["tokens"] if token.startswith(TEXT)}
    # nothing is template in an article, nor on a copy of another page
    copy = known and any(page.roles[node] == slot and token in known for node, token in page.whole_texts().items())
    if not known or copy or all(page.outer[node] >= 0 for node, _ in slotted):
        return " ".join(text for _, text in slotted)
    fixed, records = _template(page, classes, inside, slot)
    gone = _spread(page, fixed)
    every = _spread(page, fixed.union(*records))
    free = [k for k, (node, _) in enumerate(slotted) if not every[node]]
    for tops in records:
        own = _spread(page, set(tops))
        begin = min((k for k, (node, _) in enumerate(slotted) if own[node]), default=0)
        if free and free[-1] < begin:
            gone = [a or b for a, b in zip(gone, own, strict=True)]
    left = [text for node, text in slotted if not gone[node]]
    return " ".join(left or [text for _, text in slotted])


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        classes = batch.column("classes")
        for row, (slot, page) in enumerate(zip(batch.column("slot").to_pylist(), batch.column("html"), strict=True)):
            found = parsed(page.as_py() or "")
            inside = found.inside(slot) if slot is not None else []
            if slot is None or not any(inside[node] for node, _ in found.blocks):
                slot = _main_role(found)
            texts.append(_slot_text(found, slot, classes[row].as_py() or []) if slot is not None else "")
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
        )


def main_slots(pages: DataFrame) -> DataFrame:
    """``host``, ``slot``, ``classes`` (template classes with fixed texts) of each host that has a template; needs host, page, html.

    A host's template tokens stand on half of its pages, so they are at most twice those of a page.
    """
    found = pages.mapInArrow(_occurrences, "host string, page bigint, token string, n bigint, first bigint, chars bigint")
    tokens = found.groupBy("host", "token").agg(
        F.count("*").alias("pages"),
        F.sum("chars").alias("chars"),
        F.sum("first").alias("place"),
        F.max("n").alias("most"),
        F.sum(F.xxhash64("page", "n").cast("decimal(38,0)")).alias("vector"),
    )
    tokens = landed(tokens, "tokens")
    sizes = tokens.where(F.col("token") == PAGE).select("host", F.col("pages").alias("all"))
    tokens = tokens.where(F.col("token") != PAGE)
    enough = tokens.join(sizes, "host").where(F.col("pages") >= F.col("all") * TEMPLATE_SHARE).where("all > 1")
    text = F.col("token").startswith(TEXT)
    slots = enough.where(~text).groupBy("host").agg(F.min_by("token", F.struct(-F.col("chars"), F.col("token"))).alias("slot"))
    classes = enough.where("pages > 1").groupBy("host", "vector", "pages").agg(
        F.array_sort(F.collect_list(F.struct("place", "token"))).alias("order"),
        (F.max("most") > 1).alias("repeated"),
        F.max(text).alias("fixed"),
    )
    classes = classes.where("fixed").groupBy("host").agg(
        F.collect_list(F.struct(F.col("order.token").alias("tokens"), "repeated")).alias("classes")
    )
    return slots.join(classes, "host", "left")


def main_texts(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` (``page_id``, ``url``, ``html``): page_id, url, text, n_chars (code points).

    Null, empty and textless pages give an empty text. A null url has the empty host. Repeated rows and
    null ids come back as they are; other columns are not read.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    rows = rows.withColumns(
        {
            "host": host_of(F.col("url")),
            "page": F.xxhash64("page_id", "url", F.length("html")),
            "salt": F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"),
        }
    )
    slots = landed(main_slots(rows.select("host", "page", "html")), "slots")
    slots = slots.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    placed = rows.drop("page").join(slots, ["host", "salt"], "left").select("page_id", "url", "html", "slot", "classes")
    out = placed.mapInArrow(_extracted, "page_id bigint, url string, text string")
    return out.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
