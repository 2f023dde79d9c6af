"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared as words: lower-cased, every run of other characters one space. A test item of n
characters may be quoted with up to PERCENT % of n edits (k). It is split into k + 1 pieces; k edits
leave at least one piece untouched, so every quotation holds an exact piece. Pieces are found with an
Aho-Corasick automaton, and the passage around a hit is verified with Myers' bit-parallel distance.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulframe.llm.landed import columns_of, numbered

PERCENT = 8
BLOCK_CHARS = 4_000_000  # test items are taken in blocks of about so many characters, one scan each

_GAP = re.compile(r"[\W_]+")
_prepared: dict[str, tuple] = {}


def folded(text: str) -> str:
    return _GAP.sub(" ", text.lower()).strip()


def pieces(item: str, percent: int) -> list[tuple[int, str]]:
    """Error budget plus one pieces, with their places in the item."""
    k = len(item) * percent // 100
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def distances(masks: dict[str, int], size: int, text: str, first: int = 0) -> Iterator[tuple[int, int]]:
    """(end, edit distance of the pattern to the nearest part of ``text`` from ``first`` that ends there), where it falls."""
    full, high = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score = full, 0, size
    for at in range(first + 1, len(text) + 1):
        c = text[at - 1]
        same = masks.get(c, 0)
        vertical = same | minus
        across = (((same & plus) + plus) ^ plus) | same
        up = minus | (full & ~(across | plus))
        down = plus & across
        if up & high:
            score += 1
        elif down & high:
            score -= 1
            yield at, score
        up <<= 1
        down <<= 1
        plus = (down | ~(vertical | up)) & full
        minus = up & vertical & full


def nearest(masks: dict[str, int], size: int, text: str) -> tuple[int, int]:
    """Smallest edit distance of the pattern to a part of ``text``, and where the first such part ends."""
    best, end = size, 0
    for at, score in distances(masks, size, text):
        if score < best:
            best, end = score, at
    return best, end


def one_by_one(masks: dict[str, int], size: int, text: str, most: int) -> Iterator[tuple[int, int, int]]:
    """(edits, end, end of the one before) of parts with at most ``most`` edits, from left to right, none in another.

    Of parts that end within one length of the pattern, the nearest is taken, then the search goes on behind it.
    """
    before = 0
    while True:
        best, end = most + 1, 0
        for at, score in distances(masks, size, text, before):
            if end and at > end + size:
                break
            if score < best:
                best, end = score, at
            if not best:
                break
        if not end:
            return
        yield best, end, before
        before = end


def masks_of(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def _automaton(items: list[tuple[int, str]], percent: int):
    import ahocorasick

    found: dict[str, list] = {}
    texts = {}
    for at, (_, text) in enumerate(items):
        text = folded(text)
        if not text:
            continue
        texts[at] = (text, masks_of(text), masks_of(text[::-1]))
        for offset, piece in pieces(text, percent):
            found.setdefault(piece, []).append((at, offset))
    automaton = ahocorasick.Automaton()
    for piece, places in found.items():
        automaton.add_word(piece, (len(piece), places))
    automaton.make_automaton()
    return automaton, texts


def quotations(text: str, automaton, texts: dict, percent: int) -> Iterator[tuple[int, int, int, int]]:
    """(item, edits, start, end) of the passages near an item, none in another of its; positions count in folded text."""
    if not len(automaton):
        return
    near: dict[int, list[int]] = {}
    for last, (length, places) in automaton.iter(text):
        for item, offset in places:
            near.setdefault(item, []).append(last + 1 - length - offset)
    for item, starts in near.items():
        pattern, masks, backward = texts[item]
        k = len(pattern) * percent // 100
        starts.sort()
        low = high = None
        for start in [*starts, None]:
            if start is not None and low is not None and start - high <= 2 * k:
                high = start
                continue
            if low is not None:
                left = max(0, low - k)
                part = text[left : high + len(pattern) + k]
                for edits, end, before in one_by_one(masks, len(pattern), part, k):
                    # the passage may open up to k characters earlier or later than it would without edits
                    _, back = nearest(backward, len(pattern), part[max(before, end - len(pattern) - k) : end][::-1])
                    yield item, edits, left + end - back, left + end
            low = high = start


def _search(block, percent: int):
    name = uuid.uuid4().hex  # a worker prepares a block once, however many tasks it runs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _prepared:
            _prepared.clear()
            _prepared[name] = _automaton(block.value, percent)
        automaton, texts = _prepared[name]
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py()
                if not text:
                    continue
                for item, edits, start, end in quotations(folded(text), automaton, texts, percent):
                    for column, value in zip(out, (doc_id, block.value[item][0], edits, start, end), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(out, [pa.int64(), pa.int64(), *[pa.int32()] * 3], strict=True)],
                ["doc_id", "item_id", "edits", "start", "end"],
            )

    return run


def quoted(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per passage of ``docs`` (``doc_id``, ``text``) that quotes an item (``item_id``, ``text``).

    Columns: doc_id, item_id, edits, start, end (characters of the folded text). Quotations of one item that
    follow one another are rows of their own. An item counts inside longer words too. Null, empty and
    wordless texts and items match nothing. Repeated rows on either side are rows of their own; a null
    doc_id or item_id is carried along. Other columns are not read. The documents are scanned once per
    block of items; a block is what the driver and the tasks hold, whatever the size of the benchmark.
    """
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("bigint"), F.col("text").cast("string")).where("text IS NOT NULL")
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = -(-chars // BLOCK_CHARS)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for at in range(max(1, blocks)):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks))) == at).collect()
        block = spark.sparkContext.broadcast([(r.item_id, r.text) for r in rows])
        hits = docs.mapInArrow(
            _search(block, percent), "doc_id bigint, item_id bigint, edits int, start int, end int"
        )
        found = hits if found is None else found.unionByName(hits)
    return found


def clean(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose doc_id quotes no item, and those without doc_id whose own text quotes none."""
    hit = quoted(docs, items, percent).select("doc_id").where("doc_id IS NOT NULL").distinct()
    named = docs.where("doc_id IS NOT NULL").join(hit, "doc_id", "left_anti").select(columns_of(docs))
    nameless, row = numbered(docs.where("doc_id IS NULL"))
    hit = quoted(nameless.select(F.col(row).alias("doc_id"), "text"), items, percent)
    hit = hit.select(F.col("doc_id").alias(row)).distinct()
    return named.unionByName(nameless.join(hit, row, "left_anti").select(columns_of(docs)))
