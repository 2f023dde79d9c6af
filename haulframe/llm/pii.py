"""Personal data: four kinds of spans by fixed patterns, and more of them by a semi-Markov field.

The patterns give the base spans. A semi-Markov conditional random field then looks at the stretches
around digits, at-signs and their spelled-out forms: whole candidate segments are scored by features
of the complete span (groups of digits, separators, check digit, ends, neighbours), and dynamic
programming over segments of bounded length chooses boundaries and kinds together. It is trained on
base spans and on rewritten forms of them that the patterns do not match. Its spans are added where
they do not overlap a base span.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
TRAINING_STRETCHES = 400  # bound of the training sample
EPOCHS = 6
MOST_TOKENS = 26  # longest entity, in letter runs, digit runs and other characters
TRAINING_PER_TEXT = 20  # stretches of one text that may be in the training sample
TRAINING_CHARS = 1000  # longest stretch that may be in it

# Fixed patterns; possessive forms of the given ones, which match the same spans in linear time.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_TRIGGER = re.compile(r"[0-9@]|\(at\)|\[at\]|\bdot\b")
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\S\n]+|.", re.DOTALL)
_SIGN = re.compile(r" ?(?:@|\(at\)|\[at\]) ?| at ?|at ")
_POINT = re.compile(r" ?(?:\.|\(dot\)|\[dot\]) ?")
_LOCAL_PART = re.compile(r"[\w.%+-]+")
_LABEL = re.compile(r"[\w-]+")
_GLUED = re.compile(r"[\w-]dot[\w-]")


def spelled_address(span: str) -> bool:
    """An address with its signs as such, in brackets or as words: a local part, ``at``, and two labels or more.

    Read from left to right, once: bracketed signs first, then the words of what lies between them, of which
    ``dot`` may stand alone or at the end or beginning of another.
    """
    sign = _SIGN.search(span)
    if not sign or not _LOCAL_PART.fullmatch(span, 0, sign.start()):
        return False
    parts = _POINT.split(span[sign.end() :])
    points = len(parts) - 1
    for part in parts:
        words = part.split(" ")
        if not all(_LABEL.fullmatch(w) for w in words):
            return False
        label, i = words[0], 1
        points += any(_GLUED.search(w) for w in words)
        while i < len(words):
            if words[i] == "dot" and i + 1 < len(words):
                label, i = words[i + 1], i + 2
            elif words[i].startswith("dot") and len(words[i]) > 3:
                label, i = words[i][3:], i + 1
            elif label.endswith("dot") and len(label) > 3:
                label, i = words[i], i + 1
            else:
                return False
            points += 1
    return points > 0


def luhn(digits: str) -> bool:
    total = 0
    for at, c in enumerate(reversed(digits)):
        d = int(c) * (1 + at % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and (not part or int(part) <= 255)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, in order."""
    found = []
    if "@" in text:
        done = 0
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                found.append((start, 0, m.end()))
                done = m.end()
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(map(_byte, m.group().split("."))):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = _NOT_DIGIT.sub("", m.group())
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
    found.sort()
    return found


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of the text around triggers: as many tokens on either side as an entity may have, or to the line's end.

    Parts that meet are one. So an entity around a trigger lies whole in one part.
    """
    out: list[list[int]] = []
    first = _TRIGGER.search(text)
    while first:
        line = text.rfind("\n", 0, first.start()) + 1
        end = text.find("\n", first.start())
        end = len(text) if end < 0 else end
        at = [line, *(m.end() for m in _TOKEN.finditer(text, line, end))]
        for m in _TRIGGER.finditer(text, first.start(), end):
            i, j = bisect_right(at, m.start()) - 1, bisect_left(at, m.end())
            a, b = at[max(0, i - MOST_TOKENS)], at[min(len(at) - 1, j + MOST_TOKENS)]
            if out and a <= out[-1][1] and line <= out[-1][1]:
                out[-1][1] = max(b, out[-1][1])
            else:
                out.append([a, b])
        first = _TRIGGER.search(text, end)
    return [(a, b) for a, b in out]


def features(kind: int, span: str, left: str, right: str) -> list[str]:
    """Features of a whole span as one kind; empty if it cannot be of that kind."""
    digits = _NOT_DIGIT.sub("", span)
    out = ["b"]
    if kind == 0:
        if not spelled_address(span):
            return []
        out.append("sign" if "@" in span else "bracketed" if "at)" in span or "at]" in span else "spelled")
        out.append("dot" if re.search(r"\bdot\b", span) else "point")
        ending = re.search(r"[\w-]+$", span)
        out.append("letters" if ending and ending.group().isalpha() and 2 <= len(ending.group()) <= 6 else "odd ending")
        if " " in span and "sign" in out and "point" in out:
            out.append("gap")
    else:
        shape = re.sub(r"[0-9]+", lambda x: str(len(x.group())), span)
        marks = "".join(sorted(set(_DIGIT.sub("", span))))
        if kind == 1:
            parts = re.split(r" ?(?:\.|\[\.\]|\(\.\)) ?", span)
            if len(parts) != 4 or not all(p.isdigit() for p in parts):
                return []
            out += ["small" if all(map(_byte, parts)) else "large", "marks" + marks]
        elif kind == 2:
            if not 12 <= len(digits) <= 20 or not luhn(digits):
                return []
            out += ["n" + str(len(digits)), "marks" + marks]
            out.append("fours" if re.fullmatch(r"(4\D+){2,4}[1-4]", shape) else "plain" if not marks else "uneven")
        else:
            if not 7 <= len(digits) <= 15:
                return []
            opening = "plus" if span[0] == "+" else "area" if span[0] == "(" else "zeros" if span.startswith("00") else "bare"
            out += [opening, "n" + str(len(digits)), "marks" + marks, opening + "shape" + shape]
            if re.fullmatch(r"(19|20)[0-9]{2}([-./])[01]?[0-9]\2[0-3]?[0-9]|[0-3]?[0-9]([-./])[01]?[0-9]\3(19|20)[0-9]{2}", span):
                return []  # a date
            if span.count("(") != span.count(")"):
                out.append("half bracket")
    out.append("L" + ("alnum" if left.isalnum() else left if left in "+.-@_\"'(/=" else "other"))
    out.append("R" + ("alnum" if right.isalnum() else right if right in "-@_\"'/=" else "other"))
    return out


def candidates(text: str, tokens: list[str], at: list[int]) -> Iterator[list[tuple[int, int, list[str]]]]:
    """Per token of a stretch, the entities that could start there: (end token, kind, features)."""
    for i, first in enumerate(tokens):
        found_here: list[tuple[int, int, list[str]]] = []
        if not (first[0].isalnum() or first in "+("):
            yield found_here
            continue
        letters, digits = 0, 0
        for j in range(i, min(len(tokens), i + MOST_TOKENS)):
            t = tokens[j]
            if "\n" in t:
                break
            if t[0].isdigit():
                digits += len(t)
            elif t[0].isalpha():
                letters += 1
            if digits > 24:
                break
            if not t[0].isalnum():
                continue
            span = text[at[i] : at[j + 1]]
            left, right = text[at[i] - 1 : at[i]] if at[i] else "", text[at[j + 1] : at[j + 1] + 1]
            kinds = ()
            if letters == 0:
                kinds = (1, 2, 3) if digits >= 7 else (1,) if digits >= 4 else ()
                if kinds and any(c not in "0123456789 .-()+[]/" for c in span):
                    kinds = ()
            elif letters >= 2 and first[0].isalnum() and ("@" in span or "at" in span):
                kinds = (0,)
            for kind in kinds:
                found = features(kind, span, left, right)
                if found:
                    found_here.append((j + 1, kind, [f"{kind}{f}" for f in found]))
        yield found_here


def _plain(token: str) -> list[str]:
    return ["O", "Odigits" + str(min(len(token), 8))] if token[0].isdigit() else ["O"]


def _scores(text: str, weights: dict[str, float]):
    """Token bounds of a stretch, and per token the scored steps from it."""
    tokens = _TOKEN.findall(text)
    at = [0, *accumulate(map(len, tokens))]
    w = weights.get

    def steps():
        for i, starting in enumerate(candidates(text, tokens, at)):
            out = [(i + 1, -1, _plain(tokens[i])), *starting]
            yield [(j, k, f, sum(w(x, 0.0) for x in f)) for j, k, f in out]

    return at, steps()


def decoded(text: str, weights: dict[str, float]) -> list[tuple[int, int, int]]:
    """The best segmentation of a stretch: (start, kind, end) of its entities."""
    at, arcs = _scores(text, weights)
    n = len(at) - 1
    best = [-math.inf] * (n + 1)
    back: list = [None] * (n + 1)
    best[0] = 0.0
    for i, out in enumerate(arcs):
        for j, kind, _, score in out:
            if best[i] + score > best[j]:
                best[j], back[j] = best[i] + score, (i, kind)
    spans, j = [], n
    while j:
        i, kind = back[j]
        if kind >= 0:
            spans.append((at[i], kind, at[j]))
        j = i
    return spans[::-1]


def _gradient(text: str, gold: list[tuple[int, int, int]], weights: dict[str, float]) -> dict[str, float]:
    """Features of the gold segmentation less the expected ones."""
    at, steps = _scores(text, weights)
    arcs = list(steps)
    n, place = len(arcs), {a: i for i, a in enumerate(at)}
    low = -1e30

    def add(a: float, b: float) -> float:
        hi, lo = (a, b) if a > b else (b, a)
        return hi if lo <= low else hi + math.log1p(math.exp(lo - hi))

    ahead, behind = [low] * (n + 1), [low] * (n + 1)
    ahead[0] = behind[n] = 0.0
    for i, out in enumerate(arcs):
        for j, _, _, s in out:
            ahead[j] = add(ahead[j], ahead[i] + s)
    for i in range(n - 1, -1, -1):
        for j, _, _, s in arcs[i]:
            behind[i] = add(behind[i], behind[j] + s)
    change: dict[str, float] = {}
    for i, out in enumerate(arcs):
        for j, _, found, s in out:
            p = math.exp(min(0.0, ahead[i] + s + behind[j] - ahead[n]))
            if p > 1e-6:
                for f in found:
                    change[f] = change.get(f, 0.0) - p
    wanted = {(place.get(a), k): place.get(b) for a, k, b in gold}
    i = 0
    while i < n:
        arc = next((x for x in arcs[i] if x[1] >= 0 and wanted.get((i, x[1])) == x[0]), arcs[i][0])
        for f in arc[2]:
            change[f] = change.get(f, 0.0) + 1.0
        i = arc[0]
    return change


def rewritten(kind: int, span: str, choice: int) -> str:
    """A form of a base span that the patterns may not match."""
    if kind == 0:
        local, _, domain = span.partition("@")
        at = (" at ", " [at] ", "(at)", " (at) ", "@")[choice % 5]
        return local + at + domain.replace(".", (" dot ", "[dot]", ".")[choice // 5 % 3] if at != "@" else " dot ")
    if kind == 1:
        return span.replace(".", ("[.]", " . ", "(.)")[choice % 3])
    digits = _NOT_DIGIT.sub("", span)
    if kind == 2:
        mark = (".", "/", " - ")[choice % 3]
        return mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    own = digits[-10:]
    forms = ("({0}) {1}-{2}", "{0}-{1}-{2}", "{0}.{1}.{2}", "001 {0} {1} {2}", "{0} {1}-{2}")
    return forms[choice % 5].format(own[:3], own[3:6], own[6:])


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of a text with their base spans, as (text, spans)."""
    for batch in batches:
        texts, spans = [], []
        for text in batch.column("text").to_pylist():
            base = base_spans(text or "")
            for a, b in stretches(text or "")[:TRAINING_PER_TEXT]:
                if b - a > TRAINING_CHARS:
                    continue
                inside = [(s - a, k, e - a) for s, k, e in base if s >= a and e <= b]
                texts.append(text[a:b])
                spans.append(joined(inside))
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(spans, pa.string())], ["stretch", "spans"])


def trained(docs: DataFrame, most: int = TRAINING_STRETCHES, epochs: int = EPOCHS) -> dict[str, float]:
    """Weights of the field, from at most ``most`` stretches with base spans and as many without.

    The sample is bounded and picked by a hash of the stretch, of at most TRAINING_PER_TEXT stretches a text
    and TRAINING_CHARS characters a stretch; it does not grow with the corpus.
    Without any base span the field finds nothing.
    """
    slim = docs.select(F.col("text").cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))
    found = slim.mapInArrow(_examples, "stretch string, spans string").distinct()
    order = F.xxhash64("stretch")
    rows = []
    for part in (found.where("spans <> ''"), found.where("spans = ''")):
        rows += part.orderBy(order, "stretch").limit(most).collect()
    data = []
    for row in rows:
        gold = [(int(a), KINDS.index(k), int(b)) for k, a, b in (x.split(":") for x in row.spans.split(",") if x)]
        data.append((row.stretch, gold))
        if gold:
            text, moved, shift = row.stretch, [], 0
            choice = zlib.crc32(text.encode())
            for a, k, b in gold:
                if moved and a + shift < moved[-1][2]:
                    continue
                new = rewritten(k, row.stretch[a:b], choice)
                text = text[: a + shift] + new + text[b + shift :]
                moved.append((a + shift, k, a + shift + len(new)))
                shift += len(new) - (b - a)
            data.append((text, moved))
    if not any(gold for _, gold in data):
        return {}
    data.sort(key=lambda x: zlib.crc32(x[0].encode()))
    weights: dict[str, float] = {}
    sums: dict[str, float] = {}
    for epoch in range(epochs):
        rate = 0.5 / (1 + epoch)
        for text, gold in data:
            for f, g in _gradient(text, gold, weights).items():
                sums[f] = sums.get(f, 1.0) + g * g
                weights[f] = (weights.get(f, 0.0) + rate * g / math.sqrt(sums[f])) * 0.9999
    return weights


def spans_of(text: str, weights: dict[str, float]) -> tuple[list, list]:
    """Base spans, and all spans."""
    base = base_spans(text)
    if not weights:
        return base, base
    added = []
    for a, b in stretches(text):
        for s, k, e in decoded(text[a:b], weights):
            added.append((a + s, k, a + e))
    if not added:
        return base, base
    out, opening = list(base), [s for s, _, _ in base]
    reach = list(accumulate((e for _, _, e in base), max))
    for s, k, e in added:
        before = bisect_left(opening, e)
        if not before or reach[before - 1] <= s:
            out.append((s, k, e))
    return base, sorted(out)


def _found(weights: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[], [], [], []]
            digests, every = [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                base, spans = spans_of(text, weights) if _TRIGGER.search(text) else ([], [])
                for k in range(4):
                    counts[k].append(sum(x[1] == k for x in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                every.append(joined(spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests), pa.array(every, pa.string())],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
            )

    return run


def personal_data(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): doc_id, counts of base spans by kind, base_sha256, spans.

    Null texts count as empty; a text without spans has empty ``spans``. Repeated rows and null ids come
    back as they are; other columns are not read. ``spans`` is kind:start:end in code points, by start.
    """
    weights = trained(docs) if weights is None else weights
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(
        _found(weights),
        "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    )
