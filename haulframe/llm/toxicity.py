"""Toxicity by a weighted lexicon.

Texts are folded first: lower case, look-alike letters and digits that stand for letters replaced,
marks and invisible characters dropped. The lexicon and its weights, exception phrases and the two
numbers that turn matches into a probability are learned from labelled documents. Matching is one
Aho-Corasick pass; a match counts only as a whole word and outside an exception phrase; the sum of
weights is normalised by the number of words.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulframe.llm.landed import landed
from haulframe.llm.words import distinct_shingles, slices

SAMPLE_ROWS = 20_000  # labelled rows that the model is fitted on, about; all of them if there are fewer
SUPPORT = 0.01  # share of the toxic texts that hold a lexicon word; each language has words of its own
PURITY = 0.5  # toxic share of the texts that hold it
CERTAINTY = 3.2  # standard errors that the log odds of a word lie above zero
LEXICON_WORDS = 5_000
EXCEPTION_TEXTS = 10  # clean texts that hold an exception phrase, at least
CUT = 0.5

# Letters that look like Latin ones, and characters that stand for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l",
    "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ѵ": "v", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ł": "l", "ø": "o", "đ": "d", "ħ": "h",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l"}
INVISIBLE = "­​‌‍⁠﻿"

_LETTERS = str.maketrans(HOMOGLYPHS | dict.fromkeys(INVISIBLE))
#: A digit or sign counts as a letter only beside a letter, so that numbers and sentence marks stay.
_STANDS = re.compile(r"(?<=[a-z])[01345789@$|]+(?=[a-z])|(?<![\w@$])[01345789@$]+(?=[a-z])|(?<=[a-z])[01345789$]+(?![\w])|(?<=[a-z])!(?=[a-z])")
_ANY_STAND = re.compile(r"[01345789@$|!]")
_STAND_TABLE = str.maketrans(DIGITS)
_WORD = re.compile(r"\w+")


def folded(text: str) -> str:
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)
        text = "".join(c for c in text if not unicodedata.combining(c)).lower().translate(_LETTERS)
    if not _ANY_STAND.search(text):
        return text
    return _STANDS.sub(lambda m: m.group().translate(_STAND_TABLE), text)


@dataclass
class Model:
    """Weights by word, phrases in which a word does not count, and the coefficients of the probability."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    coefficients: tuple[float, float, float] = (-3.0, 0.0, 0.0)

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for word, weight in self.weights.items():
            found.add_word(word, (len(word), weight))
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), None))
        if len(found):
            found.make_automaton()
        return found


def measures(text: str, automaton) -> tuple[float, float, int]:
    """log(1 + weight), log(1 + weight per hundred words), number of matches."""
    text = folded(text)
    total, count = 0.0, 0
    if len(automaton) and text:
        hits, excused = [], []
        for last, (length, weight) in automaton.iter(text):
            first = last + 1 - length
            if (first and text[first - 1].isalnum()) or (last + 1 < len(text) and text[last + 1].isalnum()):
                continue
            if weight is None:
                excused.append((first, last))
            else:
                hits.append((first, last, weight))
        # phrases come by their ends: of those that end at a word's end or later, one must open early enough
        ends, opening = [b for _, b in excused], [a for a, _ in excused]
        for i in range(len(opening) - 2, -1, -1):
            opening[i] = min(opening[i], opening[i + 1])
        for first, last, weight in hits:
            at = bisect_left(ends, last)
            if at == len(ends) or opening[at] > first:
                total += weight
                count += 1
    if not count:
        return 0.0, 0.0, 0
    words = text.count(" ") + text.count("\n") + 1
    return float(np.log1p(total)), float(np.log1p(100.0 * total / (words + 20))), count


def _training_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, toxic, key) per distinct word of a text; the key is a hash of the words around it.

    A word that is typical of a class stands among many different words. One that a copied text or
    passage carries along always has the same neighbours, and so counts once however often it is copied.
    """
    for batch in slices(batches):
        words, toxic, keys = [], [], []
        for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            found = ["", *_WORD.findall(folded(text or "")), ""]
            first = {w: (a, c) for a, w, c in zip(found[-3::-1], found[-2:0:-1], found[:1:-1], strict=True)}
            words.extend(first)
            toxic.extend([label] * len(first))
            keys.extend(zlib.crc32(f"{a} {c}".encode()) for a, c in first.values())
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array(toxic, pa.int32()), pa.array(keys, pa.int64())],
            ["word", "toxic", "key"],
        )


def _phrases(weights: dict[str, float]):
    """(phrase, toxic, key) per pair of neighbouring words of which one is in the lexicon."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[list] = [[], [], []]
            rows = zip(
                batch.column("text").to_pylist(),
                batch.column("toxic").to_pylist(),
                distinct_shingles(batch.column("text"), 3),
                strict=True,
            )
            for text, label, shingles in rows:
                text = folded(text or "")
                words = _WORD.findall(text)
                near = {f"{a} {b}" for a, b in zip(words, words[1:], strict=False) if a in weights or b in weights}
                for phrase in near:
                    out[0].append(phrase)
                    out[1].append(label)
                    out[2].append(int(shingles[0].view(np.int64)) if len(shingles) else 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.string()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64())],
                ["phrase", "toxic", "key"],
            )

    return run


def _points(batch: pa.RecordBatch, automaton, coefficients: tuple[float, float, float]) -> tuple[np.ndarray, np.ndarray]:
    """Measures and score of each text."""
    b0, b1, b2 = coefficients
    x = np.array([measures(t.as_py() or "", automaton) for t in batch.column("text")], float).reshape(-1, 3)
    return x, 1.0 / (1.0 + np.exp(-(b0 + b1 * x[:, 0] + b2 * x[:, 1])))


def _acceptable(model: Model):
    """The rows, all columns as they are, whose text is not scored toxic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in slices(batches):
            yield batch.filter(pa.array(_points(batch, automaton, model.coefficients)[1] < CUT))

    return run


def _measured(model: Model, columns: list[tuple[str, pa.DataType]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in slices(batches):
            x, score = _points(batch, automaton, model.coefficients)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n, _ in columns], pa.array(x[:, 0]), pa.array(x[:, 1]), pa.array(score), pa.array(x[:, 2].astype(np.int64))],
                [*[n for n, _ in columns], "x1", "x2", "score", "matches"],
            )

    return run


def _by_class(rows: DataFrame, name: str) -> DataFrame:
    """Different keys of the word, by class."""
    one = rows.groupBy(name, "toxic", "key").agg(F.lit(1).alias("one"))
    return one.groupBy(name).agg(
        F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("toxic") == 0, 1).otherwise(0)).alias("good"),
    )


def held_out(doc_id: str = "doc_id"):
    """A fifth of the documents, by id: their labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def fitted(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from ``labels`` (``doc_id``, ``toxic``) of documents that are not held out.

    A document with several labels is toxic if one says so; null ids and labels are left out. About
    ``sample_rows`` labelled rows are used, picked by a hash of the id. Without labels of both classes
    the model has no words and every score is the same.
    """
    known = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .where(~held_out())
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    )
    n = known.count()
    if n > sample_rows:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < round(1_000_000 * sample_rows / n))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = landed(texts.join(known, "doc_id").select("text", "toxic"), "labelled")
    rows = sample.mapInArrow(_training_words, "word string, toxic int, key bigint")
    classes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(classes) < 2:
        return Model()
    weights = _lexicon(_by_class(rows, "word"), classes)
    near = sample.mapInArrow(_phrases(weights), "phrase string, toxic int, key bigint")
    excused = (
        _by_class(near, "phrase")
        .where((F.col("good") >= EXCEPTION_TEXTS) & (F.col("bad") * classes[0] < F.col("good") * classes[1] * 0.2))
        .orderBy(F.col("good").desc(), "phrase")
        .limit(LEXICON_WORDS)
    )
    model = Model(weights, [r["phrase"] for r in excused.collect()])
    points = sample.mapInArrow(
        _measured(model, [("toxic", pa.int32())]), "toxic int, x1 double, x2 double, score double, matches bigint"
    )
    rows_ = points.select("x1", "x2", "toxic").toArrow()
    model.coefficients = _logistic(
        np.column_stack([rows_["x1"].to_numpy(), rows_["x2"].to_numpy()]), rows_["toxic"].to_numpy()
    )
    return model


def _lexicon(counts: DataFrame, classes: dict[int, int]) -> dict[str, float]:
    """Words that a share SUPPORT of the toxic texts hold, that are mostly toxic, and not by chance."""
    share_bad = (F.col("bad") + 0.5) / (classes[1] + 1.0)
    share_good = (F.col("good") + 0.5) / (classes[0] + 1.0)
    weight = F.log(share_bad / share_good)
    found = (
        counts.where(F.col("bad") >= max(2.0, SUPPORT * classes[1]))
        .where(F.col("bad") >= PURITY * (F.col("bad") + F.col("good")))
        .withColumn("weight", weight)
        .where(F.col("weight") > CERTAINTY * F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5)))
        .orderBy(F.col("weight").desc(), "word")
        .limit(LEXICON_WORDS)
    )
    return {r.word: float(r.weight) for r in found.collect()}


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 40) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton's method."""
    design = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(3)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ b, -30, 30)))
        grad = design.T @ (y - p) - 0.1 * b
        hess = (design * (p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(3)
        step = np.linalg.solve(hess, grad)
        b = b + step
        if np.abs(step).max() < 1e-9:
            break
    return float(b[0]), float(b[1]), float(b[2])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted, matches.

    Null and empty texts have no matches and get the lowest score. Repeated rows and null ids come back
    as they are. Only the text enters the score.
    """
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = slim.mapInArrow(
        _measured(model, [("doc_id", pa.int64())]), "doc_id bigint, x1 double, x2 double, score double, matches bigint"
    )
    return found.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"), "matches"
    )


def acceptable(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is not scored toxic.

    Each row is judged by its own text in one map, so null and repeated doc_ids are judged like others and
    no text is moved. Columns come back as they are.
    """
    # a map looks its columns up by name, which names with dots would break
    plain = docs.toDF(*[name if name == "text" else f"c{at}" for at, name in enumerate(docs.columns)])
    return plain.mapInArrow(_acceptable(fitted(docs, labels)), plain.schema).toDF(*docs.columns)
