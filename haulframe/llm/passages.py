"""Passages that repeat across documents, by collinear chaining of shared seeds.

Seeds are runs of SEED_WORDS words: those with a hash in the lowest SEED_SHARE, which changed neighbours
cannot hide, and those at minimizer places (the smallest hash of every WINDOW runs), so two texts that
share SEED_WORDS + WINDOW - 1 words in a row share a seed. Of a seed that stands in FEW places all holders meet.
Of more frequent ones two are needed, NEAREST to FARTHEST words apart: whoever holds such a pair meets its first
holder, what is not covered by a passage then meets the first holder among the uncovered, and what is left meets all
earlier holders of its pairs that are WIDE words apart (all that share a line shorter than that are not tried by it alone). Of documents that meet, matches of shared seeds that run in the same order are chained,
with a cost for gaps, by a Fenwick tree over prefix maxima. Chains are then aligned word by word, past their ends as
long as the words agree well enough. Two documents that share seeds of few places only out of line are looked at first
through the words around each match, of one byte each.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulframe.llm.landed import landed, removed
from haulframe.llm.words import chunks, mixed, text_bytes

SEED_WORDS = 4
WINDOW = 12
SEED_SHARE = 0.25  # of the runs are seeds whatever stands around them
FEW = 8  # places of a seed whose holders all meet by it alone
NEAREST, FARTHEST = 12, 40  # words between two frequent seeds that make a key
WIDE = 24  # words apart by which all holders of a key meet in the end, not the first ones only
REPEATED = 36, 47  # the same where either stands between them too, as runs of one line are no passage until they are long
SHORT_LINES = 43  # the least distance there for lines of one or two words
SECOND_ROUNDS = 1  # in which what is uncovered meets its first holder, before it meets all
THIN = 16  # words of a diagonal of which one match enters the chains
MOST_PLACES = 8  # of a seed in either document that are matched each with each; of more, those of the same rank
AROUND = 64  # words on either side of a match that are looked at before the texts are
LIKELY = 0.6  # of the words of a passage are reached from a match in it that way
MIN_WORDS = 50
PERCENT = 80  # of the words of a passage that are the same in both documents
GAP_COST = 0.01  # per word of a gap on either side, where a match is worth one
LONGEST_GAP = 60  # words between two matches of a passage
LARGEST_SHIFT = 15  # words by which the two sides of a gap differ
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
DROP = 12  # an extension ends once it is so many points below its best


def _sliding(smallest_or_largest: np.ufunc, values: np.ndarray, window: int) -> np.ndarray:
    """Over every ``window`` neighbouring values, of which there are as many at least."""
    size = 1
    while 2 * size <= window:
        values, size = smallest_or_largest(values[:-size], values[size:]), 2 * size
    rest = window - size
    return smallest_or_largest(values[:-rest], values[rest:]) if rest else values


def _least_of_windows(hashes: np.ndarray, rows: np.ndarray, window: int) -> np.ndarray:
    """Whether a hash is the smallest of ``window`` neighbouring ones of its row, or of a row that has fewer."""
    chosen = np.zeros(len(hashes), bool)
    if not len(hashes):
        return chosen
    begins = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    counts = np.diff(np.append(begins, len(rows)))
    short = np.repeat(counts < window, counts)
    chosen[short] = (hashes == np.repeat(np.minimum.reduceat(hashes, begins), counts))[short]
    if len(hashes) >= window:
        lows = np.where(rows[window - 1 :] == rows[: len(rows) - window + 1], _sliding(np.minimum, hashes, window), np.uint64(0))
        edge = np.zeros(window - 1, np.uint64)
        chosen |= _sliding(np.maximum, np.concatenate([edge, lows, edge]), window) == hashes
    return chosen


def minimizers(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the smallest of every ``window`` neighbouring hashes."""
    return np.flatnonzero(_least_of_windows(hashes, np.zeros(len(hashes), np.int64), window))


def _row_seeds(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places, among all words, and hashes of the seeds of texts that stand one behind another."""
    n = len(words) - SEED_WORDS + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    runs = np.zeros(n, np.uint64)
    for j in range(SEED_WORDS):
        runs = mixed(runs + words[j : n + j])
    whole = np.flatnonzero(rows[SEED_WORDS - 1 :] == rows[:n])
    runs = runs[whole]
    chosen = (runs < np.uint64(int(SEED_SHARE * 2**64))) | _least_of_windows(runs, rows[whole], WINDOW)
    return whole[chosen], runs[chosen]


def seeds_of(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the seeds of a text."""
    return _row_seeds(words, np.zeros(len(words), np.int64))


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        for part in chunks(batch.column("text")):
            at, seeds = _row_seeds(part.hash, part.row)
            begins = np.searchsorted(part.row, np.arange(part.last - part.first))
            rows = part.row[at]
            columns = [ids.take(pa.array(rows + part.first)), pa.array((at - begins[rows]).astype(np.int32)), pa.array(seeds.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "place", "seed"])


def _places_of_same(at: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every seed, the next and the last place of the same seed in the text; places ascend."""
    order = np.argsort(seeds, kind="stable")
    same = seeds[order][1:] == seeds[order][:-1]
    after, before = np.full(len(at), np.iinfo(np.int32).max), np.full(len(at), -1)
    after[order[:-1][same]], before[order[1:][same]] = at[order[1:][same]], at[order[:-1][same]]
    return after, before


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document, a key for every two of its frequent seeds that stand NEAREST to FARTHEST words apart, and its places."""
    for batch in batches:
        lists, seeds_of_rows = batch.column("at"), batch.column("seeds").flatten().to_numpy().view(np.uint64)
        all_at, cuts = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(5)]
        for row in range(batch.num_rows):
            at, seeds = all_at[cuts[row] : cuts[row + 1]], seeds_of_rows[cuts[row] : cuts[row + 1]]
            order = np.argsort(at, kind="stable")
            at, seeds = at[order], seeds[order]
            low, high = np.searchsorted(at, at + NEAREST), np.searchsorted(at, at + max(FARTHEST, REPEATED[1]), "right")
            n = high - low
            own = np.repeat(np.arange(len(at)), n)
            if not len(own):
                continue
            after, before = _places_of_same(at, seeds)
            other = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n) + low[own]
            apart = at[other] - at[own]
            repeated = (after[own] <= at[other]) | (before[other] >= at[own])
            least = np.where(after[own] - at[own] > 2, REPEATED[0], SHORT_LINES)
            wanted = np.where(repeated, (apart >= least) & (apart <= REPEATED[1]), apart <= FARTHEST)
            own, other = own[wanted], other[wanted]
            if not len(own):
                continue
            keys, places, apart = mixed(seeds[own] * np.uint64(3) + seeds[other]), at[own], apart[wanted]
            order = np.lexsort((places, keys))
            keys, places = keys[order], places[order]
            new = np.concatenate([[True], keys[1:] != keys[:-1]])
            begins = np.flatnonzero(new)
            once = new | np.concatenate([[True], places[1:] != places[:-1]])
            counts = np.diff(np.append(np.cumsum(once)[begins] - 1, np.count_nonzero(once)))
            wide = np.maximum.reduceat(apart[order], begins) >= WIDE
            for column, value in zip(out, (keys[begins].view(np.int64), np.full(len(begins), row), counts, places[once], wide), strict=True):
                column.append(value)
        keys, rows, counts, places, wide = (np.concatenate(x) for x in out)
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        columns = [
            pa.array(keys),
            batch.column("doc_id").take(pa.array(rows)),
            pa.ListArray.from_arrays(offsets, pa.array(places.astype(np.int32))),
            pa.array(wide.astype(bool)),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["key", "doc_id", "places", "wide"])


def _ranked_seeds(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the seeds of a text, by hash."""
    at, seeds = seeds_of(words)
    order = np.argsort(seeds, kind="stable")
    return at[order], seeds[order]


def _matches(words: np.ndarray, other_at: np.ndarray, ranked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Matched places of a text and of another one, whose seeds are given by hash."""
    at, seeds = seeds_of(words)
    low, high = np.searchsorted(ranked, seeds, "left"), np.searchsorted(ranked, seeds, "right")
    n = high - low
    shared = np.flatnonzero(n > 0)
    shared = shared[np.argsort(seeds[shared], kind="stable")]
    same = np.zeros(len(shared), bool)
    same[1:] = seeds[shared[1:]] == seeds[shared[:-1]]
    begins = np.flatnonzero(~same)
    counts = np.diff(np.append(begins, len(shared)))
    often = (np.repeat(counts, counts) > MOST_PLACES) | (n[shared] > MOST_PLACES)
    few, many = shared[~often], shared[often]
    own = np.repeat(at[few], n[few])
    steps = np.arange(len(own)) - np.repeat(np.cumsum(n[few]) - n[few], n[few])
    there = other_at[np.repeat(low[few], n[few]) + steps]
    if not len(many):
        return own, there
    ranks = (np.arange(len(shared)) - np.repeat(begins, counts))[often]
    opens = many[~(same[often] & (np.diff(at[shared], prepend=0)[often] <= LONGEST_GAP))]
    own = np.concatenate([own, at[many], at[opens]])
    return own, np.concatenate([there, other_at[low[many] + ranks % n[many]], other_at[low[opens]]])


def matched_places(words: np.ndarray, others: np.ndarray) -> list[tuple[int, int]]:
    """Places of the seeds that two texts share, in both.

    A place is matched with all places of its seed in the other text. Where either text has more than MOST_PLACES of
    them, it is matched with the one of its own rank, as repeated lines stand in the same order, counted round and round
    if the other text has fewer; the first place of a run of such lines with the first place there as well.
    """
    return list(zip(*(x.tolist() for x in _matches(words, *_ranked_seeds(others))), strict=True))


def _thinned(x: np.ndarray, y: np.ndarray) -> dict[tuple[int, int], float]:
    """The first match of every THIN words of a diagonal, with the number of matches it stands for.

    Matches of a place that has others as well stand for themselves, or chains would count it more than once.
    """
    order = np.lexsort((x, y - x))
    x, y = x[order], y[order]
    alone = np.ones(len(x), bool)
    for side in (x, y):
        _, inverse, times = np.unique(side, return_inverse=True, return_counts=True)
        alone &= times[inverse] == 1
    new = np.ones(len(x), bool)
    new[1:] = ((y - x)[1:] != (y - x)[:-1]) | (x[1:] // THIN != x[:-1] // THIN)
    new[1:] |= ~(alone[1:] & alone[:-1])
    begins = np.flatnonzero(new)
    counts = np.diff(np.append(begins, len(x)))
    return dict(zip(zip(x[begins].tolist(), y[begins].tolist(), strict=True), counts.tolist(), strict=True))


class Fenwick:
    """Largest value, with its index, over prefixes."""

    def __init__(self, size: int):
        self.values, self.owners = [float("-inf")] * (size + 1), [-1] * (size + 1)

    def put(self, at: int, value: float, owner: int) -> None:
        at += 1
        while at < len(self.values):
            if value > self.values[at]:
                self.values[at], self.owners[at] = value, owner
            at += at & -at

    def best(self, before: int) -> tuple[float, int]:
        """Over places smaller than ``before``."""
        value, owner = float("-inf"), -1
        while before:
            if self.values[before] > value:
                value, owner = self.values[before], self.owners[before]
            before -= before & -before
        return value, owner


def chained(matches: list[tuple[int, int]] | dict[tuple[int, int], float]) -> list[list[tuple[int, int]]]:
    """Chains of (place, other place) matches, both ascending, best first; each match is in one at most.

    A match is worth one, or what is given with it; going on from (x, y) to (u, v) costs GAP_COST for every word of both gaps,
    u - x + v - y. The cost is a sum of a term per end, so the best match to come from is a prefix
    maximum over the other places of all matches further left.
    """
    worth = matches if isinstance(matches, dict) else dict.fromkeys(matches, 1.0)
    matches = sorted(worth)
    others = sorted({y for _, y in matches})
    ranks = {y: k for k, y in enumerate(others)}
    tree = Fenwick(len(others))
    score, back = [worth[m] for m in matches], [-1] * len(matches)
    entered = 0
    for i, (u, v) in enumerate(matches):
        while matches[entered][0] < u:
            x, y = matches[entered]
            tree.put(ranks[y], score[entered] + GAP_COST * (x + y), entered)
            entered += 1
        value, k = tree.best(ranks[v])
        if k >= 0 and value - GAP_COST * (u + v) > 0:
            score[i], back[i] = score[i] + value - GAP_COST * (u + v), k
    used = [False] * len(matches)
    out = []
    for i in sorted(range(len(matches)), key=lambda j: (-score[j], matches[j])):
        chain, k = [], i
        while k >= 0 and not used[k]:
            used[k] = True
            chain.append(matches[k])
            k = back[k]
        if chain:
            out.append(chain[::-1])
    return out


def unbroken(chain: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """The chain, cut where a gap is too long or its sides differ too much to be one passage; longest part first."""
    parts = [[chain[0]]]
    for (x, y), (u, v) in zip(chain, chain[1:], strict=False):
        if max(u - x, v - y) > LONGEST_GAP or abs((u - x) - (v - y)) > LARGEST_SHIFT:
            parts.append([])
        parts[-1].append((u, v))
    return sorted(parts, key=lambda p: (p[0][0] - p[-1][0], p[0]))


def _extended(a: np.ndarray, b: np.ndarray, match: int = 1, miss: int = -2) -> tuple[int, int]:
    """How far two word sequences agree from their starts, with few words changed, added or left out."""
    i = j = best_i = best_j = score = best = 0
    size = 64
    x, y = a[:size].tolist(), b[:size].tolist()
    while i < len(a) and j < len(b) and score > best - DROP:
        if max(i, j) + 8 > size:
            size = 4 * max(size, i, j)
            x, y = a[:size].tolist(), b[:size].tolist()
        if x[i] == y[j]:
            run = min(len(a) - i, len(b) - j, 256)
            differ = np.flatnonzero(a[i : i + run] != b[j : j + run])
            same = int(differ[0]) if len(differ) else run
            i, j, score = i + same, j + same, score + same * match
            if score > best:
                best, best_i, best_j = score, i, j
            if i >= len(a) or j >= len(b) or same == run:
                continue
            if max(i, j) + 8 > size:
                size = 4 * max(size, i, j)
                x, y = a[:size].tolist(), b[:size].tolist()
        score += miss
        # the nearest place where three words agree again, on either side
        for u, v in ((1, 1), (1, 0), (0, 1), (2, 2), (2, 1), (1, 2), (3, 3), (2, 0), (0, 2)):
            p, q = i + u, j + v
            rest = min(3, len(a) - p, len(b) - q)
            if rest > 0 and x[p] == y[q] and (rest < 2 or x[p + 1] == y[q + 1]) and (rest < 3 or x[p + 2] == y[q + 2]):
                i, j, score = p, q, score - max(u, v) + 1
                break
        else:
            i, j, score = i + 1, j + 1, score - 1
    return best_i, best_j


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Words that two short sequences have in common in order."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    begin = int(differ[0]) if len(differ) else n
    a, b = a[begin:], b[begin:]
    n = min(len(a), len(b))
    if not n:
        return begin
    differ = np.flatnonzero(a[::-1][:n] != b[::-1][:n])
    end = int(differ[0]) if len(differ) else n
    a, b = a[: len(a) - end], b[: len(b) - end]
    if not len(a) or not len(b):
        return begin + end
    row = np.zeros(len(b) + 1, np.int64)
    for word in a:
        hit = np.concatenate([[0], row[:-1] + (b == word)])
        row = np.maximum.accumulate(np.maximum(row, hit))
    return begin + int(row[-1]) + end


def _straight(words: np.ndarray, others: np.ndarray, chain: list[tuple[int, int]], seed_words: int) -> int:
    """How many of the first matches of a chain lie in one stretch that is the same in both texts, word by word."""
    x, y = chain[0]
    first, last = 0, len(chain)  # the first ``first`` do, or none was looked at; more than ``last`` do not
    while last and chain[last - 1][1] - chain[last - 1][0] != y - x:
        last -= 1
    if last > 1:
        end = chain[last - 1][0] + seed_words
        differ = words[x:end] != others[y : y + end - x]
        stop = x + int(differ.argmax()) if differ.any() else end
        while first < last and chain[first][1] - chain[first][0] == y - x and chain[first][0] + seed_words <= stop:
            first += 1
    return first


def aligned(words: np.ndarray, others: np.ndarray, chain: list[tuple[int, int]], seed_words: int, match: int = 1, least: float = 0):
    """(start, end, other start, other end, same words) of the passage around a chain; more words with a higher ``match``.

    The same words are not counted where either side is shorter than ``least``.
    """
    x, y = chain[0]
    back = _extended(words[:x][::-1], others[:y][::-1], match)
    start, other_start = x - back[0], y - back[1]
    last, other_last = chain[-1][0] + seed_words, chain[-1][1] + seed_words
    ahead = _extended(words[last:], others[other_last:], match)
    if min(last + ahead[0] - start, other_last + ahead[1] - other_start) < least:
        return start, last + ahead[0], other_start, other_last + ahead[1], 0
    same = _common(others[other_start:y], words[start:x])
    i, j = x, y
    straight = _straight(words, others, chain, seed_words)
    if straight:
        same += chain[straight - 1][0] + seed_words - x
        i, j = (place + seed_words for place in chain[straight - 1])
    for u, v in chain[straight:]:
        if u + seed_words <= i or v + seed_words <= j:
            continue
        overlap = max(0, i - u, j - v)
        if u > i or v > j:
            gap, other_gap = words[i : max(i, u)], others[j : max(j, v)]
            same += _common(gap, other_gap) if len(gap) * len(other_gap) <= 1 << 22 else 0
        i, j = u + seed_words, v + seed_words
        same += seed_words - overlap
    same += _common(others[j : j + ahead[1]], words[i : i + ahead[0]])
    return start, i + ahead[0], other_start, j + ahead[1], same


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One byte per word before (from the match backwards) and from each of the places of a text."""
    for batch in batches:
        ids, wanted = batch.column("doc_id").to_pylist(), batch.column("places").to_pylist()
        out: list[list] = [[], [], [], []]
        for doc_id, places, (h, _, _) in zip(ids, wanted, _row_words(batch.column("text")), strict=True):
            small = (h & np.uint64(255)).astype(np.uint8)
            for place in places:
                before = small[max(0, place - AROUND) : place][::-1].tobytes()
                for column, value in zip(out, (doc_id, place, before, small[place : place + AROUND].tobytes()), strict=True):
                    column.append(value)
        types = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types, strict=True)], ["doc_id", "place", "before", "ahead"])


def _near(a: bytes, b: bytes, words: int = 15, least: int = 6) -> bool:
    """Whether as many of the first words stand near the start of the other side as an extension over them needs."""
    near = b[: words + 3]
    return sum(x in near for x in a[:words]) >= least


def _likely(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("before", "other_before", "ahead", "other_ahead")
        for batch in batches:
            keep = []
            for row in zip(*(batch.column(name).to_pylist() for name in names), strict=True):
                if not (_near(row[0], row[1]) or _near(row[2], row[3])):
                    keep.append(False)
                    continue
                a, b, c, d = (np.frombuffer(x, np.uint8) for x in row)
                keep.append(min(_extended(a, b)) + min(_extended(c, d)) >= LIKELY * least)
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("doc_id"), kept.column("other_id")], ["doc_id", "other_id"])

    return run


def _split(chain: list[tuple[int, int]], taken: list[tuple[int, int]], seed_words: int, size: int):
    """The parts of a chain in the stretches of the document between accepted passages: (part, stretch)."""
    out, ends, begins = [], [0], []
    for a, b in sorted(taken):
        begins.append(a)
        ends.append(max(b, ends[-1]))
    for x, y in zip(ends, [*begins, size], strict=True):
        part = [(u, v) for u, v in chain if x <= u and u + seed_words <= y]
        if part:
            out.append((part, (x, y)))
    return out


def _passage(words: np.ndarray, others: np.ndarray, chain: list[tuple[int, int]], seed_words: int, least: int, percent: int):
    """What ``aligned`` gives, if it is long enough with enough of its words the same."""
    found = aligned(words, others, chain, seed_words, 1, LIKELY * least)
    if LIKELY * least <= min(found[1] - found[0], found[3] - found[2]) < least:  # changed words near its ends may have ended it early
        found = aligned(words, others, chain, seed_words, 2)
    a, b, c, d, same = found
    return found if min(b - a, d - c) >= least and 100 * same >= percent * max(b - a, d - c) else None


def _dense(hits: np.ndarray, least: int) -> bool:
    """Whether LIKELY of ``least`` words in a row stand in the other document as well; ``hits`` are running counts."""
    return len(hits) > least and int((hits[least:] - hits[:-least]).max()) >= LIKELY * least


def _running(words: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Running counts of the words that stand among the others, which are in order."""
    found = others[np.minimum(np.searchsorted(others, words), len(others) - 1)] == words
    return np.concatenate([[0], np.cumsum(found)])


def _promising(words: np.ndarray, others: np.ndarray, hits: np.ndarray, chain: list[tuple[int, int]], least: int) -> bool:
    """Whether the words around a chain stand in the other document, and around it there."""
    (x, y), (u, v) = chain[0], chain[-1]
    low, high = max(0, x - least), u + least
    if not _dense(hits[low : high + 1], least):
        return False
    near = others[max(0, y - least - LARGEST_SHIFT) : v + least + LARGEST_SHIFT]
    return _dense(_running(words[low:high], np.sort(near)), least)


def _verified(seed_words: int, least: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "end", "other_id", "other_start", "other_end", "same_words", "words", "first_word"]
        for batch in batches:
            out: list[list[int]] = [[] for _ in names]
            own, texts = _row_words(batch.column("text")), batch.column("other_text")
            # pairs come by the other document mostly, whose words, and their order, are then made once
            new = np.ones(len(texts), bool)
            new[1:] = pc.fill_null(pc.not_equal(texts.slice(1), texts.slice(0, len(texts) - 1)), True).to_numpy(zero_copy_only=False)
            others = _row_words(texts.filter(pa.array(new)))
            ids, other_ids = batch.column("doc_id").to_pylist(), batch.column("other_id").to_pylist()
            raw, at = text_bytes(batch.column("text"))
            raw_b, at_b = text_bytes(batch.column("other_text"))
            for row, (h, s, e) in enumerate(own):
                if new[row]:
                    g, t, f = next(others)
                    g_in_order, g_seeds = np.sort(g), None
                taken: list[tuple[int, int]] = []
                if min(len(h), len(g)) < least:
                    continue
                hits = _running(h, g_in_order)
                if not _dense(hits, least):  # nor is it around any chain
                    continue
                g_seeds = g_seeds or _ranked_seeds(g)
                chains = chained(_thinned(*_matches(h, *g_seeds)))
                for chain, free in ((p, f) for whole in chains for part in unbroken(whole) for p, f in _split(part, taken, seed_words, len(h))):
                    if not _promising(h, g, hits, chain, least):
                        continue
                    found, low = _passage(h[free[0] : free[1]], g, [(u - free[0], v) for u, v in chain], seed_words, least, percent), free[0]
                    if found is None and taken and free[1] - free[0] >= LIKELY * least:
                        # too short without the few words that an accepted passage may have run into it
                        low, high = max(0, free[0] - least // 5), free[1] + least // 5
                        found = _passage(h[low:high], g, [(u - low, v) for u, v in chain], seed_words, least, percent)
                    if found is None:
                        continue
                    a, b, c, d, same = found
                    a, b = a + low, b + low
                    taken.append((a, b))
                    text, other = raw[at[row] : at[row + 1]], raw_b[at_b[row] : at_b[row + 1]]
                    values = (
                        ids[row], _chars(text, s[a]), _chars(text, e[b - 1]), other_ids[row],
                        _chars(other, t[c]), _chars(other, f[d - 1]), same, b - a, a,
                    )
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names)

    return run


def _chars(text: np.ndarray, end: int) -> int:
    """Characters in the first bytes of a UTF-8 text."""
    return int(np.count_nonzero((text[:end] & 0xC0) != 0x80))


def _row_words(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for part in chunks(texts):
        begins = np.searchsorted(part.row, np.arange(part.last - part.first + 1))
        for i in range(part.last - part.first):
            own = slice(begins[i], begins[i + 1])
            yield part.hash[own], part.start[own], part.end[own]


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Files of a shuffle go when the step that made it has been written, not when the driver's memory is cleared."""
    before = spark.conf.get(REMOVE_SHUFFLES, None)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(REMOVE_SHUFFLES) if before is None else spark.conf.set(REMOVE_SHUFFLES, before)


def _rare_pairs(slim: DataFrame, held: DataFrame, least: int) -> DataFrame:
    """``doc_id``, ``other_id`` of documents that share seeds of few places and may share a passage."""
    seeds = held.where(F.col("n") <= FEW).groupBy("seed").agg(F.collect_list(F.struct("doc_id", "place")).alias("at"))
    matched = seeds.select("at", F.explode("at").alias("own"))
    earlier = F.filter("at", lambda x: x["doc_id"] < F.col("own.doc_id"))
    matched = matched.select("own.*", F.explode(earlier).alias("other"))
    pairs = matched.groupBy("doc_id", F.col("other.doc_id").alias("other_id")).agg(
        F.collect_list(F.struct("place", F.col("other.place").alias("other_place"))).alias("matches")
    )
    # A passage of ``least`` words with enough of them unchanged mostly shares seeds in line, some way apart; else its matches are extended.
    pairs = pairs.withColumn("matches", F.array_sort("matches"))
    step = F.zip_with(
        F.slice("matches", 1, F.greatest(F.size("matches") - 1, F.lit(0))),
        F.slice("matches", 2, F.size("matches")),
        lambda a, b: F.when(
            ((b["place"] - a["place"]) <= LONGEST_GAP)
            & (F.abs((b["place"] - a["place"]) - (b["other_place"] - a["other_place"])) <= LARGEST_SHIFT),
            b["place"] - a["place"],
        ).otherwise(0),
    )
    pairs = pairs.withColumn("in_line", F.aggregate(step, F.lit(0), lambda total, x: total + x) >= least // 4)
    pairs = landed(pairs, "pairs")
    few = pairs.where("NOT in_line").select("doc_id", "other_id", F.explode("matches").alias("m")).select("doc_id", "other_id", "m.*")
    asked = few.select("doc_id", "place").union(few.select("other_id", "other_place"))
    asked = asked.groupBy("doc_id").agg(F.collect_set("place").alias("places"))
    around = landed(
        slim.join(asked, "doc_id").mapInArrow(_surroundings, "doc_id bigint, place int, before binary, ahead binary"), "around"
    )
    others = around.withColumnsRenamed({"doc_id": "other_id", "place": "other_place", "before": "other_before", "ahead": "other_ahead"})
    likely = few.join(around, ["doc_id", "place"]).join(others, ["other_id", "other_place"])
    likely = likely.mapInArrow(_likely(least), "doc_id bigint, other_id bigint").distinct()
    return pairs.where("in_line").select("doc_id", "other_id").union(likely)


def _first_holders(keys: DataFrame) -> DataFrame:
    firsts = keys.groupBy("key").agg(F.min("doc_id").alias("other_id"), F.max("doc_id").alias("last_id"))
    return firsts.where("other_id < last_id").select("key", "other_id")


def _pairs(keys: DataFrame, holders: DataFrame) -> DataFrame:
    """Documents with the earlier ones of the ``holders`` of their keys."""
    return keys.join(holders, "key").where("other_id < doc_id").select("doc_id", "other_id").distinct()


def _uncovered(keys: DataFrame, found: DataFrame) -> DataFrame:
    """The keys of documents that do not lie in passages found in them everywhere."""
    stretches = found.select("doc_id", F.struct("first_word", (F.col("first_word") + F.col("words")).alias("after")).alias("s"))
    stretches = stretches.groupBy("doc_id").agg(F.collect_set("s").alias("stretches"))
    middle = (NEAREST + SEED_WORDS) // 2
    covered = F.forall(
        "places",
        lambda x: F.exists("stretches", lambda s: (s["first_word"] <= x + middle) & (x + middle < s["after"])),
    )
    return keys.join(stretches, "doc_id", "left").where(~F.coalesce(covered, F.lit(False))).select(keys.columns)


def _found(slim: DataFrame, least: int, percent: int) -> DataFrame:
    """Passages of the documents that meet, with ``first_word``."""

    def verified(pairs: DataFrame, label: str) -> DataFrame:
        wanted = pairs.select(F.explode(F.array("doc_id", "other_id")).alias("doc_id")).distinct()
        texts = slim.join(wanted, "doc_id", "left_semi")
        rows = pairs.join(texts, "doc_id").join(texts.withColumnsRenamed({"doc_id": "other_id", "text": "other_text"}), "other_id")
        rows = rows.select("doc_id", "other_id", "text", "other_text")
        names = "doc_id start end other_id other_start other_end same_words words first_word".split()
        return landed(rows.mapInArrow(_verified(SEED_WORDS, least, percent), ", ".join(f"{x} bigint" for x in names)), label)

    seeds = landed(slim.mapInArrow(_seeds, "doc_id bigint, place int, seed bigint"), "seeds")
    shared = seeds.groupBy("seed").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.count("*").alias("n"))
    shared = landed(shared.where("first_id < last_id").select("seed", "n"), "shared")
    held = landed(seeds.join(shared.hint("shuffle_hash"), "seed"), "held")
    removed(seeds)
    removed(shared)
    frequent = held.where(F.col("n") > FEW).groupBy("doc_id").agg(F.collect_list(F.struct("place", "seed")).alias("at"))
    frequent = frequent.where(F.size("at") > 1).select("doc_id", F.col("at.place").alias("at"), F.col("at.seed").alias("seeds"))
    keys = landed(frequent.mapInArrow(_keys, "key bigint, doc_id bigint, places array<int>, wide boolean"), "keys")
    firsts = landed(_first_holders(keys), "firsts")
    tried = landed(_rare_pairs(slim, held, least).union(_pairs(keys, firsts)).distinct(), "tried")
    removed(held)
    found = verified(tried, "found")
    later = keys.join(firsts, "key").where("other_id < doc_id").drop("other_id")
    left = landed(_uncovered(later, found), "left")
    for _ in range(SECOND_ROUNDS):
        pairs = landed(_pairs(left, _first_holders(left)).join(tried, ["doc_id", "other_id"], "left_anti"), "second")
        found, tried = found.union(verified(pairs, "found")), tried.union(pairs)
        left = landed(_uncovered(left, found), "left")
    holders = keys.where("wide").select("key", F.col("doc_id").alias("other_id"))
    rest = landed(_pairs(left.where("wide"), holders).join(tried, ["doc_id", "other_id"], "left_anti"), "rest")
    return found.union(verified(rest, "found"))


def repeated_passages(docs: DataFrame, least: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per passage of ``docs`` (``doc_id``, ``text``) that an earlier document holds too.

    Columns: doc_id, start, end, other_id, other_start, other_end (characters, end exclusive),
    same_words, words (length in this document). A passage has at least ``least`` words on both sides, of
    which ``percent`` % are the same in order. Words are compared with A-Z lower-cased. Every document
    but the first, by id, that holds a passage gets a row; so rows grow with the documents, not with
    pairs. Of passages of a document that lie inside one another the longest is reported, of equal ones
    that of the earliest other document. Null, empty and short texts have none; rows with a null doc_id are left out; rows that
    share a doc_id are one document, each of whose texts is tried. Passages are found against one
    earlier document at a time: one that is put together from parts of several, each shorter than
    ``least``, is not reported.
    """
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    slim = slim.where("doc_id IS NOT NULL AND text IS NOT NULL")
    with _shuffles_removed(docs.sparkSession):
        found = _found(slim, least, percent).drop("first_word")
    inner = Window.partitionBy("doc_id").orderBy("start", F.desc("end"), "other_id", "other_start", "other_end")
    reach = F.max("end").over(inner.rowsBetween(Window.unboundedPreceding, -1))
    found = found.distinct().withColumn("reach", reach)  # repeated rows of the input
    return found.where("reach IS NULL OR reach < end").drop("reach")
