"""Words and word shingles of whole Arrow batches as 64-bit hashes, without a Python step per word.

A word is a run of characters other than the six ASCII white-space ones, A-Z lower-cased. Its hash is
a polynomial over its bytes, taken from running sums and then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, CHUNK_BYTES)
        up = np.full(size, BASE, np.uint64)
        down = np.full(size, np.uint64(pow(int(BASE), -1, 1 << 64)), np.uint64)
        up[0] = down[0] = 1
        _powers["up"], _powers["down"] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers["up"][:n], _powers["down"][:n]


@dataclass
class Words:
    """The words of rows ``first`` to ``last`` (exclusive) of a batch, in order."""

    first: int
    last: int
    row: np.ndarray  # of each word, counted from ``first``
    start: np.ndarray  # byte positions within the row
    end: np.ndarray
    hash: np.ndarray

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Row and hash of each run of ``size`` words; a row with fewer words gives all its words as one."""
        n = len(self.row)
        counts = np.bincount(self.row, minlength=self.last - self.first)
        if n >= size:
            whole = self.row[size - 1 :] == self.row[: n - size + 1]
            runs = np.zeros(n - size + 1, np.uint64)
            for j in range(size):
                runs = (runs + self.hash[j : n - size + 1 + j]) * BASE
            rows, runs = self.row[: n - size + 1][whole], mixed(runs[whole])
        else:
            rows, runs = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        short = np.flatnonzero((counts > 0) & (counts < size))
        if len(short):
            at = np.concatenate([[0], np.cumsum(counts)])
            sums = []
            for r in short:
                x = np.uint64(counts[r])
                for h in self.hash[at[r] : at[r + 1]]:
                    x = np.uint64((int(x) + int(h)) * int(BASE) % (1 << 64))
                sums.append(x)
            rows = np.concatenate([rows, short])
            runs = np.concatenate([runs, mixed(np.array(sums, np.uint64))])
            order = np.argsort(rows, kind="stable")
            rows, runs = rows[order], runs[order]
        return rows, runs


def runs_of(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` neighbouring words of one text, from running sums."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _power_tables(len(hashes))
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up, out=sums[1:])
    return mixed((sums[size:] - sums[:n]) * down[:n] + np.uint64(size))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text column; a null counts as empty."""
    texts = (texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts).cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones, for steps that make many Python objects per row."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def chunks(texts: pa.Array) -> Iterator[Words]:
    """The words of a batch, in chunks of about CHUNK_BYTES; a longer row is a chunk of its own."""
    if not len(texts):
        return
    raw, offsets = text_bytes(texts)
    n, first = len(offsets) - 1, 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1)
        yield _words(raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], first, last)
        first = last


def _words(data: np.ndarray, at: np.ndarray, first: int, last: int) -> Words:
    size = len(data)
    if not size:
        none = np.zeros(0, np.int64)
        return Words(first, last, none, none, none, np.zeros(0, np.uint64))
    data = data | (((data >= 65) & (data <= 90)).view(np.uint8) << 5)
    space = _SPACE[data]
    opens, closes = np.ones(size, bool), np.ones(size, bool)
    opens[1:], closes[:-1] = space[:-1], space[1:]
    opens[at[:-1][at[:-1] < size]] = True
    closes[at[1:][at[1:] > 0] - 1] = True
    start = np.flatnonzero(opens & ~space)
    end = np.flatnonzero(closes & ~space) + 1
    up, down = _power_tables(size)
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    hashes = mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    row = np.searchsorted(at, start, "right") - 1
    return Words(first, last, row, start - at[row], end - at[row], hashes)


def distinct_shingles(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Per row, the sorted distinct shingles."""
    for part in chunks(texts):
        rows, runs = part.shingles(size)
        at = np.searchsorted(rows, np.arange(part.last - part.first + 1))
        for i in range(part.last - part.first):
            yield np.unique(runs[at[i] : at[i + 1]])
