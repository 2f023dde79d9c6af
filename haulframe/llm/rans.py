"""Static range asymmetric numeral system over interleaved lanes, in numpy.

A block of tokens is dealt row by row to LANES coders that share one stream of 32-bit words; every
coder has a 64-bit state. All symbols use one table of frequencies that add up to 2^BITS. States and
word position are kept every CHECKPOINT rows, so a part of a block can be decoded without what comes
before it.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BITS = 20
LANES = 1024
CHECKPOINT = 256  # rows of LANES tokens
LOWEST = np.uint64(1 << 31)
MAGIC = b"HFRA"
HEADER = struct.Struct("<4sHHIIII")  # magic, version, bits, lanes, tokens, words, checkpoints
_WORD = np.uint64(32)


class Table:
    """Frequencies scaled to 2^BITS; every symbol that occurs keeps at least one."""

    def __init__(self, scaled: np.ndarray):
        self.scaled = scaled.astype(np.uint64)
        self.below = np.concatenate([[0], np.cumsum(self.scaled)]).astype(np.uint64)
        if int(self.below[-1]) != 1 << BITS:
            raise ValueError("frequencies must add up to 2^BITS")
        self.limit = self.scaled << np.uint64(31 - BITS + 32)
        self._symbols: np.ndarray | None = None

    @classmethod
    def of_counts(cls, counts: np.ndarray) -> Table:
        counts = np.asarray(counts, np.float64)
        used = counts > 0
        if not used.any():
            counts, used = np.ones(1), np.ones(1, bool)
        spare = (1 << BITS) - int(used.sum())
        exact = counts / counts.sum() * spare
        scaled = np.floor(exact).astype(np.int64) + used
        rest = (1 << BITS) - int(scaled.sum())
        order = np.lexsort((np.arange(len(counts)), -(exact - np.floor(exact))))
        scaled[order[used[order]][:rest]] += 1
        scaled[int(np.argmax(scaled))] += (1 << BITS) - int(scaled.sum())
        return cls(scaled)

    @property
    def symbols(self) -> np.ndarray:
        if self._symbols is None:
            self._symbols = np.repeat(np.arange(len(self.scaled), dtype=np.uint32), self.scaled.astype(np.int64))
        return self._symbols


def encoded(tokens: np.ndarray, table: Table, lanes: int = LANES) -> bytes:
    n = len(tokens)
    rows = -(-n // lanes)
    filler = int(np.argmax(table.scaled))
    grid = np.full(rows * lanes, filler, np.int64)
    grid[:n] = tokens
    grid = grid.reshape(rows, lanes)
    if n and not table.scaled[grid].all():
        raise ValueError("a token is not in the table")
    state = np.full(lanes, LOWEST, np.uint64)
    words: list[np.ndarray] = []
    marks = []
    shift, low = np.uint64(BITS), np.uint64(0xFFFFFFFF)
    for row in range(rows - 1, -1, -1):
        s = grid[row]
        f = table.scaled[s]
        full = state >= table.limit[s]
        if full.any():
            words.append((state[full] & low).astype(np.uint32))
            state[full] >>= _WORD
        else:
            words.append(np.zeros(0, np.uint32))
        q = state // f
        state = (q << shift) + (state - q * f) + table.below[s]
        if row % CHECKPOINT == 0:
            marks.append(state.copy())
    words.reverse()
    marks.reverse()
    sizes = np.cumsum([0, *[len(w) for w in words]])
    stream = np.concatenate(words) if words else np.zeros(0, np.uint32)
    head = HEADER.pack(MAGIC, 1, BITS, lanes, n, len(stream), len(marks))
    places = np.array([sizes[k * CHECKPOINT] for k in range(len(marks))], "<u4")
    body = head + places.tobytes() + b"".join(m.astype("<u8").tobytes() for m in marks) + stream.astype("<u4").tobytes()
    return body + struct.pack("<I", zlib.crc32(body))


def decoded(block: bytes, table: Table, first: int = 0, last: int | None = None) -> np.ndarray:
    """Tokens ``first`` to ``last`` (exclusive); starts at the checkpoint before ``first``."""
    body, (check,) = block[:-4], struct.unpack("<I", block[-4:])
    if zlib.crc32(body) != check:
        raise ValueError("checksum of a block does not match")
    magic, version, bits, lanes, n, n_words, n_marks = HEADER.unpack_from(body)
    if magic != MAGIC or version != 1 or bits != BITS:
        raise ValueError("not a block of this format")
    last = n if last is None else min(last, n)
    if first >= last:
        return np.zeros(0, np.uint32)
    at = HEADER.size
    places = np.frombuffer(body, "<u4", n_marks, at)
    at += 4 * n_marks
    mark = first // lanes // CHECKPOINT
    state = np.frombuffer(body, "<u8", lanes, at + 8 * lanes * mark).astype(np.uint64)
    at += 8 * lanes * n_marks
    stream = np.frombuffer(body, "<u4", n_words, at)
    position = int(places[mark])
    begin, end = mark * CHECKPOINT, -(-last // lanes)
    out = np.empty((end - begin, lanes), np.uint32)
    shift, mask = np.uint64(BITS), np.uint64((1 << BITS) - 1)
    symbols, scaled, below = table.symbols, table.scaled, table.below
    for row in range(end - begin):
        slot = state & mask
        s = symbols[slot]
        out[row] = s
        state = scaled[s] * (state >> shift) + slot - below[s]
        empty = state < LOWEST
        k = int(np.count_nonzero(empty))
        if k:
            state[empty] = (state[empty] << _WORD) | stream[position : position + k]
            position += k
    return out.reshape(-1)[first - begin * lanes : last - begin * lanes]
