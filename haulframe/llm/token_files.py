"""Token ids of documents in compressed files.

Documents are put in the order of doc_id, encoded, and packed into blocks of whole documents. One
frequency table, counted over all tokens, serves every block; a block is a byte string of the format
in ``rans`` beside the ids and lengths of its documents, so blocks are decoded in parallel and apart.
The files are Parquet files of blocks, written with Spark's commit protocol to any file system.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulframe.llm import rans
from haulframe.sources.scratch import new_path

END_ID = 2
BLOCK_TOKENS = 1 << 20
CACHE_WORDS = 1_390_000  # pieces that a worker remembers; it starts anew when they are more
LONG_PIECE = 64
_WORD_AND_SIGNS = re.compile(r"""([^\W_]*[a-z0-9À-ÖØ-öø-ÿ])([!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~]+)""")
_PLAIN_WORD = re.compile("[a-zß-öø-ÿ]+")
_workers: dict = {}


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes for themselves, others from 256 on."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(others)) for b in range(256)]


_BYTE_LETTERS = _byte_letters()


class Encoder:
    """Encodes whole texts piece by piece, remembering the ids of pieces.

    Pieces are cut at spaces and line ends, which the vocabulary's own rule drops and never joins
    across, and before signs that follow a word, where it always cuts, so the ids are those of the
    whole text. Pieces are encoded by the tokenizers library. This holds for vocabularies that lower
    the case, drop white space and split words from signs, as ``word_bpe_49k.json`` does.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.known: dict[str, bytes] = {"": b""}

    def bytes_of(self, ids: list[int]) -> bytes:
        found = array("H" if self.width == "<u2" else "I", ids)
        if sys.byteorder == "big":
            found.byteswap()
        return found.tobytes()

    def encoded(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids per text."""
        cut = [_pieces(t) for t in texts]
        missing = self._missing(cut)
        if len(self.known) + len(missing) > CACHE_WORDS:
            self.known = {"": b""}
            missing = self._missing(cut)
        self._learn(missing)
        out = [b"".join(map(self.known.__getitem__, pieces)) for pieces in cut]
        for piece in missing:
            if len(piece) > LONG_PIECE:
                del self.known[piece]
        return out

    def _missing(self, cut: list[list[str]]) -> set[str]:
        missing: set[str] = set()
        for pieces in cut:
            missing.update(pieces)
        return missing.difference(self.known)

    def _learn(self, missing: set[str]) -> None:
        """Encode the pieces; one that is a word and signs after it is put together from both."""
        known, tokenize, split = self.known, self.tokenizer.model.tokenize, []
        whole, words, other = [], set(), set()
        for piece in missing:
            if piece.isalpha():
                whole.append(piece)
            elif m := _WORD_AND_SIGNS.fullmatch(piece):
                word, signs = m.groups()
                split.append((piece, word, signs))
                if word not in known and word not in missing:
                    words.add(word)
                if signs not in known:
                    other.add(signs)
            else:
                whole.append(piece)
        for piece in chain(whole, words):
            # lower-case letters only: nothing to normalise or cut, the word is one unit of the model
            if piece.isascii() and piece.isalpha() and piece.islower():
                units = piece
            elif _PLAIN_WORD.fullmatch(piece):
                units = "".join(map(_BYTE_LETTERS.__getitem__, piece.encode()))
            else:
                other.add(piece)
                continue
            known[piece] = self.bytes_of([t.id for t in tokenize(units)])
        rest = list(other)
        for piece, found in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            known[piece] = self.bytes_of(found.ids)
        for piece, word, signs in split:
            known[piece] = known[word] + known[signs]


def _pieces(text: str) -> list[str]:
    """Cut at spaces and line ends; A-Z lower-cased, as the vocabulary does it, where no special token could arise."""
    if "<|" not in text:
        text = text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    return text.replace("\n", " ").split(" ")


def _encoder(path: str) -> Encoder:
    if path not in _workers:
        _workers[path] = Encoder(path)
    return _workers[path]


def _tokenised(path: str, end_id: int, group: int = 500):
    """(part, at, doc_id, n, ids) in the order of the rows; ``at`` counts tokens within the part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        end = np.array([end_id], encoder.width).tobytes()
        part, at = TaskContext.get().partitionId(), 0
        for whole in batches:
            for first in range(0, whole.num_rows, group):
                batch = whole.slice(first, group)
                ids = [x + end for x in encoder.encoded([t or "" for t in batch.column("text").to_pylist()])]
                lengths = np.array([len(x) for x in ids], np.int64) // len(end)
                starts = at + np.cumsum(lengths) - lengths
                at += int(lengths.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(ids), part, np.int32)),
                        pa.array(starts),
                        batch.column("doc_id"),
                        pa.array(lengths),
                        pa.array(ids, pa.binary()),
                    ],
                    ["part", "at", "doc_id", "n", "ids"],
                )

    return run


def _counted(width: str):
    """(id, n) of all tokens of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for ids in batch.column("ids"):
                found = np.bincount(np.frombuffer(ids.as_buffer(), width))
                if len(found) > len(total):
                    total = np.concatenate([total, np.zeros(len(found) - len(total), np.int64)])
                total[: len(found)] += found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["id", "n"])

    return run


def _packed(scaled, width: str, block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rans.Table(scaled.value)
        held: list[tuple] = []
        size = 0

        def block() -> pa.RecordBatch:
            tokens = np.concatenate([np.frombuffer(x[4], width) for x in held])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([held[0][0]], pa.int32()),
                    pa.array([held[0][1]], pa.int64()),
                    pa.array([[x[2] for x in held]], pa.list_(pa.int64())),
                    pa.array([[x[3] for x in held]], pa.list_(pa.int64())),
                    pa.array([rans.encoded(tokens, table)], pa.binary()),
                ],
                ["part", "at", "doc_ids", "lengths", "block"],
            )

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and (size >= block_tokens or (row[0], row[1]) != (held[-1][0], held[-1][1] + held[-1][3])):
                    yield block()
                    held, size = [], 0
                held.append(row)
                size += row[3]
        if held:
            yield block()

    return run


def _unpacked(scaled):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rans.Table(scaled.value)
        for batch in batches:
            for part, at, doc_ids, lengths, block in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                tokens = rans.decoded(block, table).astype("<u4")
                ends = np.cumsum(lengths)
                checks = [zlib.crc32(tokens[e - n : e].tobytes()) for e, n in zip(ends, lengths, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(doc_ids), pa.int32()),
                        pa.array(at + ends - np.array(lengths), pa.int64()),
                        pa.array(doc_ids, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(checks, pa.int64()),
                    ],
                    ["part", "at", "doc_id", "n_tokens", "ids_crc32"],
                )

    return run


def written(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS) -> None:
    """Encode ``docs`` (``doc_id``, ``text``) into files below ``path``: ``blocks``, ``table`` and ``parts``.

    Order: doc_id ascending, null ids first, equal ids by text. Null and empty texts give the end id
    alone. A block holds whole documents; one longer than ``block_tokens`` is a block of its own with
    several checkpoints. ``end_id`` is appended to every document.
    """
    spark = docs.sparkSession
    width = _encoder(vocabulary).width
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = slim.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    tokens = ordered.mapInArrow(
        _tokenised(vocabulary, end_id), "part int, at bigint, doc_id bigint, n bigint, ids binary"
    )
    raw = new_path(spark, "token-ids")
    tokens.write.option("compression", "zstd").parquet(raw)
    tokens = spark.read.parquet(raw)
    totals = tokens.select("ids").mapInArrow(_counted(width), "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    found = totals.collect()  # one row per id of the vocabulary at most
    counts = np.zeros(max([end_id, *[r.id for r in found]]) + 1, np.int64)
    counts[[r.id for r in found]] = [r.n for r in found]
    table = rans.Table.of_counts(counts)
    rows = [(int(i), int(f)) for i, f in enumerate(table.scaled) if f]
    spark.createDataFrame(rows, "id int, frequency bigint").coalesce(1).write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast(table.scaled)
    blocks = tokens.select("part", "at", "doc_id", "n", "ids").mapInArrow(
        _packed(shared, width, block_tokens),
        "part int, at bigint, doc_ids array<bigint>, lengths array<bigint>, block binary",
    )
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")
    tokens.groupBy("part").agg(F.max(F.col("at") + F.col("n")).alias("tokens")).write.parquet(f"{path}/parts")


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start (tokens before it), n_tokens, ids_crc32 (of 32-bit ids).

    Every block is checked against its checksum and decoded on its own. Only the parts, one row per
    file of the ordered write, are added up in order.
    """
    table = spark.read.parquet(f"{path}/table").collect()  # bounded by the vocabulary
    scaled = np.zeros(max(r.id for r in table) + 1, np.int64)
    scaled[[r.id for r in table]] = [r.frequency for r in table]
    shared = spark.sparkContext.broadcast(scaled)
    rows = spark.read.parquet(f"{path}/blocks").mapInArrow(
        _unpacked(shared), "part int, at bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint"
    )
    parts = spark.read.parquet(f"{path}/parts")
    before = F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")
    rows = rows.join(parts.select("part", before.alias("before")), "part")
    return rows.select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, vocabulary: str, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """Write the files and read them back."""
    path = new_path(docs.sparkSession, "token-files") if path is None else path
    written(docs, path, vocabulary, end_id)
    return read_back(docs.sparkSession, path)
