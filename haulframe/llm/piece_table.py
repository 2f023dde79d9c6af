"""SentencePiece ids of whole texts, by a table of distinct chunks.

A marked text is a run of chunks: white-space markers and the characters up to the next marker. Where no
piece of the model has a marker behind another character, no piece crosses from one chunk into the next, so the
ids of a text are those of its chunks in order. Documents are taken in blocks. A block sends its distinct
chunks to the table, dealt by hash of the chunk, where each distinct chunk is segmented once; the ids come
back under the chunk's number in the block, and the block, which holds its documents as such numbers, puts
them in place.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulframe.llm.words import slices

MARK = "▁"
BLOCK_CHARS = 16_000_000  # of the documents of a block; a longer text is a block of its own
PART_CHARS = 1_000_000  # of a text that are cut into chunks at a time
MEMO_CHARS = 64_000_000  # of the chunks that a bucket's task remembers; beyond it they are segmented again
JOIN_CHUNKS = 1_000_000  # whose ids are put in place at a time

_CHUNKS = re.compile(f"{MARK}+[^{MARK}]*")
_BORDER = re.compile(f"(?<=[^{MARK}]){MARK}")
_models: dict[str, sentencepiece.SentencePieceProcessor] = {}


def model(path: str) -> sentencepiece.SentencePieceProcessor:
    """The model, loaded once per worker; it must put a marker before every text and none of its pieces across chunks."""
    if path not in _models:
        loaded = sentencepiece.SentencePieceProcessor(model_file=path)
        if [loaded.normalize(t) for t in ("a", " a  b ")] != [f"{MARK}a", f"{MARK}{MARK}a{MARK}{MARK}b{MARK}"]:
            raise ValueError("the model does not keep all white space behind one marker more")
        if any(_BORDER.search(loaded.id_to_piece(i)) for i in range(loaded.vocab_size())):
            raise ValueError("the model has pieces that cross a white-space marker")
        _models[path] = loaded
    return _models[path]


def chunks(marked: str) -> Iterator[list[str]]:
    """The chunks of a marked text, some at a time."""
    start = 0
    while len(marked) - start > PART_CHARS:
        border = _BORDER.search(marked, start + PART_CHARS)
        if not border:
            break
        yield _CHUNKS.findall(marked, start, border.start())
        start = border.start()
    yield _CHUNKS.findall(marked, start)


def chunk_ids(processor: sentencepiece.SentencePieceProcessor, tails: list[str]) -> list[list[int]]:
    """Ids of chunks. The library puts the first marker itself, so a chunk is given without it; a marker alone is one piece."""
    return [ids or [processor.piece_to_id(MARK)] for ids in processor.encode(tails, num_threads=1)]


def packed(numbers: list[np.ndarray], blob: bytes = b"") -> bytes:
    """Arrays of 32-bit numbers, byte by byte of their places, and further bytes, compressed."""
    head = np.array([len(numbers), *map(len, numbers)], "<u4").tobytes()
    planes = [np.ascontiguousarray(a.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes() for a in numbers]
    return zlib.compress(b"".join([head, *planes, blob]), 1)


def unpacked(data: bytes) -> tuple[list[np.ndarray], bytes]:
    raw = zlib.decompress(data)
    count = int.from_bytes(raw[:4], "little")
    sizes = np.frombuffer(raw, "<u4", count, 4)
    at, out = 4 + 4 * count, []
    for n in map(int, sizes):
        planes = np.frombuffer(raw, np.uint8, 4 * n, at).reshape(4, n)
        out.append(np.ascontiguousarray(planes.T).view("<u4").ravel())
        at += 4 * n
    return out, raw[at:]


class _Numbers(dict):
    """Numbers in order of first use."""

    def __missing__(self, tail: str) -> int:
        number = self[tail] = len(self)
        return number


class Block:
    """Documents as numbers of their chunks; the more often a chunk stands in the block, the smaller its number.

    A chunk is named by what follows its first marker.
    """

    def __init__(self):
        self.known = _Numbers()
        self.doc_ids: list[int | None] = []
        self.sizes: list[int] = []
        self.along = array("i")
        self.chars = 0

    def add(self, doc_id: int | None, marked: str) -> None:
        number, before = self.known.__getitem__, len(self.along)
        if len(marked) <= PART_CHARS and MARK * 2 not in marked:
            self.along.extend(map(number, marked.split(MARK)[1:]))
        else:
            for some in chunks(marked):
                self.along.extend([number(c[1:]) for c in some])
        self.doc_ids.append(doc_id)
        self.sizes.append(len(self.along) - before)
        self.chars += len(marked)

    def ranked(self) -> tuple[list[str], np.ndarray]:
        """The chunks by number, and the numbers of all documents one after another."""
        along = np.frombuffer(self.along, np.int32)
        order = np.argsort(-np.bincount(along, minlength=len(self.known)), kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        names = list(self.known)
        return [names[i] for i in order], rank[along]


def _blocks(path: str, block_chars: int, rows_of: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor, task, block, number = model(path), TaskContext.get().partitionId(), Block(), 0
        for batch in slices(batches):
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for i, text in zip(ids, texts, strict=True):
                block.add(i, processor.normalize(text.as_py() or ""))
                if block.chars >= block_chars:
                    yield from rows_of(f"{task}-{number}", block)
                    block, number = Block(), number + 1
        if block.doc_ids:
            yield from rows_of(f"{task}-{number}", block)

    return run


def _named(name: str, names: list[str]) -> str:
    """A block is known by its task, its number and its chunks."""
    digest = hashlib.blake2b(digest_size=12)
    for c in names:
        digest.update(c.encode() + b"\0")
    return f"{name}-{digest.hexdigest()}"


def _document_rows(name: str, block: Block) -> Iterator[pa.RecordBatch]:
    names, along = block.ranked()
    sizes = np.array(block.sizes)
    row = {
        "block": pa.array([_named(name, names)]),
        "doc_ids": pa.array([block.doc_ids], pa.list_(pa.int64())),
        "places": pa.array([packed([np.array([len(names)]), sizes, along])], pa.binary()),
    }
    yield pa.RecordBatch.from_pydict(row)


def _chunk_rows(buckets: int) -> Callable:
    def rows_of(name: str, block: Block) -> Iterator[pa.RecordBatch]:
        names, _ = block.ranked()
        raw = [c.encode() for c in names]
        bucket = np.fromiter((zlib.crc32(c) % buckets for c in raw), np.int64, len(raw))
        order = np.argsort(bucket, kind="stable")
        numbers, first = np.unique(bucket[order], return_index=True)
        sent = []
        for mine in np.split(order, first[1:]) if len(order) else ():
            words = [raw[i] for i in mine]
            sent.append(packed([np.diff(mine, prepend=0), np.array([len(w) for w in words])], b"".join(words)))
        names_of = [_named(name, names)] * len(sent)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names_of, pa.string()), pa.array(numbers, pa.int32()), pa.array(sent, pa.binary())], ["block", "bucket", "chunks"]
        )

    return rows_of


def _segmented(path: str) -> Callable:
    """Answers to the chunks of blocks; rows come bucket by bucket, and a bucket has all mentions of its chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor, table, held, current = model(path), {}, 0, None
        for batch in slices(batches, 100):
            answers = []
            for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("chunks"), strict=True):
                if bucket != current or held > MEMO_CHARS:
                    table, held, current = {}, 0, bucket
                (gaps, sizes), blob = unpacked(data.as_py())
                ends = np.cumsum(sizes, dtype=np.int64)
                words = [blob[e - n : e] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
                new = list({w for w in words if w not in table})
                for w, ids in zip(new, chunk_ids(processor, [w.decode() for w in new]), strict=True):
                    table[w] = ids
                    held += 50 + len(w)
                found = [table[w] for w in words]
                ids = np.fromiter(chain.from_iterable(found), np.int64)
                answers.append(packed([gaps, np.array(list(map(len, found))), ids]))
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(answers, pa.binary())], ["block", "answer"])

    return run


def _joined(blocks: pa.Table, answers: pa.Table) -> pa.Table:
    """The documents of a block with the ids of their chunks."""
    if blocks.num_rows != 1:
        raise RuntimeError("the documents came in other blocks when they were read again; write them to files first")
    (count, docs, along), _ = unpacked(blocks["places"][0].as_py())
    sizes = np.zeros(int(count[0]), np.int64)
    parts = [unpacked(a.as_py())[0] for a in answers["answer"]]
    for gaps, lengths, _ in parts:
        sizes[np.cumsum(gaps, dtype=np.int64)] = lengths
    if not sizes.all():
        raise RuntimeError("chunks of a block were not answered; write the documents to files first")
    starts = np.cumsum(sizes) - sizes
    flat = np.zeros(int(sizes.sum()), np.int32)
    for gaps, lengths, ids in parts:
        flat[_runs(starts[np.cumsum(gaps, dtype=np.int64)], lengths.astype(np.int64))] = ids
    upto = np.concatenate([[0], np.cumsum(docs, dtype=np.int64)])
    tables, first = [], 0
    while first < len(docs):
        last = max(first + 1, int(np.searchsorted(upto, upto[first] + JOIN_CHUNKS, "right")) - 1)
        mine = along[upto[first] : upto[last]]
        lengths = sizes[mine]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        values = flat[_runs(starts[mine], lengths)]
        offsets = ends[upto[first : last + 1] - upto[first]]
        ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))
        tables.append(pa.table({"doc_id": blocks["doc_ids"][0].values.slice(first, last - first), "ids": ids}))
        first = last
    return pa.concat_tables(tables)


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of runs one after another."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def encoded(docs: DataFrame, path: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id`` and ``ids`` of every row of ``docs`` (``doc_id``, ``text``): those of the library for the whole text.

    No begin or end ids, no sampling. A null or empty text has no ids; rows are kept one by one, whatever
    their doc_id. ``path`` names the model file on every machine. Models that drop white space or whose pieces
    cross a marker are refused. A text of any length is cut into chunks piece by piece; a text without white
    space is one chunk. The documents are read twice, once for the chunks and once for their order; blocks
    must come alike, as they do from files, and it is an error, never a wrong result, where they do not.
    """
    model(path)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.mapInArrow(_blocks(path, block_chars, _document_rows), "block string, doc_ids array<bigint>, places binary")
    asked = rows.mapInArrow(_blocks(path, block_chars, _chunk_rows(buckets)), "block string, bucket int, chunks binary")
    dealt = asked.repartition("bucket").sortWithinPartitions("bucket")
    answered = dealt.mapInArrow(_segmented(path), "block string, answer binary")
    return placed.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(_joined, "doc_id bigint, ids array<int>")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded``, the library's text of the ids; null ids have a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = model(path)
        for batch in slices(batches):
            ids = batch.column("ids")
            ends = ids.offsets.to_numpy()
            every = ids.values.slice(ends[0], ends[-1] - ends[0]).to_numpy(zero_copy_only=False).tolist()
            ends = (ends - ends[0]).tolist()
            lists = [every[a:b] for a, b in zip(ends, ends[1:], strict=False)]
            found = iter(processor.decode([x for x in lists if x]))
            texts = [(next(found) if x else "") if valid else None for x, valid in zip(lists, ids.is_valid().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: number of ids, digest of the ids as decimal text, digest of the decoded text."""
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded(encoded(docs, path), path).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
