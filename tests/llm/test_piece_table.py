import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from haulframe.llm import piece_table

PATH = public_tokenizers.path("piece_bpe_32k.model")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_library(rows):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    out = []
    for doc_id, text in rows:
        ids = model.encode(text or "")
        out.append((doc_id, len(ids), digest(",".join(map(str, ids))), digest(model.decode(ids) if ids else "")))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


ODD = [
    (1, None), (2, ""), (3, " "), (4, "  "), (5, "a "), (6, " a"), (7, "▁x ▁"), (8, "a▁▁ b"), (9, "<s> </s> <0x41>"),
    (10, "a\0b \0"), (11, "\n\ta  b\r\n c"), (12, "\U0001f600 ﬁ Ａ é  x　y z"), (13, "a "), (13, "a "), (None, "no id"),
    (14, "x" * 5000), (15, " " * 3000), (16, "word " * 3000),
]


def test_odd_texts(spark, documents):
    assert rows_of(piece_table.digests(documents(ODD), PATH)) == by_library(ODD)
    assert piece_table.digests(documents([]), PATH).count() == 0


def test_random_texts_in_small_blocks(spark, documents):
    rng = random.Random(5)
    signs = ["a", "the", "▁", " ", "  ", " ", "\n", "é", "\U0001f600", "ing", ".", "世", "\t", "0", "́"]
    rows = [(i, "".join(rng.choice(signs) for _ in range(rng.randrange(60)))) for i in range(800)]
    got = piece_table.encoded(documents(rows).repartition(3, "doc_id"), PATH, block_chars=500)
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert {r["doc_id"]: r["ids"] for r in got.collect()} == {i: model.encode(t) for i, t in rows}


def test_long_text_is_cut_between_chunks(monkeypatch):
    rng = random.Random(1)
    marked = "▁" + "".join(rng.choice(["ab", "c", "▁", "▁▁"]) for _ in range(2000))
    whole = [c for some in piece_table.chunks(marked) for c in some]
    monkeypatch.setattr(piece_table, "PART_CHARS", 7)
    assert [c for some in piece_table.chunks(marked) for c in some] == whole
    assert "".join(whole) == marked


def test_other_columns_do_not_matter(spark):
    rows = spark.createDataFrame([(1, "a b", "x", "y", 3)], "doc_id int, text string, ids string, block string, doc_ids int")
    assert rows_of(piece_table.digests(rows, PATH)) == by_library([(1, "a b")])


def test_blocks_that_do_not_match_are_an_error():
    import numpy as np
    import pyarrow as pa

    block = pa.table({"block": ["x"], "doc_ids": [[1]], "places": [piece_table.packed([np.array([2]), np.array([2]), np.array([0, 1])])]})
    none = pa.table({"block": pa.array([], pa.string()), "answer": pa.array([], pa.binary())})
    with pytest.raises(RuntimeError):
        piece_table._joined(block, none)
    with pytest.raises(RuntimeError):
        piece_table._joined(block.slice(1), none)


def test_whole_table(spark, sf_dir):
    from haulframe.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(QUERIES["op12_sentencepiece"](spark, sf_dir)) == by_library(rows)
