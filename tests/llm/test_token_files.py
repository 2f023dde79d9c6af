import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from haulframe.llm import rans, token_files
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n", [0, 1, 7, 64, 1000, 70_000])
def test_blocks_come_back(n):
    rng = np.random.default_rng(n)
    tokens = np.minimum(rng.geometric(0.01, n), 49_000)
    counts = np.bincount(np.concatenate([tokens, np.array([3, 48_999])]))
    table = rans.Table.of_counts(counts)
    block = rans.encoded(tokens, table, lanes=8)
    assert rans.decoded(block, table).tolist() == tokens.tolist()
    for first, last in ((0, 5), (n // 2, n // 2 + 9), (max(0, n - 3), n), (n, n + 5)):
        assert rans.decoded(block, table, first, last).tolist() == tokens[first:last].tolist()


def test_tables_keep_every_symbol_and_add_up():
    rng = random.Random(2)
    for _ in range(20):
        counts = [rng.choice([0, 0, 1, 5, 10**9]) for _ in range(rng.randint(1, 3000))]
        table = rans.Table.of_counts(np.array(counts))
        assert int(table.scaled.sum()) == 1 << rans.BITS
        assert all((f > 0) == (c > 0) for f, c in zip(table.scaled, counts)) or not any(counts)


def test_size_is_near_the_entropy():
    rng = np.random.default_rng(0)
    tokens = np.minimum(rng.geometric(0.05, 300_000), 200)
    p = np.bincount(tokens) / len(tokens)
    bits = -(p[p > 0] * np.log2(p[p > 0])).sum() * len(tokens)
    block = rans.encoded(tokens, rans.Table.of_counts(np.bincount(tokens)))
    assert len(block) * 8 < bits * 1.02 + 8 * 1024 * 8 * 4


def test_damage_is_found():
    tokens = np.arange(50)
    table = rans.Table.of_counts(np.ones(50))
    block = bytearray(rans.encoded(tokens, table))
    block[len(block) // 2] ^= 1
    with pytest.raises(ValueError):
        rans.decoded(bytes(block), table)
    with pytest.raises(ValueError):
        rans.encoded(np.array([60]), rans.Table.of_counts(np.ones(61) * (np.arange(61) != 60)))


def test_pieces_give_the_ids_of_whole_texts():
    whole, encoder = Tokenizer.from_file(PATH), token_files.Encoder(PATH)
    rng = random.Random(1)
    odd = [
        "It's THE dog's <|endoftext|> x", "<|ENDOFTEXT|> A", "ΣΑΣ. İ! é. áb é", "a\x1cb\x85c d", "x_y. _z__ 12.5, don't!!",
        "'. '.' \"'s\" I'LL", "́ .́ a.́ שׁ.", "日本語。", "a" * 3000 + "!", "tab\there\r\nnew", "ﬁne ½. x²,", "",
    ]
    letters = "aB cD.,'’!éİΣς́\n\t12½_<|>#ſK"
    for text in odd + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 14))) for _ in range(4000)]:
        want = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encoded([text])[0], "<u2").tolist() == want, text


def test_a_full_memory_starts_anew(monkeypatch):
    monkeypatch.setattr(token_files, "CACHE_WORDS", 3)
    encoder = token_files.Encoder(PATH)
    texts = ["one two three four", "five six", "one two"]
    assert [encoder.encoded([t])[0] for t in texts] == token_files.Encoder(PATH).encoded(texts)


def test_words_without_signs_are_learned_without_a_pattern(monkeypatch):
    tried, pattern = [], token_files._WORD_AND_SIGNS

    class Noting:
        def fullmatch(self, piece):
            tried.append(piece)
            return pattern.fullmatch(piece)

    monkeypatch.setattr(token_files, "_WORD_AND_SIGNS", Noting())
    text, whole = "a plain word, a word. été Ünder (x)", Tokenizer.from_file(PATH)
    found = np.frombuffer(token_files.Encoder(PATH).encoded([text])[0], "<u2").tolist()
    assert found == whole.encode(text, add_special_tokens=False).ids
    assert sorted(tried) == ["(x)", "word,", "word."]


def by_brute_force(rows, end_id=2):
    whole, start, out = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, end_id]
        out.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def test_odd_rows(documents):
    rows = [(9, "last"), (3, None), (3, ""), (3, "b"), (3, "a"), (3, "a"), (None, "no id"), (-5, "x " * 5000)]
    got = [tuple(r) for r in token_files.round_trip(documents(rows), PATH).orderBy("start").collect()]
    assert got == by_brute_force(rows)
    assert token_files.round_trip(documents([]), PATH).count() == 0


def test_small_blocks(spark, documents, folder):
    rows = [(k, f"text number {k} " * (k % 7)) for k in range(200)]
    path = folder("files")
    token_files.written(documents(rows), path, PATH, block_tokens=50)
    assert spark.read.parquet(f"{path}/blocks").count() > 20
    assert [tuple(r) for r in token_files.read_back(spark, path).orderBy("start").collect()] == by_brute_force(rows)


def test_whole_table(spark, sf_dir):
    from haulframe.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in QUERIES["op5_token_files"](spark, sf_dir).collect()) == by_brute_force(rows)
