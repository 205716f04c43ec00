"""Byte-level BPE against the tokenizers library."""

import random
from hashlib import sha256

import pytest
from cases import clashing, docs, empty, rows

from tagloom.llm import byte_bpe
from tagloom.llm.tokens import tokenizer_path


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path(byte_bpe.BYTE_BPE))
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.byte_bpe(tokenizer_path(byte_bpe.BYTE_BPE))


def texts():
    rng = random.Random(3)
    out = ["", " ", "  ", "\n", "a  b", " a", "a ", "a \n b\n", "\t x  \t y", "don't I'LL 's 't x'd ", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>"]
    out += ["<|endoftext|", "x" * 10_000, "ab" * 5_000, "the" * 3_000, "漢字かな交じり文" * 400, "١٢٣ 123 ½²", "\x00\x01\x85   x", "é ‍ 😀 \U0010ffff"]
    out += ["".join(map(chr, range(0x370, 0x600))), "a՘b 1₏2 ՘"]  # with code points of newer Unicode versions
    out.append("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000)))
    for _ in range(200):
        kinds = [(32, 127), (0x80, 0x3000), (0x1F300, 0x1F700), (9, 14), (32, 33), (0x10000, 0x11000)]
        out.append("".join(chr(rng.randrange(*rng.choice(kinds))) for _ in range(rng.randrange(120))))
    return out


def test_ids_and_text_equal_the_library(bpe, library):
    for t in texts():
        want = library.encode(t, add_special_tokens=False).ids
        assert bpe.encode(t).tolist() == want, t[:60]
        assert bpe.decode(want).decode("utf-8", "replace") == library.decode(want, skip_special_tokens=False)


def test_pieces_and_small_batches(library, monkeypatch):
    """Bounds that are met at every step change nothing."""
    for name, value in (("PIECE", 7), ("GATHERED", 11), ("ROUND_SYMBOLS", 5), ("ROUNDS", 2), ("LONG_WORD", 3)):
        monkeypatch.setattr(byte_bpe, name, value)
    monkeypatch.setattr(byte_bpe.pieces, "__defaults__", (7,))
    small = byte_bpe.ByteBpe(tokenizer_path(byte_bpe.BYTE_BPE), byte_bpe.newer_characters(), memory=5)
    some = [t[:300] for t in texts()]
    got = [[] for _ in some]
    for k, ids in small.stream(some):
        got[k] += ids.tolist()
    assert got == [library.encode(t, add_special_tokens=False).ids for t in some]
    assert len(small.known) <= 5 + max(t.count(" ") for t in some) + 1


def test_ids_outside_the_vocabulary(bpe):
    assert bpe.decode([-1, 10**9]) == b"" and bpe.decode([]) == b""


def test_round_trip_of_documents(spark, library):
    want = []
    for doc_id, text, *_ in rows():
        ids = library.encode(text or "", add_special_tokens=False).ids
        said = library.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256(said.encode()).hexdigest()))
    got = byte_bpe.round_trip(clashing(docs(spark)))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert byte_bpe.round_trip(empty(spark)).collect() == []


def test_tables_of_ids_and_texts(spark, library):
    given = clashing(docs(spark)).withColumnRenamed("piece", "ids")  # an own column of the result's name is in the way of nothing
    out = byte_bpe.decode_ids(byte_bpe.encode_texts(given, ids="tokens"), ids="tokens", text="again")
    assert out.columns == [*given.columns, "tokens", "again"]
    for r in out.collect():
        assert r["again"] == (r["text"] or "")
        assert r["tokens"] == library.encode(r["text"] or "", add_special_tokens=False).ids
