import random
import zlib

import numpy as np
from cases import clashing, docs, empty, rows

from tagloom.llm import packing
from tagloom.llm.tokens import WordTokenizer, tokenizer_path

ODD = [
    "", "  ", "A. B, C.", "it's. I'll, we've.", "<|endoftext|> x <|STARTOFTEXT|>", "É. é, É İ İ. ΣΑΣ. Σ", "...", "a... b.,c ,. d,.",
    "中文。 字,", "x y. z w, ​", "ﬁ, ß.", "don't.Stop, a.b. ", "日本語. ㈠, ½.", "á. b́,", "a<|endoftext|>b. C",
    "😀. 👍, ok😀.", "\x1ca\x1db. c", "ab*** x!! c&& d-- e. f;: g(h). i. j&s, k~ l_ m^ n`", "x'. y's. z'',", "K Å 각",
]


def plain_ids(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    return t.encode(text or "", add_special_tokens=False).ids


def test_remembered_chunks_equal_the_tokenizer():
    rng = random.Random(3)
    texts = ODD + [r[1] or "" for r in rows(4)[:40]] + [" ".join(rng.choice(ODD) for _ in range(9)) for _ in range(50)]
    t = WordTokenizer(tokenizer_path(), memory=50)  # forgets all the time
    for i in range(0, len(texts), 7):
        part = texts[i : i + 7]
        got = t.ids_batch([x.encode() for x in part])
        for x, g in zip(part, got, strict=True):
            assert np.frombuffer(g, "<u4").tolist() == plain_ids(x), x


def check(placed, given, capacity):
    """Every document is there once and whole; sequences are gapless and not too long."""
    want = []
    for d, text, *_ in given:
        ids = plain_ids(text) + [0]
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[a : a + capacity], dtype="<u4").tobytes()
            want.append((d, k, a, len(part) // 4, zlib.crc32(part)))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in placed]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    seqs = {}
    for r in placed:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    return len(seqs)


def test_documents_are_packed_whole(spark):
    given = rows(2)
    for group in (10, 100_000):
        out = packing.pack_documents(clashing(docs(spark, 2)), capacity=64, group_pieces=group).collect()
        n = check(out, given, 64)
        bound = packing.lower_bound(np.array([r["length"] for r in out]), 64)
        assert bound <= n <= bound * 1.05 + 2


def test_sequences_hold_the_ids(spark):
    given = rows(2)
    out = packing.sequences(docs(spark, 2), capacity=64).collect()
    by_doc = {}
    for r in out:
        starts = list(r["starts"]) + [len(r["ids"])]
        for d, a, b in zip(r["doc_ids"], starts, starts[1:], strict=False):
            by_doc.setdefault(d, []).append(list(r["ids"][a:b]))
    one = given[0]
    whole = [x for part in by_doc[one[0]] for x in part]
    assert sorted(whole) == sorted(plain_ids(one[1]) + [0])


def test_empty_table(spark):
    assert packing.pack_documents(empty(spark)).count() == 0


def test_lower_bound_is_a_bound_and_packing_is_close():
    rng = np.random.default_rng(0)
    for kind in range(6):
        sizes = [
            rng.integers(1, 101, 400), rng.integers(34, 60, 400), np.full(99, 51), np.full(99, 34),
            np.concatenate((np.full(50, 67), np.full(50, 33))), np.repeat([20, 45, 36], 30),
        ][kind]
        seq, off, free = packing.best_fit_decreasing(sizes, 100)
        load = np.bincount(seq, weights=sizes)
        assert load.max() <= 100 and (100 - load == np.array(free)).all()
        bound = packing.lower_bound(sizes, 100)
        assert bound <= len(free) <= bound * 1.25 + 1
    assert packing.lower_bound(np.full(99, 51), 100) == 99  # more than half: one each
    assert packing.lower_bound(np.full(99, 34), 100) == 50  # two to a sequence
    assert packing.lower_bound(np.zeros(0), 100) == 0


def test_bound_never_exceeds_the_optimum():
    # brute force over tiny instances
    from itertools import product

    rng = random.Random(1)
    for _ in range(60):
        sizes = [rng.randint(1, 10) for _ in range(rng.randint(1, 6))]
        best = min(
            len(set(p)) for p in product(range(len(sizes)), repeat=len(sizes))
            if all(sum(s for s, b in zip(sizes, p, strict=True) if b == k) <= 10 for k in set(p))
        )
        assert packing.lower_bound(np.array(sizes), 10) <= best
