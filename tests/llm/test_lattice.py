import math
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import clashing, docs, empty, rows
from pyspark.sql import functions as F

from tagloom.llm import lattice


def tiny():
    return lattice.Pieces([b" ", b" a", b" ab", b"a", b"b", b"ab", b"c", b"bc"])


def all_paths(word, pieces, score):
    """Sum over all segmentations, spelled out."""
    text = lattice.MARK + word

    def go(i):
        if i == len(text):
            return math.exp(score[pieces.eow])
        return sum(math.exp(score[k]) * go(i + len(p)) for p, k in pieces.ids.items() if text.startswith(p, i))

    return go(0)


def test_forward_recursion_sums_all_segmentations():
    p = tiny()
    rng = np.random.default_rng(0)
    score = p.normal(rng.uniform(0.1, 1, (2, p.eow + 1)), 0.0)
    words = [b"a", b"ab", b"abc", b"abcab", b"aabbcc", b"cab"]
    got = lattice.spell(words, p, score)
    for i, w in enumerate(words):
        for k in (0, 1):
            assert got[i, k] == pytest.approx(math.log(all_paths(w, p, score[k])))
    assert lattice.spell([b"abx"], p, score)[0, 0] == -np.inf  # no piece for x


def test_expected_counts_are_the_gradient():
    p = tiny()
    score = p.normal(np.random.default_rng(1).uniform(0.1, 1, (1, p.eow + 1)), 0.0)
    words = [b"ab", b"abcab", b"cab"]
    got = lattice.expected_counts(words, np.zeros(3, int), p, score)[0]
    eps = 1e-5
    for k in range(p.eow + 1):
        up, down = score.copy(), score.copy()
        up[0, k] += eps
        down[0, k] -= eps
        slope = (lattice.spell(words, p, up).sum() - lattice.spell(words, p, down).sum()) / (2 * eps)
        assert got[k] == pytest.approx(slope, abs=1e-4)


def test_spellings_sum_to_one_at_most():
    p = lattice.Pieces([b" ", b" a", b"a", b"b", b"ab"])
    score = p.normal(np.array([[1.0, 2, 1, 1, 1, 3]]), 0.0)
    from itertools import product

    words = [bytes(w) for n in range(1, 10) for w in product(b"ab", repeat=n)]
    total = np.exp(lattice.spell(words, p, score)).sum()
    assert 0.5 < total <= 1 + 1e-9


def held(d):
    return zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2


def brute_base(given):
    train = Counter()
    for d, t, *_ in given:
        if not held(d):
            train.update((t or "").encode().lower().split())
            train[None] += 1
    n, v = sum(train.values()), len(train)
    out = []
    for d, t, *_ in given:
        toks = [*(t or "").encode().lower().split(), None]
        base = sum(math.log10((train[w] + 1) / (n + v + 1)) for w in toks)
        out.append((d, held(d), len(toks), sum(train[w] > 0 for w in toks), n, base))
    return out


def test_counts_and_base_score_equal_brute_force(spark):
    given = rows(3, 80)
    got = lattice.lattice_scores(clashing(docs(spark, 3, 80)), lattice.contract_held_out(), sent_words=20).collect()
    key = lambda r: (repr(r[:5]), round(r[5], 4))
    mine = sorted([(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got], key=key)
    want = sorted(brute_base(given), key=key)
    assert [x[:5] for x in mine] == [x[:5] for x in want]
    assert np.allclose([x[5] for x in mine], [x[5] for x in want])


def test_joined_and_sent_words_give_the_same_scores(spark):
    d = docs(spark, 3, 80)
    a = lattice.lattice_scores(d, lattice.contract_held_out(), sent_words=0).collect()
    b = lattice.lattice_scores(d, lattice.contract_held_out(), sent_words=100_000).collect()
    key = lambda r: (repr(r["doc_id"]), r["n_tokens"], round(r["score"], 1))
    assert np.allclose([r["score"] for r in sorted(a, key=key)], [r["score"] for r in sorted(b, key=key)], rtol=1e-5)


def test_token_distribution_is_proper(spark):
    """P_k over all known words and the end leaves exactly what spelled words get."""
    d = docs(spark, 3, 80)
    label, labels = lattice.label_index(d, F.lit(True), "lang")
    classes = 2 * labels
    df = lattice.count_words(d, label, F.lit(True), classes)
    words = df.filter(F.length("word") > 0).toPandas()
    t = lattice.Totals(df, classes)
    c = words[[f"c{k}" for k in range(classes)]].to_numpy().astype(float)
    p = np.exp(t.log_prob(c, np.full(c.shape, -np.inf))).sum(axis=0) + np.exp(
        t.log_prob(t.ends[None, :], np.full((1, classes), -np.inf))[0]
    )
    used = t.class_n > 0
    assert np.allclose((p + t.gamma * (1 - t.mu))[used], 1)


def test_held_out_score_beats_the_base(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = lattice.lattice_scores(d, lattice.contract_held_out()).filter("held_out").toPandas()
    assert len(got) > 100 and got["score"].sum() > got["base_score"].sum()


def test_empty_and_all_held_out(spark):
    assert lattice.lattice_scores(empty(spark), lattice.contract_held_out()).count() == 0
    got = lattice.lattice_scores(docs(spark, 1, 5), F.lit(True)).collect()
    assert len(got) == len(rows(1, 5)) and all(np.isfinite(r["score"]) and r["train_tokens"] == 0 for r in got)


def test_without_a_class_column(spark):
    d = spark.createDataFrame([(1, "a b a"), (2, None)], "doc_id long, text string")
    assert lattice.lattice_scores(d).count() == 2


def test_pieces_of_any_length_are_in_the_lattice():
    """A small vocabulary with long pieces, overlapping and of one beginning, against all paths."""
    p = lattice.Pieces(
        [b" ", b" a", b"a", b"b", b"abababab", b"ababababa", b"ababababab", b" abababab", b" babababababab", b"bbbbbbbbbbbbbbbbbbbb", b"ab"]
    )
    rng = np.random.default_rng(3)
    score = p.normal(rng.uniform(0.1, 1, (2, p.eow + 1)), 0.0)
    words = [b"ab" * 7, b"ba" * 7 + b"b", b"b" * 22, b"a" + b"b" * 25, b"abababa", b"ab" * 12]
    got = lattice.spell(words, p, score)
    for i, w in enumerate(words):
        for k in (0, 1):
            assert got[i, k] == pytest.approx(math.log(all_paths(w, p, score[k])))
    eps = 1e-5
    uses = lattice.expected_counts(words, np.zeros(len(words), int), p, score[:1])[0]
    for k in range(p.eow + 1):
        up, down = score[:1].copy(), score[:1].copy()
        up[0, k] += eps
        down[0, k] -= eps
        slope = (lattice.spell(words, p, up).sum() - lattice.spell(words, p, down).sum()) / (2 * eps)
        assert uses[k] == pytest.approx(slope, abs=1e-3)


def test_every_piece_changes_the_score_of_a_word_that_holds_it():
    """Each piece of the vocabulary file, whatever its length, as a word of its own (with a letter after it)."""
    p = lattice.load_pieces()
    assert max(map(len, p.entries)) > 2 * lattice.LONGEST
    score = p.start()[None, :]
    words = [x[1:] + b"q" if x[:1] == lattice.MARK else b"q" + x + b"q" for x in p.entries]
    before = lattice.spell(words, p, score)[:, 0]
    for part in range(4):  # a quarter of the pieces at a time: all others keep their scores
        without = score.copy()
        without[0, part : p.eow : 4] -= 3.0
        changed = lattice.spell(words, p, without)[:, 0] < before - 1e-12
        assert changed[part :: 4].all()
