import zlib

import numpy as np
import pytest
from cases import clashing, docs, empty, rows
from pyspark.sql import functions as F

from tagloom.llm import quality, toxicity

LABELS = "doc_id long, quality int, toxic int"
DIR = "/root/testdata/sf0.01"
LARGER = "/root/testdata/sf0.1"


def real(spark, folder=DIR):
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


@pytest.fixture(scope="module")
def quality_out(spark):
    d, labels = real(spark)
    return quality.quality_scores(d, labels).join(labels, "doc_id", "left").toPandas()


@pytest.fixture(scope="module")
def toxicity_out(spark):
    d, labels = real(spark, LARGER)  # some dozens of toxic documents are too few to learn their words
    return toxicity.toxicity_scores(d, labels).join(labels, "doc_id", "left").toPandas()


def held_out_accuracy(out, label):
    known = out[out["held_out"] & out[label].notna()]
    assert len(known) > 40
    return (known["predicted"] == known[label]).mean()


def test_quality_held_out_accuracy(quality_out):
    assert held_out_accuracy(quality_out, "quality") >= 0.95
    h = [zlib.crc32(str(d).encode()) % 5 == 0 for d in quality_out["doc_id"]]
    assert (quality_out["held_out"] == h).all()
    assert quality_out["score"].between(0, 1).all() and ((quality_out["score"] >= 0.3) == quality_out["predicted"]).all()


def test_toxicity_held_out_accuracy(toxicity_out):
    assert held_out_accuracy(toxicity_out, "toxic") >= 0.97
    h = [zlib.crc32(str(d).encode()) % 3 == 1 for d in toxicity_out["doc_id"]]
    assert (toxicity_out["held_out"] == h).all()
    assert toxicity_out["score"].between(0, 1).all() and ((toxicity_out["score"] >= 0.7) == toxicity_out["predicted"]).all()


def labels_for(spark, given):
    lab = [(r[0], i % 2, int(i % 5 == 0)) for i, r in enumerate(given)]
    return spark.createDataFrame(lab + [(None, 1, 1), (5, None, None), (7, 0, 0), (7, 1, 1), (99999, 1, 0)], LABELS)


@pytest.mark.parametrize("score", [quality.quality_scores, lambda d, lab: toxicity.toxicity_scores(d, lab, train_docs=20)])
def test_odd_rows_and_tables(spark, score):
    given = rows(1)
    d, labels = docs(spark, 1), labels_for(spark, given)
    out = score(clashing(d), labels).collect()
    assert len(out) == len(given) and all(0 <= r["score"] <= 1 for r in out)
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], set()).add(r["score"])
    assert len(by[5]) == 1  # repeated rows score alike
    assert score(empty(spark), labels).count() == 0
    none = score(d, labels.filter("false")).collect()
    assert {r["score"] for r in none} == {0.5}
    one_kind = score(d, labels.filter("toxic = 1").withColumn("quality", F.lit(1))).collect()
    assert len(one_kind) == len(given)


def test_scores_do_not_depend_on_other_columns(spark):
    d, labels = docs(spark, 1), labels_for(spark, rows(1))
    a = {(r["doc_id"], round(r["score"], 9)) for r in quality.quality_scores(d, labels).collect()}
    other = d.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("q"))
    assert a == {(r["doc_id"], round(r["score"], 9)) for r in quality.quality_scores(other, labels).collect()}


def test_rejected_documents_go(spark):
    d, labels = real(spark)
    kept = quality.keep_quality(clashing(d), labels)
    assert kept.columns == clashing(d).columns
    scored = quality.quality_scores(d, labels)
    want = {r["doc_id"] for r in scored.filter("predicted = 1").collect()}
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == want


def test_isotonic_is_the_closest_monotone_fit():
    rng = np.random.default_rng(0)
    y, w = rng.uniform(size=12), rng.integers(1, 5, 12).astype(float)
    fit = quality.isotonic(np.arange(12.0), y, w)
    assert (np.diff(fit) >= -1e-12).all()
    # against the min-max formula
    for i in range(12):
        want = max(min(np.average(y[a : b + 1], weights=w[a : b + 1]) for b in range(i, 12)) for a in range(i + 1))
        assert fit[i] == pytest.approx(want)


def test_normal_equations_equal_a_direct_fit(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, len(quality.STATISTICS)))
    y = (x[:, 0] > 0).astype(float)
    df = spark.createDataFrame([(r.tolist(), float(v), int(i % 4)) for i, (r, v) in enumerate(zip(x, y, strict=True))], "x array<double>, y double, part int")
    model = quality.fit(df.repartition(3), features=20)
    keep = np.arange(200) % 4 != 0
    z = model.fourier(x[keep])
    a = z.T @ z + np.eye(z.shape[1])
    a[0, 0] -= 1 - 1e-6
    assert np.allclose(model.beta, np.linalg.solve(a, z.T @ y[keep]), atol=1e-6)


def test_fourier_features_approximate_the_kernel():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(30, 5))
    f = quality.Fourier(np.zeros(5), np.ones(5), 20_000, 2.0, 0)
    z = f(x)[:, 6:]
    d2 = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    assert np.abs(z @ z.T - np.exp(-d2 / (2 * 4))).max() < 0.05


def test_network_gradients():
    rng = np.random.default_rng(0)
    net = toxicity.Network(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    proj = rng.normal(size=(6, 2, 3 * toxicity.HIDDEN)).astype(np.float64)
    idx, mask = rng.integers(0, 6, (3, 5)), np.ones((3, 5))
    mask[1, 3:] = 0
    _, kept = net.forward(proj, idx, mask, keep=True)
    g = rng.normal(size=3)
    grad, dproj = net.backward(idx, mask, kept, g, 6)
    loss = lambda: float(net.forward(proj, idx, mask) @ g)
    for name, table in [*((k, net.p[k]) for k in ("uh", "wa", "va", "wo", "bo")), ("proj", proj)]:
        want = dproj if name == "proj" else grad[name]
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in table.shape)
            old = table[at]
            table[at] = old + 1e-2
            up = loss()
            table[at] = old - 1e-2
            down = loss()
            table[at] = old
            assert want[at] == pytest.approx((up - down) / 2e-2, abs=3e-3, rel=3e-2), name


def test_windows_hold_every_word_and_match_single_scoring():
    for n in (0, 1, 23, 24, 25, 36, 37, 100):
        starts = toxicity.window_starts(n)
        seen = {i for a in starts for i in range(a, min(a + toxicity.WINDOW, n))}
        assert seen == set(range(n)) and len(starts) >= 1
    net = toxicity.Network(2)
    texts = [b"", b"one", b" ".join(b"w%d" % (i % 37) for i in range(200)), b"a b c"]
    s = toxicity.Scorer(net)
    together = s(texts)
    alone = [float(toxicity.Scorer(net)([t])[0]) for t in texts]
    assert np.allclose(together, alone, atol=1e-5)


def test_long_runs_are_read_whole():
    # a clause without spaces: every n-gram of it reaches the network, wherever it stands
    run = "这是一个没有空格的很长的句子用来检查中间的每一个字都会被读到而不只是开头和结尾的几个字".encode()
    for w in (run, bytes(97 + i * i % 26 for i in range(41)), b"ab" * 500, b"x" * 40):
        parts = toxicity.read_words(w)
        assert max(map(len, parts)) <= toxicity.LONGEST_WORD
        for n in (3, 4):
            assert {w[i : i + n] for i in range(len(w) - n + 1)} == {q[i : i + n] for q in parts for i in range(len(q) - n + 1)}
    net = toxicity.Network(2)
    net.p["ec"] *= 100
    one, other = toxicity.Scorer(net)([b"a" * 100 + b"kill" + b"a" * 100, b"a" * 100 + b"milk" + b"a" * 100])
    assert abs(one - other) > 1e-3


def test_long_training_documents_are_read_whole(spark, monkeypatch):
    # the passage of a long toxic document is in one place of some hundred windows
    rng = np.random.default_rng(0)
    texts, labels = [], []
    for i in range(60):
        ws = ["w%d" % k for k in rng.integers(0, 300, 1500)]
        if i % 2:
            ws[rng.integers(0, 1500)] = "poison"
        texts.append((i, " ".join(ws)))
        labels.append((i, 0, i % 2))
    d = spark.createDataFrame(texts, "doc_id long, text string")
    seen, trained = [], []
    calibrate, step = toxicity.calibrate, toxicity._step
    monkeypatch.setattr(toxicity, "calibrate", lambda logit, y: (seen.append(logit), calibrate(logit, y))[1])
    monkeypatch.setattr(toxicity, "_step", lambda net, opt, rng, some, *a: (trained.append(some), step(net, opt, rng, some, *a))[1])
    model = toxicity.fit(d, spark.createDataFrame(labels, LABELS), epochs=1)
    fold = [t.encode() for i, t in texts if zlib.crc32(str(i).encode()) % 5 == 0]
    whole = toxicity.Scorer(model.net)(fold)
    assert len(seen[0]) == len(fold) and np.allclose(seen[0], whole, atol=1e-5)
    # the highest windows of all windows, not of some
    text = texts[1][1].encode()
    ws = text.split()
    s = toxicity.Scorer(model.net)
    all_of = [b" ".join(ws[a : a + toxicity.WINDOW]) for a in toxicity.window_starts(len(ws))]
    best = s.chosen(text, 1)
    assert len(best) == toxicity.DOC_WINDOWS and s([best[0]])[0] == pytest.approx(s(all_of).max(), abs=1e-5)
    assert toxicity.sample_windows(d.select("doc_id", F.col("text").cast("binary").alias("text")), model.net)[1][0] == best[0]
    assert all(len(w) <= toxicity.STEP_WINDOWS for some in trained for w in some)
    assert len({w for turn in range(1, 60) for w in s.chosen(text, turn)}) > 0.9 * len(set(all_of))  # none is never drawn


def test_stretches_hold_the_windows_of_the_whole():
    for n in (0, 1, 24, 25, 36, 37, 100, 301):
        ws = list(range(n))
        parts = [p[a : a + toxicity.WINDOW] for p in toxicity.stretches(ws, 3) for a in toxicity.window_starts(len(p))]
        assert parts == [ws[a : a + toxicity.WINDOW] for a in toxicity.window_starts(n)]
