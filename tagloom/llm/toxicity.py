"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

Each word enters as two vectors: one of its hashed word bucket and the mean
over the buckets of its character n-grams.  A gated recurrent network reads a
window of words in both directions, attention pools its states, and a linear
layer gives the window's logit.  Every document is read whole, as overlapping
windows; its score comes from its highest window, calibrated on documents.

Training: a bounded sample of labelled documents (``TRAIN_DOCS`` of
label 1 and twice as many of label 0, chosen by a hash of the id) is written
as a table of whole texts, and the network, which is small, learns on the
driver.  The label is the document's: in each step the gradient goes to the
document's highest window.  For the first of ``ROUNDS`` rounds the driver gets
windows spread over each text; before each later one, tasks score all windows
of the sampled documents and send the highest of each, and others drawn from
all: labels taught by the highest alone do not leave an early wrong choice.
The calibrating part
is scored whole too, so its maxima and those of scoring are over the same
windows.  Scoring runs on all documents in tasks, which keep the input
projections of recent words.

Defined cases: a null or empty text has no word; its one window is empty and
gets the network's score of it; words of any length (in pieces of at
most ``LONGEST_WORD`` bytes) and documents of any number of windows are read
whole; rows without an id or label are scored and
teach nothing; several labels of one id count as their mean, rounded; repeated
rows are scored each; without labels of both kinds every score is the
smoothed share of label 1 (one half if there are none); other columns are not
read.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import doc_bucket, map_batches, staged, text_bytes
from tagloom.llm.decontam import words

WINDOW = 24
STRIDE = 12
WORD_BUCKETS = 1 << 16
CHAR_BUCKETS = 1 << 14
WORD_DIM = 8
CHAR_DIM = 12
HIDDEN = 8
ATTENTION = 8
LONGEST_WORD = 40  # bytes; longer runs are read as consecutive pieces
TRAIN_DOCS = 1000  # sampled documents of label 1, and twice as many of label 0
DOC_WINDOWS = 24  # windows of a sampled document in one round
STEP_WINDOWS = 8  # windows of a document that one training step reads, and highest ones chosen for a round
EPOCHS = 6
ROUNDS = 6  # choices of training windows; an epoch each, or more on small samples
SAMPLE_TASKS = 24  # tasks that score the sampled documents
LEAST_STEPS = 400
EMBED = 0.05  # spread of untrained vectors: a word never seen in training says little
DECAY = 0.05  # of the vectors that a step touches, times the rate
DROP = 0.5  # share of a step's words read by their characters alone
BATCH_DOCS = 32
RATE = 0.01
MEMORY_WORDS = 200_000  # words whose projections a worker keeps
THRESHOLD = 0.7
SEED = 7


# --- words ---------------------------------------------------------------------


def read_words(text: bytes) -> list[bytes]:
    """The words of a text; a run over ``LONGEST_WORD`` bytes (a clause without spaces, glued words) is
    read as consecutive pieces, which share 3 bytes, so every n-gram of the run is in one of them."""
    ws = words(text)
    if max(map(len, ws), default=0) <= LONGEST_WORD:
        return ws
    step = LONGEST_WORD - 3
    return [w[a : a + LONGEST_WORD] for w in ws for a in range(0, max(1, len(w) - 3), step)]


def grams(word: bytes) -> list[int]:
    """Buckets of the n-grams (3 and 4 bytes) of a word with its boundaries."""
    w = b"<" + word + b">"
    out = [zlib.crc32(w[i : i + 3]) & (CHAR_BUCKETS - 1) for i in range(len(w) - 2)]
    out += [zlib.crc32(w[i : i + 4], 1) & (CHAR_BUCKETS - 1) for i in range(len(w) - 3)]
    return out


def word_bucket(word: bytes) -> int:
    return zlib.crc32(word, 2) & (WORD_BUCKETS - 1)


def window_starts(n: int, window: int = WINDOW, stride: int = STRIDE) -> range:
    """Starts of overlapping windows that together hold all ``n`` words (one at least)."""
    return range(0, max(1, n - window + stride), stride)


# --- network -------------------------------------------------------------------


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Network:
    """Parameters by name; two directions are the leading axis of wx, uh and b."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        d, h = WORD_DIM + CHAR_DIM, HIDDEN
        r = lambda *shape, s: rng.normal(0, s, shape).astype(np.float32)
        self.p = {
            "ew": r(WORD_BUCKETS, WORD_DIM, s=EMBED),
            "ec": r(CHAR_BUCKETS, CHAR_DIM, s=EMBED),
            "wx": r(2, d, 3 * h, s=0.5),
            "uh": r(2, h, 3 * h, s=0.3),
            "b": np.zeros((2, 3 * h), np.float32),
            "wa": r(2 * h, ATTENTION, s=0.3),
            "va": r(ATTENTION, s=0.3),
            "wo": r(2 * h, s=0.3),
            "bo": np.full(1, -1.0, np.float32),
        }

    def word_vectors(self, ws: list[bytes]) -> np.ndarray:
        """Input vectors (words, dimensions)."""
        out = np.empty((len(ws), WORD_DIM + CHAR_DIM), np.float32)
        if not ws:
            return out
        out[:, :WORD_DIM] = self.p["ew"][[word_bucket(w) for w in ws]]
        gs = [grams(w) for w in ws]
        n = np.array([len(g) for g in gs])
        flat = self.p["ec"][[x for g in gs for x in g]]
        out[:, WORD_DIM:] = np.add.reduceat(flat, np.concatenate(([0], n.cumsum()[:-1])), axis=0) / n[:, None]
        return out

    def project(self, x: np.ndarray) -> np.ndarray:
        """(words, 2 directions, 3 gates x hidden)."""
        k, d, g = self.p["wx"].shape
        return (x @ self.p["wx"].transpose(1, 0, 2).reshape(d, k * g)).reshape(len(x), k, g) + self.p["b"]

    def forward(self, proj: np.ndarray, idx: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows: ``idx`` (windows, places) picks rows of ``proj``; ``mask`` is 0 on padding."""
        p, h, (n, t) = self.p, HIDDEN, idx.shape
        states = np.empty((t, n, 2 * h), np.float32)
        trace = []
        full = [bool(m.all()) for m in mask.T]
        for k in (0, 1):
            s = np.zeros((n, h), np.float32)
            for i in range(t) if k == 0 else range(t - 1, -1, -1):
                x, u = proj[idx[:, i], k], s @ p["uh"][k]
                zr = sigmoid(x[:, : 2 * h] + u[:, : 2 * h])
                z, r = zr[:, :h], zr[:, h:]
                c = np.tanh(x[:, 2 * h :] + r * u[:, 2 * h :])
                new = c + z * (s - c)
                if not full[i]:
                    new = np.where(mask[:, i, None] > 0, new, s)
                if keep:
                    trace.append((k, i, s, z, r, c, u[:, 2 * h :]))
                s = new
                states[i, :, k * h : (k + 1) * h] = s
        a = np.tanh(states @ p["wa"])
        e = a @ p["va"]
        e = np.where(mask.T > 0, e, -1e9)
        w = np.exp(e - e.max(axis=0))
        w /= w.sum(axis=0)
        pooled = (w[:, :, None] * states).sum(axis=0)
        logit = pooled @ p["wo"] + p["bo"][0]
        return (logit, (states, trace, a, w, pooled)) if keep else logit

    def backward(self, idx, mask, kept, g: np.ndarray, words_n: int):
        """Gradients of all parameters but the vectors, and of ``proj``, for gradients ``g`` of the logits."""
        p, h = self.p, HIDDEN
        states, trace, a, w, pooled = kept
        grad = {"wo": pooled.T @ g, "bo": np.array([g.sum()])}
        dp = g[:, None] * p["wo"]
        ds = w[:, :, None] * dp
        dw = (states * dp).sum(axis=2)
        de = w * (dw - (w * dw).sum(axis=0))
        grad["va"] = np.einsum("tn,tna->a", de, a)
        da = de[:, :, None] * p["va"] * (1 - a * a)
        grad["wa"] = np.einsum("tns,tna->sa", states, da)
        ds = ds + da @ p["wa"].T
        dproj = np.zeros((words_n, 2, 3 * h), np.float32)
        grad["uh"] = np.zeros_like(p["uh"])
        carry = None
        for k, i, s, z, r, c, un in reversed(trace):
            if carry is None or carry[0] != k:
                carry = (k, np.zeros_like(s))
            dh = carry[1] + ds[i, :, k * h : (k + 1) * h]
            m = mask[:, i, None]
            dn = dh * m
            dc = dn * (1 - z) * (1 - c * c)
            dz = dn * (s - c) * z * (1 - z)
            dr = dc * un * r * (1 - r)
            du = np.concatenate((dz, dr, dc * r), axis=1)
            dx = np.concatenate((dz, dr, dc), axis=1)
            np.add.at(dproj[:, k], idx[:, i], dx)
            grad["uh"][k] += s.T @ du
            carry = (k, dh * (1 - m) + dn * z + du @ p["uh"][k].T)
        return grad, dproj


class Adam:
    def __init__(self, p: dict, rate: float):
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}
        self.rate, self.t = rate, 0

    def step(self, p: dict, grads: dict, rows: dict) -> None:
        """``rows``: for tables, the rows their gradients are of."""
        self.t += 1
        fix = np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, g in grads.items():
            at = rows.get(k, slice(None))
            self.m[k][at] = m = 0.9 * self.m[k][at] + 0.1 * g
            self.v[k][at] = v = 0.999 * self.v[k][at] + 0.001 * g * g
            p[k][at] -= (self.rate * (fix * m / (np.sqrt(v) + 1e-8) + (DECAY * p[k][at] if k in rows else 0))).astype(np.float32)


def windows_of(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window index and mask arrays of several word id sequences, and the first window of each.

    Id 0 pads.  An empty sequence is one window of one padding word.
    """
    starts = [np.arange(window_starts(len(x)).start, window_starts(len(x)).stop, STRIDE) for x in ids]
    first = np.concatenate(([0], np.cumsum([len(s) for s in starts])))
    longest = max([min(WINDOW, max(len(x), 1)) for x in ids])
    base = np.concatenate(([0], np.cumsum([len(x) for x in ids])))
    flat = np.concatenate([*ids, [0]]).astype(np.int64)
    at = np.concatenate([s + b for s, b in zip(starts, base, strict=False)])
    end = np.concatenate([np.full(len(s), b) for s, b in zip(starts, base[1:], strict=True)])
    place = at[:, None] + np.arange(longest)
    mask = place < end[:, None]
    idx = np.where(mask, flat[np.minimum(place, len(flat) - 1)], 0)
    mask[:, 0] = True
    return idx, mask.astype(np.float32), first


def stretches(ws: list[bytes], windows: int = 4096):
    """Parts of a word sequence whose windows, one after the other, are those of the whole."""
    n = len(window_starts(len(ws)))
    for a in range(0, n, windows):
        last = min(n, a + windows) - 1
        yield ws[a * STRIDE : last * STRIDE + WINDOW]


def train(docs: list[tuple[list[bytes], int]], epochs: int = EPOCHS, seed: int = SEED, choose=None) -> Network:
    """Fit on (texts of windows, label) of documents; small samples get more epochs, ``LEAST_STEPS`` in all.

    A step reads up to ``STEP_WINDOWS`` windows of each of its documents.
    ``choose(network, round)`` gives the documents' windows for each round but the first.
    """
    net = Network(seed)
    rng = np.random.default_rng(seed)
    ys = np.array([y for _, y in docs], dtype=np.float32)
    weight = np.where(ys > 0, 0.5 / max(ys.mean(), 1e-6), 0.5 / max(1 - ys.mean(), 1e-6))
    opt = Adam(net.p, RATE)
    per_epoch = max(1, len(docs) // BATCH_DOCS)
    epochs = max(epochs, -(-LEAST_STEPS // per_epoch))
    windows = [ws for ws, _ in docs]
    for turn, part in enumerate(np.array_split(np.arange(epochs), min(ROUNDS, epochs))):
        if turn and choose:
            windows = choose(net, turn)
        vocab: dict[bytes, int] = {}
        seqs = [[np.array([vocab.setdefault(w, len(vocab) + 1) for w in x.split()], dtype=np.int64) for x in ws] for ws in windows]
        ws = [b"", *vocab]  # id 0 pads
        buckets = np.array([word_bucket(w) for w in ws])
        bags = [grams(w) for w in ws]
        sizes = np.array([len(b) for b in bags])
        starts = np.concatenate(([0], sizes.cumsum()[:-1]))
        flat = np.array([x for b in bags for x in b], dtype=np.int64)
        for epoch in part.tolist():
            opt.rate = RATE * (1 - epoch / epochs * 0.8)
            for at in np.array_split(rng.permutation(len(docs)), per_epoch):
                some = [[seqs[d][k] for k in rng.permutation(len(seqs[d]))[:STEP_WINDOWS]] for d in at]
                _step(net, opt, rng, some, ys[at], weight[at] / len(at), buckets, flat, starts, sizes)
    return net


def _step(net, opt, rng, some, y, weight, buckets, flat, starts, sizes) -> None:
    """One gradient step on documents given as lists of windows (arrays of word ids)."""
    ids = [x for windows in some for x in windows]
    first = np.concatenate(([0], np.cumsum([len(w) for w in some])))
    idx = np.zeros((len(ids), max(1, *(len(x) for x in ids)) if len(ids) > 1 else max(1, len(ids[0]))), np.int64)
    for k, x in enumerate(ids):
        idx[k, : len(x)] = x
    mask = (idx > 0).astype(np.float32)
    mask[:, 0] = 1
    used, inv = np.unique(idx, return_inverse=True)
    inv = inv.reshape(idx.shape)
    # n-grams of the used words, one after the other
    n = sizes[used]
    begin = np.concatenate(([0], n.cumsum()[:-1]))
    gram = flat[np.repeat(starts[used] - begin, n) + np.arange(n.sum())]
    x = np.empty((len(used), WORD_DIM + CHAR_DIM), np.float32)
    heard = rng.random(len(used)) >= DROP
    x[:, :WORD_DIM] = net.p["ew"][buckets[used]] * heard[:, None]
    x[:, WORD_DIM:] = np.add.reduceat(net.p["ec"][gram], begin, axis=0) / np.maximum(n, 1)[:, None]
    x[used == 0] = 0
    proj = net.project(x)
    # the highest window of each document is found first and gets the gradient
    logit = net.forward(proj, inv, mask)
    best = np.array([a + int(np.argmax(logit[a:b])) for a, b in zip(first, first[1:], strict=False)])
    _, kept = net.forward(proj, inv[best], mask[best], keep=True)
    g = ((sigmoid(logit[best]) - y) * weight).astype(np.float32)
    grad, dproj = net.backward(inv[best], mask[best], kept, g, len(used))
    grad["wx"] = np.einsum("nd,nkg->kdg", x, dproj)
    grad["b"] = dproj.sum(axis=0)
    dx = np.einsum("nkg,kdg->nd", dproj, net.p["wx"])
    dx[used == 0] = 0
    dx[~heard, :WORD_DIM] = 0
    touched = np.unique(inv[best])  # only words of the best windows have gradients
    rows = {}
    rows["ew"], to = np.unique(buckets[used[touched]], return_inverse=True)
    grad["ew"] = np.zeros((len(rows["ew"]), WORD_DIM), np.float32)
    np.add.at(grad["ew"], to, dx[touched, :WORD_DIM])
    m = n[touched]
    mine = gram[np.repeat(begin[touched] - np.concatenate(([0], m.cumsum()[:-1])), m) + np.arange(m.sum())]
    rows["ec"], to = np.unique(mine, return_inverse=True)
    grad["ec"] = np.zeros((len(rows["ec"]), CHAR_DIM), np.float32)
    np.add.at(grad["ec"], to, np.repeat(dx[touched, WORD_DIM:] / np.maximum(m, 1)[:, None], m, axis=0))
    opt.step(net.p, grad, rows)


class Scorer:
    """Highest window logit of texts; keeps the projections of recent words."""

    def __init__(self, net: Network):
        self.net = net
        self._forget()

    def _forget(self):
        self.place: dict[bytes, int] = {}
        self.proj = np.zeros((1024, 2, 3 * HIDDEN), np.float32)
        self.proj[0] = self.net.p["b"]
        self.n = 1

    def _learn(self, ws: set[bytes]) -> None:
        new = [w for w in ws if w not in self.place]
        if self.n + len(new) > MEMORY_WORDS and self.n > 1:
            self._forget()
            new = list(ws)
        if not new:
            return
        end = self.n + len(new)
        if end > len(self.proj):
            more = np.zeros((max(end, 2 * len(self.proj)), 2, 3 * HIDDEN), np.float32)
            more[: self.n] = self.proj[: self.n]
            self.proj = more
        for a in range(0, len(new), 4096):
            part = new[a : a + 4096]
            self.proj[self.n + a : self.n + a + len(part)] = self.net.project(self.net.word_vectors(part))
        self.place.update(zip(new, range(self.n, end), strict=True))
        self.n = end

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        out, held, size = [], [], 0
        for t in texts:
            ws = read_words(t)
            held.append(ws)
            size += len(ws)
            if size >= 40_000:
                out.append(self._some(held))
                held, size = [], 0
        if held:
            out.append(self._some(held))
        return np.concatenate(out) if out else np.zeros(0)

    def chosen(self, text: bytes, turn: int) -> list[bytes]:
        """The ``STEP_WINDOWS`` windows with the highest logits of all windows of a text, highest first, and
        some of the others, drawn anew in each turn, ``DOC_WINDOWS`` in all."""
        ws = read_words(text)
        logit = np.concatenate([self._logits([part])[0] for part in stretches(ws)])
        starts = window_starts(len(ws))
        order = np.argsort(-logit, kind="stable")
        others = np.random.default_rng((zlib.crc32(text), turn)).permutation(order[STEP_WINDOWS:])
        at = np.concatenate((order[:STEP_WINDOWS], others[: DOC_WINDOWS - STEP_WINDOWS])).tolist()
        return [b" ".join(ws[starts[i] : starts[i] + WINDOW]) for i in at]

    def _some(self, docs: list[list[bytes]]) -> np.ndarray:
        logit, first = self._logits(docs)
        return np.maximum.reduceat(logit, first[:-1])

    def _logits(self, docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Logits of all windows, and the first window of each document."""
        self._learn(set().union(*docs))
        get = self.place.__getitem__
        ids = [np.fromiter(map(get, ws), dtype=np.int64, count=len(ws)) for ws in docs]
        idx, mask, first = windows_of(ids)
        logit = np.empty(len(idx), np.float32)
        for a in range(0, len(idx), 2048):
            logit[a : a + 2048] = self.net.forward(self.proj, idx[a : a + 2048], mask[a : a + 2048])
        return logit, first


def calibrate(logit: np.ndarray, y: np.ndarray, rounds: int = 200) -> tuple[float, float]:
    """Slope and intercept of the documents' scores, by a few regularised Newton steps."""
    a, b = 1.0, 0.0
    x = np.clip(logit.astype(float), -15, 15)
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-(a * x + b)))
        g = np.array([((q - y) * x).sum() + 0.1 * (a - 1), (q - y).sum() + 0.01 * b])
        s = q * (1 - q)
        h = np.array([[(s * x * x).sum() + 0.1, (s * x).sum()], [(s * x).sum(), s.sum() + 0.01]])
        step = np.linalg.solve(h + 1e-6 * np.eye(2), g)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)


# --- on Spark ------------------------------------------------------------------


class Model:
    def __init__(self, net: Network | None, slope: float, intercept: float):
        self.net, self.slope, self.intercept = net, slope, intercept

    def scores(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logit.astype(float) + self.intercept, -40, 40)))


def training_sample(docs: DataFrame, labels: DataFrame, label_col: str, held_out: F.Column, train_docs: int) -> DataFrame:
    """doc_id, y and whole text of up to ``train_docs`` documents of label 1 and twice as many of label 0."""
    y = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.round(F.avg(F.col(label_col).cast("double"))).cast("int").alias("y"))
    )
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).filter(~held_out)
    known = y.join(ids.distinct(), "doc_id", "left_semi")
    chosen = None
    for v in (0, 1):
        part = known.filter(F.col("y") == v).orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(train_docs * (2 - v))
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes(F.col("text")).alias("text"))
    texts = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "text").dropDuplicates(["doc_id"])
    return staged(texts.repartition(SAMPLE_TASKS, "doc_id"), "toxicity-sample")


def spread_windows(text: bytes) -> list[bytes]:
    """Up to ``DOC_WINDOWS`` windows, evenly over the text."""
    ws = read_words(text)
    starts = window_starts(len(ws))
    if len(starts) > DOC_WINDOWS:
        starts = [starts[i] for i in np.linspace(0, len(starts) - 1, DOC_WINDOWS).astype(int)]
    return [b" ".join(ws[a : a + WINDOW]) for a in starts]


def sample_windows(sample: DataFrame, net: Network | None, turn: int = 0) -> dict[int, list[bytes]]:
    """Windows of each sampled document, chosen from all by the network; without one, spread over the text."""
    sent = sample.sparkSession.sparkContext.broadcast(net)

    def make():
        scorer = Scorer(sent.value) if sent.value else None

        def f(b):
            ts = b.column(1).to_pylist()
            yield {"doc_id": b.column(0), "windows": [scorer.chosen(t, turn) if scorer else spread_windows(t) for t in ts]}

        return f

    got = map_batches(sample.select("doc_id", "text"), make, "doc_id long, windows array<binary>").collect()
    sent.destroy()
    return {r["doc_id"]: [bytes(x) for x in r["windows"]] for r in got}


def sample_logits(sample: DataFrame, net: Network) -> dict[int, float]:
    """Highest logit over all windows of each sampled document."""
    sent = sample.sparkSession.sparkContext.broadcast(net)

    def make():
        scorer = Scorer(sent.value)

        def f(b):
            yield {"doc_id": b.column(0), "logit": scorer(b.column(1).to_pylist()).astype(float)}

        return f

    got = map_batches(sample.select("doc_id", "text"), make, "doc_id long, logit double").collect()
    sent.destroy()
    return {r["doc_id"]: r["logit"] for r in got}


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    held_out: F.Column | None = None,
    train_docs: int = TRAIN_DOCS,
    epochs: int = EPOCHS,
) -> Model:
    held_out = F.lit(False) if held_out is None else held_out
    sample = training_sample(docs, labels, label_col, held_out, train_docs)
    rows = sorted((r["doc_id"], r["y"]) for r in sample.select("doc_id", "y").collect())
    y = np.array([r[1] for r in rows])
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 0.5) / (len(y) + 1)
        return Model(None, 0.0, float(np.log(share / (1 - share))))
    # one part in five calibrates
    calibrates = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    part = np.array([zlib.crc32(str(d).encode()) % 5 for d, _ in rows])
    learn = [r for r, k in zip(rows, part, strict=True) if k]
    fold = [r for r, k in zip(rows, part, strict=True) if not k]

    def choose(net, turn):
        got = sample_windows(sample.filter(~calibrates), net, turn)
        return [got[d] for d, _ in learn]

    net = train([(w, v) for w, (_, v) in zip(choose(None, 0), learn, strict=True)], epochs, choose=choose)
    whole = len({v for _, v in fold}) < 2
    got = sample_logits(sample if whole else sample.filter(calibrates), net)
    fold = rows if whole else fold
    slope, intercept = calibrate(np.array([got[d] for d, _ in fold]), np.array([v for _, v in fold]))
    return Model(net, slope, intercept)


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    held_out: F.Column | None = None,
    threshold: float = THRESHOLD,
    train_docs: int = TRAIN_DOCS,
) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; learns from rows not held out."""
    held_out = doc_bucket(F.col("doc_id"), 3) == 1 if held_out is None else held_out
    model = fit(docs, labels, label_col, held_out, train_docs)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = sent.value
        scorer = Scorer(model.net) if model.net else None

        def f(b):
            logit = scorer(b.column(2).to_pylist()) if scorer else np.zeros(len(b))
            s = model.scores(logit)
            yield {"doc_id": b.column(0), "held_out": b.column(1), "score": s, "predicted": (s >= threshold).astype(int)}

        return f

    given = docs.select(F.col("doc_id").cast("long"), held_out, text_bytes(F.col("text")))
    return map_batches(given, make, "doc_id long, held_out boolean, score double, predicted int")
