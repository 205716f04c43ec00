"""Quality classifier: random Fourier features, ridge, isotonic calibration.

Each text gives a short vector of statistics.  Random Fourier features
approximate a Gaussian kernel over the standardised vector; ridge regression
on them needs only the sums Z'Z and Z'y, which every task adds up over its own
rows before anything is shuffled.  The raw score is made monotone in the
label's frequency by isotonic regression on rows that the ridge fit did not
see, pooled on a fixed grid of raw scores.

All statistics come from the whole text and from nothing else.  Labels are
learned from every labelled row that is not held out.

Defined cases: a null or empty text has the statistics of the empty text and
gets the score of that point; rows without an id, or whose label is null, are
scored but teach nothing; several labels of one id count as their mean;
repeated rows are scored each; without labels every score is 0.5; other
columns of the documents pass through or are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import OWN, append_columns, doc_bucket, staged, text_bytes, with_package
from tagloom.operators.broadcast import maybe_broadcast

FEATURES = 384  # random Fourier features
WIDTH = 4.0  # of the kernel, in standard deviations
RIDGE = 1.0
GRID = 512  # cells of raw scores for the isotonic fit
CALIBRATION_PARTS = 4  # one part in so many of the learning rows calibrates
THRESHOLD = 0.3
SEED = 20240229

STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "letters", "upper", "digits", "spaces", "non_ascii", "stops", "symbols",
    "bars", "bangs", "lines", "line_words", "repeated_lines", "distinct_words", "same_as_last", "top_word",
    "word_end_symbol", "short_words", "capital_words",
)

_LETTERS = bytes(c for c in range(128) if chr(c).isalpha())
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_SPACE = b" \t\n\r\x0b\x0c"
_HIGH = bytes(range(128, 256))
_STOPS = b".,;:"
_SYMBOLS = b"#$%&*+/<=>@[\\]^_`{}~"
_BARS = b"|"
_BANGS = b"!?"
_END = re.compile(rb"[^0-9A-Za-z\x80-\xff.,;:](?=[ \t\n\r\x0b\x0c]|$)")
_CAPITAL = re.compile(rb"(?:^|(?<=[ \t\n\r\x0b\x0c]))[A-Z]")


def statistics(text: bytes) -> list[float]:
    """The STATISTICS of one text, each of moderate size."""
    size = len(text)
    if not size:
        return [0.0] * len(STATISTICS)

    def share(chars: bytes) -> float:
        return (size - len(text.translate(None, chars))) / size

    words = text.split()
    n = max(len(words), 1)
    lines = [x for x in text.split(b"\n") if x]
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    same = sum(map(bytes.__eq__, words[1:], words))
    return [
        float(np.log1p(size)),
        float(np.log1p(len(words))),
        min(sum(map(len, words)) / n, 50.0),
        share(_LETTERS),
        share(_UPPER),
        share(_DIGITS),
        share(_SPACE),
        share(_HIGH),
        share(_STOPS),
        share(_SYMBOLS),
        share(_BARS),
        share(_BANGS),
        len(lines) / n,
        float(np.log1p(n / max(len(lines), 1))),
        1 - len(set(lines)) / max(len(lines), 1),
        len(counts) / n,
        same / n,
        max(counts.values(), default=0) / n,
        len(_END.findall(text)) / n,
        sum(len(w) <= 3 for w in words) / n,
        len(_CAPITAL.findall(text)) / n,
    ]


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` and the OWN-prefixed column x: the statistics of each text."""

    def make():
        return lambda text: {"x": [statistics(t) for t in text]}

    return append_columns(docs, {"text": text_bytes(F.col(text_col))}, "x array<double>", make)


class Fourier:
    """Standardised statistics, a constant and cosines of random projections."""

    def __init__(self, mean: np.ndarray, std: np.ndarray, features: int, width: float, seed: int):
        rng = np.random.default_rng(seed)
        self.mean, self.std = mean, np.where(std > 1e-9, std, 1.0)
        self.w = rng.normal(0, 1 / width, (len(mean), features))
        self.b = rng.uniform(0, 2 * np.pi, features)
        self.scale = np.sqrt(2.0 / features)
        self.size = features + len(mean) + 1

    def __call__(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.std, -6, 6)
        return np.concatenate((np.ones((len(x), 1)), x, self.scale * np.cos(x @ self.w + self.b)), axis=1)


class Model:
    """Raw ridge scores and their isotonic calibration."""

    def __init__(self, fourier: Fourier | None = None, beta: np.ndarray | None = None):
        self.fourier, self.beta = fourier, beta
        self.at, self.value = np.zeros(1), np.full(1, 0.5)

    def raw(self, x: np.ndarray) -> np.ndarray:
        if self.beta is None or not len(x):
            return np.zeros(len(x))
        return self.fourier(x) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.at, self.value)


def isotonic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Non-decreasing values closest to ``y`` (weights ``n``) by pooling adjacent violators; ``x`` ascending."""
    blocks: list[list[float]] = []
    for v, w in zip(y.tolist(), n.tolist(), strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, k2 = blocks.pop()
            v1, w1, k1 = blocks[-1]
            blocks[-1] = [(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, k1 + k2]
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def _column(t: pa.RecordBatch, i: int) -> np.ndarray:
    return t.column(i).values.to_numpy().reshape(len(t), -1) if len(t) else np.zeros((0, 0))


def _summed(df: DataFrame, make_sums, rows: int, width: int) -> np.ndarray:
    """Sum of a (rows, width) array that every task fills from its own batches.

    A task hands on one record per row of the array; the records are summed by
    row on the executors, and the driver gets ``rows`` records.
    """

    def run(batches):
        f = make_sums()
        total = np.zeros((rows, width))
        some = False
        for b in batches:
            if len(b):
                total += f(b)
                some = True
        if some:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(rows, dtype=np.int32)), pa.array([r.tobytes() for r in total], type=pa.binary())],
                names=["row", "sums"],
            )

    def add(t: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x.as_py()).reshape(1, -1) for x in t.column(1)]
        total = np.concatenate(parts).sum(axis=0).tobytes()
        return pa.table({"row": t.column(0)[:1], "sums": pa.array([total], type=pa.binary())})

    parts = with_package(df).mapInArrow(run, "row int, sums binary")
    out = np.zeros((rows, width))
    for r in parts.groupBy("row").applyInArrow(add, "row int, sums binary").collect():
        out[r["row"]] = np.frombuffer(r["sums"])
    return out


def fit(rows: DataFrame, features: int = FEATURES, width: float = WIDTH, ridge: float = RIDGE, seed: int = SEED) -> Model:
    """Fit on ``rows``: x (statistics), y (label 0..1), part (0 calibrates, others fit).

    Three passes over narrow rows: moments, normal equations, calibration.
    """
    spark, d = rows.sparkSession, len(STATISTICS)
    rows = rows.select("x", F.col("y").cast("double"), F.col("part").cast("int"))

    def moments():
        def f(b):
            x = _column(b, 0)
            out = np.zeros((3, d))
            out[0, 0] = len(x)
            out[1], out[2] = x.sum(axis=0), (x * x).sum(axis=0)
            return out

        return f

    m = _summed(rows, moments, 3, d)
    n = m[0, 0]
    if not n:
        return Model()
    mean = m[1] / n
    fourier = Fourier(mean, np.sqrt(np.maximum(m[2] / n - mean**2, 0)), features, width, seed)
    size = fourier.size
    sent = spark.sparkContext.broadcast(fourier)

    def normal():
        phi = sent.value

        def f(b):
            out = np.zeros((size, size + 1))
            x, y, part = _column(b, 0), b.column(1).to_numpy(), b.column(2).to_numpy()
            for a in range(0, len(x), 4096):
                keep = part[a : a + 4096] != 0
                z, t = phi(x[a : a + 4096][keep]), y[a : a + 4096][keep]
                out[:, :size] += z.T @ z
                out[:, size] += z.T @ t
            return out

        return f

    s = _summed(rows, normal, size, size + 1)
    a = s[:, :size] + ridge * np.eye(size)
    a[0, 0] -= ridge * (1 - 1e-6)  # the constant is hardly shrunk
    model = Model(fourier, np.linalg.solve(a, s[:, size]))
    sent_model = spark.sparkContext.broadcast(model)
    lo, hi = -1.0, 2.0

    def cells():
        model = sent_model.value

        def f(b):
            out = np.zeros((2, GRID))
            x, y, part = _column(b, 0), b.column(1).to_numpy(), b.column(2).to_numpy()
            keep = part == 0
            r = model.raw(x[keep])
            k = np.clip(((r - lo) / (hi - lo) * GRID).astype(int), 0, GRID - 1)
            out[0], out[1] = np.bincount(k, minlength=GRID), np.bincount(k, weights=y[keep], minlength=GRID)
            return out

        return f

    c = _summed(rows, cells, 2, GRID)
    used = np.flatnonzero(c[0])
    if len(used):
        centre = lo + (used + 0.5) * (hi - lo) / GRID
        # each cell's share, drawn a little towards the raw score
        y = (c[1, used] + 0.5 * np.clip(centre, 0, 1)) / (c[0, used] + 0.5)
        model.at, model.value = centre, np.clip(isotonic(centre, y, c[0, used]), 0, 1)
    else:
        model.at, model.value = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def learning_rows(known: DataFrame, labels: DataFrame, label_col: str, held_out: F.Column) -> DataFrame:
    """Statistics, label and part of the labelled rows that are not held out."""
    y = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.avg(F.col(label_col).cast("double")).alias("y"))
    )
    part = F.pmod(F.xxhash64("doc_id"), F.lit(CALIBRATION_PARTS)).cast("int").alias("part")
    return known.filter(~held_out).join(y, "doc_id").select("x", "y", part)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    held_out: F.Column | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    held_out = doc_bucket(F.col("doc_id"), 5) == 0 if held_out is None else held_out
    x = with_statistics(docs.select(F.col("doc_id").cast("long"), "text"))
    known = staged(x.select("doc_id", F.col(OWN + "x").alias("x")), "quality-statistics")
    model = fit(staged(learning_rows(known, labels, label_col, held_out), "quality-learning"))
    scored = _score(known, model, "x")
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        F.col(OWN + "score").alias("score"),
        (F.col(OWN + "score") >= threshold).cast("int").alias("predicted"),
    )


def _score(df: DataFrame, model: Model, x_col: str) -> DataFrame:
    sent = df.sparkSession.sparkContext.broadcast(model)

    def make():
        model = sent.value

        def f(statistics):
            x = np.array(statistics, dtype=float).reshape(len(statistics), len(STATISTICS))
            return {"score": model.score(x)}

        return f

    return append_columns(df, {"statistics": F.col(x_col)}, "score double", make)


def keep_quality(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    held_out: F.Column | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, with the columns of ``docs``.

    Statistics of the learning rows are computed first and written (the fit
    reads them three times); the texts are then read once more to be scored.
    """
    held_out = doc_bucket(F.col("doc_id"), 5) == 0 if held_out is None else held_out
    ids = labels.filter(F.col(label_col).isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    ids, _ = maybe_broadcast(ids)  # while their measured size fits, no text is shuffled to find them
    taught = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(~held_out).join(ids, "doc_id", "left_semi")
    x = with_statistics(taught).select("doc_id", F.col(OWN + "x").alias("x"))
    model = fit(staged(learning_rows(x, labels, label_col, F.lit(False)), "quality-learning"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = sent.value

        def f(text):
            x = np.array([statistics(t) for t in text], dtype=float).reshape(len(text), len(STATISTICS))
            return {"score": model.score(x)}

        return f

    # statistics and score in one step: one Python worker for each running task
    scored = append_columns(docs, {"text": text_bytes(F.col("text"))}, "score double", make)
    return scored.filter(F.col(OWN + "score") >= threshold).select(*docs.columns)
