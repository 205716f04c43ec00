"""Subword lattice likelihood of whole documents.

An existing subword vocabulary gives the pieces and their first scores (by
its order).  A word is spelled by any sequence of pieces that joins to it;
the probability of a spelling is the sum over all its segmentations, found by
a forward recursion in log space.  Piece scores are refitted to the corpus by
expectation-maximisation over the distinct words of the training documents.

Whole words seen in training are entries of the vocabulary too.  With
absolute discounting, what a word's count gives up pays for words that are
spelled.  The scores depend on a document's class (its language, by default,
and whether many of its bytes are signs).  A training document's class is
known; when a text is scored it is not, and the document probability is the
marginal over classes and segmentations,

    P(text) = sum_k pi_k * prod over tokens P_k(token),   tokens = words, end
    P_k(w)  = max(c_k(w) - d_k, 0) / N_k
              + gamma_k * (mu * c(w) / N + (1 - mu) * S_k(w)),

where S_k is the lattice probability of the spelling.  Each P_k sums to one
at most over all tokens, so scores are true log probabilities.

On Spark: words are counted per task and summed by one shuffle; all distinct
words are scored once, wherever they are; the most frequent (a fixed number)
are sent to the tasks that read the texts, all others meet their documents
through a join on the word.  No word is left out, and no word that is joined
is frequent enough to be a hot key.

Defined cases: a null or empty text is its end token alone; null ids and null
classes count as empty text; repeated rows count as often as they occur; an
empty training set scores words by the unfitted pieces; tokens of any length
are scored whole; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import doc_bucket, map_batches, staged, text_bytes
from tagloom.llm.tokens import tokenizer_path

PIECES = "piece_bpe_32k.model"
LONGEST = 8  # bytes of a span that is looked up in the packed table; longer pieces are edges of their own
MAX_LABELS = 8  # the largest labels are classes of their own, the rest share one
SIGNS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,")
MANY_SIGNS = 0.05  # share of a text's bytes
SENT_WORDS = 200_000  # words sent to the tasks; the rest is joined
HELD_WORDS = 400_000  # distinct words a task counts before it hands them on
NEAR_TOKENS = 30_000  # tokens counted together before they join the task's counts
EM_ROUNDS = 2
MARK = b" "  # stands before the first byte of a word; words hold no white space
END_BACKOFF = 1e-3  # share of the backoff for the end token
PRIOR = 20.0  # weight of the first scores in each refit
EM_DISCOUNT = 0.5  # taken from every expected count, so rare pieces give way to common ones


# --- pieces and lattices -----------------------------------------------------


class PieceTable:
    """Ids of many byte strings of up to 8 bytes at a time, by an open hash table in arrays."""

    BITS = 18

    def __init__(self, entries: list[bytes]):
        size = 1 << self.BITS
        if len(entries) * 4 > size:
            raise ValueError("too many pieces")
        self.key, self.length = np.zeros(size, np.uint64), np.zeros(size, np.uint8)
        self.none = len(entries) + 1
        self.id = np.full(size, self.none, np.int32)
        for i, p in enumerate(entries):
            if not p:  # no entry
                continue
            k = np.array([int.from_bytes(p, "little")], np.uint64)
            at = int(self.slot(k, len(p))[0])
            while self.length[at]:
                at = (at + 1) % size
            self.key[at], self.length[at], self.id[at] = k[0], len(p), i

    def slot(self, key: np.ndarray, length: int) -> np.ndarray:
        h = (key ^ np.uint64(length * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
        return ((h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def __call__(self, key: np.ndarray, length: int) -> np.ndarray:
        """Id of each packed string of ``length`` bytes, ``none`` where it is no entry."""
        at = self.slot(key, length)
        out = np.full(key.shape, self.none, np.int32)
        hit = (self.key[at] == key) & (self.length[at] == length)
        np.copyto(out, self.id[at], where=hit)
        more = ~hit & (self.length[at] > 0)  # another string's place: look at the next ones
        where = np.nonzero(more)
        at = at[where]
        while len(at):
            at = (at + 1) % len(self.key)
            hit = (self.key[at] == key[where]) & (self.length[at] == length)
            out[tuple(w[hit] for w in where)] = self.id[at[hit]]
            go = ~hit & (self.length[at] > 0)
            at, where = at[go], tuple(w[go] for w in where)
        return out


class Pieces:
    """Piece bytes, and log scores per class; the last id stands for no piece.

    First pieces of a word (they begin with MARK) and later ones are two
    distributions; the end of a word is an entry of the second.
    """

    def __init__(self, entries: list[bytes]):
        self.entries = entries
        self.ids = {p: i for i, p in enumerate(entries)}
        self.eow = len(entries)
        self.none = self.eow + 1
        self.first = np.array([p[:1] == MARK for p in entries] + [False])
        self.table = PieceTable([p if len(p) <= LONGEST else b"" for p in entries])
        # longer pieces by their first bytes
        self.long: dict[int, list[tuple[bytes, int]]] = {}
        for i, p in enumerate(entries):
            if len(p) > LONGEST:
                self.long.setdefault(int.from_bytes(p[:LONGEST], "little"), []).append((p, i))
        self.long_heads = np.array(sorted(self.long), dtype=np.uint64)

    def long_edges(self, words: list[bytes]) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """Spans of equally long words that are longer pieces: (start, end, rows, ids), by start and end."""
        n = len(words[0])
        if n <= LONGEST or not len(self.long_heads):
            return []
        chars = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), n).astype(np.uint64)
        key = np.zeros((len(words), n - LONGEST), np.uint64)
        for i in range(LONGEST):
            key |= chars[:, i : i + n - LONGEST] << np.uint64(8 * i)
        at = np.minimum(np.searchsorted(self.long_heads, key), len(self.long_heads) - 1)
        found: dict[tuple[int, int], list] = {}
        for row, a in np.argwhere(self.long_heads[at] == key).tolist():
            for p, i in self.long[int(key[row, a])]:
                if words[row].startswith(p, a):
                    found.setdefault((a, a + len(p)), []).append((row, i))
        return [(a, b, *np.array(x).T) for (a, b), x in sorted(found.items())]

    def start(self) -> np.ndarray:
        """Scores by the vocabulary's own order, normalised in both distributions."""
        return self.normal(1.0 / (np.arange(self.eow + 1) + 2.0), 0.0)

    def normal(self, weight: np.ndarray, prior: float) -> np.ndarray:
        """Log scores from weights (..., pieces), smoothed by the order's scores."""
        out = np.array(weight, dtype=float)
        for part in (self.first, ~self.first):
            w = out[..., part]
            if prior:
                zipf = 1.0 / (np.flatnonzero(part) + 2.0)
                w = w + prior * zipf / zipf.sum()
            out[..., part] = w / w.sum(axis=-1, keepdims=True)
        return np.log(out)


def load_pieces(path: str | None = None) -> Pieces:
    """Pieces of a public vocabulary file in its order, of every length, with every single byte and the bare mark."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path or tokenizer_path(PIECES))
    seen: dict[bytes, None] = {}
    for i in range(m.get_piece_size()):
        if m.is_control(i) or m.is_unknown(i) or m.is_byte(i):
            continue
        p = m.id_to_piece(i).replace("▁", " ").encode()
        if p.rfind(MARK) <= 0:
            seen[p] = None
    for b in [MARK] + [bytes([c]) for c in range(256)]:
        seen.setdefault(b)
    return Pieces(list(seen))


def spans_of(length: int, longest: int) -> list[tuple[int, int]]:
    """All (start, end) of at most ``longest`` bytes, by end and then start."""
    return [(a, b) for b in range(1, length + 1) for a in range(max(0, b - longest), b)]


def lattice_ids(words: list[bytes], pieces: Pieces, longest: int = LONGEST) -> np.ndarray:
    """Piece ids of all spans of equally long words: (words, spans)."""
    n = len(words[0])
    place = {s: i for i, s in enumerate(spans_of(n, longest))}
    chars = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), n).astype(np.uint64)
    out = np.empty((len(words), len(place)), np.int32)
    key = np.zeros((len(words), n), np.uint64)
    for size in range(1, min(longest, n) + 1):
        starts = n - size + 1
        key = key[:, :starts] | (chars[:, size - 1 :] << np.uint64(8 * (size - 1)))
        out[:, [place[a, a + size] for a in range(starts)]] = pieces.table(key, size)
    return out


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def forward(edge: np.ndarray, length: int, longest: int = LONGEST, long: list = ()) -> list[np.ndarray]:
    """Log of the summed weight of all paths to each place; ``edge``: (spans, ...) log scores.

    ``long``: further edges (start, end, rows, scores of those rows).
    """
    alpha = [np.zeros(edge.shape[1:])]
    into: dict[int, list] = {}
    for a, b, rows, s in long:
        into.setdefault(b, []).append((a, rows, s))
    at = 0
    for b in range(1, length + 1):
        a0 = max(0, b - longest)
        alpha.append(log_sum(np.stack(alpha[a0:b]) + edge[at : at + b - a0], 0))
        at += b - a0
        for a, rows, s in into.get(b, ()):  # a row has one piece from a to b
            alpha[b][rows] = np.logaddexp(alpha[b][rows], alpha[a][rows] + s)
    return alpha


def backward(edge: np.ndarray, length: int, longest: int = LONGEST, long: list = ()) -> list[np.ndarray]:
    """Log of the summed weight of all paths from each place to the end."""
    out_of: dict[int, list] = {}
    for a, b, rows, s in long:
        out_of.setdefault(a, []).append((b, rows, s))
    start = np.cumsum([0] + [b - max(0, b - longest) for b in range(1, length + 1)])
    beta: list = [None] * length + [np.zeros(edge.shape[1:])]
    for a in range(length - 1, -1, -1):
        ends = range(a + 1, min(length, a + longest) + 1)
        rows = [start[b - 1] + a - max(0, b - longest) for b in ends]
        beta[a] = log_sum(np.stack([beta[b] for b in ends]) + edge[rows], 0)
        for b, some, s in out_of.get(a, ()):
            beta[a][some] = np.logaddexp(beta[a][some], beta[b][some] + s)
    return beta


def by_length(words: list[bytes], most: int = 2048):
    """Places of equally long words, some at a time (fewer of long ones)."""
    order: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        order.setdefault(len(w), []).append(k)
    for n, ks in order.items():
        step = max(1, min(most, 40_000 // (n + 1)))
        for i in range(0, len(ks), step):
            yield n, ks[i : i + step]


def spell(words: list[bytes], pieces: Pieces, score: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Log probability of each word's spelling in each class: (words, classes)."""
    out = np.empty((len(words), score.shape[0]))
    wide = np.concatenate([score.T, np.full((1, score.shape[0]), -np.inf)])
    marked = [MARK + w for w in words]
    for n, ks in by_length(marked):
        ws = [marked[k] for k in ks]
        long = [(a, b, rows, wide[i]) for a, b, rows, i in pieces.long_edges(ws)]
        out[ks] = forward(wide[lattice_ids(ws, pieces, longest).T], n, longest, long)[n] + score[:, pieces.eow]
    return out


def expected_counts(
    words: list[bytes], cls: np.ndarray, pieces: Pieces, score: np.ndarray, longest: int = LONGEST
) -> np.ndarray:
    """Expected uses of each piece (classes, pieces and end of word), one spelling of each word."""
    classes, size = score.shape
    got = np.zeros(classes * (size + 1))
    wide = np.concatenate([score, np.full((classes, 1), -np.inf)], axis=1)
    marked = [MARK + w for w in words]
    for n, ks in by_length(marked):
        c = cls[ks]
        ws = [marked[k] for k in ks]
        ids = lattice_ids(ws, pieces, longest).T
        edge = wide[c[None, :], ids]
        far = pieces.long_edges(ws)
        long = [(a, b, rows, wide[c[rows], i]) for a, b, rows, i in far]
        alpha, beta = np.stack(forward(edge, n, longest, long)), np.stack(backward(edge, n, longest, long))
        starts, ends = map(list, zip(*spans_of(n, longest), strict=True))
        use = np.exp(alpha[starts] + edge + beta[ends] - alpha[n])
        some = use > 1e-12
        got += np.bincount((c * (size + 1) + ids)[some], weights=use[some], minlength=len(got))
        for (a, b, rows, i), (*_, s) in zip(far, long, strict=True):
            use = np.exp(alpha[a, rows] + s + beta[b, rows] - alpha[n, rows])
            got += np.bincount(c[rows] * (size + 1) + i, weights=use, minlength=len(got))
    got = got.reshape(classes, size + 1)[:, :size]
    got[:, pieces.eow] += np.bincount(cls, minlength=classes)
    return got


# --- counting ------------------------------------------------------------------


def many_signs(text: bytes) -> bool:
    return len(text) - len(text.translate(None, SIGNS)) > MANY_SIGNS * len(text)


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()


def label_index(docs: DataFrame, train: F.Column, label_col: str | None) -> tuple[F.Column, int]:
    """Number of a row's label and the number of labels."""
    if label_col is None or label_col not in docs.columns:
        return F.lit(0), 1
    name = F.coalesce(F.col(label_col).cast("string"), F.lit(""))
    sizes = docs.filter(train).groupBy(name.alias("k")).count().orderBy(F.desc("count"), "k")
    top = sizes.limit(MAX_LABELS).collect()
    named = top if len(top) < MAX_LABELS else top[:-1]
    idx = F.lit(len(named) if len(named) < len(top) else 0)
    for i, r in enumerate(named):
        idx = F.when(name == F.lit(r["k"]), F.lit(i)).otherwise(idx)
    return idx, max(len(top), 1)


def count_words(docs: DataFrame, label: F.Column, train: F.Column, classes: int) -> DataFrame:
    """word, n (all documents), c0..: counts in the training documents of each class.

    The empty word stands for the end of a text.  A class is twice the label,
    and one more where the text has many signs.
    """

    def make():
        held: dict[int, Counter] = {}  # all words of the task so far, by class
        near: dict[int, list] = {}  # tokens of some texts, counted together while they are in the cache

        def merge(k):
            c = held.setdefault(k, Counter())
            get = c.get
            for w, n in Counter(near.pop(k)).items():
                c[w] = n + get(w, 0)

        def hand_on():
            for k in list(near):
                merge(k)
            for k in list(held):
                c = held.pop(k)
                words = list(c)
                for i in range(0, len(words), 100_000):
                    w = words[i : i + 100_000]
                    yield {"word": w, "cls": [k] * len(w), "n": [c[x] for x in w]}

        def f(b):
            for k, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                k = k if k < 0 else 2 * k + many_signs(raw)
                some = near.setdefault(k, [])
                some += tokens(raw)
                some.append(b"")
                if len(some) > NEAR_TOKENS:
                    merge(k)
            if sum(map(len, held.values())) > HELD_WORDS:
                yield from hand_on()

        f.finish = hand_on
        return f

    rows = docs.select(F.when(train, label).otherwise(F.lit(-1)).cast("int"), text_bytes(F.col("text")))
    parts = map_batches(rows, make, "word binary, cls int, n long")
    return parts.groupBy("word").agg(
        F.sum("n").alias("n"),
        *[F.sum(F.when(F.col("cls") == k, F.col("n")).otherwise(F.lit(0))).alias(f"c{k}") for k in range(classes)],
    )


class Totals:
    """What the discounts need: counts of tokens, of words, and of words seen once and twice."""

    def __init__(self, words: DataFrame, classes: int):
        ends = words.filter(F.length("word") == 0).select(*[f"c{k}" for k in range(classes)]).first()
        words = words.filter(F.length("word") > 0)
        cs = [F.col(f"c{k}") for k in range(classes)]
        c = sum(cs[1:], cs[0])
        aggs = []
        for name, x in [("all", c), *((str(k), x) for k, x in enumerate(cs))]:
            aggs += [F.coalesce(F.sum(x), F.lit(0)).alias("n_" + name)]
            aggs += [F.count_if(test).alias(t + "_" + name) for t, test in (("v", x > 0), ("one", x == 1), ("two", x == 2))]
        r = words.agg(*aggs).first()
        self.ends = np.array(ends or [0] * classes, dtype=float)
        n = np.array([r[f"n_{k}"] for k in range(classes)], dtype=float) + self.ends
        v = np.array([r[f"v_{k}"] for k in range(classes)], dtype=float) + (self.ends > 0)
        one = np.array([r[f"one_{k}"] for k in range(classes)], dtype=float)
        two = np.array([r[f"two_{k}"] for k in range(classes)], dtype=float)
        self.n = int(r["n_all"] + self.ends.sum())  # training tokens, ends too
        self.v = int(r["v_all"] + (self.ends.sum() > 0))
        self.class_n = n
        self.discount = np.where(one + two > 0, (one + 1) / (one + 2 * two + 2), 0.5)
        with np.errstate(divide="ignore", invalid="ignore"):
            self.gamma = np.where(n > 0, self.discount * v / np.maximum(n, 1), 1.0)
        # of the words a class sees once, how many other classes know
        self.mu = 0.0 if self.n == 0 else float(np.clip(1 - r["one_all"] / max(one.sum(), 1), 0.01, 0.99))
        self.log_prior = np.log((self.ends + 0.5) / (self.ends + 0.5).sum())

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1) / (self.n + self.v + 1))

    def log_prob(self, c: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        """ln P_k of tokens with class counts ``c`` (tokens, classes) and ln S_k ``spelled``."""
        with np.errstate(divide="ignore"):
            own = np.maximum(c - self.discount, 0) / np.maximum(self.class_n, 1)
            known = self.mu * c.sum(axis=1, keepdims=True) / max(self.n, 1)
            back = np.log(known + 0.0)
            back = np.logaddexp(back, math.log(1 - self.mu) + spelled)
            return np.logaddexp(np.log(own), np.log(self.gamma) + back)

    def end_log_prob(self) -> np.ndarray:
        return self.log_prob(self.ends[None, :], np.full((1, len(self.ends)), math.log(END_BACKOFF)))[0]


def fit_pieces(words: DataFrame, classes: int, pieces: Pieces, rounds: int = EM_ROUNDS) -> np.ndarray:
    """Piece scores per class, by EM over the distinct training words of each class."""
    spark = words.sparkSession
    score = np.repeat(pieces.start()[None, :], classes, axis=0)
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast((pieces, score))

        def make(sent=sent):
            pieces, score = sent.value
            got = np.zeros_like(score)

            def f(b):
                ws = b.column(0).to_pylist()
                n = np.stack([b.column(1 + k).to_numpy() for k in range(score.shape[0])], axis=1)
                row, cls = np.nonzero(n)
                if len(row):
                    got[:] += expected_counts([ws[i] for i in row], cls, pieces, score)
                return ()

            def finish():
                k, p = np.nonzero(got)
                yield {"cls": k, "piece": p, "uses": got[k, p]}

            f.finish = finish
            return f

        given = words.select("word", *[f"c{k}" for k in range(classes)])
        uses = map_batches(given, make, "cls int, piece int, uses double").groupBy("cls", "piece").agg(F.sum("uses"))
        weight = np.zeros_like(score)
        got = uses.toArrow()  # at most one row for each class and piece
        weight[got.column(0).to_numpy(), got.column(1).to_numpy()] = got.column(2).to_numpy()
        score = pieces.normal(np.maximum(weight - EM_DISCOUNT, 0), PRIOR)
    return score


def score_words(words: DataFrame, classes: int, pieces: Pieces, score: np.ndarray, totals: Totals) -> DataFrame:
    """word, n, c (training count), p0..: ln P_k."""
    sent = words.sparkSession.sparkContext.broadcast((pieces, score, totals))

    def make():
        pieces, score, totals = sent.value
        share = math.log(1 - END_BACKOFF)

        def f(b):
            ws = b.column(0).to_pylist()
            c = np.stack([b.column(2 + k).to_numpy() for k in range(classes)], axis=1).astype(float)
            p = totals.log_prob(c, spell(ws, pieces, score) + share)
            yield {"word": b.column(0), "n": b.column(1), "c": c.sum(axis=1).astype(np.int64)} | {
                f"p{k}": p[:, k] for k in range(classes)
            }

        return f

    given = words.select("word", "n", *[f"c{k}" for k in range(classes)])
    return map_batches(given, make, "word binary, n long, c long, " + ", ".join(f"p{k} double" for k in range(classes)))


class Places(dict):
    """Place of each word; -1 for others."""

    def __missing__(self, word):
        return -1


def frequent(scored: DataFrame, most: int):
    """Words with more than ``least`` occurrences, where at most ``most`` words have that many; and ``least``."""
    per_count = scored.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n"))
    total, least = 0, 0
    for r in per_count.toLocalIterator():
        if total + r["words"] > most:
            least = r["n"]
            break
        total += r["words"]
    return scored.filter(F.col("n") > least), least


def lattice_scores(
    docs: DataFrame,
    held_out: F.Column | None = None,
    label_col: str | None = "lang",
    vocabulary: str | None = None,
    rounds: int = EM_ROUNDS,
    sent_words: int = SENT_WORDS,
) -> DataFrame:
    """Learn from the rows that are not held out, score all rows.

    doc_id, held_out, n_tokens, n_known, train_tokens, base_score (log10 by
    add-one word counts) and score (log10 of the model's marginal document
    probability).
    """
    spark = docs.sparkSession
    held_out = F.lit(False) if held_out is None else held_out
    label, labels = label_index(docs, ~held_out, label_col)
    classes = 2 * labels
    pieces = load_pieces(vocabulary)
    # equally long words together: tasks work on words of one length at a time
    counted = count_words(docs, label, ~held_out, classes).sortWithinPartitions(F.length("word"))
    words = staged(counted, "lm-words")
    totals = Totals(words, classes)
    words = words.filter(F.length("word") > 0)
    score = fit_pieces(words, classes, pieces, rounds)
    scored = staged(score_words(words, classes, pieces, score, totals), "lm-scored")
    top, least = frequent(scored, sent_words)
    t = top.toArrow()  # at most ``sent_words`` rows
    p_top = np.stack([t.column(f"p{k}").to_numpy() for k in range(classes)], axis=1).reshape(-1, classes)
    sent = spark.sparkContext.broadcast((t.column("word").to_pylist(), t.column("c").to_numpy(), p_top, totals))
    ps = [f"p{k}" for k in range(classes)]

    def make():
        ws, c, p, totals = sent.value
        place = Places(zip(ws, range(len(ws)), strict=True))
        base = totals.base(c)
        known = c > 0
        ends = totals.ends.sum()
        end_base, end_p = float(totals.base(ends)), totals.end_log_prob()
        own = ["uid", "doc_id", "held_out", "n_tokens", "n_known", "base"]
        kinds = {"uid": pa.int64(), "doc_id": pa.int64(), "held_out": pa.bool_(), "word": pa.binary()}
        kinds |= {"base": pa.float64()} | {f"p{k}": pa.float64() for k in range(classes)}

        def some(cols: dict) -> dict:
            """A batch with nulls in the columns that are not given."""
            n = len(cols["uid"])
            return {k: cols.get(k, pa.nulls(n, kinds.get(k, pa.int64()))) for k in [*own, "word", "n", *ps]}

        def f(b):
            texts = {k: [] for k in own}
            sums = []
            rest: dict[str, list] = {"uid": [], "word": [], "n": []}
            for uid, d, h, raw in zip(*[b.column(i).to_pylist() for i in range(4)], strict=True):
                toks = tokens(raw)
                at = np.fromiter(map(place.__getitem__, toks), dtype=np.int64, count=len(toks))
                missing = np.flatnonzero(at < 0)
                hit = at[at >= 0] if len(missing) else at
                row = (uid, d, h, len(toks) + 1, int(known[hit].sum()) + int(ends > 0), float(base[hit].sum()) + end_base)
                for k, v in zip(own, row, strict=True):
                    texts[k].append(v)
                sums.append(p[hit].sum(axis=0, dtype=float) + end_p)
                if len(missing):
                    counts = Counter([toks[i] for i in missing.tolist()])
                    rest["uid"] += [uid] * len(counts)
                    rest["word"] += counts.keys()
                    rest["n"] += counts.values()
            if sums:
                wide = np.stack(sums)
                yield some(texts | {q: wide[:, k] for k, q in enumerate(ps)})
            yield some(rest)

        return f

    given = docs.select(
        F.monotonically_increasing_id(), F.col("doc_id").cast("long"), held_out, text_bytes(F.col("text"))
    )
    schema = "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, word binary, n long, "
    parts = staged(map_batches(given, make, schema + ", ".join(f"{p} double" for p in ps)), "lm-parts")
    size = totals.n + totals.v + 1
    rare = scored.filter(F.col("n") <= least).select("word", "c", *[F.col(p).alias("w" + p) for p in ps])
    joined = (
        parts.filter(F.col("word").isNotNull())
        .select("uid", "word", "n")
        .join(rare, "word")
        .groupBy("uid")
        .agg(
            F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(F.lit(0))).alias("k"),
            F.sum(F.col("n") * F.log10((F.col("c") + 1) / F.lit(float(size)))).alias("b"),
            *[F.sum(F.col("n") * F.col("w" + p)).alias("s" + p) for p in ps],
        )
    )
    docs_rows = parts.filter(F.col("word").isNull()).join(joined, "uid", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    per = [F.lit(float(totals.log_prior[k])) + F.col(p) + zero("s" + p) for k, p in enumerate(ps)]
    top_p = F.greatest(*per) if len(per) > 1 else per[0]
    total = sum([F.exp(x - top_p) for x in per[1:]], F.exp(per[0] - top_p))
    return docs_rows.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + zero("k")).cast("long").alias("n_known"),
        F.lit(totals.n).cast("long").alias("train_tokens"),
        (F.col("base") + zero("b")).alias("base_score"),
        ((top_p + F.log(total)) / F.lit(math.log(10))).alias("score"),
    )


def contract_held_out() -> F.Column:
    return doc_bucket(F.col("doc_id"), 7) == 2
