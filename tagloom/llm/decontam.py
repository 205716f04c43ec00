"""Benchmark decontamination with a generalised suffix automaton.

The normalised test items build one word-level suffix automaton per block of
items.  Each document streams its words through it and tracks, word by word,
the length of the longest suffix that occurs in some item.  Where that length
reaches ``window``, the last ``window`` words are a window of an item; items
shorter than a window match whole.  Matched words form spans, which are
removed; a document whose matched share exceeds ``max_coverage`` is removed
whole.

Words are maximal runs of ASCII digits and letters and of non-ASCII bytes,
after lower-casing A-Z.

An automaton is sent to every task, so its size is bounded: items are dealt
to blocks of at most BLOCK_WORDS words, and the documents pass the blocks one
after the other, each pass adding the spans it finds, without a shuffle; what a
pass found is written to the shared folder, so one automaton is held at a time.
The result does not depend on the blocks.

Defined cases: null or empty texts have no words, no hits and are kept;
every row of the input gives one row, repeated rows too; items without words
match nothing; items with a null id mark words but are not listed; several
items with one id count once; an empty benchmark leaves documents unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import OWN, append_columns, staged, text_bytes

WINDOW = 10
MAX_COVERAGE = 0.5
BLOCK_WORDS = 500_000

_SEPARATORS = bytes(c for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122))
_NORMAL = bytes.maketrans(
    _SEPARATORS + bytes(range(65, 91)), b" " * len(_SEPARATORS) + bytes(range(97, 123))
)
_WORD = re.compile(rb"[^ ]+")


def words(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


class Automaton:
    """Suffix automaton of several word sequences, with the items of each window."""

    def __init__(self, items: Iterable[tuple[str | None, bytes]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        seqs = []
        for item, text in items:
            seq = [self.vocab.setdefault(w, len(self.vocab)) for w in words(text)]
            if seq:
                seqs.append((item, seq))
                self._insert(seq)
        self.least = min([window, *(len(s) for _, s in seqs)])
        self._mark(seqs)

    def _state(self, length: int, nxt: dict[int, int], link: int) -> int:
        self.len.append(length)
        self.next.append(nxt)
        self.link.append(link)
        return len(self.len) - 1

    def _insert(self, seq: list[int]) -> None:
        last = 0
        for c in seq:
            if c in self.next[last]:
                last = self._split(last, c)
                continue
            new = self._state(self.len[last] + 1, {}, 0)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, c)
            last = new

    def _split(self, p: int, c: int) -> int:
        """The state reached from ``p`` by ``c``, whose longest string is p's and c."""
        q = self.next[p][c]
        if self.len[q] == self.len[p] + 1:
            return q
        clone = self._state(self.len[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _mark(self, seqs) -> None:
        n = self.window
        order = np.argsort(self.len, kind="stable").tolist()
        # anc[v]: the state that holds v's suffix of exactly ``window`` words
        self.anc = [-1] * len(self.len)
        for v in order:
            if self.len[v] >= n:
                self.anc[v] = v if self.len[self.link[v]] < n else self.anc[self.link[v]]
        self.items: dict[int, set] = {}
        own: dict[int, dict[int, set]] = {}  # short items by state and length
        for item, seq in seqs:
            v = 0
            for i, c in enumerate(seq):
                v = self.next[v][c]
                if i + 1 >= n:
                    self.items.setdefault(self.anc[v], set()).add(item)
            if len(seq) < n:
                while self.len[self.link[v]] >= len(seq):
                    v = self.link[v]
                own.setdefault(v, {}).setdefault(len(seq), set()).add(item)
        # short items that are suffixes of a state's strings, longest first
        self.short: dict[int, list[tuple[int, set]]] = {}
        if own:
            for v in order:
                got = sorted(own.get(v, {}).items(), reverse=True) + self.short.get(self.link[v], [])
                if got:
                    self.short[v] = got

    def spans(self, ws: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Merged [start, end) spans of matched words, and the items whose windows occur."""
        get = self.vocab.get
        ids = np.fromiter((get(w, -1) for w in ws), dtype=np.int64, count=len(ws))
        found: list[tuple[int, int]] = []
        items: set = set()
        for a, b in _runs(ids >= 0):
            if b - a >= self.least:
                self._match(ids[a:b].tolist(), a, found, items)
        return merge_spans(found), items

    def _match(self, ids, base, found, items) -> None:
        nxt, link, length, n, short = self.next, self.link, self.len, self.window, self.short
        v = size = 0
        for i, c in enumerate(ids, base + 1):
            while v and c not in nxt[v]:
                v = link[v]
                size = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                size += 1
            if size >= n:
                found.append((i - n, i))
                items |= self.items[self.anc[v]]
            if short and v in short:
                for m, who in short[v]:
                    if m <= size:
                        found.append((i - m, i))
                        items |= who


def _runs(mask: np.ndarray) -> Iterator[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)


def merge_spans(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the words of the spans and what stands between them."""
    at = [m.span() for m in _WORD.finditer(text.translate(_NORMAL))]
    keep, last = [], 0
    for a, b in spans:
        keep.append(text[last : at[a][0]])
        last = at[b - 1][1]
    keep.append(text[last:])
    return b"".join(keep)


# --- on Spark ------------------------------------------------------------------


def blocks(items: DataFrame, id_col="item_id", text_col="text", block_words: int = BLOCK_WORDS) -> Iterator[list]:
    """Items in blocks of at most ``block_words`` words (a longer item is one block)."""
    held, size = [], 0
    rows = items.select(F.col(id_col).cast("string").alias("i"), text_bytes(F.col(text_col)).alias("t"))
    for r in rows.toLocalIterator():
        raw = bytes(r["t"])
        n = len(words(raw))
        if held and size + n > block_words:
            yield held
            held, size = [], 0
        if n:
            held.append((r["i"], raw))
            size += n
    if held:
        yield held


def find_spans(
    docs: DataFrame, items: DataFrame, text_col="text", window: int = WINDOW, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """The rows of ``docs`` with OWN-prefixed columns: n_words, spans (flat word
    offsets: start, end, start, end, ...) and items (ids whose windows occur)."""
    spark = docs.sparkSession
    out = None
    for block in blocks(items, block_words=block_words):
        out = None if out is None else staged(out, "decontam-spans")
        sent = spark.sparkContext.broadcast(Automaton(block, window))

        def make(sent=sent):
            sam = sent.value

            def f(text, spans=None, items=None):
                n, s, it = [], [], []
                for k, t in enumerate(text):
                    ws = words(t)
                    got, who = sam.spans(ws)
                    old = spans[k] if spans else []
                    n.append(len(ws))
                    s.append([x for ab in merge_spans(got + list(zip(old[::2], old[1::2], strict=True))) for x in ab])
                    it.append(sorted({x for x in who if x is not None} | set(items[k] if items else [])))
                return {"n_words": n, "spans": s, "items": it}

            return f

        schema = "n_words long, spans array<int>, items array<string>"
        if out is None:
            out = append_columns(docs, {"text": text_bytes(F.col(text_col))}, schema, make)
        else:
            before = {k: F.col(OWN + k) for k in ("n_words", "spans", "items")}
            kept = out.select(*docs.columns, *[F.col(OWN + k).alias(OWN + "old_" + k) for k in before])
            out = append_columns(
                kept,
                {
                    "text": text_bytes(F.col(text_col)),
                    "spans": F.col(OWN + "old_spans"),
                    "items": F.col(OWN + "old_items"),
                },
                schema,
                make,
            ).drop(*[OWN + "old_" + k for k in before])
    if out is None:  # no items: only the words are counted

        def count():
            def f(text):
                return {"n_words": [len(words(t)) for t in text], "spans": [[]] * len(text), "items": [[]] * len(text)}

            return f

        out = append_columns(
            docs, {"text": text_bytes(F.col(text_col))}, "n_words long, spans array<int>, items array<string>", count
        )
    return out


def n_hit() -> F.Column:
    """Number of words inside spans."""
    s = F.col(OWN + "spans")
    return F.coalesce(
        F.aggregate(
            F.transform(s, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0), lambda a, x: a + x
        ),
        F.lit(0),
    ).cast("long")


def contamination_report(docs: DataFrame, items: DataFrame, **kw) -> DataFrame:
    """One row per row of ``docs``: which words lie inside windows of items, and of which items."""
    found = find_spans(docs.select("doc_id", "text"), items, **kw)
    ids = F.array_sort(F.col(OWN + "items"))
    return found.select(
        "doc_id",
        F.col(OWN + "n_words").alias("n_words"),
        n_hit().alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit() > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    length_col: str | None = "n_chars",
    window: int = WINDOW,
    max_coverage: float = MAX_COVERAGE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` without the matched spans, and without rows matched for more than ``max_coverage``.

    Cutting the spans of all items may join words into a new match, so texts
    that were cut are looked at again until they match nothing.  ``length_col``,
    where present, is set to the new number of characters of changed texts.
    Other rows are unchanged.
    """
    names = docs.columns
    two = list(islice(blocks(items, block_words=block_words), 2))
    if not two:
        return docs
    if len(two) == 1:
        out = _cut_in_place(docs, text_col, Automaton(two[0], window))
    else:
        out = _cut_in_rounds(docs, items, text_col, window, block_words)
    out = out.filter(F.col(OWN + "n_cut") <= F.col(OWN + "n_words") * max_coverage)
    new = F.col(OWN + "cut")
    cols = []
    for c in names:
        if c == text_col:
            cols.append(F.coalesce(new, F.col(c)).alias(c))
        elif c == length_col:
            kind = docs.schema[c].dataType
            cols.append(F.when(new.isNotNull(), F.length(new).cast(kind)).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return out.select(*cols)


_STATE = "cut string, n_words long, n_cut long"


def _cut_in_place(docs: DataFrame, text_col: str, sam: Automaton) -> DataFrame:
    """OWN-prefixed cut (null: unchanged), n_words and n_cut by one automaton of all items."""
    sent = docs.sparkSession.sparkContext.broadcast(sam)

    def make():
        def f(text):
            got = [clean(t, sent.value) for t in text]
            return {
                "cut": [new.decode() if n else None for new, n in got],
                "n_words": [len(words(t)) for t in text],
                "n_cut": [n for _, n in got],
            }

        return f

    return append_columns(docs, {"text": text_bytes(F.col(text_col))}, _STATE, make)


def _cut_in_rounds(docs: DataFrame, items: DataFrame, text_col: str, window: int, block_words: int) -> DataFrame:
    """The same over several blocks: a round finds the spans of all of them, then cuts; cut texts go another round."""
    names = docs.columns
    state = {"cut": F.lit(None).cast("string"), "n_words": F.lit(None).cast("long"), "n_cut": F.lit(0).cast("long")}
    left = docs.select(*names, *[c.alias(OWN + "s_" + k) for k, c in state.items()])
    done: list[DataFrame] = []

    def make():
        def f(text, in_spans, in_words, first, in_cut, in_sum):
            got = {"cut": [], "n_words": [], "n_cut": []}
            for t, s, n, before, old, sum_ in zip(text, in_spans, in_words, first, in_cut, in_sum, strict=True):
                pairs = list(zip(s[::2], s[1::2], strict=True))
                got["cut"].append(cut(t, pairs).decode() if pairs else old)
                got["n_words"].append(n if before is None else before)
                got["n_cut"].append(sum_ + sum(b - a for a, b in pairs))
            return got

        return f

    while True:
        now = text_bytes(F.coalesce(F.col(OWN + "s_cut"), F.col(text_col)))
        found = find_spans(left.withColumn(OWN + "now", now.cast("string")), items, OWN + "now", window, block_words)
        inputs = {
            "text": text_bytes(F.col(OWN + "now")), "in_spans": F.col(OWN + "spans"), "in_words": F.col(OWN + "n_words"),
            "first": F.col(OWN + "s_n_words"), "in_cut": F.col(OWN + "s_cut"), "in_sum": F.col(OWN + "s_n_cut"),
        }
        after = append_columns(found, inputs, "r_cut string, r_n_words long, r_n_cut long", lambda: _renamed(make()))
        after = after.select(
            *names, *[F.col(f"{OWN}r_{k}").alias(OWN + k) for k in state], (F.size(OWN + "spans") > 0).alias(OWN + "again")
        )
        after = staged(after, "decontam-round")
        done.append(after.filter(~F.col(OWN + "again")).drop(OWN + "again"))
        left = after.filter(OWN + "again").select(*names, *[F.col(OWN + k).alias(OWN + "s_" + k) for k in state])
        if left.isEmpty():
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def _renamed(f):
    return lambda **kw: {"r_" + k: v for k, v in f(**kw).items()}


def clean(text: bytes, sam: Automaton) -> tuple[bytes, int]:
    """``text`` without matches, and the number of words removed."""
    removed = 0
    while spans := sam.spans(words(text))[0]:
        text = cut(text, spans)
        removed += sum(b - a for a, b in spans)
    return text, removed
