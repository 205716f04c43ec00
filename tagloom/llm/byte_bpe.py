"""Byte-level BPE encoding and decoding in batched numpy merge rounds.

A task cuts texts into units at spaces and remembers the ids of units, up to a
bound; new units are gathered, split into words by the tokenizer's pattern and
encoded together.  The symbols of all of them lie in one flat array.  In a round the pairs of
neighbours are found by binary search over the sorted pair keys of the merge
list, every word joins its pair of lowest rank wherever it occurs (from the
left, without overlap), and words without a pair leave.  A pair made by a
merge always ranks behind it, so joining all places of one rank at once is the
tokenizer's own order.  Words are first cut where no token of the vocabulary
holds the two bytes side by side, for no merge crosses such a place.

Nothing is shuffled: every text is encoded and decoded where it is read, a
piece of bounded length at a time, so that a very long text needs no more than
its own bytes and one piece.

Defined cases: a null or empty text has no tokens and decodes to empty text;
the strings of special tokens are those tokens, as in the library; bytes that
are not UTF-8 count as U+FFFD; repeated rows and null ids are kept as they
are; other columns pass through ``encode_texts`` and ``decode_ids`` whatever
their names; an empty table gives no rows.  An id that the vocabulary does not
have decodes to nothing.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import islice

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import append_columns, map_batches, text_bytes
from tagloom.llm.tokens import tokenizer_path

BYTE_BPE = "byte_bpe_50k.json"
MEMORY = 400_000  # units of text remembered by a worker; beyond that the later half is forgotten
PIECE = 1 << 18  # characters of a text that are split at once
GATHERED = 1 << 22  # characters split before their new units are encoded
ROUND_SYMBOLS = 1 << 20  # characters of one batch of merge rounds
ROUNDS = 64  # rounds after which words that are still long go on by a heap, in the same order
LONG_WORD = 1 << 12  # symbols of such a word
SLICE = 1 << 18  # ids decoded or written out at once
NONE = np.iinfo(np.int64).max


# --- the split into words -------------------------------------------------------


PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?{sign}+|\s+(?!\S)|\s+"


@lru_cache(maxsize=1)
def newer_characters() -> str:
    """The class of letters and numbers that only this process's ``regex`` knows.

    The tokenizer's library is of an older Unicode version and takes them for
    signs.  Only code points that are unassigned to ``unicodedata`` can differ,
    and the library is asked about each.  Empty where the two agree.
    """
    from tokenizers import pre_tokenizers

    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    runs: list[list[int]] = []
    for m in regex.compile(r"[\p{L}\p{N}]").finditer("".join(_unassigned())):
        c = m[0]
        if len(split("a" + c)) > 1 and len(split("1" + c)) > 1:
            if runs and runs[-1][1] == ord(c) - 1:
                runs[-1][1] += 1
            else:
                runs.append([ord(c), ord(c)])
    return "[" + "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in runs) + "]" if runs else ""


def _unassigned() -> Iterator[str]:
    for cp in range(0x110000):
        if not 0xD800 <= cp < 0xE000 and unicodedata.category(chr(cp)) == "Cn":
            yield chr(cp)


def split_patterns(newer: str) -> tuple:
    """The split, the split of texts with newer characters, and a test for those."""
    plain = PATTERN.format(letter=r"\p{L}", number=r"\p{N}", sign=r"[^\s\p{L}\p{N}]")
    if not newer:
        return regex.compile(plain).findall, regex.compile(plain).findall, lambda text: None
    classes = {"letter": rf"[\p{{L}}--{newer}]", "number": rf"[\p{{N}}--{newer}]", "sign": rf"[[^\s\p{{L}}\p{{N}}]||{newer}]"}
    whole = regex.compile("(?V1)" + PATTERN.format(**classes))
    return regex.compile(plain).findall, whole.findall, regex.compile(newer).search


_SPACE_AFTER = regex.compile(r"\S(?=\s)")


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """``text`` in pieces that end before white space, where every split has a boundary."""
    at = 0
    while len(text) - at > size:
        m = _SPACE_AFTER.search(text, at + size - 1)
        if m is None:
            break
        yield text[at : m.end()]
        at = m.end()
    yield text[at:] if at else text


_LOOSE = re.compile(r"(?:\A|\s) |\s\Z")
_ASCII_LOOSE = tuple(c + " " for c in " \t\n\v\f\r\x1c\x1d\x1e\x1f")


def _loose(piece: str) -> bool:
    """Whether white space stands before a space, or a space at the begin, or white space at the end."""
    if piece.isascii():
        return piece[0] == " " or piece[-1].isspace() or any(c in piece for c in _ASCII_LOOSE)
    return _LOOSE.search(piece) is not None


def units(piece: str) -> list[str]:
    """Parts of a piece between single spaces, glued where a part does not end in a sign or letter.

    The split has a boundary before a space that follows a character, so every
    unit but the first is split as its text with a space before it.
    """
    parts = piece.split(" ")
    if not _loose(piece):
        return parts
    out: list[str] = []
    held: list[str] = []
    for w in parts:
        held.append(w)
        if w and not w[-1].isspace():
            out.append(" ".join(held))
            held = []
    if held:
        out.append(" ".join(held))
    return out


# --- merges ---------------------------------------------------------------------


def byte_characters() -> list[str]:
    """The character that stands for each byte in the vocabulary: itself where it can be printed."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(printed) else chr(next(rest)) for b in range(256)]


class ByteBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str, newer: str, memory: int = MEMORY):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        vocab, merges = file["model"]["vocab"], file["model"]["merges"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in merges]
        special = {t["content"]: t["id"] for t in file.get("added_tokens", [])}
        self.findall, self.findall_newer, self.has_newer = split_patterns(newer)
        self.special = special
        self.specials = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None

        byte_of = {c: b for b, c in enumerate(byte_characters())}
        self.first = np.array([vocab[c] for c in byte_characters()], dtype=np.int64)
        self.span = max([*vocab.values(), *special.values()]) + 1
        words = [b""] * self.span
        for w, i in vocab.items():
            words[i] = bytes([byte_of[c] for c in w])
        for w, i in special.items():
            words[i] = w.encode()
        self.token_bytes = _Table(words)
        self.token_text = _Table([b"%d," % i for i in range(self.span)])

        left = np.array([vocab[a] for a, _ in merges], dtype=np.int64)
        right = np.array([vocab[b] for _, b in merges], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        keys = left * self.span + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made
        self.byte_ranks = self.rank(np.repeat(self.first, 256), np.tile(self.first, 256)).reshape(256, 256)
        joined = np.zeros((256, 256), dtype=bool)  # bytes that some token holds side by side
        for w in words:
            b = np.frombuffer(w, dtype=np.uint8)
            joined[b[:-1], b[1:]] = True
        self.joined = joined

        self.memory = memory
        self.known: dict[str, bytes] = {}  # ids of a unit with a space before it
        self.heads: dict[str, bytes] = {}  # ids of a first unit

    # encoding

    def encode(self, text: str) -> np.ndarray:
        return np.concatenate([np.zeros(0, dtype="<u4"), *(ids for _, ids in self.stream([text]))])

    def stream(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray]]:
        """(number of the text, ids) in order; a text's ids come in consecutive arrays, or none if it is empty."""
        waiting: list[tuple] = []
        held = 0
        for k, text in enumerate(texts):
            for part in self._parts(text):
                if isinstance(part, int):
                    waiting.append((k, part, None))
                    continue
                for piece in pieces(part):
                    us = units(piece)
                    waiting.append((k, us.pop(0), us))
                    held += len(piece)
                    if held > GATHERED:
                        yield from self._settle(waiting)
                        waiting, held = [], 0
        yield from self._settle(waiting)

    def _parts(self, text: str) -> Iterator[str | int]:
        at = 0
        for m in self.specials.finditer(text) if self.specials else ():
            if m.start() > at:
                yield text[at : m.start()]
            yield self.special[m[0]]
            at = m.end()
        if at < len(text):
            yield text[at:] if at else text

    def _settle(self, waiting: list[tuple]) -> Iterator[tuple[int, np.ndarray]]:
        known, heads = self.known, self.heads
        new: set[str] = set()
        for _, _, us in waiting:
            if us is not None:
                new.update(us)
        new.difference_update(known)
        self._learn(new, {head for _, head, us in waiting if us is not None and head not in heads})
        for k, head, us in waiting:
            if us is None:
                yield k, np.array([head], dtype="<u4")
            else:
                yield k, np.frombuffer(heads[head] + b"".join(map(known.__getitem__, us)), dtype="<u4")
        if len(known) > self.memory or len(heads) > self.memory:
            self.forget(self.memory // 2)

    def _learn(self, new: set[str], first: set[str]) -> None:
        """Encode new units: the words of all of them together."""
        tails, heads = list(new), list(first)
        split = [self.plain_words(u) for u in tails] + [None] * len(heads)
        rest = [k for k, words in enumerate(split) if words is None]
        texts = [" " + tails[k] if k < len(tails) else heads[k - len(tails)] for k in rest]
        together = "\n".join(texts)
        findall = self.findall if together.isascii() or not self.has_newer(together) else self.findall_newer
        for k, words in zip(rest, map(findall, texts), strict=True):
            split[k] = words
        ids: dict[str, bytes] = {}
        for words in split:
            for w in words:
                if w not in ids:
                    ids[w] = self.known.get(w[1:], b"") if w[0] == " " else b""  # a unit of one word
        ask = [w for w, got in ids.items() if not got]
        at = 0
        while at < len(ask):
            batch, size = [], 0
            while at < len(ask) and (not batch or size + len(ask[at]) <= ROUND_SYMBOLS):
                batch.append(ask[at])
                size += len(ask[at])
                at += 1
            ids.update(zip(batch, self._encode_words(batch), strict=True))
        for u, words in zip(tails, split, strict=False):
            self.known[u] = b"".join([ids[w] for w in words])
        for u, words in zip(heads, split[len(tails) :], strict=True):
            self.heads[u] = b"".join([ids[w] for w in words])

    @staticmethod
    def plain_words(u: str) -> list[str] | None:
        """The words of a unit of letters, or of letters and one common sign; None for others."""
        if u.isalpha():
            return [" " + u]
        if u and u[-1] in ",.;:!?" and u[:-1].isalpha():
            return [" " + u[:-1], u[-1]]
        return None

    def _encode_words(self, words: list[str]) -> list[bytes]:
        raw = [w.encode() for w in words]
        flat = np.frombuffer(b"".join(raw), dtype=np.uint8)
        ends = np.cumsum([len(x) for x in raw])
        starts = np.zeros(len(flat), dtype=bool)
        starts[1:] = ~self.joined[flat[:-1], flat[1:]]
        starts[0] = True
        starts[ends[:-1]] = True
        ids, sizes = self.merge(self.first[flat], np.flatnonzero(starts), self.byte_ranks[flat[:-1], flat[1:]])
        # parts of a word lie side by side: a word's ids end where its last part's do
        part_end = np.append(np.flatnonzero(starts)[1:], len(flat))
        cut = np.cumsum(sizes)[np.searchsorted(part_end, ends)] * 4
        out = ids.astype("<u4").tobytes()
        return [out[a:b] for a, b in zip([0, *cut.tolist()], cut.tolist(), strict=False)]

    def merge(self, symbols: np.ndarray, starts: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge all words of a flat symbol array; returns the ids and the number of each word's.

        ``rank`` holds the rank of each symbol and its neighbour; a round finds those of changed pairs only.
        """
        n = len(starts)
        word = np.repeat(np.arange(n), np.diff(np.append(starts, len(symbols))))
        rank = np.append(rank, NONE)
        rank[:-1][word[:-1] != word[1:]] = NONE
        done_word, done_ids = [], []
        rounds = 0
        while len(symbols):
            rounds += 1
            if rounds == ROUNDS:
                for w in np.flatnonzero(np.bincount(word, minlength=n) > LONG_WORD):
                    here = word == w
                    ids = self.merge_long(symbols[here], rank[here])
                    done_word.append(np.full(len(ids), w))
                    done_ids.append(ids)
                    symbols, word, rank = symbols[~here], word[~here], rank[~here]
                if not len(symbols):
                    break
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lowest = np.minimum.reduceat(rank, first)
            length = np.diff(np.append(first, len(word)))
            none = lowest == NONE
            if none.any():  # words without a pair leave
                over = np.repeat(none, length)
                done_word.append(word[over])
                done_ids.append(symbols[over])
                live = ~over
                symbols, word, rank = symbols[live], word[live], rank[live]
                lowest, length = lowest[~none], length[~none]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(lowest, length))
            # of places that overlap (a a a) every second one from the left
            run = np.append(True, np.diff(at) != 1)
            place = np.arange(len(at))
            at = at[(place - np.maximum.accumulate(np.where(run, place, 0))) % 2 == 0]
            symbols[at] = self.made[rank[at]]
            stay = np.ones(len(symbols), dtype=bool)
            stay[at + 1] = False
            symbols, word, rank = symbols[stay], word[stay], rank[stay]
            at -= np.arange(len(at))  # where the joined symbols are now
            changed = np.zeros(len(symbols) + 1, dtype=bool)
            changed[at] = True
            changed[at - 1] = True  # of the first symbol that is the spare place at the end
            if changed[len(symbols) - 1]:
                rank[-1] = NONE
            left = np.flatnonzero(changed[: len(symbols) - 1])
            rank[left] = np.where(word[left] == word[left + 1], self.rank(symbols[left], symbols[left + 1]), NONE)
        word = np.concatenate(done_word) if done_word else np.zeros(0, dtype=np.int64)
        ids = np.concatenate(done_ids) if done_ids else np.zeros(0, dtype=np.int64)
        return ids[np.argsort(word, kind="stable")], np.bincount(word, minlength=n)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, NONE where there is no merge."""
        key = left * self.span + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merge_long(self, symbols: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """One long word: pairs from a heap, lowest rank first and then from the left."""
        from heapq import heapify, heappop, heappush

        n = len(symbols)
        at = np.flatnonzero(rank != NONE)
        heap = list(zip(rank[at].tolist(), at.tolist(), strict=True))
        heapify(heap)
        sym = symbols.tolist()
        pair = dict(zip(at.tolist(), rank[at].tolist(), strict=True))  # place -> rank of the pair that begins there
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        keys, ranks, made, span = self.keys, self.ranks, self.made, self.span
        found: dict[int, int] = {}

        def renew(i: int) -> None:
            j = after[i]
            r = None
            if j < n:
                key = sym[i] * span + sym[j]
                r = found.get(key)
                if r is None:
                    k = int(np.searchsorted(keys, key))
                    r = found[key] = int(ranks[k]) if k < len(keys) and keys[k] == key else -1
            if r is None or r < 0:
                pair.pop(i, None)
            else:
                pair[i] = r
                heappush(heap, (r, i))

        while heap:
            r, i = heappop(heap)
            if pair.get(i) != r:
                continue
            j = after[i]
            sym[i] = int(made[r])
            sym[j] = -1
            pair.pop(j, None)
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            renew(i)
            if before[i] >= 0:
                renew(before[i])
        out = np.array(sym, dtype=np.int64)
        return out[out >= 0]

    # decoding

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of token ids; ids outside the vocabulary are nothing."""
        ids = np.asarray(ids, dtype=np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= self.span):
            ids = ids[(ids >= 0) & (ids < self.span)]
        return b"".join([self.token_bytes.take(ids[k : k + SLICE]) for k in range(0, len(ids), SLICE)])

    def forget(self, kept: int) -> None:
        """Forget all but the first units: frequent ones are met early."""
        for held in (self.known, self.heads):
            if len(held) > kept:
                first = list(islice(held.items(), kept))
                held.clear()
                held.update(first)


class _Table:
    """Byte strings by number, joined by one gather."""

    def __init__(self, words: list[bytes]):
        self.flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        self.size = np.array([len(w) for w in words], dtype=np.int32)
        self.start = (np.cumsum(self.size) - self.size).astype(np.int32)

    def take(self, ids: np.ndarray) -> bytes:
        size = self.size[ids]
        end = np.cumsum(size, dtype=np.int32)
        shift = self.start[ids] - (end - size)
        total = int(end[-1]) if len(end) else 0
        return self.flat[np.repeat(shift, size) + np.arange(total, dtype=np.int32)].tobytes()


_held: dict[tuple[str, str], ByteBpe] = {}


def byte_bpe(path: str, newer: str | None = None) -> ByteBpe:
    """One per Python worker: workers run many tasks, and the memory of units serves them all."""
    key = (path, newer_characters() if newer is None else newer)
    if key not in _held:
        _held[key] = ByteBpe(*key)
    return _held[key]


# --- tables ---------------------------------------------------------------------


def encode_texts(df: DataFrame, text: str = "text", ids: str = "ids", path: str | None = None) -> DataFrame:
    """``df`` with a column of the token ids of its texts."""
    path, newer = path or tokenizer_path(BYTE_BPE), newer_characters()

    def make():
        bpe = byte_bpe(path, newer)

        def f(t: list[bytes]) -> dict:
            got: list[list] = [[np.zeros(0, dtype="<u4")] for _ in t]
            for k, ids in bpe.stream([x.decode("utf-8", "replace") for x in t]):
                got[k].append(ids)
            return {"ids": [np.concatenate(x).astype(np.int32) for x in got]}

        return f

    out = append_columns(df, {"t": text_bytes(F.col(f"`{text}`"))}, "ids array<int>", make)
    return out.withColumnRenamed("_tl_ids", ids)


def decode_ids(df: DataFrame, ids: str = "ids", text: str = "text", path: str | None = None) -> DataFrame:
    """``df`` with a column of the texts that its token ids stand for."""
    path, newer = path or tokenizer_path(BYTE_BPE), newer_characters()

    def make():
        bpe = byte_bpe(path, newer)

        def f(i: list[list[int] | None]) -> dict:
            return {"text": [bpe.decode([k for k in x or () if k is not None]).decode("utf-8", "replace") for x in i]}

        return f

    return append_columns(df, {"i": F.col(f"`{ids}`")}, "text string", make).withColumnRenamed("_tl_text", text)


def round_trip(df: DataFrame, path: str | None = None) -> DataFrame:
    """Per row of documents: number of tokens, SHA-256 of the ids, comma-joined, and of the decoded text."""
    path, newer = path or tokenizer_path(BYTE_BPE), newer_characters()
    given = df.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes(F.col("text")).alias("t"))

    def make():
        bpe = byte_bpe(path, newer)

        def f(b):
            texts = [x.decode("utf-8", "replace") for x in b.column("t").to_pylist()]
            count = [0] * len(texts)
            of_ids, of_text = [sha256() for _ in texts], [sha256() for _ in texts]
            for k, ids in bpe.stream(texts):
                for part in (ids[i : i + SLICE] for i in range(0, len(ids), SLICE)):
                    said = bpe.token_text.take(part)
                    of_ids[k].update(b"," + said[:-1] if count[k] else said[:-1])
                    of_text[k].update(bpe.decode(part))  # UTF-8 joins at any byte
                    count[k] += len(part)
            yield {
                "doc_id": b.column("doc_id"),
                "n_tokens": count,
                "ids_sha256": [h.hexdigest() for h in of_ids],
                "decoded_sha256": [h.hexdigest() for h in of_text],
            }

        return f

    return map_batches(given, make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
