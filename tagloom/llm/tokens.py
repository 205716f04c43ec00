"""Token ids of whole texts by a public tokenizer, with a bounded word memory.

The word-level tokenizer lower-cases, drops white space and never joins
characters across it, so the ids of a text are the ids of its white-space
chunks in order.  Most chunks repeat, so a worker remembers the ids of chunks,
up to a bound, and sends only new ones to the tokenizer, many at a time.  ASCII
signs that end a chunk after an ASCII letter or digit are split off first, for
the tokenizer splits there too.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import islice

import numpy as np

WORD_BPE = "word_bpe_49k.json"
SEPARATOR = "<|endoftext|>"  # a special token of the file; chunks that hold one are encoded alone
MEMORY = 500_000  # chunks remembered by a task; beyond that the later third is forgotten
KEPT = 60_000  # chunks a worker keeps between tasks
FREQUENT = 16_384  # chunks kept in a small table of their own, which stays in the processor's cache
SAMPLE = 300_000  # chunks of a worker's first texts that choose them
TOGETHER = 500  # chunks sent to the tokenizer in one string
NEW_CHUNKS = 20_000  # new chunks gathered before the tokenizer is asked

# a run of ASCII signs (no apostrophe: 's, 'll and the like are words) at the end of a chunk
_STOPPED = re.compile(rb"(.*[0-9a-z])([!-&(-/:-@\[-`{-~]+)", re.DOTALL)


def tokenizer_path(name: str = WORD_BPE) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def chunks(text: bytes) -> list[bytes]:
    if b"<|" in text:  # the strings of special tokens are case-sensitive
        return text.split()
    return text.lower().split()


class WordTokenizer:
    """``ids_batch(texts)``: little-endian unsigned 32-bit ids of UTF-8 texts, as bytes."""

    def __init__(self, path: str, memory: int = MEMORY):
        from tokenizers import Tokenizer

        self.t = Tokenizer.from_file(path)
        self.sep = self.t.token_to_id(SEPARATOR)
        size = self.t.get_vocab_size()
        self.ends = np.zeros(size, dtype=bool)  # tokens that end a word
        self.ends[[i for w, i in self.t.get_vocab().items() if w.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}
        self.frequent: dict[bytes, bytes] = {}
        self.first: Counter | None = Counter()
        self.memory = memory

    def ids_batch(self, texts: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        new: set[bytes] = set()
        waiting: list[tuple] = []  # texts with new chunks: what is known, and where and what is not

        def settle():
            self._learn(new)
            known = self.known
            for k, got, at, ws in waiting:
                for i, w in zip(at, ws, strict=True):
                    got[i] = known[w]
                out[k] = b"".join(got)
            new.clear()
            waiting.clear()
            if self.first is not None and self.first.total() > SAMPLE:
                self.frequent = {w: known[w] for w, _ in self.first.most_common(FREQUENT) if w in known}
                self.first = None
            if len(known) > self.memory:  # frequent chunks are met early, so the first part is kept
                self.known = dict(islice(known.items(), self.memory // 3 * 2))

        for k, x in enumerate(texts):
            ws = chunks(x)
            if self.first is not None:
                self.first.update(ws)
            got = list(map(self.frequent.get, ws))
            get, at = self.known.get, []
            for i, g in enumerate(got):
                if g is None:
                    got[i] = g = get(ws[i])
                    if g is None:
                        at.append(i)
            if at:
                ws = [ws[i] for i in at]
                new.update(ws)
                waiting.append((k, got, at, ws))
                if len(new) > NEW_CHUNKS:
                    settle()
            else:
                out[k] = b"".join(got)
        settle()
        return out

    def rest(self) -> tuple:
        """Forget most chunks at the end of a task: the worker may go on with other work."""
        self.known = dict(islice(self.known.items(), KEPT))
        return ()

    def _learn(self, new: set[bytes]) -> None:
        known = self.known
        stopped = [m for m in map(_STOPPED.fullmatch, new) if m and b"<|" not in m[0]]
        ask = new.difference([m[0] for m in stopped])
        ask.update([x for m in stopped for x in m.groups() if x not in known])
        ask = list(ask)
        known.update(zip(ask, self._encode(ask), strict=True))
        known.update([(m[0], known[m[1]] + known[m[2]]) for m in stopped])

    def _encode(self, ws: list[bytes]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(ws)
        texts = [w.decode() for w in ws]
        # a chunk of letters is one word and ends with the only token that ends a word
        words = [k for k, w in enumerate(texts) if w.isalpha()]
        other = [k for k, w in enumerate(texts) if not w.isalpha() and "<|" not in w]
        for ks in self._together(words, texts, " ", out):
            other += ks
        for ks in self._together(other, texts, SEPARATOR, out):
            raise RuntimeError(f"{len(ks)} chunks came back in another number")
        for k, w in enumerate(texts):
            if out[k] is None:
                out[k] = np.array(self.t.encode(w, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return out

    def _together(self, at: list[int], texts: list[str], glue: str, out: list) -> list[list[int]]:
        """Encode chunks joined by ``glue``; returns groups that could not be told apart again."""
        groups = [at[i : i + TOGETHER] for i in range(0, len(at), TOGETHER)]
        joined = [glue.join([texts[k] for k in g]) for g in groups]
        failed = []
        for g, e in zip(groups, self.t.encode_batch_fast(joined, add_special_tokens=False), strict=True):
            ids = np.array(e.ids, dtype="<u4")
            if glue == SEPARATOR:
                cut = np.flatnonzero(ids == self.sep)
                starts, ends = np.concatenate(([0], cut + 1)), np.concatenate((cut, [len(ids)]))
            else:
                ends = np.flatnonzero(self.ends[ids]) + 1
                starts = np.concatenate(([0], ends[:-1]))
            if len(ends) != len(g):
                failed.append(g)
                continue
            raw = ids.tobytes()
            for k, a, b in zip(g, (starts * 4).tolist(), (ends * 4).tolist(), strict=True):
                out[k] = raw[a:b]
        return failed


_held: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One per Python worker: workers run many tasks, and the memory serves them all."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _held:
        _held[path] = WordTokenizer(path)
    return _held[path]
