"""Structure repair and prefix trie against plain statements of both."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256
from itertools import product

import pytest
from cases import clashing

from tagloom.llm import prefix_trie, repair

SCHEMA = "conv_id long, turn long, role string, text string"
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def table(seed=0, n=60):
    """Conversations with nulls, ties, repeats, blanks, odd roles, a long one and one of a single turn."""
    rng = random.Random(seed)
    say = lambda: rng.choice(["yes.", "no", "why?", "", " \t", "well then", "ok!", "é.", " ", "long " * 30 + "."])
    out = []
    for c in range(n):
        for t in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ("user", "assistant")[t % 2]
            out.append((c, t, "system" if t == 0 and rng.random() < 0.3 else role, say()))
        if c % 5 == 2:  # shares its whole begin with its family's head
            out += [(c, t, r, x) for k, t, r, x in out if k == c - 2]
    out += [(n, t, ("user", "assistant")[t % 2], say()) for t in range(400)]
    out += [(None, None, None, None), (None, 1, "user", "a."), (n + 3, None, "user", None), (n + 3, None, None, "x."), (n + 3, None, "user", "x.")]
    out += [(n + 5, 3, "tool", "y."), (n + 5, 4, "", "z."), (n + 5, 2**62, "user", "w"), (n + 7, -4, "unknown", "v."), (n + 7, 4, "assistant", "v.")]
    out += [(-3, 0, "user", "neg."), (-3, 1, "assistant", "neg."), (-5, 0, "user", "neg."), (n + 8, 0, "user", "x" * 200_000)]
    out += [out[3]] * 2  # fully repeated rows
    rng.shuffle(out)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        own = out[conv]
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else "".join(c for c in text if c not in ".!?") if fault == 2 else text
        own += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


STEP = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
DUE = {"0": "u", "s": "u", "u": "a", "a": "u"}
NAME = {"u": "user", "a": "assistant"}


def cheapest(rows, faults):
    """(cost, letters, repaired turns): the least of all ways, turn by turn."""

    def inserted(best):
        for _ in range(3):
            for q, (cost, letters, out) in list(best.items()):
                way = (cost + 3, letters + "I", (*out, (NAME[DUE[q]], "")))
                best[DUE[q]] = min(best.get(DUE[q], way), way)
        return best

    best = {"0": (0, "", ())}
    for (_, role, text), fault in zip(rows, faults, strict=True):
        ways = []
        for q, (cost, letters, out) in inserted(best).items():
            ways.append((q, (cost + 4, letters + "D", out)))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                if (q, role[:1]) in STEP:
                    ways.append((STEP[q, role[:1]], (cost + more, letters + "K", (*out, (role, text)))))
                ways.append((DUE[q], (cost + 3 + more, letters + "R", (*out, (NAME[DUE[q]], text)))))
        best = {}
        for q, way in ways:
            best[q] = min(best.get(q, way), way)
    return min(way for q, way in (inserted(best) if rows else best).items() if q in "0a")


def plain_repair(rows):
    rows, seen, faults = in_order(rows), set(), []
    for _, role, text in rows:
        s = text.strip(BLANKS)
        faults.append("blank" if not s else "duplicate" if (role, text) in seen else "truncated" if s[-1] not in ".!?" else "")
        seen.add((role, text))
    cost, letters, out = cheapest(rows, faults)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return gaps, *counts, illegal, cost, letters, out


def said(out):
    return sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest()


def by_key(rows):
    return sorted(rows, key=lambda r: [(x is not None, x) for x in r])


@pytest.mark.parametrize("seed", [0, 1])
def test_repair_equals_plain(spark, seed):
    rows = table(seed)
    given = clashing(spark.createDataFrame(rows, SCHEMA))
    got = repair.repair_report(repair.damaged(given))
    want = [(c, *r[:-1], said(r[-1])) for c, r in ((c, plain_repair(v)) for c, v in damage(rows).items())]
    assert by_key(tuple(r) for r in got.collect()) == by_key(want)


def test_repaired_turns(spark):
    rows = table(3)
    given = repair.turns(spark.createDataFrame(rows, SCHEMA))
    got = defaultdict(list)
    for r in repair.repaired_turns(given, repair.report(given)).orderBy("place").collect():
        got[r["conv_id"]].append((r["role"], r["text"]))
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn, " " if role is None else role, " " if text is None else text))
    assert dict(got) == {c: list(out) for c, v in convs.items() if (out := plain_repair(v)[-1])}


def test_every_short_conversation():
    """All conversations of up to four turns, every role and fault."""
    faults = ["", "truncated", "blank"]
    for n in range(4):
        for kinds in product(product("suax", range(3)), repeat=n):
            rows = [(0, r, "t") for r, _ in kinds]
            cost, letters, _ = cheapest(rows, [faults[f] for _, f in kinds])
            assert repair.cheapest_edits(bytes(4 * "suax".index(r) + f for r, f in kinds)) == (cost, letters)


@pytest.mark.parametrize("block", [1, 3, 64, 10_000])
def test_blocks_do_not_matter(monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rng = random.Random(block)
    for n in (1, 2, 5, 63, 64, 65, 130):
        codes = bytes(rng.randrange(16) for _ in range(n))
        names = ["", "truncated", "blank", "duplicate"]
        want = cheapest([(0, "suax"[c // 4], "t") for c in codes], [names[c % 4] for c in codes])
        assert repair.cheapest_edits(codes) == want[:2]


def test_long_conversation_is_linear():
    rng = random.Random(5)
    cost, letters = repair.cheapest_edits(bytes(rng.randrange(16) for _ in range(200_000)))
    assert cost == sum({"D": 4, "I": 3, "R": 3}.get(x, 0) for x in letters) + 3 * _kept_cut(letters, 5)


def _kept_cut(letters, seed):
    rng = random.Random(seed)
    return sum(rng.randrange(16) % 4 == repair.CUT and x != "D" for x in letters if x != "I")


def test_repair_of_no_rows(spark):
    got = repair.repair_report(repair.damaged(spark.createDataFrame([], SCHEMA)))
    assert got.collect() == []


# --- prefix trie


def sequences(rows, rebuilt):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn, role or "", text or ""))
    convs = {c: [(r, x) for _, r, x in in_order(v)] for c, v in convs.items()}
    if not rebuilt:
        return {c: tuple(v) for c, v in convs.items()}
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        head = c - (abs(c) % 5) * (1 if c > 0 else -1)  # as SQL's remainder
        out[c] = tuple(convs.get(head, [])[:h] + own[h:])
    return out


def plain_trie(seqs):
    members, kids, below = defaultdict(list), defaultdict(list), {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    out = []
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        below[p] = own + sum(below[k][0] for k in kids[p]), sum(below[k][1] for k in kids[p]) or 1
        ends = ",".join(map(str, sorted(c for c in members[p] if len(seqs[c]) == len(p))))
        parent = min(members[p[:-1]]) if p else None
        counts = len(members[p]), len(kids[p]), below[p][1], below[p][0]
        out.append((min(members[p]), len(p), parent, *counts, sha256(ends.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("rebuilt", [True, False])
@pytest.mark.parametrize("chunk", [4096, 3])
def test_trie_equals_plain(spark, monkeypatch, rebuilt, chunk):
    monkeypatch.setattr(prefix_trie, "CHUNK", chunk)
    monkeypatch.setattr(prefix_trie, "ID_BYTES", 8)
    rows = table(4, 40)
    # whole copies, one within another, and one without turns of its own after rebuilding
    rows += [(100 + k, t, "user", f"same {t}") for k in range(30) for t in range(4 if k % 3 else 2)]
    turns = prefix_trie.turn_digests(clashing(spark.createDataFrame(rows, SCHEMA)))
    got = prefix_trie.trie((prefix_trie.rebuilt_turns if rebuilt else prefix_trie.own_turns)(turns))
    assert by_key(tuple(r) for r in got.collect()) == by_key(plain_trie(sequences(rows, rebuilt)))


def test_trie_of_no_rows(spark):
    none = prefix_trie.turn_digests(spark.createDataFrame([], SCHEMA))
    assert prefix_trie.trie(prefix_trie.rebuilt_turns(none)).collect() == []
    nulls = prefix_trie.turn_digests(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA))
    assert prefix_trie.trie(prefix_trie.own_turns(nulls)).collect() == []
