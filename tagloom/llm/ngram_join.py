"""N-gram Jaccard join by MinHash banding, verified on the full n-gram sets.

A text is the set of its word n-grams (a shorter text is one n-gram).  Band
and row counts are chosen so that a pair at the threshold meets in some band
with the target recall.  Texts with equal sets are one class of copies and
only one of them goes on.  The others are shuffled on their band hashes; the
members of buckets form candidate groups, whose texts are verified on full
sets, inside tasks: groups of up to ``BLOCK`` texts whole, larger ones as pairs
of blocks that meet in some band (``candidate_units``), so that no unit holds
much more than two blocks.  Texts are cut into at most ``PARTS`` blocks per home,
so the rows sent to units grow with the texts of a group and not with their
square, until a block would hold more than ``BLOCK_GRAMS`` n-grams; comparing the
texts of a unit, which is quadratic by nature, goes on in tiles of ``TILE`` texts.
Tasks hand on, per text, its number of links and one link to the texts before
it; pairs are never written out.

Result: one row per row of the input with its class (the connected component
of verified links) and its numbers of links.

Defined cases: null and empty texts have no n-grams and are copies of each
other; repeated rows are copies; null ids take part, and the class is then
named by the smallest id present (null if there is none); texts of any length
are compared whole; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import join_hot, map_batches, staged, text_bytes
from tagloom.llm.graph import components
from tagloom.operators.broadcast import maybe_broadcast

NGRAM = 5
THRESHOLD = 0.8
RECALL = 0.999
MAX_HASHES = 256
BLOCK = 256
# Enough pairs of blocks to keep some hundred tasks busy with one home.
PARTS = 24
# 64-bit hashes: 32 MB for a block, twice that for a unit.
BLOCK_GRAMS = 4 << 20
TILE = 256
SEED = 5


def band_counts(threshold: float, recall: float, most: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the fewest chance meetings of a pair at half the threshold among
    all counts of at most ``most`` hashes that reach ``recall`` at the threshold."""
    best = None
    for rows in range(1, most + 1):
        p = threshold**rows
        bands = 1 if p >= 1 else int(np.ceil(np.log(1 - recall) / np.log1p(-p)))
        if bands * rows > most // 2:
            continue
        chance = 1 - (1 - (threshold / 2) ** rows) ** bands
        if best is None or chance < best[0]:
            best = (chance, bands, rows)
    if best is None:
        raise ValueError("no band count reaches the recall")
    return best[1], best[2]


# --- sets and signatures -------------------------------------------------------


def ngram_hashes(text: bytes, n: int = NGRAM) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of a text, A-Z lower-cased."""
    ws = text.lower().split()
    if not ws:
        return np.zeros(0, np.uint64)
    if len(ws) < n:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(ws), len(ws))], dtype=np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, ws), dtype=np.uint64, count=len(ws))
    h = np.zeros(len(ws) - n + 1, np.uint64)
    for i in range(n):
        h = (h ^ w[i : i + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return np.unique(h)


class MinHash:
    def __init__(self, bands: int, rows: int, seed: int = SEED):
        rng = np.random.default_rng(seed)
        k = bands * rows
        self.bands, self.rows = bands, rows
        self.a = rng.integers(0, 1 << 63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, k, dtype=np.uint64)

    def band_hashes(self, sets: list[np.ndarray]) -> list[np.ndarray | None]:
        """Signed 64-bit hash of each band of each non-empty set."""
        out: list[np.ndarray | None] = [None] * len(sets)
        some = [i for i, s in enumerate(sets) if len(s)]
        while some:
            take, size = [], 0
            while some and (not take or size + len(sets[some[-1]]) <= 100_000):
                take.append(some.pop())
                size += len(sets[take[-1]])
            flat = np.concatenate([sets[i] for i in take])
            starts = np.concatenate(([0], np.cumsum([len(sets[i]) for i in take])[:-1]))
            low = np.empty((len(self.a), len(take)), np.uint64)
            for k, (a, b) in enumerate(zip(self.a, self.b, strict=True)):
                x = flat * a + b
                low[k] = np.minimum.reduceat(x ^ (x >> np.uint64(29)), starts)
            for j in range(self.bands):
                h = np.full(len(take), j + 1, np.uint64)
                for r in range(self.rows):
                    h = (h ^ low[j * self.rows + r]) * np.uint64(0x9E3779B97F4A7C15)
                    h ^= h >> np.uint64(31)
                low[j] = h
            got = low[: self.bands].T.astype(np.int64)
            for i, g in zip(take, got, strict=True):
                out[i] = g
        return out


# --- verification inside a task ------------------------------------------------


def shared(sets_a: list[np.ndarray], sets_b: list[np.ndarray] | None) -> np.ndarray:
    """Sizes of all intersections of two lists of sets (of one list with itself if the other is None)."""
    sets = sets_a + (sets_b or [])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, inv, n = np.unique(flat, return_inverse=True, return_counts=True)
    inv = inv.ravel()
    keep = n[inv] > 1  # only n-grams of several sets can be shared
    col = np.cumsum(n > 1)[inv[keep]] - 1
    owner = owner[keep]
    order = np.argsort(col, kind="stable")
    col, owner = col[order], owner[order]
    na = len(sets_a)
    out = np.zeros((na, len(sets_b) if sets_b is not None else na), np.float32)
    width = 4096
    total = int(col[-1]) + 1 if len(col) else 0
    for c in range(0, total, width):
        i, j = np.searchsorted(col, (c, c + width))
        m = np.zeros((len(sets), width), np.float32)
        m[owner[i:j], col[i:j] - c] = 1
        out += m[:na] @ (m[na:] if sets_b is not None else m).T
    return out


def verify(sets: list[np.ndarray], sizes: np.ndarray, side: np.ndarray, threshold: float, cross: bool):
    """Links among texts of a unit: (links weighted by copies, linked texts, links that join all linked texts).

    ``cross``: only pairs of different sides count.  Memory beside the sets is that of a pair of tiles.
    """
    n = len(sets)
    size = np.array([len(s) for s in sets], dtype=float)
    links, texts = np.zeros(n, np.int64), np.zeros(n, np.int64)
    forest = Forest(n)
    tiles = lambda at: [at[i : i + TILE] for i in range(0, len(at), TILE)]
    left = tiles(np.flatnonzero(side == 0))
    right = tiles(np.flatnonzero(side == 1)) if cross else left
    for i, a in enumerate(left):
        for b in right if cross else right[i:]:
            same = a is b
            both = shared([sets[k] for k in a], None if same else [sets[k] for k in b])
            ok = both >= threshold * (size[a][:, None] + size[b][None, :] - both) - 1e-6
            if same:
                np.fill_diagonal(ok, False)
            links[a] += ok @ sizes[b]
            texts[a] += ok.sum(axis=1)
            if not same:
                links[b] += ok.T @ sizes[a]
                texts[b] += ok.sum(axis=0)
            forest.add(a, b, ok)
    return links, texts, forest.links


class Forest:
    """Links that join all linked texts, at most one fewer than texts."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def add(self, a: np.ndarray, b: np.ndarray, ok: np.ndarray) -> None:
        for i, mine in enumerate(a):
            to = b[ok[i]]
            for other in to[self.label[to] != self.label[mine]]:
                if self.label[other] != self.label[mine]:
                    self.label[self.label == self.label[other]] = self.label[mine]
                    self.links.append((int(mine), int(other)))


# --- on Spark ------------------------------------------------------------------


def text_keys(text: F.Column) -> list[F.Column]:
    """128 bits of a text in two longs."""
    t = text_bytes(text)
    return [F.xxhash64(t).alias("k1"), F.xxhash64(F.lit(17), t).alias("k2")]


def signatures(docs: DataFrame, n: int, hasher: MinHash) -> DataFrame:
    """doc_id, k1, k2 (text), s1, s2 and grams (n-gram set and its size) and bands of every row."""

    def make():
        def f(b):
            sets = [ngram_hashes(x, n) for x in b.column(3).to_pylist()]
            raw = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            key = np.frombuffer(b"".join(raw), dtype="<i8").reshape(-1, 2)
            bands = hasher.band_hashes(sets)
            yield {
                "doc_id": b.column(0), "k1": b.column(1), "k2": b.column(2),
                "s1": key[:, 0], "s2": key[:, 1], "grams": [len(s) for s in sets], "bands": bands,
            }

        return f

    given = docs.select(F.col("doc_id").cast("long"), *text_keys(F.col("text")), text_bytes(F.col("text")))
    return map_batches(given, make, "doc_id long, k1 long, k2 long, s1 long, s2 long, grams long, bands array<long>")


def candidate_units(reps: DataFrame, block: int) -> DataFrame:
    """The units of verification: rid, c1, b1, c2, b2, side.

    Texts that meet in bands form candidate groups.  A group of up to
    ``block`` texts is one unit.  A text of a larger group has its home with the
    smallest text of the largest bucket it is in.  Homes are cut into blocks of a
    quarter of ``block`` texts or more (see ``PARTS``), and those of fewer texts
    are put together, with others that meet the same larger home; two blocks
    are a unit where a band brings texts of their homes together.  So a long
    chain of texts costs its meetings, not the square of its length, and a text
    of a dense group is sent to a number of units that does not grow with the
    group.
    """
    band = reps.select("rid", "grams", F.explode("bands").alias("band"))
    bucket = staged(band.groupBy("band").agg(F.count("*").alias("n"), F.min("rid").alias("low")).filter("n > 1"), "ngram-buckets")
    meets = staged(join_hot(band, bucket, ["band"], "n"), "ngram-meetings")
    groups = components(meets.select(F.col("rid").alias("a"), F.col("low").alias("b")), "ngram-candidates")
    groups = staged(groups.select(F.col("node").alias("rid"), F.col("component").alias("grp")), "ngram-groups")
    count = staged(groups.groupBy("grp").agg(F.count("*").alias("m")), "ngram-group-sizes")
    zero = F.lit(0)
    whole = join_hot(groups, count, ["grp"], "m").filter(F.col("m") <= block)
    whole = whole.select("rid", F.col("grp").alias("c1"), zero.alias("b1"), F.col("grp").alias("c2"), zero.alias("b2"), zero.alias("side"))
    large = count.filter(F.col("m") > block)
    if large.isEmpty():
        return whole
    inside = join_hot(groups, large, ["grp"], "m").select("rid")
    largest = F.max(F.struct("n", (-F.col("low")).alias("low"))).getField("low")
    text = meets.groupBy("rid").agg((-largest).alias("home"), F.first("grams").alias("grams"), F.collect_set("band").alias("bands"))
    home = staged(text.join(inside, "rid"), "ngram-homes")
    size = home.groupBy("home").agg(F.count("*").alias("texts"), F.sum("grams").alias("grams"))
    size = staged(size, "ngram-home-sizes")
    at = staged(home.select("home", F.explode("bands").alias("band")).distinct(), "ngram-homes-of-bands")
    # no more rows than meetings: each pair of homes of a band stands for a pair of texts that meet in it
    pairs = at.join(at.select("band", F.col("home").alias("other")), "band").select("home", "other").distinct()
    pairs = staged(pairs, "ngram-home-pairs")
    cut = max(1, block // 4)
    by_texts, by_grams = F.ceil(F.col("texts") / F.lit(float(cut))), F.ceil(F.col("grams") / F.lit(float(BLOCK_GRAMS)))
    small = size.filter(F.col("texts") < cut)
    other = size.select(F.col("home").alias("other"), F.col("texts").alias("its"))
    host = F.max(F.struct("its", (-F.col("other")).alias("other"))).getField("other")
    guests = pairs.join(small, "home").join(other, "other").groupBy("home", "texts", "grams").agg((-host).alias("c"))
    guests = staged(guests, "ngram-guests")
    packs = guests.groupBy("c").agg(F.sum("texts").alias("texts"), F.sum("grams").alias("grams"))
    packs = staged(packs.select("c", "texts", F.greatest(by_texts, by_grams).alias("packs")), "ngram-packs")
    pack = (-1 - F.pmod(F.xxhash64("home"), F.col("packs"))).cast("int")
    guests = join_hot(guests.select("home", "c"), packs, ["c"], "texts").select("home", "c", pack.alias("b"))
    blocks = F.greatest(F.least(by_texts, F.lit(PARTS)), by_grams).cast("int")
    cells = size.filter(F.col("texts") >= cut).select("home", F.col("home").alias("c"), F.sequence(zero, blocks - 1).alias("bs"))
    cells = staged(cells.unionByName(guests.select("home", "c", F.array("b").alias("bs"))), "ngram-cells")
    dealt = join_hot(home.select("rid", "home"), cells.join(size.select("home", "texts"), "home"), ["home"], "texts")
    mine = F.element_at("bs", F.pmod(F.xxhash64("rid"), F.size("bs")).cast("int") + 1)
    dealt = dealt.select("rid", "c", mine.alias("b"))
    parts = cells.select("home", "c", F.explode("bs").alias("b"))
    its = parts.select(F.col("home").alias("other"), F.col("c").alias("oc"), F.col("b").alias("ob"))
    meet = pairs.join(parts, "home").join(its, "other").select("c", "b", "oc", "ob").distinct()
    units = dealt.join(meet, ["c", "b"])
    mine, its = F.struct(F.col("c"), F.col("b")), F.struct(F.col("oc").alias("c"), F.col("ob").alias("b"))
    low, high = F.least(mine, its), F.greatest(mine, its)
    return whole.unionByName(
        units.select(
            "rid",
            low.getField("c").alias("c1"),
            low.getField("b").alias("b1"),
            high.getField("c").alias("c2"),
            high.getField("b").alias("b2"),
            (mine > its).cast("int").alias("side"),
        )
    )


UNIT = ("c1", "b1", "c2", "b2")


def verify_units(members: DataFrame, n: int, threshold: float) -> DataFrame:
    """Verified links of the units: rid, links, texts, to (one linked text or null).

    ``members``: UNIT, side, rid, size (copies of the text), text.
    """
    units = members.select(*UNIT, "side", "rid", "size", "text")

    def make():
        held: list[tuple] = []

        def work(rows):
            cross = rows[0][:2] != rows[0][2:4]
            sets = [r[7] for r in rows]
            side, sizes = np.array([r[4] for r in rows]), np.array([r[6] for r in rows], dtype=np.int64)
            links, texts, forest = verify(sets, sizes, side, threshold, cross)
            rid = np.array([r[5] for r in rows], dtype=np.int64)
            at = np.flatnonzero(links)
            out = {"rid": rid[at].tolist(), "links": links[at].tolist(), "texts": texts[at].tolist(), "to": [None] * len(at)}
            place = {int(p): k for k, p in enumerate(at)}
            for x, y in forest:  # a forest link is told by one of its two texts that is still free
                for p, q in ((x, y), (y, x)):
                    if out["to"][place[p]] is None:
                        out["to"][place[p]] = int(rid[q])
                        break
                else:
                    for k, v in (("rid", int(rid[x])), ("links", 0), ("texts", 0), ("to", int(rid[y]))):
                        out[k].append(v)
            return out

        def f(b):
            cols = [c.to_pylist() for c in b.columns]
            for row in zip(*cols, strict=True):
                if held and held[0][:4] != row[:4]:
                    yield work(held)
                    held.clear()
                held.append((*row[:7], ngram_hashes(row[7], n)))

        f.finish = lambda: [work(held)] if held else ()
        return f

    dealt = units.repartition(*UNIT).sortWithinPartitions(*UNIT)
    return map_batches(dealt, make, "rid long, links long, texts long, to long")


def ngram_join(
    docs: DataFrame,
    n: int = NGRAM,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    block: int = BLOCK,
    keep_keys: bool = False,
) -> DataFrame:
    """One row per row of ``docs``:

    doc_id, class_id (smallest doc_id of its connected component), copy_id
    (smallest doc_id with the same n-gram set), n_links (other rows at
    ``threshold`` or above, copies included), n_copies (other rows with the
    same set) and n_linked_texts (other distinct sets at ``threshold`` or above).
    """
    hasher = MinHash(*band_counts(threshold, recall))
    sig = staged(signatures(docs, n, hasher), "ngram-signatures")
    classes = sig.groupBy("s1", "s2").agg(
        F.count("*").alias("size"),
        F.min("doc_id").alias("copy_id"),
        F.min(F.struct("k1", "k2")).alias("k"),
        F.first("grams").alias("grams"),
        F.first("bands").alias("bands"),
    )
    reps = staged(classes.withColumn("rid", F.monotonically_increasing_id()), "ngram-classes")
    units = staged(candidate_units(reps.filter(F.col("bands").isNotNull()), block), "ngram-units")
    wanted = units.select("rid").distinct().join(reps, "rid")
    wanted = staged(wanted.select("rid", "size", F.col("k.k1").alias("k1"), F.col("k.k2").alias("k2")), "ngram-wanted")
    side, _ = maybe_broadcast(wanted.select("k1", "k2"))
    texts = (
        docs.select(*text_keys(F.col("text")), text_bytes(F.col("text")).alias("text"))
        .join(side, ["k1", "k2"], "left_semi")
        .groupBy("k1", "k2")
        .agg(F.first("text").alias("text"))
    )
    members = wanted.join(texts, ["k1", "k2"]).join(units, "rid")
    found = staged(verify_units(members, n, threshold), "ngram-links")
    linked = components(found.filter("to is not null").select(F.col("rid").alias("a"), F.col("to").alias("b")), "ngram-linked")
    per = found.groupBy("rid").agg(F.sum("links").alias("links"), F.sum("texts").alias("texts"))
    per = reps.select("s1", "s2", "rid", "size", "copy_id").join(per, "rid", "left").join(
        linked.withColumnRenamed("node", "rid"), "rid", "left"
    )
    per = per.withColumn("component", F.coalesce("component", "rid"))
    per = staged(per, "ngram-components")
    name = staged(per.groupBy("component").agg(F.min("copy_id").alias("class_id"), F.count("*").alias("n")), "ngram-names")
    per = staged(join_hot(per, name, ["component"], "n").drop("n"), "ngram-rows")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    out = join_hot(sig, per, ["s1", "s2"], "size").select(
        "doc_id",
        "class_id",
        "copy_id",
        (zero("links") + F.col("size") - 1).cast("long").alias("n_links"),
        (F.col("size") - 1).cast("long").alias("n_copies"),
        zero("texts").cast("long").alias("n_linked_texts"),
        *(["component", "k1", "k2"] if keep_keys else []),
    )
    return out


def keep_one(docs: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs`` that stay when each class keeps one: the smallest (doc_id, text), null ids last."""
    from tagloom.llm.common import OWN

    rows = staged(ngram_join(docs, keep_keys=True, **kw), "ngram-classes-of-rows")
    who = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2")
    first = staged(rows.groupBy("component").agg(F.min(who).alias("first"), F.count("*").alias("rows")), "ngram-first")
    same = F.col("first") == who
    judged = join_hot(rows, first, ["component"], "rows").groupBy("doc_id", "k1", "k2").agg(
        F.count("*").alias("n"), F.bool_or(same).alias("stays")
    )
    # rows that go, and rows that stay but stand more than once
    marked = staged(judged.filter(~F.col("stays") | (F.col("n") > 1)).select(
        F.col("doc_id").alias(OWN + "id"), F.col("k1").alias(OWN + "k1"), F.col("k2").alias(OWN + "k2"), F.col("stays").alias(OWN + "stays")
    ), "ngram-marked")
    side, _ = maybe_broadcast(marked)
    k1, k2 = text_keys(F.col("text"))
    key = docs.select("*", k1.alias(OWN + "d1"), k2.alias(OWN + "d2"))
    on = (
        (F.col(OWN + "d1") == F.col(OWN + "k1"))
        & (F.col(OWN + "d2") == F.col(OWN + "k2"))
        & F.col("doc_id").cast("long").eqNullSafe(F.col(OWN + "id"))
    )
    kept = key.join(side, on, "left_anti").select(*docs.columns)
    several = marked.filter(F.col(OWN + "stays"))
    if several.isEmpty():
        return kept
    again = key.join(several, on).groupBy(OWN + "id", OWN + "k1", OWN + "k2").agg(F.first(F.struct(*docs.columns)).alias(OWN + "row"))
    return kept.unionByName(again.select(OWN + "row.*"))
