"""Prefix trie of conversations by whole-sequence collapse.

Conversations that share their first turns share nodes.  The trie is never
walked: identical conversations collapse into weighted sequences, sequences
that are proper prefixes of others are told by an anti-join (the rest are the
leaves), and every node is an aggregate over the sequences that pass it.

A node is named by a digest chained over (role, text) of its turns, so no text
is shuffled.  Sums over a node's subtree are sums over the sequences through
it as well: the tokens of all members below are weight times what is left of
the sequence, and every node below counts once, at the sequence of smallest
id that passes it.  Such a sequence owns a suffix of its own nodes, which the
first aggregate tells.

How it runs: a turn is a digest and a length (about 50 bytes).  Turns of one
conversation stream through one task in order, holding 24 bytes a turn; the
copies of a sequence are combined before the shuffle; the root and common
first turns are partial aggregates; the join that names parents is salted; the
ids that end at a node are sorted by range, so those of a hot sequence lie in
several tasks, and are hashed from joined blocks of text.

Defined cases: a null role or text is empty; turns are taken by ``turn``, nulls
first, then by role and text (its first 64 characters, then its digest); rows
without a conversation id belong to no conversation and are not members; a
conversation may be turnless after rebuilding and then ends at the root; an
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import map_batches, staged
from tagloom.llm.repair import digest

ROOT = bytes(16)
EMPTY = sha256().hexdigest()
CHUNK = 4096  # nodes of a sequence in one row
SALTS = 16
ID_BYTES = 1 << 20  # joined ids in one row
HEADS, FAMILY = 9, 5  # of the rebuilding: up to 8 first turns are taken over within 5 consecutive ids


# --- conversations --------------------------------------------------------------


def turn_digests(df: DataFrame) -> DataFrame:
    """Conversation, order columns, digest and UTF-8 length of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return df.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.substring(text, 1, 64).alias("head"),
        digest(role, text).alias("mark"),
        F.octet_length(text).cast("long").alias("bytes"),
    )


ORDER = ("turn", "role", "head", "mark")


def own_turns(turns: DataFrame) -> DataFrame:
    """Every conversation as it is: target, part, order columns, digest and length; part 0 opens it."""
    opened = turns.select("conv").distinct().select(F.col("conv").alias("target"), F.lit(0).alias("part"), *_no_order(turns))
    return opened.unionByName(turns.select(F.col("conv").alias("target"), F.lit(2).alias("part"), *ORDER, "bytes"))


def _no_order(turns: DataFrame) -> list[Column]:
    return [F.lit(None).cast(turns.schema[c].dataType).alias(c) for c in (*ORDER, "bytes")]


def taken_over(conv: Column) -> Column:
    """How many first turns a conversation takes from the head of its family."""
    return (F.crc32(conv.cast("string").cast("binary")) % HEADS).cast("int")


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """Every conversation with its first turns taken from the first conversation of its family.

    The family of c begins with c - c % 5.  Only the eight first turns of a
    family's head are repeated; a conversation that is not in the table gets
    no opening row and is left out.
    """
    from pyspark.sql import Window

    by = [F.col(c).asc_nulls_first() for c in ORDER]
    numbered = turns.withColumn("k", F.row_number().over(Window.partitionBy("conv").orderBy(*by)))
    is_head = F.col("conv") % FAMILY == 0
    own = F.when(is_head | (F.col("k") > taken_over(F.col("conv"))), F.array(F.struct(F.col("conv").alias("target"), F.lit(2).alias("part"))))
    opened = F.when(F.col("k") == 1, F.array(F.struct(F.col("conv").alias("target"), F.lit(0).alias("part"))))
    steps = F.array(*[F.lit(j).cast("long") for j in range(1 - FAMILY, FAMILY) if j])
    others = F.transform(steps, lambda j: F.struct(F.try_add(F.col("conv"), j).alias("target"), F.lit(1).alias("part")))
    others = F.filter(others, lambda x: (x["target"] - x["target"] % FAMILY == F.col("conv")) & (taken_over(x["target"]) >= F.col("k")))
    others = F.when(is_head & (F.col("k") < HEADS), others)
    none = F.array().cast("array<struct<target:bigint,part:int>>")
    targets = F.concat(*[F.coalesce(x, none) for x in (own, opened, others)])
    out = numbered.select(F.explode(targets).alias("t"), *ORDER, "bytes")
    return out.select("t.target", "t.part", *ORDER, "bytes")


# --- sequences ------------------------------------------------------------------


def chains(rows: DataFrame) -> DataFrame:
    """Per conversation the chained digests and running lengths of its nodes, the root first.

    In rows of at most CHUNK nodes: conv, chunk, size (turns), last (digest of
    the whole), total (bytes), before and base (node before the first and the
    bytes up to it), nodes, sums.
    """
    by = [F.col("target"), F.col("part"), *[F.col(c).asc_nulls_first() for c in ORDER]]
    given = rows.repartition(F.col("target")).sortWithinPartitions(*by).select("target", "part", "mark", "bytes")

    def make():
        now: dict = {"conv": None}

        def begin(conv: int) -> None:
            now.update(conv=conv, open=False, nodes=bytearray(ROOT), sums=array("q", [0]), at=ROOT, total=0)

        def result() -> Iterator[dict]:
            if now["conv"] is None or not now["open"]:
                return
            n, nodes, sums = len(now["sums"]), bytes(now["nodes"]), now["sums"]
            for k, a in enumerate(range(0, n, CHUNK)):
                part = [nodes[16 * i : 16 * i + 16] for i in range(a, min(a + CHUNK, n))]
                yield {
                    "conv": [now["conv"]], "chunk": [k], "size": [n - 1], "last": [now["at"]], "total": [now["total"]],
                    "before": [nodes[16 * a - 16 : 16 * a] if a else None], "base": [sums[a - 1] if a else 0],
                    "nodes": [part], "sums": [sums[a : a + CHUNK].tolist()],
                }

        def f(b: pa.RecordBatch) -> Iterator[dict]:
            out: dict[str, list] = {}
            for conv, part, mark, size in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if conv != now["conv"]:
                    for r in result():
                        for c, v in r.items():
                            out.setdefault(c, []).extend(v)
                    begin(conv)
                if part == 0:
                    now["open"] = True
                elif now["open"]:
                    now["at"] = blake2b(now["at"] + mark, digest_size=16).digest()
                    now["total"] += size
                    now["nodes"] += now["at"]
                    now["sums"].append(now["total"])
            if out:
                yield out

        f.finish = result
        return f

    return map_batches(
        given, make,
        "conv long, chunk int, size long, last binary, total long, before binary, base long, nodes array<binary>, sums array<long>",
    )


def collapse(chain: DataFrame) -> DataFrame:
    """Identical conversations as one weighted sequence, which has its smallest member's id."""
    first = F.min(F.struct("conv", "size", "total", "before", "base", "nodes", "sums")).alias("s")
    out = chain.groupBy("last", "chunk").agg(first, F.count(F.lit(1)).alias("weight"))
    return out.select("last", "chunk", "weight", F.col("s.conv").alias("id"), "s.size", "s.total", "s.before", "s.base", "s.nodes", "s.sums")


def end_lists(ends: DataFrame) -> DataFrame:
    """Per sequence (``last``) the SHA-256 of its members' ids, ascending and comma-joined.

    Ids are sorted by range over all tasks and joined there into blocks of
    text; a sequence's blocks are then hashed in order.
    """
    ordered = ends.select("last", "conv").repartitionByRange(F.col("last"), F.col("conv")).sortWithinPartitions("last", "conv")

    def blocks():
        now: dict = {"last": None, "ids": [], "size": 0}

        def result() -> Iterator[dict]:
            if now["ids"]:
                yield {"last": [now["last"]], "first": [now["ids"][0]], "ids": [",".join(map(str, now["ids"]))]}
            now["ids"], now["size"] = [], 0

        def f(b: pa.RecordBatch) -> Iterator[dict]:
            for last, conv in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if last != now["last"] or now["size"] > ID_BYTES:
                    yield from result()
                    now["last"] = last
                now["ids"].append(conv)
                now["size"] += 1 + len(str(conv))

        f.finish = result
        return f

    def hashes():
        now: dict = {"last": None, "hash": None}

        def result() -> Iterator[dict]:
            if now["hash"] is not None:
                yield {"last": [now["last"]], "ends_sha256": [now["hash"].hexdigest()]}

        def f(b: pa.RecordBatch) -> Iterator[dict]:
            out: dict[str, list] = {"last": [], "ends_sha256": []}
            for last, ids in zip(b.column("last").to_pylist(), b.column("ids").to_pylist(), strict=True):
                if last != now["last"] or now["hash"] is None:
                    for r in result():
                        for c, v in r.items():
                            out[c] += v
                    now.update(last=last, hash=sha256(ids.encode()))
                else:
                    now["hash"].update(b"," + ids.encode())
            yield out

        f.finish = result
        return f

    joined = map_batches(ordered, _batched(blocks), "last binary, first long, ids string")
    joined = joined.repartition(F.col("last")).sortWithinPartitions("last", "first")
    return map_batches(joined, hashes, "last binary, ends_sha256 string")


def _batched(make):
    """Single result rows put together into batches."""

    def made():
        f = make()

        def g(b: pa.RecordBatch) -> Iterator[dict]:
            out: dict[str, list] = {}
            size = 0
            for r in f(b):
                for c, v in r.items():
                    out.setdefault(c, []).extend(v)
                size += len(r["ids"][0])
                if size > 4 * ID_BYTES:
                    yield out
                    out, size = {}, 0
            if out:
                yield out

        g.finish = f.finish
        return g

    return made


# --- nodes ----------------------------------------------------------------------


def paths(sequences: DataFrame, *more: str) -> DataFrame:
    """One row per sequence and node on it: node, parent, depth and the bytes of the texts before the node's."""
    out = sequences.select("*", F.posexplode("nodes").alias("i", "node"))
    i = F.col("i")
    return out.select(
        "id", "weight", "size", "total", "node", *more,
        (F.col("chunk").cast("long") * CHUNK + i).alias("depth"),
        F.when(i > 0, F.get("nodes", i - 1)).otherwise(F.col("before")).alias("parent"),
        F.when(i > 0, F.get("sums", i - 1)).otherwise(F.col("base")).alias("above"),
    )


def trie(rows: DataFrame) -> DataFrame:
    """The nodes of the prefix trie of conversations (``own_turns`` or ``rebuilt_turns``).

    What several steps read is staged in the shared folder.
    """
    chain = staged(chains(rows), "trie-chains")
    sequences = staged(collapse(chain), "trie-sequences")

    # who passes a node first, and which nodes lie inside a longer sequence
    first_pass = paths(sequences).groupBy("node").agg(
        F.min("id").alias("owner"), F.max("depth").alias("depth"), F.max("above").alias("above"),
        F.max(F.col("depth") < F.col("size")).alias("inner"),
    )
    seen = staged(first_pass, "trie-seen")
    inner = seen.filter("inner").select(F.col("node").alias("last"))
    leaves = sequences.join(inner, "last", "left_anti").withColumn("leaf", F.lit(1).cast("long"))
    prefixes = sequences.join(inner, "last", "left_semi").withColumn("leaf", F.lit(0).cast("long"))
    owned = seen.groupBy(F.col("owner").alias("id")).agg(F.min(F.struct("depth", "above")).alias("from"))
    marked = leaves.unionByName(prefixes).join(owned, "id", "left").select(
        "*",
        F.coalesce("from.depth", F.col("size") + 1).alias("begin"),  # the first depth the sequence owns
        F.coalesce("from.above", F.col("total")).alias("passed"),  # bytes of its texts before that
    )

    # tokens saved below a node: (members - 1) times bytes, over all nodes there
    of_members = F.col("weight") * (F.col("total") - F.col("above"))
    of_nodes = F.col("total") - F.greatest("above", "passed")
    nodes = staged(
        paths(marked, "leaf", "begin", "passed").groupBy("node").agg(
            F.min("id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent").alias("parent"),
            F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"),
            F.sum(of_members - of_nodes).alias("saved_tokens"), F.max(F.col("depth") == F.col("begin")).alias("entered"),
        ),
        "trie-nodes",
    )

    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    ends = end_lists(chain.filter("chunk = 0")).withColumnRenamed("last", "node")
    out = _parents(nodes).join(children, "node", "left").join(ends, "node", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )


def _parents(nodes: DataFrame) -> DataFrame:
    """Nodes with the smallest member of their parent.

    It is the node's own but where the smallest member enters its own part of
    the trie; those nodes look it up, and many may share a parent.
    """
    salt = F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")
    asked = nodes.filter("entered AND parent IS NOT NULL").select("node", "parent", salt.alias("salt"))
    wanted = asked.groupBy("parent").agg(F.count(F.lit(1)).alias("n")).select("parent")
    named = wanted.join(nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("found")), "parent")
    named = named.select("parent", "found", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    told = asked.join(named, ["parent", "salt"]).select("node", "found")
    parent = F.when(F.col("parent").isNotNull(), F.when(F.col("entered"), F.col("found")).otherwise(F.col("conv_id")))
    return nodes.join(told, "node", "left").select("*", parent.alias("parent_conv_id"))
