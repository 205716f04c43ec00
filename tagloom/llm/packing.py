"""Best-fit packing of documents into sequences, certified by lower bounds.

Pieces are dealt to groups of bounded size.  A group packs its pieces by
best-fit decreasing and compares the number of sequences with a lower bound
from dual feasible functions; where the two are equal no packing of the group
can do better.  A group with a gap keeps its full sequences and hands the
rest on; a certified group hands on its emptiest sequence only.  What was
handed on meets the pieces of other groups in the next round, in fewer
groups, until one group is left or the rounds end.

Only lengths and positions are shuffled, never texts or token ids.

Defined cases: a null or empty text is the end id alone; repeated rows are
documents of their own; a null doc_id is kept; ties of length may be placed
in any order; an empty table gives no pieces; other columns are not read by
``document_pieces`` and pass through ``pack``.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.common import OWN, arrow_schema, map_batches, staged, text_bytes, with_package
from tagloom.llm.tokens import WORD_BPE, tokenizer_path, word_tokenizer

CAPACITY = 2048
END_ID = 0
GROUP_PIECES = 200_000
MAX_ROUNDS = 8
_SEQ_BITS = 22  # sequences of one group; a group never has more than its pieces

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


# --- bounds and one group ------------------------------------------------------


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Largest of the bounds that three families of dual feasible functions give.

    Each function keeps the sum over any set that fits one sequence at one or
    less, so the sum over all pieces, rounded up, bounds the sequences needed.
    """
    if not len(sizes):
        return 0
    x, n = np.unique(np.asarray(sizes, dtype=np.int64), return_counts=True)
    best = -(-int((x * n).sum()) // capacity)
    # pieces over capacity - t count whole, pieces under t not at all
    for t in np.unique(np.concatenate((x[x <= capacity // 2], capacity - x[x > capacity // 2] + 1))):
        if 0 < t <= capacity // 2:
            f = np.where(x > capacity - t, capacity, np.where(x < t, 0, x))
            best = max(best, -(-int((f * n).sum()) // capacity))
    # rounding to multiples of 1/k
    for k in range(1, 101):
        whole = ((k + 1) * x) % capacity == 0
        f = np.where(whole, x * k, (k + 1) * x // capacity * capacity)
        best = max(best, -(-int((f * n).sum()) // (capacity * k)))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(sequence, offset) of each piece, and what is left free in each sequence."""
    seq = np.empty(len(sizes), dtype=np.int64)
    off = np.empty(len(sizes), dtype=np.int64)
    free: list[int] = []
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = 0  # bit r: a sequence with r free exists
    order = np.argsort(-sizes, kind="stable")
    for i, s in zip(order.tolist(), sizes[order].tolist(), strict=True):
        fits = some >> s
        if fits:
            r = s + (fits & -fits).bit_length() - 1
            b = by_free[r].pop()
            if not by_free[r]:
                some &= ~(1 << r)
        else:
            r, b = capacity, len(free)
            free.append(capacity)
        seq[i], off[i] = b, capacity - r
        free[b] = r - s
        by_free[r - s].append(b)
        some |= 1 << (r - s)
    return seq, off, free


def pack_group(sizes: np.ndarray, capacity: int, last: bool) -> dict[str, np.ndarray]:
    seq, off, free = best_fit_decreasing(sizes, capacity)
    bound = lower_bound(sizes, capacity)
    left = np.array(free, dtype=np.int64)
    if last or not len(left):
        go = np.zeros(len(left), dtype=bool)
    elif len(left) > bound:
        go = left > 0
    else:
        go = np.zeros(len(left), dtype=bool)
        go[np.argmax(left)] = left.max() > 0
    n = len(sizes)
    return {
        "seq": seq,
        "offset": off,
        "moved": go[seq],
        "bound": np.full(n, bound),
        "bins": np.full(n, len(left)),
    }


# --- on Spark ------------------------------------------------------------------


def document_pieces(
    docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False
) -> DataFrame:
    """Token pieces of whole texts: each text's ids and one end id, cut only where longer than ``capacity``.

    ``with_ids`` adds the ids themselves (array of int).
    """
    path = path or tokenizer_path(WORD_BPE)
    schema = PIECE_SCHEMA + (", ids array<int>" if with_ids else "")

    def make():
        t = word_tokenizer(path)
        end = np.array([END_ID], dtype="<u4").tobytes()

        def f(b):
            ids = b.column(0).to_pylist()
            out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            for d, raw in zip(ids, t.ids_batch(b.column(1).to_pylist()), strict=True):
                raw += end
                for k, a in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[a : a + 4 * capacity]
                    out["doc_id"].append(d)
                    out["piece"].append(k)
                    out["start"].append(a // 4)
                    out["length"].append(len(part) // 4)
                    out["ids_crc32"].append(zlib.crc32(part))
                    if with_ids:
                        out["ids"].append(np.frombuffer(part, dtype="<i4"))
            yield out

        f.finish = t.rest
        return f

    return map_batches(docs.select(F.col("doc_id").cast("long"), text_bytes(F.col("text"))), make, schema)


def pack(
    pieces: DataFrame,
    size_col: str = "length",
    capacity: int = CAPACITY,
    group_pieces: int = GROUP_PIECES,
    max_rounds: int = MAX_ROUNDS,
) -> DataFrame:
    """``pieces`` and where each is placed: sequence_id, offset, group_bound, group_sequences.

    The last two say how the group that placed a piece fared: where they are
    equal the group's packing is certified.
    """
    size = F.coalesce(F.col(size_col).cast("long"), F.lit(0))
    given = [c for c in pieces.columns if c not in ("sequence_id", "offset", "group_bound", "group_sequences")]
    pool = staged(
        pieces.select(*given, size.alias(OWN + "size"), F.monotonically_increasing_id().alias(OWN + "uid")), "pack-pool"
    )
    done, base = [], 0
    for turn in range(max_rounds):
        total = pool.count()
        groups = max(1, -(-total // group_pieces))
        last = groups == 1 or turn == max_rounds - 1
        placed = staged(_one_round(pool, groups, capacity, last, turn), "pack-round")
        wide = F.lit(base).cast("long") + F.shiftleft(F.col(OWN + "group").cast("long"), _SEQ_BITS)
        done.append(
            placed.filter(~F.col(OWN + "moved")).select(
                *given,
                (wide + F.col(OWN + "seq")).alias("sequence_id"),
                F.col(OWN + "offset").alias("offset"),
                F.col(OWN + "bound").alias("group_bound"),
                F.col(OWN + "bins").alias("group_sequences"),
            )
        )
        if last:
            break
        base += groups << _SEQ_BITS
        pool = placed.filter(OWN + "moved").select(*given, OWN + "size", OWN + "uid")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def _one_round(pool: DataFrame, groups: int, capacity: int, last: bool, turn: int) -> DataFrame:
    dealt = pool.withColumn(
        OWN + "group", F.pmod(F.xxhash64(F.col(OWN + "uid"), F.lit(turn)), F.lit(groups)).cast("int")
    )
    result = T.StructType(
        list(dealt.schema.fields)
        + [
            T.StructField(OWN + "seq", T.LongType()),
            T.StructField(OWN + "offset", T.LongType()),
            T.StructField(OWN + "moved", T.BooleanType()),
            T.StructField(OWN + "bound", T.LongType()),
            T.StructField(OWN + "bins", T.LongType()),
        ]
    )
    arrow = arrow_schema(result)
    at = dealt.columns.index(OWN + "size")

    def one(t: pa.Table) -> pa.Table:
        sizes = t.column(at).to_numpy()
        if len(sizes) and sizes.max() > capacity:
            raise ValueError(f"a piece of {sizes.max()} does not fit {capacity}")
        got = pack_group(sizes, capacity, last)
        cols = [c.cast(arrow.field(i).type) for i, c in enumerate(t.columns)]
        cols += [pa.array(got[k]) for k in ("seq", "offset", "moved", "bound", "bins")]
        return pa.Table.from_arrays(cols, schema=arrow)

    return with_package(dealt).groupBy(OWN + "group").applyInArrow(one, result)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, **kw) -> DataFrame:
    """Pieces of all documents with their places (see ``document_pieces`` and ``pack``)."""
    return pack(document_pieces(docs, capacity, path), capacity=capacity, **kw)


def sequences(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, **kw) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (array), doc_ids and starts in place order.

    A sequence holds at most ``capacity`` ids, so each group is bounded.
    """
    placed = pack(document_pieces(docs, capacity, path, with_ids=True), capacity=capacity, **kw)
    part = F.struct("offset", "doc_id", "piece", "ids")
    g = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("p"))
    return g.select(
        "sequence_id",
        F.flatten("p.ids").alias("ids"),
        F.col("p.doc_id").alias("doc_ids"),
        F.col("p.offset").alias("starts"),
    )
