"""Approximate nearest neighbours by cross-polytope hashing.

A table rotates unit vectors by three rounds of random signs and a fast
Hadamard transform and assigns each to the nearest signed axis.  A query
probes the axes nearest to it in every table, best first; rows in probed
buckets are its candidates and are ranked by their exact cosine.

Every row is indexed.  How many axes a query probes is measured: for a
bounded sample of queries (``TUNE_QUERIES``, by a hash of the id) the exact
neighbours among all rows are found, and the probes are the fewest that reach
``TARGET_RECALL`` of them.  Queries that find fewer than asked for are searched
again with ``MORE_PROBES`` times the probes, and at last in all buckets.

On Spark: the index (ids, vectors, bucket numbers) is a written table.
Queries, a stated set, are sent to the tasks in blocks of bounded size; each
task meets the block's queries with its own rows bucket by bucket, so vectors
are never shuffled and a bucket of any size is split among the tasks that
hold its rows.  A task returns its best few per query, and one small shuffle
merges them.

Defined cases: vectors that are null, zero or hold null or non-finite
components, and rows without an id, take no part; fully repeated rows count
once; a query's own id is never its neighbour; vectors of different lengths
are not compared; equal scores go to the smaller id; fewer candidates than
asked for give fewer rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import map_batches, staged
from tagloom.session import scratch_path

TABLES = 16
TARGET_RECALL = 0.97
TUNE_QUERIES = 200
BLOCK_QUERIES = 8192
CHUNK_ROWS = 32_768
MORE_PROBES = 4
TIE = 1e-9  # scores of the matrix product differ from the exact ones by less
SEED = 11


# --- hashing -------------------------------------------------------------------


def hadamard(a: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of rows whose length is a power of two, normalised."""
    n, h = a.shape[1], 1
    while h < n:
        b = a.reshape(len(a), -1, 2, h)
        a = np.stack((b[:, :, 0] + b[:, :, 1], b[:, :, 0] - b[:, :, 1]), axis=2).reshape(len(a), n)
        h *= 2
    return a / np.sqrt(n)


def rotations(x: np.ndarray, tables: int, seed: int = SEED):
    """The rotated rows, table by table; rows are padded to a power of two."""
    d = 1 << max(1, int(np.ceil(np.log2(max(x.shape[1], 2)))))
    wide = np.zeros((len(x), d))
    wide[:, : x.shape[1]] = x
    for t in range(tables):
        signs = np.random.default_rng((seed, d, t)).choice([-1.0, 1.0], (3, d))
        y = wide
        for s in signs:
            y = hadamard(y * s)
        yield y


def buckets(x: np.ndarray, tables: int) -> np.ndarray:
    """Nearest signed axis of each row in each table: (rows, tables); axis i is 2i, its opposite 2i + 1."""
    out = np.empty((len(x), tables), np.int32)
    for t, y in enumerate(rotations(x, tables)):
        a = np.abs(y).argmax(axis=1)
        out[:, t] = 2 * a + (y[np.arange(len(y)), a] < 0)
    return out


def probe_order(x: np.ndarray, tables: int) -> np.ndarray:
    """Buckets of each query in each table, nearest axis first: (queries, tables, buckets)."""
    out = []
    for y in rotations(x, tables):
        both = np.stack((y, -y), axis=2).reshape(len(y), -1)
        out.append(np.argsort(-both, axis=1, kind="stable"))
    return np.stack(out, axis=1) if len(x) else np.zeros((0, tables, 2), np.int64)


def unit(x: np.ndarray) -> np.ndarray:
    # scaled by the largest component first, so squares neither overflow nor vanish
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


# --- search inside a task --------------------------------------------------------


class Best:
    """The best candidates of each query so far, of one task."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.full((queries, 0), -np.inf)
        self.row = np.zeros((queries, 0), np.int64)

    def add(self, q: np.ndarray, rows: np.ndarray, s: np.ndarray) -> None:
        """Scores ``s`` (q, rows) of some queries against some rows."""
        if s.shape[1] > self.k:
            keep = np.argpartition(-s, self.k - 1, axis=1)[:, : self.k]
            s, rows = np.take_along_axis(s, keep, 1), rows[keep]
        else:
            rows = np.broadcast_to(rows, s.shape)
        if self.score.shape[1] == 0:
            self.score = np.full((len(self.score), self.k), -np.inf)
            self.row = np.full((len(self.row), self.k), -1, np.int64)
        both, who = np.concatenate((self.score[q], s), axis=1), np.concatenate((self.row[q], rows), axis=1)
        # a row met in several tables counts once
        order = np.argsort(who, axis=1, kind="stable")
        who, both = np.take_along_axis(who, order, 1), np.take_along_axis(both, order, 1)
        both[:, 1:][(who[:, 1:] == who[:, :-1])] = -np.inf
        best = np.argsort(-both, axis=1, kind="stable")[:, : self.k]
        self.score[q], self.row[q] = np.take_along_axis(both, best, 1), np.take_along_axis(who, best, 1)


def search_rows(ids, x, b, block: dict, probes: int | None, k: int):
    """Best neighbours of a block's queries among rows of one vector length.

    ``probes`` None compares every row.  Yields columns query, vec_id, score
    and probe (the number of probes that reach the pair).
    """
    # equal vectors are one candidate with their smallest ids
    raw = np.ascontiguousarray(x).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel()
    _, first, group = np.unique(raw, return_index=True, return_inverse=True)
    group = group.ravel()
    by = np.lexsort((ids, group))  # ids ascend inside a group, repeated rows count once
    by = by[np.append(True, (np.diff(group[by]) != 0) | (np.diff(ids[by]) != 0))]
    start = np.searchsorted(group[by], np.arange(len(first)))
    end = np.append(start[1:], len(by))
    u, ub = unit(x[first].astype(float)), b[first]
    qu, qid, order_q, rank_q = block["unit"], block["id"], block["order"], block["rank"]
    best = Best(len(qid), k + 4)  # more than k: near ties are settled by the exact scores below

    def near(q: int) -> np.ndarray:
        """The candidates of a query that may be among its k best by the exact scores."""
        s, rows = best.score[q], best.row[q]
        rows = rows[np.isfinite(s)]
        if len(rows) < k + 4 or s[k + 3] < s[k - 1] - TIE:
            return rows
        # as many as were kept tie with the k-th: all candidates are looked at again
        met = np.ones(len(u), bool) if probes is None else (rank_q[q, np.arange(ub.shape[1]), ub] < probes).any(axis=1)
        at = np.flatnonzero(met)
        return at[u[at] @ qu[q] >= s[k - 1] - TIE]

    everything = np.arange(len(qid))
    if probes is None:
        best.add(everything, np.arange(len(u)), qu @ u.T)
    else:
        for t in range(ub.shape[1]):
            at = np.argsort(ub[:, t], kind="stable")
            cut = np.searchsorted(ub[at, t], np.arange(rank_q.shape[2] + 1))
            for v in np.flatnonzero(np.diff(cut)):
                q = np.flatnonzero(rank_q[:, t, v] < probes)
                if len(q):
                    rows = at[cut[v] : cut[v + 1]]
                    best.add(q, rows, qu[q] @ u[rows].T)
    out_q, out_id, out_s, out_p = [], [], [], []
    for q in everything.tolist():
        rows = near(q) if best.score.shape[1] else []
        if not len(rows):
            continue
        s = np.minimum((u[rows] * qu[q]).sum(axis=1), 1.0)
        need = np.array([rank_q[q, np.arange(ub.shape[1]), ub[r]].min() + 1 for r in rows])
        got = []
        if len(rows) > k + 4:  # the best k + 1 by score and smallest id hold the answer: one may be the query
            keep = np.lexsort((ids[by[start[rows]]], -s))[: k + 1]
            rows, s, need = rows[keep], s[keep], need[keep]
        for r, score, p in zip(rows.tolist(), s.tolist(), need.tolist(), strict=True):
            mine = by[start[r] : min(end[r], start[r] + k + 1)]
            got += [(-score, int(ids[m]), p) for m in mine if ids[m] != qid[q]]
        got.sort()
        for score, i, p in got[:k]:
            out_q.append(block["uid"][q])
            out_id.append(i)
            out_s.append(-score)
            out_p.append(p)
    return {"query": out_q, "vec_id": out_id, "score": out_s, "probe": out_p}


# --- on Spark ------------------------------------------------------------------


def build_index(vectors: DataFrame, id_col="vec_id", vector_col="embedding", tables: int = TABLES) -> DataFrame:
    """vec_id, vector (doubles), buckets (one per table) of every usable row, as a written table."""
    v = F.col(vector_col).cast("array<double>")
    good = (
        F.col(id_col).isNotNull()
        & F.coalesce(F.size(v) > 0, F.lit(False))
        & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
        & F.exists(v, lambda c: c != 0)
    )
    rows = vectors.filter(good).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vector"))

    def make():
        def f(b):
            for at, x in by_dimension(b.column(1)):
                yield {
                    "vec_id": b.column(0).take(pa.array(at)),
                    "vector": list(x),
                    "buckets": list(buckets(unit(x), tables)),
                }

        return f

    return staged(map_batches(rows, make, "vec_id long, vector array<double>, buckets array<int>"), "ann-index")


def by_dimension(column: pa.Array):
    """(places, matrix) of the vectors of each length in a list column."""
    n = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, int)
    for d in np.unique(n).tolist():
        at = np.flatnonzero(n == d)
        yield at, column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), d)


def make_block(rows: pa.Table, tables: int) -> dict[int, dict]:
    """Queries by vector length: unit vectors, ids, and the rank of every bucket in their probe order."""
    out = {}
    column = rows.column("vector").combine_chunks()
    ids, uid = rows.column("vec_id").to_numpy(), rows.column("uid").to_numpy()
    for at, x in by_dimension(column):
        u = unit(x)
        order = probe_order(u, tables)
        rank = np.empty(order.shape, np.int16)
        np.put_along_axis(rank, order, np.arange(order.shape[2], dtype=np.int16)[None, None, :], axis=2)
        out[x.shape[1]] = {"unit": u, "id": ids[at], "uid": uid[at], "order": None, "rank": rank}
    return out


def search_block(index: DataFrame, queries: pa.Table, tables: int, probes: int | None, k: int) -> DataFrame:
    """query, vec_id, score, probe: the block's ``k`` nearest, merged over all tasks."""
    sent = index.sparkSession.sparkContext.broadcast(make_block(queries, tables))

    def make():
        held: list[pa.RecordBatch] = []

        def search():
            t = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            column = t.column(1).combine_chunks()
            allb = t.column(2).combine_chunks().flatten().to_numpy().reshape(len(t), -1)
            for at, x in by_dimension(column):
                if x.shape[1] in sent.value:
                    yield search_rows(t.column(0).to_numpy()[at], x, allb[at], sent.value[x.shape[1]], probes, k)

        def f(b):
            held.append(b)
            if sum(map(len, held)) >= CHUNK_ROWS:
                yield from search()

        f.finish = lambda: search() if held else ()
        return f

    found = map_batches(
        index.select("vec_id", "vector", "buckets"), make, "query long, vec_id long, score double, probe int"
    ).groupBy("query", "vec_id").agg(F.max("score").alias("score"), F.min("probe").alias("probe"))
    w = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def tune_probes(index: DataFrame, queries: DataFrame, tables: int, k: int, recall: float, most: int = TUNE_QUERIES) -> int:
    """Fewest probes that reach ``recall`` of the exact neighbours of a sample of queries."""
    sample = queries.orderBy(F.xxhash64("vec_id"), "uid").limit(most).toArrow()
    if not sample.num_rows:
        return 1
    need = sorted(r["probe"] for r in search_block(index, sample, tables, None, k).select("probe").collect())
    return need[min(len(need) - 1, int(np.ceil(recall * len(need))) - 1)] if need else 1


def nearest(
    vectors: DataFrame,
    is_query: F.Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    tables: int = TABLES,
    recall: float = TARGET_RECALL,
    probes: int | None = None,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` nearest found of each query row.

    ``is_query`` is a condition on the column vec_id of the index.
    """
    spark = vectors.sparkSession
    index = build_index(vectors, id_col, vector_col, tables)
    asked = index.filter(is_query).select("vec_id", "vector").distinct()
    asked = staged(asked.withColumn("uid", F.monotonically_increasing_id()), "ann-queries")
    probes = probes or tune_probes(index, asked, tables, k, recall)
    widest = index.agg(F.max(F.size("vector"))).first()[0] or 1
    every = 2 << max(1, int(np.ceil(np.log2(max(widest, 2)))))  # buckets of a table
    path = scratch_path(spark, "ann-found")
    read = spark.read.schema("query long, rank int, vec_id long, score double, turn int")
    # ids of a length, repeats counted once: a query can find at most those
    sizes = index.groupBy(F.size("vector").alias("dim")).agg(F.countDistinct("vec_id").alias("ids"))
    left, turn = asked, 0
    while True:
        n_blocks = max(1, -(-left.count() // block_queries))
        block = F.pmod(F.xxhash64("uid"), F.lit(n_blocks))
        for i in range(n_blocks):
            part = left.filter(block == i).toArrow()
            found = search_block(index, part, tables, None if probes >= every else probes, k)
            found = found.select("query", "rank", "vec_id", "score", F.lit(turn).alias("turn"))
            found.write.mode("append").parquet(path)
        if probes >= every:
            break
        got = read.parquet(path).filter(F.col("turn") == turn).groupBy(F.col("query").alias("uid")).agg(F.count("*").alias("n"))
        left = left.join(got, "uid", "left").withColumn("n", F.coalesce("n", F.lit(0))).filter(F.col("n") < k)
        left = left.withColumn("dim", F.size("vector")).join(F.broadcast(sizes), "dim")
        left = left.filter(F.col("n") < F.col("ids") - 1).select(asked.columns)  # its own id is none
        left = staged(left, "ann-left")
        if left.isEmpty():
            break
        turn, probes = turn + 1, min(every, probes * MORE_PROBES)
    found = read.parquet(path)
    last = found.groupBy("query").agg(F.max("turn").alias("turn"))
    found = found.join(last, ["query", "turn"])  # a later search of a query holds what earlier ones found
    names = asked.select(F.col("uid").alias("query"), F.col("vec_id").alias("query_id"))
    return found.join(names, "query").select("query_id", "rank", "vec_id", "score")
