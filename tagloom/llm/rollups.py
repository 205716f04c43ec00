"""Token-count rollups kept current by signed deltas.

A store holds, for every committed batch, the signed rows of single documents
(the ledger) and their sums by source, language and tokenizer version (the
deltas).  Totals are the sum of the deltas.  The ledger lies in partitions by
a hash of the document, and a batch reads those that its deletes and revisions
fall into, so a small batch costs what it changes.

A batch of changes inserts, deletes or revises documents under a tokenizer
version.  Deletes and revisions look up the live ledger rows of their
documents and book them with the opposite sign; inserts and revisions book
their new counts.

Commits are idempotent: a batch writes into a folder of its own attempt and
then creates the marker of its batch id, which names that folder.  Creating
a marker that exists fails, so a batch counts once, however often it is sent
or tried again; folders without a marker are never read.

Defined cases: null ids, sources and languages are values like others;
several rows of one id in a batch are booked each (an insert adds, a revision
replaces all live rows of its id and version by all its rows); a delete of an
unknown document and a null or unknown operation change nothing; null counts
are 0; an empty batch commits and changes nothing; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.common import join_hot, map_batches, staged, text_bytes
from tagloom.llm.tokens import WORD_BPE, tokenizer_path, word_tokenizer
from tagloom.session import scratch_path

KEYS = ("source", "lang", "tokenizer_version")
LEDGER = "doc_id long, source string, lang string, tokenizer_version string, n_tokens long, sign long"
PART = "_part"
PARTS = 64  # ledger partitions; part of the stored layout
DELTAS = "source string, lang string, tokenizer_version string, n_docs long, n_tokens long"


def part_of(doc_id: F.Column) -> F.Column:
    """The ledger partition of a document."""
    return F.pmod(F.xxhash64(doc_id), F.lit(PARTS)).cast("int")


class RollupStore:
    """Batches, their markers and totals below one folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.root}/commits"))

    def committed(self) -> dict[str, str]:
        """Folder of each committed batch id."""
        out = {}
        for s in self._fs.listStatus(self._path(f"{self.root}/commits")):
            name = s.getPath().getName()
            if not name.startswith(("_", ".")):
                batch, _, folder = name.rpartition("@")
                batch = bytes.fromhex(batch).decode()
                out[batch] = min(folder, out.get(batch, folder))
        return out

    def _commit(self, batch_id: str, folder: str) -> bool:
        """Create the batch's marker; False if another attempt was first.

        The name of the lock is the batch alone, so two attempts cannot both
        create it; the marker that names the folder follows.
        """
        lock = self._path(f"{self.root}/commits/.{batch_id.encode().hex()}")
        try:
            self._fs.create(lock, False).close()
        except Exception:  # noqa: BLE001 - the file exists, or the store cannot be written
            if not self._fs.exists(lock):
                raise
            if batch_id in self.committed():
                return False  # else: an earlier attempt stopped between lock and marker
        self._fs.create(self._path(f"{self.root}/commits/{batch_id.encode().hex()}@{folder}"), False).close()
        return True

    def _read(self, part: str, schema: str) -> DataFrame:
        paths = [f"{self.root}/{part}/attempt={f}" for f in self.committed().values()]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{part}").parquet(*sorted(paths))

    def ledger(self, parts: list[int] | None = None) -> DataFrame:
        """Signed rows of all batches, or those of some partitions (see ``part_of``)."""
        rows = self._read("ledger", f"{LEDGER}, {PART} int")
        return (rows if parts is None else rows.filter(F.col(PART).isin(parts))).drop(PART)

    def totals(self) -> DataFrame:
        """source, lang, tokenizer_version, n_docs, n_tokens; groups without live documents are left out."""
        sums = self._read("deltas", DELTAS).groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.filter((F.col("n_docs") != 0) | (F.col("n_tokens") != 0))

    def apply(self, batch_id: str, changes: DataFrame | Callable[[], DataFrame]) -> bool:
        """Book a batch; False (and no work) if it is committed already.

        ``changes``: op (insert, delete, revise), doc_id, source, lang,
        tokenizer_version, n_tokens.  A function is only called for new batches.
        """
        if batch_id in self.committed():
            return False
        changes = changes() if callable(changes) else changes
        changes = staged(
            changes.select(
                "op",
                F.col("doc_id").cast("long").alias("doc_id"),
                F.col("source").cast("string").alias("source"),
                F.col("lang").cast("string").alias("lang"),
                F.col("tokenizer_version").cast("string").alias("tokenizer_version"),
                F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)).alias("n_tokens"),
            ),
            "rollup-changes",
        )
        old = changes.filter(F.col("op").isin("delete", "revise"))
        out = changes.filter(F.col("op").isin("insert", "revise")).drop("op").withColumn("sign", F.lit(1).cast("long"))
        if not old.isEmpty():
            keys = old.select(F.col("doc_id").alias("d"), F.col("tokenizer_version").alias("v")).distinct()
            parts = [r[0] for r in keys.select(part_of(F.col("d"))).distinct().collect()]  # at most PARTS numbers
            ledger = self.ledger(parts)
            mine = ledger.join(
                keys, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("tokenizer_version").eqNullSafe(F.col("v")), "left_semi"
            )
            live = mine.groupBy("doc_id", *KEYS, "n_tokens").agg((-F.sum("sign")).alias("sign")).filter("sign != 0")
            out = out.unionByName(live)
        folder = uuid.uuid4().hex
        ledger, deltas = (f"{self.root}/{part}/attempt={folder}" for part in ("ledger", "deltas"))
        # a document's rows are few; null ids share a partition and are dealt over several files of it
        out = out.withColumn(PART, part_of(F.col("doc_id")))
        spread = F.when(F.col("doc_id").isNull(), F.xxhash64(*KEYS, "n_tokens"))
        out.repartition(PART, F.pmod(F.coalesce(spread, F.lit(0)), F.lit(8))).write.partitionBy(PART).parquet(ledger)
        rows = self.spark.read.schema(LEDGER).parquet(ledger)
        rows.groupBy(*KEYS).agg(
            F.sum("sign").alias("n_docs"), F.sum(F.col("sign") * F.col("n_tokens")).alias("n_tokens")
        ).write.parquet(deltas)
        return self._commit(batch_id, folder)


def count_tokens(docs: DataFrame, path: str | None = None, text_col: str = "text") -> DataFrame:
    """doc_id, source, lang and n_tokens of every row, by a public tokenizer."""
    path = path or tokenizer_path(WORD_BPE)

    def make():
        t = word_tokenizer(path)

        def f(b):
            n = [len(x) // 4 for x in t.ids_batch(b.column(3).to_pylist())]
            yield {"doc_id": b.column(0), "source": b.column(1), "lang": b.column(2), "n_tokens": n}

        f.finish = t.rest
        return f

    given = docs.select(
        F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("lang").cast("string"), text_bytes(F.col(text_col))
    )
    return map_batches(given, make, "doc_id long, source string, lang string, n_tokens long")


LICENCE_LINE = r"(?m)^(Licensed under|This work is licensed under)[^\n]*\n?"


def corpus_history(spark: SparkSession, docs: DataFrame, root: str | None = None) -> RollupStore:
    """A corpus's life as batches: loaded under two tokenizer versions, exact copies withdrawn,
    texts with licence lines revised without them; the load is sent twice."""
    store = RollupStore(spark, root or scratch_path(spark, "rollups"))
    versions = ("word_bpe_49k", "word_bpe_49k+end")
    counted = staged(count_tokens(docs), "rollup-counts")

    def under(df, op, version, more):
        return df.select(
            F.lit(op).alias("op"), "doc_id", "source", "lang", F.lit(version).alias("tokenizer_version"),
            (F.col("n_tokens") + more).alias("n_tokens"),
        )

    def load():
        return under(counted, "insert", versions[0], 0).unionByName(under(counted, "insert", versions[1], 1))

    def both(df, op):
        return under(df, op, versions[0], 0).unionByName(under(df, op, versions[1], 1))

    def copies():
        rows = docs.select("doc_id", F.xxhash64("text").alias("a"), F.xxhash64(F.lit(17), "text").alias("b"))
        rows = staged(rows, "rollup-texts")
        first = rows.groupBy("a", "b").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
        first = staged(first, "rollup-copies")
        gone = join_hot(rows, first, ["a", "b"], "n").filter("doc_id > first").select("doc_id").distinct()
        none = F.lit(None).cast("string")
        return both(gone.select("doc_id", none.alias("source"), none.alias("lang"), F.lit(0).alias("n_tokens")), "delete")

    def revisions():
        live = store.ledger().groupBy("doc_id").agg(F.sum("sign").alias("n")).filter("n > 0").select("doc_id")
        new = docs.filter(F.col("text").rlike(LICENCE_LINE)).join(live, "doc_id", "left_semi")
        return both(count_tokens(new.withColumn("text", F.regexp_replace("text", LICENCE_LINE, ""))), "revise")

    store.apply("load", load)
    store.apply("withdraw copies", copies)
    store.apply("drop licence lines", revisions)
    store.apply("load", load)
    return store
