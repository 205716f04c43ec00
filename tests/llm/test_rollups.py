from collections import Counter

import pytest
from cases import docs, empty, rows

from tagloom.llm import rollups

CHANGE = "op string, doc_id long, source string, lang string, tokenizer_version string, n_tokens long, sign string"


def apply(spark, store, batch, rows_):
    return store.apply(batch, spark.createDataFrame([(*r, "x") for r in rows_], CHANGE))


def totals(store):
    return {tuple(r[:3]): tuple(r[3:]) for r in store.totals().collect()}


class Plain:
    """The same store as a list of live rows."""

    def __init__(self):
        self.live, self.done = [], set()

    def apply(self, batch, rows_):
        if batch in self.done:
            return
        self.done.add(batch)
        gone = {(r[1], r[4]) for r in rows_ if r[0] in ("delete", "revise")}
        self.live = [x for x in self.live if (x[0], x[3]) not in gone]
        self.live += [(r[1], r[2], r[3], r[4], r[5] or 0) for r in rows_ if r[0] in ("insert", "revise")]

    def totals(self):
        n, t = Counter(), Counter()
        for _, s, lang, v, k in self.live:
            n[s, lang, v] += 1
            t[s, lang, v] += k
        return {k: (n[k], t[k]) for k in n}


BATCHES = [
    ("a", [("insert", 1, "s", "en", "v1", 10), ("insert", 2, "s", "de", "v1", 5), ("insert", 2, "s", "de", "v1", 5), ("insert", None, None, None, "v1", 3)]),
    ("b", [("insert", 1, "s", "en", "v2", 11), ("revise", 1, "t", "en", "v1", 12), ("delete", 99, None, None, "v1", None)]),
    ("a", [("insert", 1, "s", "en", "v1", 10)]),
    ("c", [("delete", 2, None, None, "v1", None), ("insert", 3, "t", "fr", "v1", None), (None, 1, "s", "en", "v1", 7), ("merge", 1, "s", "en", "v1", 7)]),
    ("d", []),
    ("e", [("delete", None, None, None, "v1", 0), ("revise", 1, "t", "en", "v1", 1), ("revise", 1, "t", "en", "v1", 2)]),
]


def test_batches_equal_a_plain_store(spark, tmp_path):
    store, plain = rollups.RollupStore(spark, f"file://{tmp_path}/s"), Plain()
    assert totals(store) == {}
    for batch, rows_ in BATCHES:
        assert apply(spark, store, batch, rows_) == (batch not in plain.done)
        plain.apply(batch, rows_)
        assert totals(store) == plain.totals()
    # another session's view, and the ledger adds up to the same
    again = rollups.RollupStore(spark, f"file://{tmp_path}/s")
    assert totals(again) == plain.totals()


def test_failed_attempts_are_not_read(spark, tmp_path):
    store = rollups.RollupStore(spark, f"file://{tmp_path}/s")
    apply(spark, store, *BATCHES[0])
    want = totals(store)
    commit = store._commit
    store._commit = lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        apply(spark, store, *BATCHES[1])
    assert totals(store) == want
    store._commit = commit
    assert apply(spark, store, *BATCHES[1]) is True
    assert not apply(spark, store, *BATCHES[1])


def test_two_writers_count_a_batch_once(spark, tmp_path):
    a, b = (rollups.RollupStore(spark, f"file://{tmp_path}/s") for _ in range(2))

    def late():
        assert apply(spark, b, *BATCHES[0])  # the other writer commits first
        return spark.createDataFrame([(*r, "x") for r in BATCHES[0][1]], CHANGE)

    assert a.apply("a", late) is False
    plain = Plain()
    plain.apply(*BATCHES[0])
    assert totals(a) == plain.totals()


def test_corpus_history(spark, tmp_path):
    from test_packing import plain_ids

    given = [r for r in rows(6) if r[0] is not None]
    given += [(500, "Licensed under X\nth er on", "en", "a", 1), (501, "th er\nThis work is licensed under Y.", "en", "a", 1)]
    seen, gone = {}, set()
    for d, t, *_ in given:
        if t is not None:
            seen.setdefault(t, set()).add(d)
    for t, ds in seen.items():
        gone |= {d for d in ds if d > min(ds)}
    gone |= {d for d, t, *_ in given if t is None and d > min(x for x, y, *_ in given if y is None)}
    import re

    n, k = Counter(), Counter()
    for d, t, lang, src, _ in given:
        if d in gone:
            continue
        t = re.sub(rollups.LICENCE_LINE, "", t or "")
        ids = len(plain_ids(t))
        for v, more in (("word_bpe_49k", 0), ("word_bpe_49k+end", 1)):
            n[src, lang, v] += 1
            k[src, lang, v] += ids + more
    df = spark.createDataFrame(given, docs(spark).schema)
    store = rollups.corpus_history(spark, df, f"file://{tmp_path}/h")
    assert totals(store) == {x: (n[x], k[x]) for x in n}


def test_empty_table(spark, tmp_path):
    assert rollups.corpus_history(spark, empty(spark), f"file://{tmp_path}/e").totals().count() == 0


def test_a_small_batch_reads_its_partitions(spark, tmp_path):
    store = rollups.RollupStore(spark, f"file://{tmp_path}/s")
    apply(spark, store, "a", [("insert", i, "s", "en", "v1", i) for i in range(500)])
    read = []
    ledger = store.ledger
    store.ledger = lambda parts=None: read.append(ledger(parts)) or read[-1]
    apply(spark, store, "b", [("delete", 7, None, None, "v1", None), ("revise", 8, "t", "en", "v1", 1)])
    assert 1 <= len({f.split("_part=")[1].split("/")[0] for f in read[0].inputFiles()}) and read[0].count() < 60
    assert totals(store) == {("s", "en", "v1"): (498, sum(range(500)) - 15), ("t", "en", "v1"): (1, 1)}
    assert ledger().count() == 503


def test_hot_keys_meet_by_broadcast(spark):
    from pyspark.sql import functions as F

    from tagloom.llm.common import join_hot

    big = spark.range(6000).select(F.when(F.col("id") < 3000, 0).when(F.col("id") < 5990, F.col("id")).alias("k"), "id")
    one = big.groupBy("k").agg(F.min("id").alias("low"), F.count("*").alias("n"))
    got = join_hot(big, one, ["k"], "n")
    assert got.count() == 5990 and got.filter("k = 0 and low = 0").count() == 3000
    assert got.filter("k > 0 and low != id").count() == 0
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()
