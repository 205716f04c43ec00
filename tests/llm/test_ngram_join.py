import random

import pytest
from cases import SCHEMA, clashing, docs, empty, rows, words
from pyspark.sql import functions as F

from tagloom.llm import graph, ngram_join
from tagloom.llm.common import join_hot


def grams(text, n=5):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def near_rows(seed=0):
    rng = random.Random(seed)
    out = rows(seed)
    for g in range(6):
        base = words(rng, rng.randint(20, 200)).split()
        for k in range(rng.choice([2, 3, 40])):
            w = list(base)
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = words(rng, 1)
            out.append((1000 + 100 * g + k, " ".join(w), "en", "a", 1))
    return out


def brute(given, threshold=0.8):
    sets = [grams(r[1]) for r in given]
    n = len(given)
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links, texts = [0] * n, [set() for _ in range(n)]
    for i in range(n):
        for j in range(i):
            u = len(sets[i] | sets[j])
            s = len(sets[i] & sets[j]) / u if u else 1.0
            if s >= threshold:
                links[i] += 1
                links[j] += 1
                if sets[i] != sets[j]:
                    texts[i].add(sets[j])
                    texts[j].add(sets[i])
                parent[root(i)] = root(j)
    ids = {}
    for i in range(n):
        if given[i][0] is not None:
            ids[root(i)] = min(ids.get(root(i), 1 << 60), given[i][0])
    same = {}
    for i in range(n):
        same.setdefault(sets[i], []).append(given[i][0])
    out = []
    for i in range(n):
        mine = [x for x in same[sets[i]] if x is not None]
        out.append((given[i][0], ids.get(root(i)), min(mine) if mine else None, links[i], len(same[sets[i]]) - 1, len(texts[i])))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [256, 5])
def test_equals_brute_force(spark, block):
    given = near_rows()
    df = clashing(spark.createDataFrame(given, SCHEMA)).repartition(4)
    got = ngram_join.ngram_join(df, block=block).collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute(given)


def test_one_of_each_class_stays(spark):
    given = near_rows(1)
    df = clashing(spark.createDataFrame(given, SCHEMA))
    out = ngram_join.keep_one(df)
    assert out.columns == df.columns
    kept = sorted([r["doc_id"] for r in out.collect()], key=repr)
    want = {c for _, c, *_ in brute(given)}
    assert sorted(kept, key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    assert ngram_join.ngram_join(empty(spark)).count() == 0
    assert ngram_join.keep_one(empty(spark)).count() == 0


def test_only_distinct_rows_stay_whole(spark):
    d = docs(spark, 5, 10)
    out = ngram_join.keep_one(d).collect()
    assert {(r["doc_id"], r["text"]) for r in out} <= {(r[0], r[1]) for r in rows(5, 10)}


def test_band_counts_reach_the_recall():
    for t in (0.5, 0.8, 0.9):
        bands, r = ngram_join.band_counts(t, 0.99)
        assert 1 - (1 - t**r) ** bands >= 0.99 - 1e-9 and bands * r <= ngram_join.MAX_HASHES


def test_components(spark):
    rng = random.Random(0)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + i, 100) for i in range(1, 30)] + [(7, 7)]
    edges += [(200 + rng.randrange(40), 200 + rng.randrange(40)) for _ in range(30)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    assert got == {x: root(x) for e in edges if e[0] != e[1] for x in e}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_chain_costs_its_meetings(spark):
    """Each text is like its neighbours only: the group is one, verified pairs grow with its length."""
    steps, width = 1200, 60
    ws = [f"w{i}" for i in range(steps * 4 + width)]
    given = [(i, " ".join(ws[4 * i : 4 * i + width]), "en", "a", 1) for i in range(steps)]
    df = spark.createDataFrame(given, SCHEMA).repartition(4)
    hasher = ngram_join.MinHash(*ngram_join.band_counts(0.8, 0.999))
    reps = ngram_join.staged(ngram_join.signatures(df, 5, hasher).withColumnRenamed("doc_id", "rid"), "test-chain")
    units = ngram_join.candidate_units(reps, 64)
    sizes = units.groupBy("c1", "b1", "c2", "b2").count().collect()
    assert sum(r["count"] for r in sizes) < 60 * steps  # all pairs of blocks would be steps**2 / 64 texts, and grow so
    assert sum(r["count"] ** 2 for r in sizes) < steps * steps
    got = ngram_join.ngram_join(df, block=64).collect()
    links = {r["doc_id"]: r["n_links"] for r in got}
    assert {r["class_id"] for r in got} == {0} and links[0] == links[steps - 1] == 1
    assert all(links[i] == 2 for i in range(1, steps - 1))


def joins_of_written_steps(monkeypatch, edges):
    """Joins in the plan of each table that components() writes."""
    found = []

    def watched(df, name):
        found.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return staged(df, name)

    staged = graph.staged
    monkeypatch.setattr(graph, "staged", watched)
    got = {r["node"]: r["component"] for r in graph.components(edges).collect()}
    return found, got


def test_components_are_found_by_small_plans(spark, monkeypatch):
    """Large plans filled the driver: a step is one join in parts, and none where no node is a hub."""
    groups = spark.range(0, 10_000).filter("id % 10 > 0").select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    found, got = joins_of_written_steps(monkeypatch, groups)
    assert not any(found) and got == {i: i - i % 10 for i in range(10_000)}


def test_components_of_a_hub_are_found_by_small_plans(spark, monkeypatch):
    hub = spark.range(1, 3000).select(F.col("id").alias("a"), F.lit(3000).cast("long").alias("b"))
    found, got = joins_of_written_steps(monkeypatch, hub)
    assert max(found) <= 4 and got == {i: 1 for i in range(1, 3001)}


def test_join_of_usual_keys_is_plain(spark):
    big = spark.range(0, 9000).select((F.col("id") % 3000).alias("k"), "id")
    one = big.groupBy("k").agg(F.count("*").alias("n"))
    df = join_hot(big, one, ["k"], "n")
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    assert df.count() == 9000
    hot = big.withColumn("k", F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("k"))).union(spark.range(5).selectExpr("null", "id"))
    one = hot.groupBy("k").agg(F.count("*").alias("n"))
    assert join_hot(hot, one, ["k"], "n").count() == 9000


def dense_units(spark, texts, block):
    """Units of one group of near copies: everybody meets everybody in some band."""
    base = [f"w{i}" for i in range(100)]
    given = [(i, " ".join([*base[: i % 100], f"x{i}", *base[i % 100 + 1 :]]), "en", "a", 1) for i in range(texts)]
    df = spark.createDataFrame(given, SCHEMA).repartition(4)
    hasher = ngram_join.MinHash(*ngram_join.band_counts(0.8, 0.999))
    reps = ngram_join.staged(ngram_join.signatures(df, 5, hasher).withColumnRenamed("doc_id", "rid"), "test-dense")
    return ngram_join.staged(ngram_join.candidate_units(reps, block), "test-dense-units")


def test_a_dense_group_is_sent_in_proportion(spark):
    """Rows sent to units grew with the square of a group's texts."""
    few, many = dense_units(spark, 600, 64).count(), dense_units(spark, 2400, 64).count()
    assert many < 6 * few  # 4 times the texts; 16 times the rows before


def test_a_dense_group_is_verified_whole(spark):
    units = dense_units(spark, 600, 64)
    mine, its = units.alias("x"), units.alias("y")
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ngram_join.UNIT]
    crossing = (F.col("x.c1") != F.col("x.c2")) | (F.col("x.b1") != F.col("x.b2"))
    sides = (F.col("x.side") < F.col("y.side")) | (~crossing & (F.col("x.rid") < F.col("y.rid")))
    pairs = mine.join(its, [*same, sides]).select(
        F.least("x.rid", "y.rid").alias("a"), F.greatest("x.rid", "y.rid").alias("b")
    )
    assert pairs.count() == pairs.distinct().count() == 600 * 599 // 2  # each pair once


def test_long_texts_are_cut_by_their_size(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "PARTS", 2)
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", 96 * 50)
    units = dense_units(spark, 600, 64)
    assert units.groupBy(*ngram_join.UNIT).count().agg(F.max("count")).first()[0] <= 2 * 100


@pytest.mark.parametrize("cross", [False, True])
def test_verification_in_tiles(monkeypatch, cross):
    rng = random.Random(3)
    sets = [ngram_join.ngram_hashes(r[1].encode()) for r in near_rows(2) if r[1]]
    sets = [s for s in sets if len(s)]
    sizes = ngram_join.np.array([rng.randint(1, 3) for _ in sets])
    side = ngram_join.np.array([rng.randrange(2) if cross else 0 for _ in sets])
    whole = ngram_join.verify(sets, sizes, side, 0.8, cross)
    monkeypatch.setattr(ngram_join, "TILE", 7)
    tiled = ngram_join.verify(sets, sizes, side, 0.8, cross)
    assert whole[0].tolist() == tiled[0].tolist() and whole[1].tolist() == tiled[1].tolist()
    assert whole[0].any() and len(whole[2]) == len(tiled[2])
