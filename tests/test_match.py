"""Exact and range matching: unmatched policies, repeats, overlaps, fallback paths."""

import pytest
from pyspark.sql import functions as F

from tagloom.operators import exact_match, range_match
from tests.conftest import rows


@pytest.fixture
def rules(spark):
    return spark.createDataFrame([(5, "1"), (6, "2"), (9, "2")], "id long, rule string")


@pytest.fixture
def users(spark):
    return spark.createDataFrame([("u1", "1"), ("u2", "2"), ("u3", "3"), ("u4", None)], "id string, gender string")


def test_exact_error_policy_raises(spark, rules, users):
    with pytest.raises(Exception, match="no rule matches value '3'|no rule matches value 'null'"):
        exact_match(users, rules, "gender", "id").collect()


def test_exact_all_matched(spark, rules, users):
    ok = users.where(F.col("gender").isin("1", "2"))
    # repeated rule text "2": highest id wins
    assert rows(exact_match(ok, rules, "gender", "id")) == [("u1", "5"), ("u2", "9")]


def test_exact_null_policy(spark, rules, users):
    got = rows(exact_match(users, rules, "gender", "id", on_unmatched="null"), "userId", "tagsId")
    assert sorted(got, key=str) == sorted([("u1", "5"), ("u2", "9"), ("u3", None), ("u4", None)], key=str)


def test_exact_drop_policy(spark, rules, users):
    assert rows(exact_match(users, rules, "gender", "id", on_unmatched="drop")) == [("u1", "5"), ("u2", "9")]


def test_exact_shuffle_fallback_equals_broadcast(spark, rules, users):
    a = rows(exact_match(users, rules, "gender", "id", on_unmatched="null"))
    b = rows(exact_match(users, rules, "gender", "id", on_unmatched="null", max_broadcast_rows=0))
    assert sorted(a, key=str) == sorted(b, key=str)


def test_bad_policy(spark, rules, users):
    with pytest.raises(ValueError):
        exact_match(users, rules, "gender", "id", on_unmatched="ignore")


def test_range_overlap_and_gaps(spark):
    vals = spark.createDataFrame([("a", 0), ("b", 30), ("c", 31), ("d", -1), ("e", None), ("f", 5000)], "userId string, days int")
    rules = spark.createDataFrame([(24, 0, 30), (25, 31, 90), (99, 30, 40)], "tagsId long, start int, end int")
    got = rows(range_match(vals, rules, "days"), "userId", "tagsId")
    assert got == [("a", 24), ("b", 24), ("b", 99), ("c", 25), ("c", 99)]


def test_range_bucketed_fallback_equals_broadcast(spark):
    vals = spark.range(0, 4000).select(F.col("id").cast("string").alias("userId"), ((F.col("id") * 37) % 3100 - 50).cast("int").alias("days"))
    bands = [(i, s, e) for i, (s, e) in enumerate([(0, 30), (31, 90), (91, 365), (366, 3000), (200, 210), (2999, 2999)])]
    rules = spark.createDataFrame(bands, "tagsId long, start int, end int")
    a = rows(range_match(vals, rules, "days"), "userId", "tagsId")
    b = rows(range_match(vals, rules, "days", max_broadcast_rows=0), "userId", "tagsId")
    assert a == b and len(a) > 3000


def test_range_fallback_with_overlapping_wide_rules(spark):
    vals = spark.range(0, 500).select(F.col("id").cast("string").alias("userId"), (F.col("id") * 7 % 3200 - 100).cast("int").alias("days"))
    wide = [(i, 0, 3000) for i in range(60)] + [(100 + i, 10 * i, 10 * i + 5) for i in range(60)]
    rules = spark.createDataFrame(wide, "tagsId long, start int, end int")
    a = rows(range_match(vals, rules, "days"), "userId", "tagsId")
    b = rows(range_match(vals, rules, "days", max_broadcast_rows=0), "userId", "tagsId")
    assert a == b and len(a) > 60 * 400


@pytest.mark.parametrize("max_rows", [1_000_000, 0])
def test_many_overlapping_rules(spark, max_rows):
    rules = spark.range(100_000).select(
        F.col("id").alias("tagsId"),
        (F.col("id") * 3 % 50_000).cast("int").alias("start"),
        (F.col("id") * 3 % 50_000 + F.when(F.col("id") % 1000 == 0, 5_000).otherwise(F.col("id") % 7)).cast("int").alias("end"),
    )
    vals = spark.range(0, 300).select(F.col("id").cast("string").alias("userId"), (F.col("id") * 181 - 100).cast("int").alias("days"))
    out = range_match(vals, rules, "days", max_broadcast_rows=max_rows)
    got = out.groupBy("userId").count().collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    want = {}
    spans = [(i * 3 % 50_000, i * 3 % 50_000 + (5_000 if i % 1000 == 0 else i % 7)) for i in range(100_000)]
    import numpy as np

    a, b = np.array(spans).T
    for i in range(300):
        n = int(((a <= i * 181 - 100) & (i * 181 - 100 <= b)).sum())
        if n:
            want[str(i)] = n
    assert {r["userId"]: r["count"] for r in got} == want


def test_inverted_and_missing_rules(spark):
    vals = spark.createDataFrame([("a", 5)], "userId string, days int")
    none = spark.createDataFrame([], "tagsId long, start int, end int")
    assert range_match(vals, none, "days").count() == 0
    rules = spark.createDataFrame([(1, 9, 2), (2, 5, 5)], "tagsId long, start int, end int")
    assert rows(range_match(vals, rules, "days"), "tagsId") == [(2,)]


def test_dyadic_pieces_cover_exactly(spark):
    """Every piece lies inside its range, no two overlap, and together they hold all of it."""
    import random

    from tagloom.operators.match import dyadic_pieces

    rng = random.Random(0)
    top, low = 2**63 - 1, -(2**63)
    spans = [(0, 0), (0, 1), (1, 1), (-1, 0), (-7, 9), (5, 4), (None, 3), (3, None), (low, top), (low, low), (top, top), (0, top), (low, -1), (1, top - 1)]
    for _ in range(300):
        a, w = rng.randrange(-(2**40), 2**40), 2 ** rng.randrange(0, 45)
        spans.append((a, a + rng.randrange(w)))
    df = spark.createDataFrame(list(enumerate(spans)), "n int, b struct<s:long,e:long>").select("n", "b.*")
    for r in df.select("s", "e", dyadic_pieces("s", "e").alias("p")).collect():
        got = sorted((x["i"] << x["k"], ((x["i"] + 1) << x["k"]) - 1) for x in r["p"])
        if r["s"] is None or r["e"] is None or r["s"] > r["e"]:
            assert got == []
            continue
        assert got[0][0] == r["s"] and got[-1][1] == r["e"]
        assert all(a[1] + 1 == b[0] for a, b in zip(got, got[1:]))
        assert len(got) <= 2 * (r["e"] - r["s"] + 1).bit_length()


@pytest.mark.parametrize("max_rows", [2_000_000, 0])
def test_mixed_widths_meet_only_matches(spark, max_rows):
    """A million rules of length one and one of 10^9: a value meets its matches, and looks up few intervals."""
    narrow = spark.range(1_000_000).select(F.col("id").alias("tagsId"), (F.col("id") * 3).alias("start"), (F.col("id") * 3).alias("end"))
    rules = narrow.unionByName(spark.createDataFrame([(10**7, -5, 10**9 - 6)], "tagsId long, start long, end long"))
    values = spark.range(0, 2_000).select((F.col("id") * 1501 - 20).alias("v"))
    out = range_match(values, rules, "v", max_broadcast_rows=max_rows, max_broadcast_bytes=2**33)
    got = {r["v"]: r["n"] for r in out.groupBy("v").agg(F.count("*").alias("n")).collect()}
    want = {v: (v % 3 == 0 and 0 <= v < 3_000_000) + (v >= -5) for v in range(-20, 2_000 * 1501 - 20, 1501)}
    assert got == {v: n for v, n in want.items() if n}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" in plan and "NestedLoop" not in plan
    # rows that the keys alone let through, without the comparison: exactly the matches
    from tagloom.operators.match import dyadic_pieces

    cut = rules.select(F.explode(dyadic_pieces("start", "end")).alias("p")).select("p.k", "p.i")
    levels = [r["k"] for r in cut.select("k").distinct().collect()]
    probes = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.shiftright("v", k).alias("i")) for k in levels]))
    met = values.select("v", probes.alias("q")).select("v", "q.*").join(cut, ["k", "i"]).count()
    assert len(levels) <= 63 and met == sum(want.values())


def test_range_of_fractions_and_clashing_names(spark):
    values = spark.createDataFrame([(1.5, "a"), (5.5, "b"), (-0.5, "c"), (float("nan"), "d"), (1e300, "e"), (5.0, "f")], "v double, k string")
    rules = spark.createDataFrame([(1, 2, 5, "p"), (2, -1, 1, "q"), (3, 1, 9, "r")], "tagsId long, start int, end int, i string")
    got = rows(range_match(values, rules, "v"), "k", "tagsId")
    assert got == [("a", 3), ("b", 3), ("c", 2), ("f", 1), ("f", 3)]
