"""Audience sets, category roll-up, rolling measures, observed ingest, user functions."""

import datetime as dt
import random

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from tagloom.functions.user import SumAggregate, register
from tagloom.operators.aggregate import rfe_measures
from tagloom.operators.audience import audience_sets, merge_sets, users_per_audience, users_per_tag
from tagloom.operators.rolling import advance, changes, day_partials, first_state, state_measures, write_days
from tagloom.operators.taxonomy import tree_paths, users_per_category
from tagloom.plans.models import UserFunctionModel
from tagloom.sources.extracts import ingest_observed, ingested, parse_lines, rejected
from tests.conftest import rows

STORE = "userId string, tagsId string"


def test_sets_merge_and_intersect(spark):
    rng = random.Random(1)
    one = [(str(rng.randrange(100_000)), ",".join(str(rng.randrange(1, 6)) for _ in range(rng.randrange(4)))) for _ in range(400)]
    two = [(u, "3") for u, _ in one[::2]] + [("7", None), (None, "1"), ("-5", "1,2"), ("0", "2,1,x"), ("32768", "1"), ("32769", "1,2")]
    days = [audience_sets(spark.createDataFrame(d, STORE)) for d in (one, two)]
    sets = merge_sets(days[0].unionByName(days[1]))
    held = {}
    for u, t in one + two:
        for x in (t or "").split(","):
            if u is not None and x.isdigit():
                held.setdefault(int(x), set()).add(u)
    assert dict(rows(users_per_tag(sets))) == {t: len(u) for t, u in held.items()}
    named = [("1+2", 1), ("1+2", 2), ("all", 1), ("all", 2), ("all", 3), ("all", 3), ("none", 1), ("none", 99), ("null", None)]
    got = dict(rows(users_per_audience(sets, spark.createDataFrame(named, "audience string, tag long"))))
    assert got == {"1+2": len(held[1] & held[2]), "all": len(held[1] & held[2] & held[3]), "none": 0}


def test_an_intersection_has_no_user_join(spark):
    sets = merge_sets(audience_sets(spark.createDataFrame([("1", "1,2")], STORE)))
    out = users_per_audience(sets, spark.createDataFrame([("a", 1), ("a", 2)], "audience string, tag long"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "userId" not in plan.split("bitmap_construct_agg")[0] and "bitmap_and_agg" in plan


def test_keys_that_are_no_numbers(spark):
    with pytest.raises(Exception, match="no user number: abc"):
        audience_sets(spark.createDataFrame([("abc", "1")], STORE)).collect()
    hashed = audience_sets(spark.createDataFrame([("abc", "1"), ("d", "1")], STORE), number=lambda k: F.pmod(F.xxhash64(k), F.lit(1 << 40)))
    assert rows(users_per_tag(merge_sets(hashed))) == [(1, 2)]


TREE = [(1, "a", -1), (2, "b", 1), (3, "c", 1), (4, "d", 2), (5, "a", -1), (6, "lost", 99), (7, "x", 8), (8, "y", 7), (9, None, 4)]


def test_tree_paths_and_users(spark):
    tax = spark.createDataFrame(TREE, "id long, name string, pid long")
    paths = {r["id"]: (r["path"], r["ancestors"]) for r in tree_paths(tax).collect()}
    assert paths == {
        1: (["a"], [1]), 2: (["a", "b"], [1, 2]), 3: (["a", "c"], [1, 3]), 4: (["a", "b", "d"], [1, 2, 4]), 5: (["a"], [5]),
        9: (["a", "b", "d", None], [1, 2, 4, 9]),
    }
    held = spark.createDataFrame([("u", 4), ("u", 3), ("u", 4), ("v", 2), ("w", 5), ("w", 6), (None, 5), ("x", None)], "userId string, tag long")
    assert dict(rows(users_per_category(held, tree_paths(tax)))) == {1: 2, 2: 2, 3: 1, 4: 1, 5: 1}
    assert tree_paths(tax.where("id > 100")).collect() == []


def visits(seed=0):
    rng = random.Random(seed)
    out = []
    for _ in range(600):
        t = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(20 * 1440))
        out.append((str(rng.randrange(25)), t.strftime("%Y-%m-%d %H:%M:%S"), rng.choice(["view", "click", "buy", None])))
    return out + [("1", "\\N", "view"), ("2", None, "click"), (None, "2024-01-05 00:00:00", "view"), ("late", "2024-01-19 10:00:00", "click")]


def test_seven_slots_equal_a_recompute(spark, tmp_path):
    events = spark.createDataFrame(visits(), "u string, t string, a string")
    path = write_days(day_partials(events, "u", "t", "a"), str(tmp_path / "days"))
    partials = spark.read.parquet(path)
    state = None
    for day in range(8, 22):
        as_of = dt.date(2024, 1, day)
        state = first_state(partials, as_of, 5) if state is None else advance(state, partials, as_of, 5)
        state.write.parquet(str(tmp_path / f"state-{day}"))
        state = spark.read.parquet(str(tmp_path / f"state-{day}"))
        want = rfe_measures(events, "u", "t", "a", as_of, 5)
        assert sorted(state_measures(state, as_of).collect(), key=repr) == sorted(want.collect(), key=repr), as_of


def test_a_slot_reads_two_days(spark, tmp_path):
    path = write_days(day_partials(spark.createDataFrame(visits(), "u string, t string, a string"), "u", "t", "a"), str(tmp_path / "d"))
    two = changes(spark.read.parquet(path), "2024-01-12", 5)
    plan = spark._jvm.PythonSQLUtils.explainString(two._jdf.queryExecution(), "formatted")
    assert "day" in plan.split("PartitionFilters")[1].split("\n")[0]
    read = two.select(F.input_file_name().alias("f")).distinct().collect()
    assert {r["f"].rsplit("day=", 1)[1][:10] for r in read} == {"2024-01-11", "2024-01-06"}
    # a day written again replaces its partition
    before = spark.read.parquet(path).where("day <> '2024-01-11'").count()
    write_days(spark.createDataFrame([("3", "2024-01-11 05:00:00", "view")], "u string, t string, a string").transform(
        lambda d: day_partials(d, "u", "t", "a")), path)
    assert spark.read.parquet(path).count() == before + 1


def test_lines_by_outcome(spark, tmp_path):
    lines = ["a\x01b\x01c", "a\x01b", "a", "", "\x01\x01", "a\x01b\x01c\x01d", "a\x01b\x01c\x01\x01", "\x01\x01c", "a\x01\x01"]
    src, dest = str(tmp_path / "src"), str(tmp_path / "dest")
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    df.write.text(src)
    columns = ["x", "y", "z"]
    assert ingest_observed(spark, src, columns, dest) == {"kept": 3, "repaired": 1, "empty": 1, "short": 3, "long": 1}
    assert rows(ingested(spark, dest, columns)) == rows(parse_lines(df, columns))
    assert rows(rejected(spark, dest)) == sorted([("empty", ""), ("short", "a"), ("short", "\x01\x01"), ("short", "a\x01\x01"), ("long", lines[5])])
    empty = str(tmp_path / "none")
    df.limit(0).write.text(empty)
    assert set(ingest_observed(spark, empty, columns, str(tmp_path / "d2")).values()) == {0}


def _double(x: pa.Array) -> pa.Array:
    return pc.multiply(x.cast(pa.float64()), 2.0)


def _square(x: pa.Array) -> pa.Array:
    return pc.multiply(x.cast(pa.float64()), x.cast(pa.float64()))


def _root(total: pa.Array) -> pa.Array:
    return pc.floor(pc.sqrt(total)).cast(pa.int64())


def test_user_functions_in_sql_and_frames(spark):
    df = spark.createDataFrame([("a", 3), ("a", 4), ("b", None), ("b", 5), ("c", None)], "k string, v long")
    double = register(spark, "tl_double", _double, "double")
    assert rows(df.select("k", double("v").alias("d")).where("d IS NOT NULL")) == [("a", 6.0), ("a", 8.0), ("b", 10.0)]
    norm = SumAggregate({"sq": _square}, _root, "bigint", ["v"])
    assert rows(norm.per_key(df, F.col("k"), "n").where("k <> 'c'")) == [("a", 5), ("b", 5)]
    assert norm.per_key(df.where("k = 'c'"), F.col("k"), "n").collect() == [("c", None)]
    norm.register(spark, "tl_norm")
    df.createOrReplaceTempView("t_user_fn")
    got = spark.sql("SELECT k, tl_norm(sum(tl_norm_sq(v))) AS n FROM t_user_fn GROUP BY k HAVING k <> 'c'")
    assert rows(got) == [("a", 5), ("b", 5)]
    # partial sums on the map side: the hot key's rows do not meet in Python
    plan = norm.per_key(df, F.col("k"), "n")._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "AggregateInArrow" not in plan and "FlatMapGroups" not in plan


def test_a_model_with_a_user_function(spark):
    df = spark.createDataFrame([("a", 3), ("a", 4), ("b", 50)], "k string, v long")
    rules = spark.createDataFrame([(1, "0-9"), (2, "10-20")], "id long, rule string")
    m = UserFunctionModel(9, key_field="k", aggregate=SumAggregate({"sq": _square}, _root, "bigint", ["v"]))
    assert rows(m.compute(rules, df)) == [("a", "1")]


def test_segments_keep_their_ranks(spark, tmp_path):
    from tagloom.operators.cluster import assign, fit_segments, read_segments, write_segments

    def measures(shift, flip):
        out = []
        for i in range(40):
            g = i % 4 if not flip else 3 - i % 4
            out.append((f"u{i}", 30 - 8 * g + i % 3, 10 * g + i % 5 + shift, None if g == 0 else float(g)))
        return spark.createDataFrame(out, "userId string, recency int, frequency long, engagement double")

    first = fit_segments(measures(0, False), k=4)
    path = write_segments(spark, first, str(tmp_path / "model"))
    again = read_segments(spark, path)
    assert again == first
    ranks = dict(rows(assign(measures(0, False), again), "userId", "rank"))
    assert all(ranks[f"u{i}"] == 3 - i % 4 for i in range(40))  # rank 0 is the most active
    # a later slot starts from the stored centres: users move between ranks, ranks keep their meaning
    later = fit_segments(measures(1, True), start=again)
    ranks = dict(rows(assign(measures(1, True), later), "userId", "rank"))
    assert all(ranks[f"u{i}"] == i % 4 for i in range(40))
    assert (later.means, later.scales) == (again.means, again.scales)


def test_segments_of_few_or_equal_users(spark):
    from tagloom.operators.cluster import assign, fit_segments

    schema = "userId string, recency int, frequency long, engagement double"
    one = spark.createDataFrame([("a", 3, 4, None), ("n", None, 4, 1.0)], schema)
    assert rows(assign(one, fit_segments(one, k=3)), "userId") == [("a",)]
    none = spark.createDataFrame([], schema)
    assert assign(none, fit_segments(none, k=3)).collect() == []
