"""Merge, replace and upsert of the tag store; properties of the merge."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagloom.functions import canonical_tags
from tagloom.operators import collapse_new_tags, merge_tags, upsert_tags
from tests.conftest import rows

STORE = [("u1", "6,8"), ("u2", "9"), ("u3", None), ("u5", "2,,3,"), ("u6", "1"), ("u7", "5")]
NEW = [("u1", "5,6"), ("u2", None), ("u3", " "), ("u4", "7"), ("u5", ","), ("u7", "5,5,,")]


def frames(spark):
    s = spark.createDataFrame(STORE, "userId string, tagsId string")
    n = spark.createDataFrame(NEW, "userId string, tagsId string")
    return s, n


def test_merge_left_join(spark):
    s, n = frames(spark)
    got = dict(rows(merge_tags(n, s)))
    assert got == {"u1": "5,6,8", "u2": "9", "u3": None, "u4": "7", "u5": "2,,3", "u7": "5"}


def test_upsert_merge_keeps_store_only_users(spark):
    s, n = frames(spark)
    got = dict(rows(upsert_tags(s, n, mode="merge")))
    assert got == {"u1": "5,6,8", "u2": "9", "u3": None, "u4": "7", "u5": "2,,3", "u6": "1", "u7": "5"}


def test_upsert_replace(spark):
    s, n = frames(spark)
    got = dict(rows(upsert_tags(s, n, mode="replace")))
    # a null new cell keeps the stored cell
    assert got == {"u1": "5,6", "u2": "9", "u3": " ", "u4": "7", "u5": ",", "u6": "1", "u7": "5,5,,"}


def test_collapse_several_rows_per_user(spark):
    n = spark.createDataFrame([("u", "31"), ("u", "32"), ("u", "31"), ("u", None), ("v", None), ("w", "100"), ("w", "9")],
                              "userId string, tagsId string")
    assert dict(rows(collapse_new_tags(n))) == {"u": "31,32", "v": None, "w": "9,100"}


def test_hot_user_is_pre_aggregated(spark):
    # one user holds most rows: the per-user set stays one small list
    n = spark.range(0, 20000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("userId"),
        (F.col("id") % 3 + 1).cast("string").alias("tagsId"),
    )
    got = dict(rows(collapse_new_tags(n).where("userId = 'hot'")))
    assert got == {"hot": "1,2,3"}


tag = st.sampled_from(["1", "2", "3", "10", "", " "])
tag_list = st.one_of(st.none(), st.lists(tag, max_size=5).map(",".join))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d"]), tag_list, tag_list), min_size=1, max_size=6, unique_by=lambda t: t[0]))
def test_merge_properties(spark, data):
    new = spark.createDataFrame([(u, n) for u, n, _ in data], "userId string, tagsId string")
    old = spark.createDataFrame([(u, o) for u, _, o in data], "userId string, tagsId string")
    once = merge_tags(new, old)
    twice = merge_tags(new, once)
    c1 = dict(rows(once.select("userId", canonical_tags("tagsId").alias("c"))))
    c2 = dict(rows(twice.select("userId", canonical_tags("tagsId").alias("c"))))
    assert c1 == c2  # idempotent in canonical form
    for u, n, o in data:
        merged = set((c1[u] or "").split(",")) - {""}
        old_tags = {t for t in (o or "").split(",") if t.strip()}
        new_tags = {t for t in (n or "").split(",") if t.strip()}
        assert old_tags <= merged  # every stored tag survives
        assert new_tags <= merged  # every new tag is added
    keys = {r["userId"] for r in upsert_tags(old, new).collect()}
    assert keys == {u for u, _, _ in data}


def test_upsert_drops_keyless_rows(spark):
    s = spark.createDataFrame([("u1", "1"), (None, "2")], "userId string, tagsId string")
    n = spark.createDataFrame([(None, "3"), ("u1", "4"), (None, "5")], "userId string, tagsId string")
    once = upsert_tags(s, n)
    assert rows(once) == [("u1", "4,1")]
    assert rows(upsert_tags(once, n)) == [("u1", "4,1")]  # stable across runs


def test_collapse_is_a_set_union(spark):
    n = spark.createDataFrame(
        [("u", "5,6"), ("u", "6,8"), ("v", " "), ("v", "7"), ("w", " "), ("w", None), ("x", "2,2,"), ("y", "3,,"), ("y", "3")],
        "userId string, tagsId string",
    )
    assert dict(rows(collapse_new_tags(n))) == {"u": "5,6,8", "v": "7", "w": " ", "x": "2,2,", "y": "3"}


def test_canonical_ids_in_any_spelling(spark):
    from tagloom.operators import tag_coverage

    s = spark.createDataFrame([("u", "5,05, 5"), ("v", "5"), ("w", "x9,\\N,,"), ("z", None)], "userId string, tagsId string")
    got = dict(rows(s.select("userId", canonical_tags("tagsId").alias("c"))))
    assert got == {"u": "5", "v": "5", "w": "", "z": None}
    assert rows(tag_coverage(s)) == [(5, 2)]
