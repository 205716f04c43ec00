"""The named wide-row source: schema from options, key filters, pruned partitions; publish in slices."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tagloom.functions.rules import SourceMeta
from tagloom.sources import (
    publish, publish_more, read_source, register_wide_rows, select_fields, sliced_positions, write_sorted_by_key,
)
from tagloom.sources.slices import slice_ranges
from tests.conftest import rows


@pytest.fixture
def table(spark, tmp_path):
    df = spark.range(1000).select(
        F.when(F.col("id") % 100 != 7, F.format_string("k%04d", F.col("id"))).alias("id"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("j"), F.col("id") % 5)).alias("job"),
        (F.col("id") % 4).cast("int").alias("n"),
        F.struct(F.when(F.col("id") % 2 == 0, F.lit("in")).alias("job"), F.lit("x").alias("only")).alias("detail"),
    )
    path = str(tmp_path / "rows")
    write_sorted_by_key(df.withColumn("pad", F.lit("p")), path, partitions=8)
    register_wide_rows(spark)
    return path, spark.read.parquet(path)


def source(spark, path, fields, **options):
    return spark.read.format("widerow").options(path=path, selectFields=fields, **options).load()


def test_schema_and_cells_come_from_the_options(spark, table):
    path, whole = table
    got = source(spark, path, "id,job,n,nope")
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [(c, "string") for c in ("id", "job", "n", "nope")]
    assert sorted(got.collect(), key=repr) == sorted(select_fields(whole, ["id", "job", "n", "nope"]).collect(), key=repr)
    got = source(spark, path, "only,job,id", family="detail", rowKey="id")
    assert sorted(got.collect(), key=repr) == sorted(select_fields(whole, ["only", "job", "id"], "detail").collect(), key=repr)


CONDITIONS = [
    "id = 'k0500'", "id > 'k0990'", "id >= 'k0990' AND id < 'k0993'", "id <= 'k0001'", "id IN ('k0001', 'k0900', 'zz')", "id LIKE 'k09%'",
    "id IS NOT NULL", "id IS NULL", "id = 'k0500' AND job = 'j0'", "id > 'k0500' OR job = 'j1'", "id BETWEEN 'a' AND 'b'", "length(id) = 5 AND id < 'k0100'",
]


@pytest.mark.parametrize("condition", CONDITIONS)
def test_filters_equal_spark(spark, table, condition):
    path, whole = table
    want = sorted(whole.select("id", "job").where(condition).collect(), key=repr)
    for push in ("true", "false"):
        assert sorted(source(spark, path, "id,job", keyPushdown=push).where(condition).collect(), key=repr) == want


def test_queries_of_one_frame_do_not_share_filters(spark, table):
    path, whole = table
    df = source(spark, path, "id,job")
    low, high = df.where("id < 'k0005'"), df.where("id >= 'k0990'")
    assert (low.count(), df.count(), high.count(), low.union(high).count()) == (5, 1000, 10, 15)
    part = source(spark, path, "id,job", startRow="k0300", stopRow="k0320")
    assert (part.where("id = 'k0500'").count(), part.count(), part.rdd.getNumPartitions()) == (0, 19, 1)


def test_key_range_is_pushed_and_prunes_partitions(spark, table):
    path, _ = table
    everything = source(spark, path, "id,job")
    narrowed = source(spark, path, "id,job", keyPushdown="true")
    some = narrowed.where("id >= 'k0300' AND id < 'k0320' AND job = 'j1'")
    plan = spark._jvm.PythonSQLUtils.explainString(some._jdf.queryExecution(), "formatted")
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan)[1]
    assert "GreaterThanOrEqual(id,k0300)" in pushed and "LessThan(id,k0320)" in pushed and "job" not in pushed
    assert everything.rdd.getNumPartitions() == 8 and some.rdd.getNumPartitions() <= 2
    assert source(spark, path, "id,job", keyPushdown="true").where("id = 'zz'").rdd.getNumPartitions() <= 1


def test_empty_folder_and_misuse(spark, tmp_path):
    register_wide_rows(spark)
    path = str(tmp_path / "none")
    spark.createDataFrame([], "id string").write.parquet(path)
    assert source(spark, path, "id,job").collect() == []
    with pytest.raises(Exception, match="selectFields"):
        spark.read.format("widerow").option("path", path).load()
    dates = str(tmp_path / "dates")
    spark.range(1).select(F.lit("a").alias("id"), F.current_date().alias("d")).write.parquet(dates)
    with pytest.raises(Exception, match="a cell is a string"):
        source(spark, dates, "id,d").collect()


def test_a_rule_names_the_source(spark, table):
    path, whole = table
    meta = SourceMeta.from_map({"inType": "widerow", "hbaseTable": path, "family": "detail", "selectFields": "id,only", "rowKey": "id"})
    assert sorted(read_source(spark, meta).collect(), key=repr) == sorted(whole.select("id", "detail.only").collect(), key=repr)


# --- publish in slices


def load(spark, ids, value):
    return spark.createDataFrame([(i, value) for i in ids], "id string, v string")


def files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def check(spark, path, want):
    got = sorted(sliced_positions(spark, path, "id", "v").collect(), key=lambda r: r["position"])
    assert [r["position"] for r in got] == list(range(1, len(want) + 1))
    ids = [r["id"] or "" for r in got]
    assert ids == sorted(ids)
    assert sorted(((r["id"], r["v"]) for r in got), key=repr) == sorted(want, key=repr)


def test_later_loads_touch_their_slices_only(spark, tmp_path):
    path = str(tmp_path / "p")
    first = [f"k{i:04d}" for i in range(0, 1000, 2)]
    publish(load(spark, first, "a"), path, slices=10)
    ranges = slice_ranges(path, "id")
    assert len(ranges) == 10 and all(a[2] < b[1] for a, b in zip(ranges, ranges[1:]))
    check(spark, path, [(i, "a") for i in first])
    before = files(path)
    inside = [ranges[3][1], ranges[3][2], ranges[3][1] + "x"]
    assert publish_more(load(spark, inside, "b"), path) == [3]
    after = files(path)
    assert {f for f in before if before[f] != after.get(f)} == {f for f in before if f.startswith("slice=3/")}
    want = {i: "a" for i in first} | {i: "b" for i in inside}
    check(spark, path, list(want.items()))
    # below the first range, above the last, in a gap, and without a key
    gap = ranges[5][2] + "z"
    assert publish_more(load(spark, ["a", "zz", "zzz", gap, None, None], "c"), path) == [0, 5, 9]
    check(spark, path, [*({i: v for i, v in want.items()} | {i: "c" for i in ("a", "zz", "zzz", gap)}).items(), (None, "c"), (None, "c")])
    assert publish_more(load(spark, [], "d"), path) == []
    assert publish_more(load(spark, ["k0000"], "d"), str(tmp_path / "new")) == [0]


def test_a_key_that_fills_slices(spark, tmp_path):
    path = str(tmp_path / "p")
    hot = spark.range(3000).select(F.when(F.col("id") < 2000, "hot").otherwise(F.concat(F.lit("i"), F.col("id"))).alias("id"), F.col("id").cast("string").alias("v"))
    publish(hot, path, slices=6)
    touched = publish_more(spark.range(1500).select(F.lit("hot").alias("id"), F.concat(F.lit("n"), F.col("id")).alias("v")), path)
    assert len(touched) >= 3
    got = spark.read.parquet(path)
    assert got.where("id = 'hot'").count() == 1500 and got.where("id = 'hot' AND v NOT LIKE 'n%'").count() == 0
    assert got.count() == 2500
    check(spark, path, rows(got, "id", "v"))


def test_extract_is_sorted_before_it_is_split(spark, tmp_path):
    from tagloom.sources import ingest, published_positions, read_extract

    lines = [f"{k}\x01b{k}\x01c" for k in range(300)] + ["7\x01short", "x", "", "8\x01two\x01", "9\x01a\x01b\x01c"]
    src, dest = str(tmp_path / "src"), str(tmp_path / "dest")
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(src)
    ingest(spark, src, ["id", "a", "b"], dest, partitions=3)
    want = rows(read_extract(spark, src, ["id", "a", "b"]))
    assert rows(spark.read.parquet(dest)) == want and len(want) == 302
    keys = [r["id"] for r in published_positions(spark, dest, "id").orderBy("position").collect()]
    assert keys == sorted(k for k, _, _ in want)
