"""Taxonomy lookups, level-4 rule, tag ⟕ model, batch path load, dense ids."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tagloom.operators import assign_dense_ids, by_level, children, find, level4_meta, load_paths, tags_with_models
from tagloom.sources import models_frame, taxonomy_frame
from tests.conftest import rows

HEAD = [
    (1, "commerce", None, 1, -1),
    (2, "mall", None, 2, 1),
    (3, "business", None, 3, 2),
    (4, "gender", "inType=table##hbaseTable=tbl_users##family=detail##selectFields=id,gender", 4, 3),
    (5, "male", "1", 5, 4),
    (6, "female", "2", 5, 4),
]


@pytest.fixture
def tax(spark):
    return taxonomy_frame(spark, HEAD)


def test_lookups(spark, tax):
    assert rows(children(tax, 4).select("id")) == [(5,), (6,)]
    assert rows(by_level(tax, 5).select("id")) == [(5,), (6,)]
    assert rows(find(tax, "mall", 2, 1).select("id")) == [(2,)]


def test_level4_meta(spark, tax):
    meta = level4_meta(tax, 4)
    assert meta.inType == "table" and meta.hbaseTable == "tbl_users" and meta.fields == ["id", "gender"]
    assert meta.zkHosts == ""  # absent option -> ''
    with pytest.raises(LookupError):
        level4_meta(tax, 99)


def test_tags_with_models(spark, tax):
    models = models_frame(spark, [(1, 4, "gender", 3, "tagloom.plans.models.ExactMatchModel", "1,2019-12-01 00:00,2029-12-01 00:00")])
    got = rows(tags_with_models(tax, models, pid=3).select("id", "model_name"))
    assert got == [(4, "gender")]
    got = rows(tags_with_models(tax, models, pid=4).select("id", "model_name"))
    assert got == [(5, None), (6, None)]


def test_load_paths_insert_if_absent(spark, tax):
    paths = spark.createDataFrame(
        [("commerce", "mall", "retail"), ("commerce", "mall", "business"), ("bank", "city bank", "people"),
         ("bank", "city bank", "people"), ("bank", None, None)],
        "l1 string, l2 string, l3 string",
    )
    out = load_paths(tax, paths)
    got = rows(out.select("id", "name", "level", "pid"))
    assert (3, "business", 3, 2) in got            # found: reused
    new = [r for r in got if r[0] > 6]
    # ids continue after max(id), per level in (pid, name) order; child takes the parent's id
    assert new == [(7, "bank", 1, -1), (8, "city bank", 2, 7), (9, "retail", 3, 2), (10, "people", 3, 8)]
    again = load_paths(out, paths)
    assert again.count() == out.count()           # idempotent


def test_dense_ids_distributed(spark):
    df = spark.range(0, 3000).select((F.col("id") * 7919 % 3001).alias("k"))
    got = rows(assign_dense_ids(df, ["k"], 100, partitions=7).select("k", "id"))
    want = rows(df.select("k", (F.lit(100) + F.row_number().over(Window.orderBy("k"))).alias("id")))
    assert got == want


def test_load_paths_with_repeated_tags(spark):
    tax = taxonomy_frame(spark, HEAD + [(9, "mall", None, 2, 1)])  # a repeat of (mall, 2, 1)
    paths = spark.createDataFrame([("commerce", "mall", "new")], "l1 string, l2 string, l3 string")
    out = load_paths(tax, paths)
    assert rows(out.where("id > 9").select("id", "name", "level", "pid")) == [(10, "new", 3, 2)]
