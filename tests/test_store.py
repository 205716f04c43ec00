"""The store: partial updates by user-hash partitions; sources by family; measures and dates."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tagloom.functions import dates
from tagloom.operators import upsert_tags
from tagloom.sources import read_source, read_store, store_parts, update_store, write_store
from tests.conftest import rows


def frame(spark, *data):
    return spark.createDataFrame(list(data), "userId string, tagsId string")


def files(root):
    return {str(f.relative_to(root)): f.stat().st_mtime_ns for f in Path(root).rglob("*.parquet")}


def test_update_equals_upsert(spark, tmp_path):
    root = str(tmp_path / "s")
    assert rows(read_store(spark, root)) == [] and store_parts(spark, root) is None
    write_store(frame(spark, *[(str(i), "1") for i in range(50)], (None, "9")), root, parts=8)
    assert store_parts(spark, root) == 8 and len(rows(read_store(spark, root))) == 50
    new = frame(spark, ("3", "2"), ("3", "4"), ("60", "5"), (None, "7"), ("5", None), ("6", " "))
    want = rows(upsert_tags(read_store(spark, root), new, "merge"))
    update_store(new, root, "merge")
    assert rows(read_store(spark, root)) == want and dict(want)["3"] == "2,4,1" and dict(want)["60"] == "5"
    update_store(new, root, "merge")  # the same run again adds nothing
    assert rows(read_store(spark, root), "userId") == [(u,) for u, _ in want]
    update_store(frame(spark, ("3", "8")), root, "replace")
    assert dict(rows(read_store(spark, root)))["3"] == "8"


def test_only_partitions_of_new_tags_are_rewritten(spark, tmp_path):
    root = str(tmp_path / "s")
    write_store(spark.range(2000).selectExpr("CAST(id AS STRING) AS userId", "'1' AS tagsId"), root, parts=16)
    before = files(root)
    assert len({f.split("/")[0] for f in before}) == 16
    touched = update_store(frame(spark, ("17", "2"), ("17", "3"), ("none yet", "4")), root)
    after = files(root)
    kept = {f for f, t in before.items() if after.get(f) == t}
    assert 1 <= len(touched) <= 2
    assert {f.split("/")[0] for f in before.keys() - kept} == {f"u16={p}" for p in touched if p in range(16)}
    assert {f.split("/")[0] for f in after.keys() - kept} == {f"u16={p}" for p in touched}
    assert update_store(frame(spark, (None, "2")), root) == [] and files(root) == after
    got = dict(rows(read_store(spark, root)))
    assert len(got) == 2001 and got["17"] == "2,3,1" and got["none yet"] == "4" and got["18"] == "1"


def test_update_reads_only_touched_partitions(spark, tmp_path, monkeypatch):
    from tagloom.sources import store

    root, seen = str(tmp_path / "s"), []
    write_store(spark.range(500).selectExpr("CAST(id AS STRING) AS userId", "'1' AS tagsId"), root, parts=16)
    upsert = store.upsert_tags

    def watched(old, new, mode):
        seen.append((old.inputFiles(), old._jdf.queryExecution().executedPlan().toString()))
        return upsert(old, new, mode=mode)

    monkeypatch.setattr(store, "upsert_tags", watched)
    touched = update_store(frame(spark, ("17", "2")), root)
    assert len(touched) == 1 and "PartitionFilters" in seen[0][1] and "u16" in seen[0][1]


def test_an_update_may_read_the_store(spark, tmp_path):
    root = str(tmp_path / "s")
    write_store(frame(spark, ("a", "1"), ("b", "2")), root, parts=4)
    update_store(read_store(spark, root).selectExpr("userId", "'9' AS tagsId"), root)
    assert dict(rows(read_store(spark, root))) == {"a": "9,1", "b": "9,2"}


def test_misuse_of_the_store(spark, tmp_path):
    root = str(tmp_path / "s")
    write_store(frame(spark, ("a", "1")), root, parts=4)
    with pytest.raises(ValueError, match="update"):
        write_store(frame(spark, ("a", "1")), root)
    with pytest.raises(ValueError, match="4 partitions"):
        update_store(frame(spark, ("a", "1")), root, parts=8)
    with pytest.raises(ValueError, match="mode"):
        update_store(frame(spark, ("a", "1")), root, "add")


def test_fields_of_a_family(spark, tmp_path):
    from tagloom.functions.rules import SourceMeta

    path = str(tmp_path / "json")
    with open(f"{tmp_path}/x.json", "w") as f:
        f.write('{"rowkey": 1, "detail": {"id": 7, "job": "x"}, "job": "outside"}\n')
    spark.read.json(f"{tmp_path}/x.json").write.parquet(path)
    meta = {"inType": "parquet", "path": path, "family": "detail", "selectFields": "rowkey,id,job,nope"}
    assert [tuple(r) for r in read_source(spark, SourceMeta.from_map(meta)).collect()] == [("1", "7", "x", None)]
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    got = read_source(spark, SourceMeta.from_map(meta | {"inType": "json", "path": f"{tmp_path}/x.json"}))
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before  # no inference job
    assert [tuple(r) for r in got.collect()] == [("1", "7", "x", None)]


def test_bad_cells_are_null(spark):
    df = spark.createDataFrame([("\\N", 10**18), ("2000-02-29", 86_400), (None, None), ("x", -(10**18))], "b string, e long")
    got = [tuple(r) for r in df.select(dates.age_years("b", "2001-02-28"), dates.epoch_to_date("e")).collect()]
    assert got == [(None, None), (0, dt.date(1970, 1, 2)), (None, None), (None, None)]


def test_default_date_is_today(spark):
    row = spark.range(1).select(dates.as_of_lit(None).alias("d"), F.current_date().alias("t")).first()
    assert row["d"] == row["t"]


def test_local_scratch_only_on_a_local_master(monkeypatch):
    from tagloom import session

    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "local-cluster[2,1,1024]"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


def test_measured_size_holds_nested_columns(spark):
    from tagloom.operators import measure

    df = spark.range(3).select(F.sequence(F.lit(1), F.lit(10_000)).alias("a"))
    assert measure(df).bytes >= 3 * 10_000 * 4
