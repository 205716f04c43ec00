"""End-to-end tagging runs against a stored store; coverage."""

import pytest
from pyspark.sql import functions as F

from tagloom.operators import tag_coverage
from tagloom.plans.models import ExactMatchModel, RecencyRangeModel
from tagloom.plans.runner import run_model
from tagloom.sources import read_store, taxonomy_frame
from tests.conftest import rows

USERS = "inType=table##hbaseTable=t_users##family=detail##selectFields=id,gender"
ORDERS = "inType=table##hbaseTable=t_orders##family=detail##selectFields=memberId,finishTime"
TAX = [
    (4, "gender", USERS, 4, 3), (5, "male", "1", 5, 4), (6, "female", "2", 5, 4),
    (23, "cycle", ORDERS, 4, 3), (24, "0-30", "0-30", 5, 23), (25, "31-90", "31-90", 5, 23),
]


def test_two_runs_through_the_store(spark, tmp_path):
    spark.createDataFrame([("1", "1"), ("2", "2"), ("3", "1")], "id string, gender string").createOrReplaceTempView("t_users")
    # epoch seconds: 2001-06-01 and 2001-05-01 (UTC); one garbage value ignored
    spark.createDataFrame([("1", "991353600"), ("1", "988675200"), ("2", "988675200"), ("2", "bad")],
                          "memberId string, finishTime string").createOrReplaceTempView("t_orders")
    tax = taxonomy_frame(spark, TAX)
    root = str(tmp_path / "store")
    assert rows(read_store(spark, root)) == []
    r1 = run_model(spark, ExactMatchModel(4, mode="replace", key_field="id", value_field="gender"), tax, store_root=root, write=True)
    assert dict(rows(r1.store)) == {"1": "5", "2": "6", "3": "5"}
    cyc = RecencyRangeModel(23, as_of="2001-08-01")
    # days = (2001-08-01 - 30) - last: user 1 -> 31, user 2 -> 62
    assert rows(cyc.days(spark.table("t_orders"))) == [("1", 31), ("2", 62)]
    r2 = run_model(spark, cyc, tax, store_root=root, write=True)
    assert dict(rows(r2.store)) == {"1": "25,5", "2": "25,6", "3": "5"}
    assert r2.path == root and dict(rows(r2.merged)) == {"1": "25,5", "2": "25,6"}
    assert dict(rows(read_store(spark, root))) == {"1": "25,5", "2": "25,6", "3": "5"}
    cov = rows(tag_coverage(read_store(spark, root), tax))
    assert cov == [(5, "male", 2), (6, "female", 1), (25, "31-90", 2)]
    # users per tag sum to the exploded (user, tag) pairs
    assert sum(c for _, _, c in cov) == 5


def test_source_missing_field_is_null(spark):
    from tagloom.functions.rules import SourceMeta
    from tagloom.sources import read_source

    spark.createDataFrame([("1", "x")], "id string, job string").createOrReplaceTempView("t_src")
    meta = SourceMeta.from_map({"inType": "HBase", "hbaseTable": "t_src", "selectFields": "id,job,nope,"})
    df = read_source(spark, meta)
    assert df.columns == ["id", "job", "nope"]
    assert [tuple(r) for r in df.collect()] == [("1", "x", None)]
    assert all(f.dataType.simpleString() == "string" for f in df.schema.fields)


def test_job_runner(spark, tmp_path):
    from tagloom.plans.jobs import main
    from tagloom.sources import read_store

    tax_path = str(tmp_path / "tax")
    taxonomy_frame(spark, TAX).write.parquet(tax_path)
    users = str(tmp_path / "users")
    spark.createDataFrame([("1", "1"), ("2", "2")], "id string, gender string").write.parquet(users)
    root = str(tmp_path / "store")
    path = main(["--model", "exact", "--tag-id", "4", "--mode", "replace", "--key-field", "id", "--value-field", "gender",
                 "--taxonomy-format", "parquet", "--taxonomy-option", f"path={tax_path}",
                 "--register", f"t_users={users}", "--store-root", root])
    assert path.startswith(root)
    assert dict(rows(read_store(spark, root))) == {"1": "5", "2": "6"}


def test_ingest_cli(spark, tmp_path):
    from tagloom.plans.jobs import main
    from tagloom.schemas import LOGS_COLUMNS

    src = tmp_path / "logs"
    src.mkdir()
    lines = ["\x01".join([str(k)] + [f"f{i}" for i in range(1, len(LOGS_COLUMNS))]) for k in (3, 1, 2)]
    (src / "part-0.txt").write_text("\n".join(lines + ["bad\x01line"]) + "\n")
    dest = str(tmp_path / "out")
    main(["ingest", "--kind", "logs", "--src", str(src), "--dest", dest, "--partitions", "2"])
    assert [r["id"] for r in spark.read.parquet(dest).collect()] == ["1", "2", "3"]


def test_run_models_equals_sequential_runs(spark):
    from tagloom.functions import canonical_tags
    from tagloom.plans.runner import run_models
    from tagloom.plans import scenario as S
    from tagloom.plans.queries import Ctx, cycle_model, status_model

    c = Ctx(spark, "/root/testdata/sf0.001")
    store = c.stored()
    m1, m2 = cycle_model(), status_model("drop")
    seq = run_model(spark, m2, c.tax, store=run_model(spark, m1, c.tax, store=store, readers=c.readers).store,
                    readers=c.readers).store
    one = run_models(spark, [m1, m2], c.tax, store=store, readers=c.readers).store
    canon = lambda df: sorted(tuple(r) for r in df.select("userId", canonical_tags("tagsId").alias("t")).collect())
    assert canon(seq) == canon(one)
    assert len(canon(one)) > 0


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_rule_named_file_sources(spark, tmp_path, fmt):
    from tagloom.functions.rules import SourceMeta
    from tagloom.sources import read_source

    path = str(tmp_path / fmt)
    df = spark.createDataFrame([(1, 2.5, "x")], "id long, amount double, job string")
    getattr(df.write.option("header", "true") if fmt == "csv" else df.write, fmt)(path)
    meta = SourceMeta.from_map({"inType": fmt, "path": path, "selectFields": "id,amount,missing"})
    got = read_source(spark, meta)
    assert [tuple(r) for r in got.collect()] == [("1", "2.5", None)]
    assert all(f.dataType.simpleString() == "string" for f in got.schema.fields)


def test_slot_cli(spark, tmp_path):
    from tagloom.plans.jobs import main, parse_model_spec
    from tagloom.sources import read_store

    m = parse_model_spec("exact:30:key_field=memberId,value_field=orderstatus,on_unmatched=drop")
    assert (m.tag_id, m.key_field, m.on_unmatched) == (30, "memberId", "drop")
    tax_path = str(tmp_path / "tax")
    taxonomy_frame(spark, TAX + [(30, "status", "inType=table##hbaseTable=t_ord##selectFields=memberId,orderstatus", 4, 3),
                                 (31, "finished", "F", 5, 30)]).write.parquet(tax_path)
    users, orders = str(tmp_path / "users"), str(tmp_path / "orders")
    spark.createDataFrame([("1", "1"), ("2", "2")], "id string, gender string").write.parquet(users)
    spark.createDataFrame([("1", "F"), ("2", "O")], "memberId string, orderstatus string").write.parquet(orders)
    root = str(tmp_path / "store")
    main(["slot", "--model", "exact:4:key_field=id,value_field=gender",
          "--model", "exact:30:key_field=memberId,value_field=orderstatus,on_unmatched=drop",
          "--taxonomy-format", "parquet", "--taxonomy-option", f"path={tax_path}",
          "--register", f"t_users={users}", "--register", f"t_ord={orders}", "--store-root", root])
    assert dict(rows(read_store(spark, root))) == {"1": "5,31", "2": "6"}  # new tags in id order
