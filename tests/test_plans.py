"""Plan properties the scale design depends on, asserted on physical plans."""

import re

import pytest

from tagloom.plans import queries as Q

SF = "/root/testdata/sf0.001"


def plan_of(df):
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    if "== Final Plan ==" in p:
        p = p.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return p


def read_schemas(plan):
    return re.findall(r"ReadSchema: (struct<[^>]*>)", plan)


def test_cycle_tags_prunes_and_hash_aggregates(spark):
    p = plan_of(Q.cycle_tags(spark, SF))
    assert read_schemas(p) == ["struct<o_custkey:bigint,o_orderdate:timestamp_ntz>"]
    assert "HashAggregate" in p and "SortAggregate" not in p      # numeric max
    assert "BroadcastNestedLoopJoin" not in p and "BroadcastHashJoin" in p  # bucketed rules broadcast
    assert p.count("Exchange hashpartitioning") == 1               # only the group-by


@pytest.mark.parametrize("q", ["gender_tags", "job_tags", "status_tags_drop"])
def test_exact_match_never_shuffles_the_source(spark, q):
    p = plan_of(Q.QUERIES[q](spark, SF))
    assert "BroadcastHashJoin" in p
    # the source scan feeds the join directly: the only exchanges are the
    # small rule-side aggregate and its broadcast
    src_scans = [s for s in read_schemas(p)]
    assert all(len(s.split(",")) <= 2 for s in src_scans)
    for m in re.finditer(r"Exchange hashpartitioning\(([^)]*)\)", p):
        assert "rule" in m.group(1)


def test_upsert_reuses_the_aggregate_partitioning(spark):
    p = plan_of(Q.model_run_cycle_merge(spark, SF))
    assert "FullOuter" in p
    # new side: partitioned once by the per-user aggregate, not again for the join
    assert p.count("Exchange hashpartitioning") <= 3


def test_no_python_in_any_plan(spark):
    for name in ("merge_tags", "upsert_store", "tag_coverage", "rule_map", "ingest_logs", "activity_rfe"):
        p = plan_of(Q.QUERIES[name](spark, SF))
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF", p), name


@pytest.mark.parametrize("q", ["cycle_tags", "merge_tags", "age_band_tags", "tag_coverage", "model_run_multi"])
def test_range_match_is_never_a_nested_loop(spark, q):
    assert "NestedLoop" not in plan_of(Q.QUERIES[q](spark, SF))


def test_models_of_one_source_share_a_scan(spark):
    p = plan_of(Q.model_run_multi(spark, SF))
    assert not any("o_orderstatus" in s for s in read_schemas(p))  # read once, before, with the other fields


def test_path_load_has_no_window(spark):
    assert "Window" not in plan_of(Q.taxonomy_path_load(spark, SF))
