"""Size measuring, numeric max per key, R/F/E measures, rule-less tags."""

import pytest
from pyspark.sql import functions as F

from tagloom.operators import last_per_key, level4_meta, maybe_broadcast, measure, rfe_measures
from tagloom.sources import taxonomy_frame
from tests.conftest import rows


def test_measure_counts_rows_bytes_invalid_extra(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None), (3, "de")], "id long, s string")
    size = measure(df, invalid=F.col("s").isNull(), extra={"top": F.max("id")})
    assert size.rows == 3 and size.invalid == 1 and size.extra == {"top": 3}
    assert size.bytes >= 3 * 16 + 5
    _, small = maybe_broadcast(df)
    assert small
    _, small = maybe_broadcast(df, max_rows=2)
    assert not small


def test_max_is_numeric_not_lexical(spark):
    src = spark.createDataFrame([("u", "99"), ("u", "100"), ("u", "x"), ("v", None)], "memberId string, finishTime string")
    assert rows(last_per_key(src, "memberId", "finishTime")) == [("u", 100), ("v", None)]


def test_rfe_measures(spark):
    ev = spark.createDataFrame(
        [("1", "2024-01-18 10:00:00", "view"), ("1", "2024-01-19 09:00:00", "click"), ("1", "2024-01-19 10:00:00", "view"),
         ("1", "2024-01-25 00:00:00", "view"),  # after as_of: not seen
         ("2", "2023-11-01 00:00:00", "view"),  # outside the lookback window
         ("3", "2024-01-10 00:00:00", "view")],
        "u string, t string, a string",
    )
    got = rows(rfe_measures(ev, "u", "t", "a", "2024-01-20", lookback_days=30))
    assert got == [("1", 1, 3, 2.0), ("2", 80, 0, None), ("3", 10, 1, None)]


def test_tag_without_rule(spark):
    tax = taxonomy_frame(spark, [(3, "classification", None, 3, 2)])
    with pytest.raises(ValueError, match="no rule"):
        level4_meta(tax, 3)


def test_cluster_ranks_most_active_first(spark):
    from tagloom.operators.cluster import cluster_rfe

    groups = [(1, 40, 3.0), (10, 15, 1.0), (20, 5, 0.5), (29, 1, None)]  # R, F, E: most active first
    data = [(f"u{g}_{i}", r + (i % 2), f + (i % 3), e) for g, (r, f, e) in enumerate(groups) for i in range(12)]
    m = spark.createDataFrame(data, "userId string, recency int, frequency long, engagement double")
    out = cluster_rfe(m, k=4, seed=3)
    by_group = {}
    for r in out.collect():
        by_group.setdefault(r["userId"].split("_")[0], set()).add(r["rank"])
    assert all(len(v) == 1 for v in by_group.values())              # each group one cluster
    assert [by_group[f"u{g}"].pop() for g in range(4)] == [0, 1, 2, 3]  # ranked by activity
