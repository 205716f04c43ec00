"""Connected components of an edge table by alternating star steps.

Defined cases: edges with a null end are left out; an edge from a node to
itself and repeated edges add nothing (a node with no other edge is in no
component); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import HOT_KEYS, join_hot, staged

MAX_ROUNDS = 60


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of an edge; ``edges`` has long columns a and b.

    The component is its smallest node.  Each round links the larger
    neighbours of every node to its smallest one, then the smaller ones; the
    number of rounds grows with the logarithm of the longest chain.  Every
    round is a written table.  The rows of a hub are not brought together.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    e = staged(e, name)
    mark, degree = _mark(e)
    for _ in range(MAX_ROUNDS):
        e = staged(_star(e, mark[0], degree, name), name)
        before = mark
        mark, degree = _mark(e)
        if mark == before:
            break
    else:
        raise RuntimeError("components did not settle")
    member = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return member.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _both(e: DataFrame) -> DataFrame:
    return e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(e: DataFrame, edges: int, degree: int, name: str) -> DataFrame:
    """The edges after one round.  Plans are kept small: a step that is read several times is written."""
    both = _both(e)
    total = 2 * edges  # rows of both, and no fewer than the larger neighbours
    if degree * HOT_KEYS <= total:  # no hub: a node's rows meet in a task, and it has no more larger neighbours than neighbours
        of = Window.partitionBy("u")
        large = both.select("u", "v", F.least("u", F.min("v").over(of)).alias("m")).filter("v > u")
        large = staged(large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), name)
        small = large.select("u", "v", F.min("v").over(of).alias("m"))
        ends = F.explode(F.array("u", "v")).alias("u")
        return small.select(ends, F.col("m").alias("v")).filter("u != v").distinct()
    low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    low = staged(low.select("u", F.least("u", "m").alias("m"), "n"), name)
    large = join_hot(both.filter("v > u"), low, ["u"], "n", total)
    large = staged(large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), name)
    low = staged(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), name)
    small = join_hot(large, low, ["u"], "n", total).filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def _mark(e: DataFrame) -> tuple[tuple, int]:
    """What tells two sets of edges apart, their number first; the most neighbours of a node."""
    h = F.xxhash64("u", "v")
    mark = tuple(e.agg(F.count("*"), F.sum(F.shiftright(h, 20)), F.bit_xor(h)).first())
    return mark, _both(e).groupBy("u").count().agg(F.max("count")).first()[0] or 0
