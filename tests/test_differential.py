"""Differential tests: Spark expressions against plain-Python statements of
the same semantics, over thousands of random strings evaluated in one job."""

import random

import pytest
from pyspark.sql import functions as F

from tagloom.functions import java_split, merge_tag_strings, rule_to_map
from tagloom.sources import parse_lines

JAVA_WS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"


def py_split(s, sep):
    """Java String.split with a literal separator: trailing empties dropped, '' -> ['']."""
    if s is None:
        return None
    if s == "":
        return [""]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def py_blank(s):
    return s is None or s.strip(JAVA_WS) == ""


def py_merge(n, o):
    if py_blank(n):
        return o
    if py_blank(o):
        return n
    out = []
    for t in py_split(n, ",") + py_split(o, ","):
        if t not in out:
            out.append(t)
    return ",".join(out)


def py_rule_map(rule):
    m = {}
    for part in py_split(rule, "##"):
        kv = py_split(part, "=")
        if len(kv) < 2:
            raise ValueError(part)
        m[kv[0]] = kv[1]
    return m


def rand_strings(alphabet, n, max_len, seed):
    r = random.Random(seed)
    out = [None, ""]
    for _ in range(n):
        out.append("".join(r.choice(alphabet) for _ in range(r.randint(0, max_len))))
    return out


@pytest.mark.parametrize("sep,alphabet", [(",", "ab,"), ("##", "a#"), ("\x01", "a\x01 "), ("=", "a=b")])
def test_java_split_matches(spark, sep, alphabet):
    data = rand_strings(alphabet, 1500, 9, seed=len(alphabet))
    df = spark.createDataFrame([(s,) for s in data], "s string")
    got = [r["x"] for r in df.select(java_split(F.col("s"), sep).alias("x")).collect()]
    assert got == [py_split(s, sep) for s in data]


def test_merge_matches(spark):
    r = random.Random(7)
    vals = rand_strings("12,, \t", 60, 6, seed=3)
    pairs = [(r.choice(vals), r.choice(vals)) for _ in range(3000)]
    df = spark.createDataFrame(pairs, "n string, o string")
    got = [r["m"] for r in df.select(merge_tag_strings("n", "o").alias("m")).collect()]
    assert got == [py_merge(n, o) for n, o in pairs]


def test_rule_map_matches(spark):
    r = random.Random(11)
    keys, vals = ["a", "b", "inType", ""], ["x", "y=z", "1,2", ""]
    rules = []
    for _ in range(1500):
        parts = [f"{r.choice(keys)}={r.choice(vals)}" for _ in range(r.randint(1, 4))]
        rules.append("##".join(parts) + r.choice(["", "##", "####"]))
    good = [x for x in rules if _parses(x)]
    df = spark.createDataFrame([(x,) for x in good], "s string")
    got = [r["m"] for r in df.select(rule_to_map(F.col("s")).alias("m")).collect()]
    assert got == [py_rule_map(x) for x in good]
    assert len(good) > 500


def _parses(rule):
    try:
        py_rule_map(rule)
        return True
    except ValueError:
        return False


def test_width_repair_matches(spark):
    cols = ["k", "a", "b", "c"]
    lines = rand_strings("x\x01", 3000, 9, seed=5)[1:]  # text lines are never null
    df = spark.createDataFrame([(s,) for s in lines], "value string")
    got = sorted(tuple(r) for r in parse_lines(df, cols).collect())
    want = []
    for s in lines:
        f = py_split(s, "\x01")
        if len(f) == len(cols) - 1:
            f = f + [""]
        if len(f) == len(cols):
            want.append(tuple(f))
    assert got == sorted(want)


def test_sql_functions_match_column_functions(spark):
    from tagloom.functions import canonical_tags
    from tagloom.functions.sql import register_sql_functions

    register_sql_functions(spark)
    r = random.Random(13)
    vals = rand_strings("12,, \t", 60, 6, seed=9)
    pairs = [(r.choice(vals), r.choice(vals)) for _ in range(2000)]
    df = spark.createDataFrame(pairs, "n string, o string")
    df.createOrReplaceTempView("t_pairs")
    sql = spark.sql("SELECT n, o, tag_merge(n, o) AS m FROM t_pairs")
    col = df.select("n", "o", merge_tag_strings("n", "o").alias("m"))
    assert sorted(map(tuple, sql.collect()), key=str) == sorted(map(tuple, col.collect()), key=str)
    nums = [x for x in rand_strings("123,,", 400, 8, seed=21) if x is None or x.replace(",", "").isdigit() or x.strip(",") == ""]
    nf = spark.createDataFrame([(x,) for x in nums], "s string")
    nf.createOrReplaceTempView("t_nums")
    a = [r["c"] for r in spark.sql("SELECT tag_canonical(s) AS c FROM t_nums").collect()]
    b = [r["c"] for r in nf.select(canonical_tags("s").alias("c")).collect()]
    assert a == b
