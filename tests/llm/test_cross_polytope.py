import numpy as np
from pyspark.sql import functions as F

from tagloom.llm import cross_polytope as cp

SCHEMA = "vec_id long, embedding array<float>, score string"


def vectors(n=600, d=24, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x[n // 2 : n // 2 + 60] = x[7] + 0.05 * rng.normal(size=(60, d))  # a close group
    x[100:140] = x[99]  # one vector many times
    out = [(i, [float(np.float32(v)) for v in row], "x") for i, row in enumerate(x)]
    out += [(n, None, "x"), (n + 1, [0.0] * d, "x"), (n + 2, [None] * d, "x"), (n + 3, [float("nan")] + [1.0] * (d - 1), "x")]
    out += [(n + 4, [float("inf")] * d, "x"), (None, out[5][1], "x"), (n + 5, [], "x"), (n + 6, [1.0, 2.0, 3.0], "x"), (n + 50, [3.0, 2.0, 1.0], "x")]
    out += [out[50]] * 3  # repeated query rows
    out += [(n + 7, [v * 1e30 for v in out[100][1]], "x")]
    return out


def brute(rows, k=5):
    seen = {}
    for i, v, _ in rows:
        if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v):
            seen[i] = np.array(v, dtype=np.float64)
    out = {}
    for q, x in seen.items():
        if q % 50 == 0:
            s = []
            for i, y in seen.items():
                if i != q and len(y) == len(x):
                    a, b = x / np.abs(x).max(), y / np.abs(y).max()
                    s.append((-float(a @ b / np.sqrt((a @ a) * (b @ b))), i))
            s.sort(key=lambda t: (round(t[0], 12), t[1]))
            out[q] = [(i, -v) for v, i in s[:k]]
    return out


def result(df):
    got = {}
    for r in df.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert len(got[r["query_id"]]) == r["rank"]
    return got


def test_all_probes_give_the_exact_neighbours(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = result(cp.nearest(df, F.col("vec_id") % 50 == 0, probes=10_000, tables=2, block_queries=5))
    want = brute(rows)
    assert got.keys() == {q for q, v in want.items() if v}
    for q, v in got.items():
        assert [i for i, _ in v] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in v], [s for _, s in want[q]], atol=1e-9)


def test_measured_probes_reach_the_recall(spark):
    rows = vectors(3000, 32, 1)
    got = result(cp.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0))
    want = brute(rows)
    hit = sum(len({i for i, _ in v} & {i for i, _ in got.get(q, [])}) for q, v in want.items())
    assert hit / sum(map(len, want.values())) >= 0.9
    for q, v in got.items():
        exact = dict(brute_scores(rows, q))
        assert all(abs(exact[i] - s) < 1e-9 for i, s in v)


def brute_scores(rows, q):
    x = np.array(next(v for i, v, _ in rows if i == q))
    for i, v, _ in rows:
        if v and len(v) == len(x) and i is not None and None not in v and np.isfinite(v).all() and any(v):
            a, b = x / np.abs(x).max(), np.array(v) / np.abs(v).max()
            yield i, float(a @ b / np.sqrt((a @ a) * (b @ b)))


def test_hadamard_is_orthonormal_and_buckets_are_nearest_axes():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(20, 16))
    h = cp.hadamard(np.eye(16))
    assert np.allclose(h @ h.T, np.eye(16)) and np.allclose(cp.hadamard(x), x @ h)
    b = cp.buckets(x, 3)
    for t, y in enumerate(cp.rotations(x, 3)):
        both = np.stack((y, -y), axis=2).reshape(20, -1)
        assert (b[:, t] == both.argmax(axis=1)).all()
        assert (cp.probe_order(x, 3)[:, t, 0] == b[:, t]).all()


def test_empty_table_and_few_candidates(spark):
    assert cp.nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0, 0.0], "x"), (1, [1.0, 1.0], "x")], SCHEMA)
    got = result(cp.nearest(two, F.col("vec_id") % 50 == 0))
    assert [i for i, _ in got[0]] == [1]
    assert not result(cp.nearest(two.filter("vec_id = 0"), F.col("vec_id") % 50 == 0))


def test_queries_far_from_all_groups_find_enough(spark):
    rng = np.random.default_rng(3)
    centres = np.eye(32)[:2] * 10
    x = [centres[i % 2] + 0.001 * rng.normal(size=32) for i in range(300)]
    x[50], x[150] = -np.eye(32)[9], -np.eye(32)[20]  # their buckets hold no other row
    rows = [(i, [float(v) for v in r], "x") for i, r in enumerate(x)] + [(1000, [1.0, 2.0, 2.0], "x"), (1001, [1.0, 0.0, 0.0], "x")]
    got = result(cp.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, probes=1, tables=2))
    want = brute(rows)
    assert all(len(got[q]) == len(v) for q, v in want.items())
    assert len(got[50]) == 5 and len(got[1000]) == 1


def test_many_ties_go_to_the_smallest_ids(spark):
    """Scaled copies and axis-aligned vectors: any number of distinct vectors of one score."""
    x = np.random.default_rng(4).normal(size=16)
    rows = [(0, [float(v) for v in x], "q")] + [(101 + i, [float(v * 2.0 ** (i % 30 - 15)) for v in x], "x") for i in np.random.default_rng(1).permutation(60).tolist()]
    axes = np.eye(16)
    rows += [(1000 + 50 * i, [float(v) for v in axes[i % 16] * (1 + i // 16)], "a") for i in range(64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string").repartition(2)
    for probes in (10_000, 3):
        got = result(cp.nearest(df, F.col("vec_id") % 50 == 0, probes=probes, tables=4))
        assert [i for i, _ in got[0]] == [101, 102, 103, 104, 105]
        assert [i for i, _ in got[1000]][:3] == [1800, 2600, 3400]  # its own axis
    exact = brute(rows)
    got = result(cp.nearest(df, F.col("vec_id") % 50 == 0, probes=10_000, tables=4))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in exact.items()}
