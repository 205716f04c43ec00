"""K-means over R/F/E activity measures (extension; declared in the reference).

Distributed ``pyspark.ml`` k-means: the measures are assembled into a
vector and standardised; each k-means iteration is one pass over the data
with only the k centers broadcast.  Cluster ids are arbitrary, so clusters
are ranked by their centers — most active first: low recency, high
frequency, high engagement — and that rank (0..k-1) is returned.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def cluster_rfe(measures: DataFrame, k: int = 4, seed: int = 7, max_iter: int = 20) -> DataFrame:
    """``measures(userId, recency, frequency, engagement)`` -> ``(userId, …, cluster, rank)``.

    A null engagement (no clicks) is scored as 0.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    feats = measures.select(
        "userId",
        F.col("recency").cast("double").alias("recency"),
        F.col("frequency").cast("double").alias("frequency"),
        F.coalesce(F.col("engagement").cast("double"), F.lit(0.0)).alias("engagement"),
    ).where(F.col("recency").isNotNull())
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=["recency", "frequency", "engagement"], outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
        KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features", predictionCol="cluster"),
    ])
    from pyspark import StorageLevel

    # k-means passes over the data once per iteration: keep the features
    feats = feats.persist(StorageLevel.MEMORY_AND_DISK)
    model = pipe.fit(feats)
    centers = model.stages[-1].clusterCenters()  # k small vectors, standardised space
    # activity score: -R + F + E in standard units; higher = more active
    score = {i: float(-c[0] + c[1] + c[2]) for i, c in enumerate(centers)}
    order = sorted(score, key=lambda i: (-score[i], i))
    rank_of = {cid: r for r, cid in enumerate(order)}
    rank_map = F.create_map(*[x for cid, r in rank_of.items() for x in (F.lit(cid), F.lit(r))])
    out = model.transform(feats).select(
        "userId", "recency", "frequency", "engagement", "cluster", rank_map[F.col("cluster")].alias("rank")
    )
    feats.unpersist()  # the result is lazy: it assigns from the measures, one pass
    return out


# --- segments that keep their ranks from run to run -------------------------------------

MEASURES = ("recency", "frequency", "engagement")
DIRECTION = (-1.0, 1.0, 1.0)  # of more activity
DIGITS = 9  # centres are rounded, so that the order of additions cannot show


@dataclass(frozen=True)
class Segments:
    """Centres in standard units, most active first, and the units: a few numbers."""

    centres: tuple[tuple[float, ...], ...]
    means: tuple[float, ...]
    scales: tuple[float, ...]


def _features(measures: DataFrame) -> DataFrame:
    known = measures.where(F.col("recency").isNotNull())
    return known.select("userId", *[F.coalesce(F.col(m).cast("double"), F.lit(0.0)).alias(m) for m in MEASURES])


def _standard(model: Segments) -> Column:
    return F.array(*[(F.col(m) - F.lit(a)) / F.lit(s) for m, a, s in zip(MEASURES, model.means, model.scales)])


def _nearest(model: Segments) -> Column:
    """Rank of the nearest centre; of equally near ones the more active."""
    z = _standard(model)
    far = [
        sum(((F.get(z, F.lit(j)) - F.lit(c)) * (F.get(z, F.lit(j)) - F.lit(c)) for j, c in enumerate(centre)), F.lit(0.0))
        for centre in model.centres
    ]
    return F.array_min(F.array(*[F.struct(d.alias("d"), F.lit(k).alias("k")) for k, d in enumerate(far)]))["k"]


def fit_segments(measures: DataFrame, k: int = 4, start: Segments | None = None, iterations: int = 10) -> Segments:
    """k-means by Lloyd's iterations from ``start``, the stored model of the run before.

    The first run starts from k points along the direction of activity, in
    standard units of its users.  Later runs start from the stored centres and
    keep its units, so a rank goes on meaning the same segment.  An iteration
    is one aggregate over the users; k centres are all that leaves it.  A
    centre without users stays where it is.
    """
    rows = _features(measures)
    if start is None:
        got = rows.agg(*[f(m).alias(f"{n}_{m}") for m in MEASURES for n, f in (("a", F.avg), ("s", F.stddev_samp))]).first()
        means = tuple(got[f"a_{m}"] or 0.0 for m in MEASURES)
        scales = tuple(got[f"s_{m}"] or 1.0 for m in MEASURES)
        steps = [(k - 1) / 2 - i for i in range(k)]
        start = Segments(tuple(tuple(t * d for d in DIRECTION) for t in steps), means, scales)
    model = start
    from pyspark import StorageLevel

    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    for _ in range(iterations):
        z = _standard(model)
        sums = rows.select(_nearest(model).alias("k"), *[F.get(z, F.lit(j)).alias(m) for j, m in enumerate(MEASURES)])
        moved = {r["k"]: r for r in sums.groupBy("k").agg(*[F.avg(m).alias(m) for m in MEASURES]).collect()}  # k rows at most
        centres = tuple(
            tuple(round(moved[i][m], DIGITS) for m in MEASURES) if i in moved else c for i, c in enumerate(model.centres)
        )
        if centres == model.centres:
            break
        model = Segments(centres, model.means, model.scales)
    rows.unpersist()
    return model


def assign(measures: DataFrame, model: Segments) -> DataFrame:
    """``(userId, recency, frequency, engagement, rank)``: every measured user with the nearest centre's rank."""
    return _features(measures).withColumn("rank", _nearest(model))


def write_segments(spark: SparkSession, model: Segments, path: str) -> str:
    """Store a model as one row per rank."""
    rows = [(i, list(c), list(model.means), list(model.scales)) for i, c in enumerate(model.centres)]
    segment_rows(spark, rows).coalesce(1).write.mode("overwrite").parquet(path)
    return path


def segment_rows(spark: SparkSession, rows: list) -> DataFrame:
    return spark.createDataFrame(rows, "rank int, centre array<double>, means array<double>, scales array<double>")


def read_segments(spark: SparkSession, path: str) -> Segments:
    rows = spark.read.parquet(path).orderBy("rank").collect()  # k rows
    return Segments(tuple(tuple(r["centre"]) for r in rows), tuple(rows[0]["means"]), tuple(rows[0]["scales"]))


def centres(spark: SparkSession, model: Segments, digits: int = 6) -> DataFrame:
    """``(rank, c_recency, c_frequency, c_engagement)``: the centres in the measures' own units."""
    rows = [
        (i, *[round(z * s + a, digits) for z, a, s in zip(c, model.means, model.scales)]) for i, c in enumerate(model.centres)
    ]
    return spark.createDataFrame(rows, "rank int, c_recency double, c_frequency double, c_engagement double")
