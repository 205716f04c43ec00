"""The tag store: keyed ``(userId, tagsId)`` rows, partitioned by a hash of the user.

The store is a plain partitioned parquet folder: partition ``u<N>=<p>`` holds
the users whose hash is ``p`` modulo ``N``, so the column's name states how
many partitions there are and the files alone describe the store.  A run joins
its new tags with the partitions they fall into and writes just those back, by
Spark's dynamic partition overwrite: partitions without a new tag are neither
read nor written.

There is one writer per schedule slot.  Spark stages the new files of all
partitions and moves them in at the job's commit, so a failed or repeated task
leaves nothing.  A driver that dies while it commits leaves whole partitions,
old or new; the same run done again completes it, for a merge adds no tag
twice and a replaced cell is replaced by itself.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.operators.merge import MODES, upsert_tags
from tagloom.schemas import STORE_SCHEMA
from tagloom.session import materialize
from tagloom.sources.extracts import partitions_for

MIN_PARTS = 16
_PART = re.compile(r"u(\d+)=\d+$")


def store_parts(spark: SparkSession, root: str) -> int | None:
    """Number of hash partitions of the store at ``root``; None where there is none yet."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    found = {m[1] for st in fs.listStatus(path) if (m := _PART.match(st.getPath().getName()))}
    if len(found) > 1:
        raise ValueError(f"{root} holds stores of {sorted(found)} partitions")
    return int(found.pop()) if found else None


def _partitioned(df: DataFrame, parts: int) -> DataFrame:
    part = F.pmod(F.xxhash64("userId"), F.lit(parts)).cast("int")
    return df.select("userId", "tagsId", part.alias(f"u{parts}"))


def _stored(spark: SparkSession, root: str, parts: int) -> DataFrame:
    schema = T.StructType([*STORE_SCHEMA.fields, T.StructField(f"u{parts}", T.IntegerType())])
    return spark.read.schema(schema).parquet(root)


def read_store(spark: SparkSession, root: str) -> DataFrame:
    """The stored tags, or an empty frame where there is no store yet."""
    parts = store_parts(spark, root)
    if parts is None:
        return spark.createDataFrame([], STORE_SCHEMA)
    return _stored(spark, root, parts).select("userId", "tagsId")


def _write(df: DataFrame, root: str, parts: int) -> None:
    out = _partitioned(df, parts)
    # one task per partition, more for a large one
    out.hint("rebalance", f"u{parts}").write.partitionBy(f"u{parts}").mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(root)


def write_store(df: DataFrame, root: str, parts: int | None = None) -> str:
    """Write a first store (one row per user; rows without a user are not stored)."""
    spark = df.sparkSession
    if store_parts(spark, root) is not None:
        raise ValueError(f"there is a store at {root}: update it")
    rows = df.select(F.col("userId").cast("string"), F.col("tagsId").cast("string")).where("userId IS NOT NULL")
    _write(rows, root, parts or max(MIN_PARTS, partitions_for(rows)))
    return root


def update_store(new: DataFrame, root: str, mode: str = "merge", parts: int | None = None) -> list[int]:
    """Merge (or replace) new tags into the store; returns the partitions that were written.

    ``new`` may hold several rows per user.  It is computed once, before any
    file of the store is replaced, so it may itself read the store.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    spark = new.sparkSession
    new = materialize(new.select(F.col("userId").cast("string"), F.col("tagsId").cast("string")).where("userId IS NOT NULL"))
    n = store_parts(spark, root)
    if n is not None and parts not in (None, n):
        raise ValueError(f"the store at {root} has {n} partitions, not {parts}")
    old = _stored(spark, root, n) if n is not None else spark.createDataFrame([], STORE_SCHEMA)
    n = n or parts or max(MIN_PARTS, partitions_for(new))
    name = f"u{n}"
    touched = sorted(r[name] for r in _partitioned(new, n).select(name).distinct().collect())  # at most n numbers
    if not touched:
        return []
    if name in old.columns:
        old = old.where(F.col(name).isin(touched))
    _write(upsert_tags(old.select("userId", "tagsId"), new, mode=mode), root, n)
    return touched
