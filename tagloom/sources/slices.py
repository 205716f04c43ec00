"""Sorted publish in slices whose key ranges stay: later loads are cut at the boundaries of the first.

A publish is a folder ``slice=N`` per key range, files in key order.  A later
load does not sample bounds anew: the ranges are read from the file footers,
every new row is dealt to the slice that holds its key by a binary search over
them, and only the slices that get rows are read, joined and written again, by
Spark's dynamic partition overwrite.  The other slices' files are not touched.

A key of the new load replaces the stored rows of that key.  A key that fills
several slices is replaced in all of them and its new rows are dealt over them
by a hash.  Keys below the first range go to the first slice, keys above the
last one to the last, keys in a gap to the slice before it; rows without a
key go to the first slice and replace nothing.  A slice that has grown is written by several tasks, as
files in key order.  ``publish`` of the whole cuts new boundaries.

One writer at a time.  A job that dies in its commit leaves every slice whole,
old or new; running the load again completes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagloom.operators.broadcast import MAX_BROADCAST_BYTES
from tagloom.session import materialize
from tagloom.sources.extracts import partitions_for, sorted_by_key
from tagloom.sources.rowsource import key_ranges

SLICE = "slice"


def publish(df: DataFrame, path: str, key: str | None = None, slices: int | None = None) -> str:
    """Publish a first load: as many slices of even size as its size asks for (or ``slices``)."""
    key = key or df.columns[0]
    ordered = sorted_by_key(df, key, slices).withColumn(SLICE, F.spark_partition_id())
    ordered.sortWithinPartitions(SLICE, key).write.partitionBy(SLICE).mode("overwrite").parquet(path)
    return path


def slice_ranges(path: str, key: str) -> list[tuple[int, str, str]]:
    """(slice, lowest key, highest key) of every slice that holds keys, from the file footers."""
    found: dict[int, list[str]] = {}
    for r in key_ranges(path, key):
        if r.low is not None:
            n = int(r.file.rsplit(f"{SLICE}=", 1)[1].split("/", 1)[0])
            found.setdefault(n, []).extend([r.low, r.high])
    return [(n, min(v), max(v)) for n, v in sorted(found.items())]


def _count_below(bounds: list[str], key: Column, inclusive: bool) -> Column:
    """How many of the sorted ``bounds`` are below ``key`` (or equal, if inclusive), by binary search."""
    of = F.lit(bounds)

    def step(s: Column, _: Column) -> Column:
        mid = F.shiftright(s["a"] + s["b"], 1)
        at = F.get(of, mid)
        right = (at <= key) if inclusive else (at < key)
        a, b = F.when(right, mid + 1).otherwise(s["a"]), F.when(right, s["b"]).otherwise(mid)
        return F.when(s["a"] < s["b"], F.struct(a.cast("int").alias("a"), b.cast("int").alias("b"))).otherwise(s)

    begin = F.struct(F.lit(0).alias("a"), F.lit(len(bounds)).alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(len(bounds).bit_length())), begin, step)["a"]


def deal(ranges: list[tuple[int, str, str]], key: Column) -> tuple[Column, Column]:
    """First and last place (index into ``ranges``) of the slices that hold or should hold a key."""
    lows, highs = [low for _, low, _ in ranges], [high for _, _, high in ranges]
    last = F.greatest(_count_below(lows, key, True) - 1, F.lit(0))
    first = F.least(_count_below(highs, key, False), last)
    return F.coalesce(first, F.lit(0)), F.coalesce(last, F.lit(0))


def publish_more(df: DataFrame, path: str, key: str | None = None) -> list[int]:
    """Publish a later load into the slices of ``path``; returns the slices that were written."""
    spark = df.sparkSession
    key = key or df.columns[0]
    ranges = slice_ranges(path, key)
    if not ranges:
        publish(df, path, key)
        return [n for n, _, _ in slice_ranges(path, key)]
    if sum(4 * (len(a) + len(b)) for _, a, b in ranges) > MAX_BROADCAST_BYTES:
        raise ValueError("the boundaries do not fit a task: publish with fewer slices")
    first, last = deal(ranges, F.col(key))
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    new = materialize(df.select("*", first.alias("__first"), last.alias("__last"), tie.alias("__tie")))
    places = new.select("__first", "__last").distinct().select(F.explode(F.sequence("__first", "__last")).alias("p")).distinct()
    touched = sorted(ranges[r["p"]][0] for r in places.collect())  # at most one small row per slice
    if not touched:
        return []

    numbers = F.lit([n for n, _, _ in ranges])
    place = F.col("__first") + F.pmod(F.col("__tie"), F.col("__last") - F.col("__first") + 1)
    dealt = new.select(*df.columns, F.get(numbers, place.cast("int")).alias(SLICE), "__tie")
    stored = spark.read.parquet(path).where(F.col(SLICE).isin(touched))
    kept = stored.join(new.select(key).distinct(), key, "left_anti").select(*df.columns, SLICE, tie.alias("__tie"))
    out = materialize(kept.unionByName(dealt))
    n = max(len(touched), partitions_for(out))
    ordered = out.repartitionByRange(n, SLICE, key, "__tie").sortWithinPartitions(SLICE, key, "__tie").drop("__tie")
    ordered.write.partitionBy(SLICE).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    return touched


def sliced_positions(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """``columns`` and the rank (from 1) of each row in slice and file order."""
    rows = spark.read.parquet(path).select(
        *columns, F.col(SLICE).alias("__s"), F.col("_metadata.file_name").alias("__f"), F.col("_metadata.row_index").alias("__i")
    )
    files = rows.groupBy("__s", "__f").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__s", "__f").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    offsets = files.select("__s", "__f", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"))
    out = rows.join(F.broadcast(offsets), ["__s", "__f"])
    return out.select(*columns, (F.col("__o") + F.col("__i") + F.lit(1)).cast("bigint").alias("position"))
