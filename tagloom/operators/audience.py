"""Audience sets: the users of a tag as bitmaps that merge over days and intersect without a join.

A user's number falls into a bucket of 32,768 numbers and a place in it; a
set is one bitmap of 4 KB per tag and bucket.  Sets of a day are built once
and kept; those of several days are united by ``bitmap_or_agg``, the users who
hold all tags of an audience are the ``bitmap_and_agg`` over its tags in a
bucket, and counts are sums of ``bitmap_count``.  What is shuffled for a
question is bitmaps, not users, and a tag that a third of all users hold is as
many rows as it has buckets.

Users are numbers (``number`` maps the key to one); a key that is none is an
error.  Numbers should be dense: sparse ones cost a bitmap per bucket they
touch.  Defined cases: rows without a key or tag are in no set; a repeated
(user, tag) counts once; an audience with a tag that nobody holds has no
users; repeated tags of an audience count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.operators.aggregate import explode_tags
from tagloom.operators.broadcast import maybe_broadcast


def user_number(key: Column) -> Column:
    """The key as a number; text that is none is an error."""
    bad = F.raise_error(F.concat(F.lit("no user number: "), key)).cast("bigint")
    return F.when(key.isNull(), F.lit(None).cast("bigint")).otherwise(F.coalesce(key.try_cast("bigint"), bad))


def audience_sets(store: DataFrame, key: str = "userId", tags: str = "tagsId", number=user_number) -> DataFrame:
    """``(tag, bucket, users)`` of stored tag lists."""
    pairs = explode_tags(store.where(F.col(key).isNotNull()), key, tags)
    n = number(F.col(key))
    placed = pairs.select(F.col(tags).alias("tag"), F.bitmap_bucket_number(n).alias("bucket"), F.bitmap_bit_position(n).alias("__bit"))
    return placed.groupBy("tag", "bucket").agg(F.bitmap_construct_agg("__bit").alias("users"))


def merge_sets(sets: DataFrame) -> DataFrame:
    """Sets of several days (or parts) as one per tag and bucket."""
    return sets.groupBy("tag", "bucket").agg(F.bitmap_or_agg("users").alias("users"))


def users_per_tag(sets: DataFrame) -> DataFrame:
    """``(tag, users)``: distinct users of merged sets."""
    return sets.groupBy("tag").agg(F.sum(F.bitmap_count("users")).cast("bigint").alias("users"))


def users_per_audience(sets: DataFrame, audiences: DataFrame) -> DataFrame:
    """``(audience, users)``: distinct users who hold all tags of each audience.

    ``audiences`` is ``(audience, tag)`` rows, small beside the sets (it is
    broadcast behind a measured bound); ``sets`` are merged ones.
    """
    wanted = audiences.select("audience", F.col("tag").cast("bigint").alias("tag")).where("tag IS NOT NULL").distinct()
    sizes = wanted.groupBy("audience").agg(F.count(F.lit(1)).alias("__size"))
    rows, _ = maybe_broadcast(wanted.join(sizes, "audience"))
    held = sets.join(rows, "tag").groupBy("audience", "bucket").agg(
        F.bitmap_and_agg("users").alias("users"), F.count(F.lit(1)).alias("__tags"), F.first("__size").alias("__size")
    )
    # a bucket counts where every tag of the audience has a set
    counts = held.where(F.col("__tags") == F.col("__size")).groupBy("audience").agg(F.sum(F.bitmap_count("users")).alias("users"))
    return sizes.select("audience").join(counts, "audience", "left").select(
        "audience", F.coalesce("users", F.lit(0)).cast("bigint").alias("users")
    )
