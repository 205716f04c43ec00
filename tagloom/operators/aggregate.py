"""Aggregations: last value per key, R/F/E activity measures, tag coverage.

All are one ``groupBy`` each with partial (map-side) aggregation, so a hot
key is pre-aggregated on every map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.dates import as_of_lit, epoch_to_long
from tagloom.functions.tags import tag_ids
from tagloom.operators.broadcast import maybe_broadcast


def last_per_key(
    source: DataFrame, key_col: str, time_col: str, out_key: str = "userId", out_time: str = "maxFinishTime"
) -> DataFrame:
    """Latest epoch-seconds value per key.

    The source cell is a string; it is cast to bigint *before* the max, so
    the max is numeric (and planned as a hash aggregate).  Malformed text is
    null and ignored by the max.
    """
    return source.groupBy(F.col(key_col).cast("string").alias(out_key)).agg(
        F.max(epoch_to_long(F.col(time_col))).alias(out_time)
    )


def rfe_measures(
    events: DataFrame,
    user_col: str,
    ts_col: str,
    action_col: str,
    as_of,
    lookback_days: int = 30,
    view_value: str = "view",
    click_value: str = "click",
) -> DataFrame:
    """Activity measures per user from a log of visits, as of a date (extension).

    R = days from the last visit before ``as_of`` to ``as_of``;
    F = visits in the ``lookback_days`` before ``as_of``;
    E = views / clicks in that period, rounded to 6 digits (null without clicks).
    Visits on or after ``as_of``, and those whose time is no timestamp
    (``\\N``), are not seen.
    """
    a = as_of_lit(as_of)
    ts = F.col(ts_col).try_cast("timestamp_ntz")
    upto = events.where(ts < a.cast("timestamp_ntz"))
    recent = ts >= F.date_sub(a, lookback_days).cast("timestamp_ntz")
    act = F.col(action_col)
    agg = upto.groupBy(F.col(user_col).cast("string").alias("userId")).agg(
        F.max(ts).alias("__last"),
        F.count_if(recent).alias("frequency"),
        F.count_if(recent & (act == F.lit(view_value))).alias("__views"),
        F.count_if(recent & (act == F.lit(click_value))).alias("__clicks"),
    )
    return agg.select(
        "userId",
        F.datediff(a, F.to_date(F.col("__last"))).cast("int").alias("recency"),
        F.col("frequency").cast("bigint").alias("frequency"),
        F.round(F.col("__views") / F.nullif(F.col("__clicks"), F.lit(0)), 6).alias("engagement"),
    )


def explode_tags(store: DataFrame, key: str = "userId", tags: str = "tagsId") -> DataFrame:
    """``(userId, tagsId)`` pairs: one per distinct tag id of each stored list (``05`` and ``5`` are one)."""
    return store.select(F.col(key), F.explode(tag_ids(F.col(tags))).alias(tags))


def tag_coverage(store: DataFrame, taxonomy: DataFrame | None = None, key: str = "userId", tags: str = "tagsId") -> DataFrame:
    """Users per tag.  The store is keyed (one row per user) and tag ids are
    de-duplicated per row, so ``count`` equals the distinct-user count and no
    distinct aggregation (Expand + second shuffle) is needed."""
    cov = explode_tags(store, key, tags).groupBy(tags).agg(
        F.count(F.lit(1)).alias("users")
    )
    if taxonomy is None:
        return cov
    names, _ = maybe_broadcast(taxonomy.select(F.col("id").cast("bigint").alias(tags), F.col("name")))
    return cov.join(names, on=tags, how="left").select(tags, "name", "users")
