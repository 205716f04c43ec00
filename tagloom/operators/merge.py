"""Tag merge (new ⟕ stored) and the keyed upsert of the tag store.

The store is keyed by ``userId`` (one row per user).  New tags may come as
several rows per user (a model can emit one row per source row); they are
first collapsed to one list per user with ``collect_set``, which Spark
aggregates partially on the map side, so even a user holding a third of all
source rows sends at most one small set per map task through the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.strings import is_blank
from tagloom.functions.tags import join_tags, merge_tag_strings, split_tags

MODES = ("merge", "replace")


def _by_length_then_text(a, b):
    # numeric order for tag ids (non-negative integers), total order for any text
    return (
        F.when(F.length(a) < F.length(b), -1)
        .when(F.length(a) > F.length(b), 1)
        .when(a < b, -1)
        .when(a > b, 1)
        .otherwise(0)
    )


def collapse_new_tags(new: DataFrame, key: str = "userId", tags: str = "tagsId") -> DataFrame:
    """One row per user: the set union of the user's lists.

    Blank lists do not count (only blank ones: the first of them stays; only
    nulls: null).  A single distinct list is kept as it is; the tags of several
    are united in the order of the lists (shorter first, then by text), each
    tag once.
    """
    per_user = new.groupBy(F.col(key).cast("string").alias(key)).agg(
        F.collect_set(F.col(tags).cast("string")).alias("__s")
    )
    s = F.col("__s")
    lists = F.array_sort(F.filter(s, lambda x: ~is_blank(x)), _by_length_then_text)
    collapsed = (
        F.when(F.size(lists) == 0, F.get(F.array_sort(s), F.lit(0)))
        .when(F.size(lists) == 1, F.get(lists, F.lit(0)))
        .otherwise(join_tags(F.array_distinct(F.flatten(F.transform(lists, split_tags)))))
    )
    return per_user.select(F.col(key), collapsed.alias(tags))


def merge_tags(new: DataFrame, old: DataFrame, key: str = "userId", tags: str = "tagsId") -> DataFrame:
    """new ⟕ stored on the key, tag lists merged.  Users only in the store are
    not in the result (the upsert keeps them)."""
    n = collapse_new_tags(new, key, tags).alias("n")
    o = old.select(F.col(key).cast("string").alias(key), F.col(tags).alias("__old")).alias("o")
    joined = n.join(o, on=key, how="left")
    return joined.select(F.col(key), merge_tag_strings(F.col(tags), F.col("__old")).alias(tags))


def upsert_tags(
    store: DataFrame,
    new: DataFrame,
    mode: str = "merge",
    key: str = "userId",
    tags: str = "tagsId",
) -> DataFrame:
    """The next store snapshot: every stored key plus every new key.

    ``merge``: a new user's list is merged into the stored one;
    ``replace``: a new user's list replaces the stored one.  A null result
    cell keeps the stored cell.  Rows without a key are not stored.  One
    full outer join, both sides keyed.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    # a store row needs a key: keyless new rows are dropped before the
    # aggregate (they would never match in the join, and a null-key group is
    # a classic hot key), and keyless stored rows are not carried forward
    new = new.where(F.col(key).isNotNull())
    store = store.where(F.col(key).isNotNull())
    n = collapse_new_tags(new, key, tags).select(F.col(key), F.col(tags).alias("__new"), F.lit(True).alias("__in_new"))
    o = store.select(F.col(key).cast("string").alias(key), F.col(tags).cast("string").alias("__old"))
    j = n.join(o, on=key, how="full_outer")
    if mode == "merge":
        cell = F.when(F.col("__in_new"), merge_tag_strings(F.col("__new"), F.col("__old")))
    else:
        cell = F.col("__new")
    return j.select(F.col(key), F.coalesce(cell, F.col("__old")).alias(tags))
