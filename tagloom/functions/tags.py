"""Tag-list expressions: split, merge, canonical form (all native Columns).

A stored tag list is a comma-joined string of tag ids (the store's cell
format).  Inside a job it is an ``array<string>``; it is joined back to a
string only at the store boundary.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.functions.strings import _c, is_blank, java_split

TAG_SEP = ","


def split_tags(s: Column | str) -> Column:
    """Comma list -> array: trailing empties dropped, inner kept, no trim."""
    return java_split(s, TAG_SEP)


def join_tags(arr: Column | str) -> Column:
    return F.array_join(_c(arr), TAG_SEP)


def merge_tag_strings(new: Column | str, old: Column | str) -> Column:
    """Merge a new tag list into a stored one.

    new blank -> the stored list as it is; stored blank -> the new list as
    it is; otherwise the set union of both lists in first-appearance order,
    new tags first.
    """
    new, old = _c(new), _c(old)
    union = F.array_distinct(F.concat(split_tags(new), split_tags(old)))
    return (
        F.when(is_blank(new), old)
        .when(is_blank(old), new)
        .otherwise(join_tags(union))
    )


def canonical_tags(s: Column | str) -> Column:
    """Deterministic form of a tag list: distinct non-empty ids in numeric order.

    Tag ids are taxonomy ids (longs), so the numeric order is well defined;
    ``05`` and `` 5`` are the tag 5 and text that is no number is no tag.  A
    null or blank list stays null.
    """
    s = _c(s)
    return F.when(is_blank(s), F.lit(None).cast("string")).otherwise(
        F.array_join(F.array_sort(tag_ids(s)).cast("array<string>"), TAG_SEP)
    )


def tag_ids(s: Column | str) -> Column:
    """The distinct tag ids of a list as longs; cells that are no number are left out."""
    cells = F.transform(F.split(_c(s), TAG_SEP, -1), lambda x: F.trim(x).try_cast("bigint"))
    return F.array_distinct(F.array_compact(cells))
