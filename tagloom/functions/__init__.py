"""Scalar Column expressions (no UDFs): strings, rules, tag lists, dates."""

from tagloom.functions.dates import (
    age_years,
    as_of_lit,
    epoch_to_date,
    epoch_to_long,
    shifted_days_since,
    timestamp_to_epoch,
)
from tagloom.functions.rules import (
    SourceMeta,
    range_bounds,
    range_rules,
    rule_entries,
    rule_to_map,
    strict_int,
)
from tagloom.functions.strings import drop_trailing_empty, is_blank, java_split
from tagloom.functions.tags import canonical_tags, join_tags, merge_tag_strings, split_tags

__all__ = [
    "SourceMeta", "age_years", "as_of_lit", "canonical_tags", "drop_trailing_empty",
    "epoch_to_date", "epoch_to_long", "is_blank", "java_split", "join_tags",
    "merge_tag_strings", "range_bounds", "range_rules", "rule_entries", "rule_to_map",
    "shifted_days_since", "split_tags", "strict_int", "timestamp_to_epoch",
]
