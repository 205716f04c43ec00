"""Relational operators: matching, merge/upsert, aggregates, taxonomy, ids, clustering."""

from tagloom.operators.aggregate import explode_tags, last_per_key, rfe_measures, tag_coverage
from tagloom.operators.broadcast import maybe_broadcast, measure
from tagloom.operators.ids import assign_dense_ids
from tagloom.operators.match import exact_match, exact_rules, range_match
from tagloom.operators.merge import collapse_new_tags, merge_tags, upsert_tags
from tagloom.operators.taxonomy import (
    by_level, children, find, level4_meta, load_paths, rule_options, tag_by_id, tags_with_models,
)

__all__ = [
    "assign_dense_ids", "by_level", "children", "collapse_new_tags", "exact_match", "exact_rules",
    "explode_tags", "find", "last_per_key", "level4_meta", "load_paths", "maybe_broadcast", "measure",
    "merge_tags", "range_match", "rfe_measures", "rule_options", "tag_by_id", "tag_coverage",
    "tags_with_models", "upsert_tags",
]
