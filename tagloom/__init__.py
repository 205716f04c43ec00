"""tagloom — user tagging on Spark DataFrames.

A tag taxonomy whose rules are data, wide-row sources read as strings,
tag models (exact match, recency range, age range, activity clusters),
a tag merge and a keyed upsert of the tag store, delimited-text ingest,
and per-tag coverage — every step a DataFrame / SQL expression that
Catalyst plans.
"""

from tagloom.session import checkpoint_root, get_session, scratch_path

__all__ = ["get_session", "checkpoint_root", "scratch_path"]
