"""Sources and sinks: taxonomy / model registry, wide-row sources, tag store, extracts."""

from tagloom.sources.extracts import (
    ingest, parse_lines, published_positions, read_extract, sorted_extract, typed_view, write_sorted_by_key,
)
from tagloom.sources.rowsource import register_wide_rows
from tagloom.sources.slices import publish, publish_more, sliced_positions
from tagloom.sources.store import read_store, store_parts, update_store, write_store
from tagloom.sources.taxonomy import conform, models_frame, read_models, read_table, read_taxonomy, taxonomy_frame
from tagloom.sources.widerow import READERS, read_source, select_fields

__all__ = [
    "READERS", "conform", "ingest", "models_frame", "parse_lines", "publish", "publish_more", "published_positions",
    "read_extract", "read_models", "read_source", "read_store", "read_table", "read_taxonomy", "register_wide_rows",
    "select_fields", "sliced_positions", "sorted_extract", "store_parts", "taxonomy_frame", "typed_view", "update_store",
    "write_sorted_by_key", "write_store",
]
