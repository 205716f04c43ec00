"""Broadcast only behind a measured size bound.

Rule frames (level-5 children of one tag) are tiny, but they come from a
taxonomy table that users own, so the size is measured, not assumed: one
small aggregate over the frame gives its exact row count and the bytes of
its string columns.  Above the bound the caller takes the shuffle path.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Defaults: a side is broadcast only when both hold.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class SideSize:
    rows: int
    bytes: int
    invalid: int = 0
    extra: dict | None = None

    def fits(self, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
        return self.rows <= max_rows and self.bytes <= max_bytes


def measure(
    df: DataFrame, invalid: Column | None = None, extra: dict | None = None, columns: list[str] | None = None
) -> SideSize:
    """Exact row count and an upper bound on the in-memory bytes of ``df`` (or of ``columns`` of it).

    ``invalid``: optional boolean Column; rows where it holds are counted in
    the same pass (used to validate parsed rules without a second job).
    ``extra``: name -> aggregate Column, computed in the same pass too.
    """
    fixed = 0
    var_cols = []
    for f in df.schema.fields:
        if columns is not None and f.name not in columns:
            continue
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            var_cols.append(F.coalesce(F.length(F.col(f.name)), F.lit(0)).cast("bigint"))
            fixed += 8
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            # the text form holds every element; 8 bytes of offset per character bound the rest
            var_cols.append(F.lit(2) * F.coalesce(F.length(F.to_json(F.struct(F.col(f.name)))), F.lit(0)).cast("bigint"))
            fixed += 8
        else:
            fixed += 8  # numeric, date and timestamp columns: at most 8 bytes
    aggs = [F.count(F.lit(1)).alias("n")]
    if invalid is not None:
        aggs.append(F.count_if(invalid).alias("bad"))
    for name, agg in (extra or {}).items():
        aggs.append(agg.alias(f"x_{name}"))
    if var_cols:
        total = var_cols[0]
        for c in var_cols[1:]:
            total = total + c
        aggs.append(F.sum(total).alias("v"))
    row = df.agg(*aggs).first()
    n = int(row["n"] or 0)
    v = int(row["v"] or 0) if var_cols else 0
    # strings are UTF-8 in Tungsten; length() counts chars, so allow 4 bytes each
    bad = int(row["bad"] or 0) if invalid is not None else 0
    ext = {name: row[f"x_{name}"] for name in (extra or {})}
    return SideSize(rows=n, bytes=n * (fixed + 16) + 4 * v, invalid=bad, extra=ext)


def maybe_broadcast(
    df: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> tuple[DataFrame, bool]:
    """``(broadcast(df), True)`` when the measured size fits, else ``(df, False)``."""
    size = measure(df)
    if size.fits(max_rows, max_bytes):
        return F.broadcast(df), True
    return df, False
