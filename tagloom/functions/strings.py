"""String helpers with the split / blank semantics the tagging data relies on.

All are Column expressions (JVM side, inside whole-stage codegen); no UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def drop_trailing_empty(arr: Column) -> Column:
    """Remove the run of empty strings at the end of an array."""
    # 1-based position of the last non-empty element, counted from the end.
    from_end = F.array_position(F.transform(F.reverse(arr), lambda x: x != F.lit("")), True)
    return F.when(from_end == 0, F.array().cast("array<string>")).otherwise(
        F.slice(arr, 1, F.size(arr) - from_end.cast("int") + 1)
    )


def java_split(s: Column | str, pattern: str) -> Column:
    """Split on a regex the way a plain Java ``String.split(regex)`` does.

    Trailing empty fields are dropped (``"a,b,,"`` -> ``[a, b]``, ``","`` ->
    ``[]``); inner and leading empties are kept; the empty string gives
    ``[""]`` because nothing matched.  Spark's own ``split`` keeps the
    trailing empties, hence this wrapper.  Null in -> null out.

    For a one-character separator the trailing run is stripped (``rtrim``
    with that character, no regex) before a single split — cheap on wide
    lines; for longer
    separators the trailing empties are trimmed from the split array, since
    stripping a repeated multi-character separator from the end is not the
    same (``"a###"`` split on ``##`` keeps ``"#"``).
    """
    s = _c(s)
    single = len(pattern) == 1 or (len(pattern) == 2 and pattern[0] == "\\")
    if single:
        stripped = strip_trailing(s, pattern[-1])
        body = F.when(stripped == F.lit(""), F.array().cast("array<string>")).otherwise(
            F.split(stripped, pattern, -1)
        )
    else:
        body = drop_trailing_empty(F.split(s, pattern, -1))
    return F.when(s.isNull(), F.lit(None).cast("array<string>")).when(
        s == F.lit(""), F.array(F.lit(""))
    ).otherwise(body)


def strip_trailing(s: Column, ch: str) -> Column:
    """Remove the run of ``ch`` at the end of ``s`` (no regex: SQL rtrim with a trim set)."""
    return F.call_function("rtrim", F.lit(ch), s)


# Java's definition of white space (Character.isWhitespace), as the blank test uses.
_BLANK_PATTERN = r"^\p{javaWhitespace}*$"


def is_blank(s: Column | str) -> Column:
    """True for null, empty, or only white space (never null itself)."""
    s = _c(s)
    return s.isNull() | s.rlike(_BLANK_PATTERN)
