"""Parsing of taxonomy rule strings.

Level-4 rule: ``k=v##k=v…`` -> map.  Per ``##`` part only fields 0 and 1 of
its ``=`` split count (``a=b=c`` gives ``a -> b``); a part with no value
(``a``, ``a=``) is an error; on a repeated key the last one wins.

Level-5 range rule: ``"start-end"``, both ends inclusive integers; fields 0
and 1 of the ``-`` split, each must be a plain (optionally signed) integer.

Everything is a Column expression evaluated row-locally, so a taxonomy of
any size parses without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.strings import _c, java_split

# Option keys a level-4 rule may carry.
RULE_KEYS = ("inType", "zkHosts", "zkPort", "hbaseTable", "family", "selectFields", "rowKey")

_INT_PATTERN = r"^[+-]?[0-9]+$"


def rule_entries(rule: Column | str) -> Column:
    """``array<struct<key,value>>`` of a level-4 rule, repeats resolved (last wins)."""
    parts = java_split(_c(rule), "##")

    def to_entry(part: Column) -> Column:
        kv = java_split(part, "=")
        value = F.when(
            F.size(kv) < 2,
            F.raise_error(F.concat(F.lit("malformed rule part (no value): "), part)),
        ).otherwise(kv.getItem(1))
        return F.struct(kv.getItem(0).alias("key"), value.cast("string").alias("value"))

    entries = F.transform(parts, to_entry)
    # last wins: fold left, each entry replacing an earlier one with its key
    # (``entries`` is evaluated once; the fold only touches the accumulator)
    empty = F.array().cast("array<struct<key:string,value:string>>")
    return F.aggregate(
        entries,
        empty,
        lambda acc, e: F.concat(F.filter(acc, lambda x: x["key"] != e["key"]), F.array(e)),
    )


def rule_to_map(rule: Column | str) -> Column:
    """``map<string,string>`` of a level-4 rule string."""
    return F.map_from_entries(rule_entries(rule))


def strict_int(s: Column) -> Column:
    """String -> int as a strict integer parser reads it; anything else -> null.

    Rejects what Spark's own cast would trim and accept (``"1 "``).
    """
    return F.when(s.rlike(_INT_PATTERN), s.try_cast("int"))


def range_bounds(rule: Column | str) -> tuple[Column, Column]:
    """(start, end) int Columns of a ``"start-end"`` range rule; null when malformed.

    Fields 0 and 1 of the ``-`` split: the text before the first ``-`` and
    the text between the first and the second.  ``"1-"``, ``"-5-10"`` and
    ``"1--2"`` have an empty field and are malformed.
    """
    r = _c(rule)
    has_sep = r.contains("-")
    start = F.when(has_sep, F.regexp_extract(r, r"^([^-]*)-", 1))
    end = F.when(has_sep, F.regexp_extract(r, r"^[^-]*-([^-]*)", 1))
    return strict_int(start), strict_int(end)


def range_rules(children: DataFrame, id_col: str = "id", rule_col: str = "rule", validate: bool = True) -> DataFrame:
    """Level-5 range children -> ``(tagsId long, start int, end int)``.

    A malformed rule is an error.  The check is an eager action on the (small)
    rule frame rather than a ``raise_error`` inside the plan: Catalyst may
    evaluate a pushed-down copy of an expression on rows a later filter would
    have removed, so an in-plan raise could fire on other tags' rules.
    """
    start, end = range_bounds(rule_col)
    parsed = children.select(
        F.col(id_col).cast("bigint").alias("tagsId"),
        start.alias("start"),
        end.alias("end"),
        F.col(rule_col).alias("__rule"),
    )
    if validate:
        bad = parsed.where(F.col("start").isNull() | F.col("end").isNull()).select("__rule").limit(1).collect()
        if bad:
            raise ValueError(f"malformed range rule: {bad[0][0]!r} (expected 'start-end')")
    return parsed.drop("__rule")


@dataclass(frozen=True)
class SourceMeta:
    """Options of a level-4 rule; absent keys are ''."""

    inType: str = ""
    zkHosts: str = ""
    zkPort: str = ""
    hbaseTable: str = ""
    family: str = ""
    selectFields: str = ""
    rowKey: str = ""
    extra: dict = field(default_factory=dict)

    @classmethod
    def from_map(cls, m: dict | None) -> "SourceMeta":
        m = dict(m or {})
        known = {k: m.pop(k, "") or "" for k in RULE_KEYS}
        return cls(**known, extra=m)

    def option(self, key: str, default: str = "") -> str:
        if key in RULE_KEYS:
            return getattr(self, key) or default
        return self.extra.get(key, default)

    @property
    def fields(self) -> list[str]:
        """The comma list of field names (trailing empties dropped, no trim)."""
        names = self.selectFields.split(",")
        while names and names[-1] == "":
            names.pop()
        return names
