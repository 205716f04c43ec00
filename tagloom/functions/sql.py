"""The tag-list and lookup functions as SQL functions, for ``spark.sql`` users.

Registered as SQL-bodied temporary functions: the analyzer inlines their
bodies into the plan, so they stay native expressions (whole-stage codegen,
no Python workers) — the SQL-text counterpart of the Column functions in
``tagloom.functions.tags``.

``tag_of(pid, value)`` looks a value up among the level-5 rules of a
level-4 tag: its body is a correlated scalar subquery over the registered
taxonomy view, which Catalyst rewrites into a left outer join with the
rules aggregated to one row per rule text (highest id wins).  AQE then
broadcasts the small rule side.  The DataFrame path
(``operators.match.exact_match``) measures the rule side before planning
and so never shuffles the source; prefer it for the largest sources.  A value
without a rule is null; ``tag_required(pid, value)`` raises instead, as the
DataFrame path does by default.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TAXONOMY_VIEW = "tagloom_taxonomy"

_FUNCTIONS = [
    """CREATE OR REPLACE TEMPORARY FUNCTION tag_is_blank(s STRING) RETURNS BOOLEAN
       RETURN s IS NULL OR s RLIKE '^\\\\p{javaWhitespace}*$'""",
    """CREATE OR REPLACE TEMPORARY FUNCTION tag_split(s STRING) RETURNS ARRAY<STRING>
       RETURN CASE WHEN s IS NULL THEN NULL
                   WHEN s = '' THEN array('')
                   WHEN regexp_replace(s, ',+$', '') = '' THEN CAST(array() AS ARRAY<STRING>)
                   ELSE split(regexp_replace(s, ',+$', ''), ',', -1) END""",
    """CREATE OR REPLACE TEMPORARY FUNCTION tag_merge(new_tags STRING, old_tags STRING) RETURNS STRING
       RETURN CASE WHEN tag_is_blank(new_tags) THEN old_tags
                   WHEN tag_is_blank(old_tags) THEN new_tags
                   ELSE array_join(array_distinct(concat(tag_split(new_tags), tag_split(old_tags))), ',') END""",
    """CREATE OR REPLACE TEMPORARY FUNCTION tag_canonical(s STRING) RETURNS STRING
       RETURN CASE WHEN tag_is_blank(s) THEN NULL
                   ELSE array_join(CAST(array_sort(array_distinct(filter(transform(
                        split(s, ',', -1), x -> try_cast(trim(x) AS BIGINT)), x -> x IS NOT NULL))) AS ARRAY<STRING>), ',') END""",
]

_LOOKUP = f"""CREATE OR REPLACE TEMPORARY FUNCTION tag_of(p BIGINT, v STRING) RETURNS BIGINT
    RETURN (SELECT max(t.id) FROM {TAXONOMY_VIEW} t WHERE t.pid = p AND t.rule = v)"""


_REQUIRED = """CREATE OR REPLACE TEMPORARY FUNCTION tag_required(p BIGINT, v STRING) RETURNS BIGINT
    RETURN coalesce(tag_of(p, v), CAST(raise_error(concat('no rule matches value ', coalesce(v, 'null'))) AS BIGINT))"""


def register_sql_functions(spark: SparkSession, taxonomy: DataFrame | None = None) -> None:
    """Register the tag functions; with a taxonomy also ``tag_of`` over it."""
    for ddl in _FUNCTIONS:
        spark.sql(ddl)
    if taxonomy is not None:
        taxonomy.select("id", "rule", "pid", "level").createOrReplaceTempView(TAXONOMY_VIEW)
        spark.sql(_LOOKUP)
        spark.sql(_REQUIRED)
