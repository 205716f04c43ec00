"""Taxonomy operations: lookups, level-4 rule, tag ⟕ model, batch path load.

The taxonomy is a self-referencing tree ``(id, name, rule, level, pid,
ctime, utime)``: levels 1–3 classify, a level-4 tag owns one model and a
rule naming its source, level-5 tags are its values.  It is a small
dimension next to user data, but it is still handled as a DataFrame — no
per-tag queries, no driver loops over rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.rules import SourceMeta, rule_to_map
from tagloom.operators.broadcast import maybe_broadcast, measure
from tagloom.operators.ids import assign_dense_ids
from tagloom.session import materialize

ROOT_PID = -1


def tag_by_id(taxonomy: DataFrame, tag_id: int) -> DataFrame:
    return taxonomy.where(F.col("id") == F.lit(tag_id))


def children(taxonomy: DataFrame, pid) -> DataFrame:
    """Tags whose parent is ``pid`` (a value or a Column)."""
    return taxonomy.where(F.col("pid") == (pid if not isinstance(pid, (int,)) else F.lit(pid)))


def by_level(taxonomy: DataFrame, level: int) -> DataFrame:
    return taxonomy.where(F.col("level") == F.lit(level))


def find(taxonomy: DataFrame, name: str, level: int, pid: int) -> DataFrame:
    return taxonomy.where(
        (F.col("name") == F.lit(name)) & (F.col("level") == F.lit(level)) & (F.col("pid") == F.lit(pid))
    )


def level4_meta(taxonomy: DataFrame, tag_id: int) -> SourceMeta:
    """Parse the rule of one level-4 tag into its source options.

    The filter runs before the projection (pushed into the scan); the map is
    built by the Spark expression, and only that one small map comes to the
    driver.  No row -> error.
    """
    row = tag_by_id(taxonomy, tag_id).select(rule_to_map(F.col("rule")).alias("m")).head()
    if row is None:
        raise LookupError(f"no tag with id {tag_id} in the taxonomy")
    if not row["m"]:
        raise ValueError(f"tag {tag_id} has no rule naming its source")
    return SourceMeta.from_map(row["m"])


def rule_options(taxonomy: DataFrame) -> DataFrame:
    """Long form ``(id, key, value)`` of every level-4 rule (repeats resolved)."""
    return by_level(taxonomy, 4).where(F.col("rule").isNotNull()).select(
        F.col("id").cast("bigint").alias("id"), F.explode(rule_to_map(F.col("rule"))).alias("key", "value")
    )


def tags_with_models(taxonomy: DataFrame, models: DataFrame, pid=None) -> DataFrame:
    """Tags (optionally only the children of ``pid``) ⟕ their model; no model -> nulls."""
    tags = taxonomy if pid is None else children(taxonomy, pid)
    m = models.select(
        F.col("tag_id").cast("bigint").alias("tag_id"),
        F.col("id").cast("bigint").alias("model_id"),
        "model_name", "state", "model_main", "sche_time",
    )
    m, _ = maybe_broadcast(m)
    return tags.join(m, tags["id"] == m["tag_id"], "left").drop("tag_id")


def load_paths(taxonomy: DataFrame, paths: DataFrame, cols=("l1", "l2", "l3")) -> DataFrame:
    """Insert-if-absent of many classification paths (levels 1..len(cols)).

    Semantics, level by level: a path's parent id is resolved, names absent
    under that parent at that level get new ids (``max(id)`` + dense rank by
    ``(pid, name)``, continuing across levels), found tags are reused, and
    a null or empty name ends a path.  Returns the whole new taxonomy.

    Plan (no per-level passes):

    1. The distinct paths are resolved against the existing tags — one join
       per level with the small tag frame.
    2. Every missing prefix is a new tag.  Its place in the level-by-level
       ``(pid, name)`` order is fixed by its own row: a new tag's deepest
       existing ancestor at depth ``a`` (the root counts as depth 0) and
       that ancestor's id, then the new names below it.  Parents that
       exist sort before parents that are new (whose ids are all higher),
       and new parents sort by the same key one level up — so the order is
       ``(a descending, anchor id, names below the anchor)``.
    3. Ids run through the levels without a gap, so one distributed ranking
       over ``(level, a descending, anchor id, names below the anchor)`` that
       starts at ``max(id)`` gives all of them; it is the only materialised
       step.  A new tag under a new parent takes its parent's id by one
       self-join on the path.
    """
    depth_n = len(cols)
    names = [F.col(c).cast("string") for c in cols]
    valid = [F.lit(True)]
    for c in names:
        valid.append(valid[-1] & c.isNotNull() & (c != ""))
    distinct_paths = paths.select(
        *[F.when(valid[i + 1], names[i]).alias(cols[i]) for i in range(depth_n)]
    ).distinct()

    raw = taxonomy.select(F.col("id").cast("bigint").alias("id"), "name", "level", F.col("pid").cast("bigint").alias("pid"))
    # one pass: the exact size (a bound for the de-duplicated frame) and max(id)
    size = measure(raw, extra={"top": F.max("id")})
    top = int(size.extra["top"] or 0)
    # one tag per (name, level, pid); should a taxonomy hold repeats, the
    # lowest id is the one found (a lookup must not fan a path out)
    existing = raw.groupBy("name", "level", "pid").agg(F.min("id").alias("id"))
    existing = F.broadcast(existing) if size.fits() else existing
    # e<d>: id of the existing tag for the prefix l1..ld (null if absent);
    # absence is prefix-closed: below a missing tag nothing can exist
    res = distinct_paths
    parent = F.lit(ROOT_PID).cast("bigint")
    for d, c in enumerate(cols, start=1):
        lvl = existing.where(F.col("level") == d).select(
            F.col("id").alias(f"e{d}"), F.col("name").alias(f"__n{d}"), F.col("pid").alias(f"__p{d}")
        )
        res = res.join(lvl, (res[c] == lvl[f"__n{d}"]) & (parent == lvl[f"__p{d}"]), "left").drop(f"__n{d}", f"__p{d}")
        parent = F.col(f"e{d}")

    # one row per new tag: level, its path, anchor depth a and anchor id
    missing = []
    for d in range(1, depth_n + 1):
        e = [F.col(f"e{k}") for k in range(1, d)]
        a = sum((F.when(x.isNotNull(), 1).otherwise(0) for x in e), F.lit(0))
        anchor = F.coalesce(*reversed(e), F.lit(ROOT_PID).cast("bigint")) if e else F.lit(ROOT_PID).cast("bigint")
        tag = F.struct(
            F.lit(d).alias("level"),
            F.array(*[F.col(c) for c in cols[:d]]).alias("path"),
            a.alias("a"),
            anchor.cast("bigint").alias("anchor"),
        )
        missing.append(F.when(F.col(cols[d - 1]).isNotNull() & F.col(f"e{d}").isNull(), tag))
    new = res.select(F.explode(F.array_compact(F.array(*missing))).alias("t")).select("t.*").distinct()
    below = F.slice(F.col("path"), F.col("a") + 1, F.col("level") - F.col("a"))
    keyed = new.withColumn("__na", -F.col("a")).withColumn("__below", below)
    ided = assign_dense_ids(keyed, ["level", "__na", "anchor", "__below"], top).drop("__na", "__below")

    # parent id: the anchor when the parent exists, else the new parent's id
    parents = ided.select(F.col("path").alias("__ppath"), F.col("id").alias("__pnew"))
    child_parent = F.slice(F.col("path"), 1, F.col("level") - 1)
    linked = ided.join(parents, child_parent == F.col("__ppath"), "left")
    pid = F.when(F.col("a") == F.col("level") - 1, F.col("anchor")).otherwise(F.col("__pnew"))
    now = F.current_timestamp()
    added = linked.select(
        F.col("id").cast("bigint").alias("id"),
        F.element_at(F.col("path"), F.col("level")).alias("name"),
        F.lit(None).cast("string").alias("rule"),
        F.col("level").cast("int").alias("level"),
        pid.cast("bigint").alias("pid"),
        now.alias("ctime"),
        now.alias("utime"),
    )
    return taxonomy.unionByName(added.select(*taxonomy.columns))


CLOSURE_DEPTH = 32  # a longer chain of parents is a cycle
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def tree_paths(taxonomy: DataFrame) -> DataFrame:
    """``(id, path, ancestors)`` of every tag below a root: its names from the root down, and the ids
    of itself and all its ancestors, root first.

    A recursive query walks the tree one level at a time, over the taxonomy
    alone; tags whose parents never reach a root are in no path.  Computed
    once and kept in the shared folder.
    """
    spark = taxonomy.sparkSession
    tags = taxonomy.select(F.col("id").cast("bigint").alias("id"), "name", F.col("pid").cast("bigint").alias("pid"))
    old = spark.conf.get(_ROW_LIMIT, None)
    spark.conf.set(_ROW_LIMIT, "-1")  # the tree's size is the bound
    try:
        walked = spark.sql(
            f"""
            WITH RECURSIVE tree(id, path, ancestors, depth) AS (
              SELECT id, array(name), array(id), 1 FROM {{tags}} WHERE pid = {ROOT_PID}
              UNION ALL
              SELECT t.id, array_append(p.path, t.name), array_append(p.ancestors, t.id), p.depth + 1
              FROM tree p JOIN {{tags}} t ON t.pid = p.id WHERE p.depth < {CLOSURE_DEPTH}
            )
            SELECT id, path, ancestors FROM tree
            """,
            tags=tags,
        )
        return materialize(walked)
    finally:
        spark.conf.unset(_ROW_LIMIT) if old is None else spark.conf.set(_ROW_LIMIT, old)


def users_per_category(holders: DataFrame, paths: DataFrame, user: str = "userId", tag: str = "tag") -> DataFrame:
    """``(id, users)``: distinct users of each tag, those of all its descendants included.

    ``holders`` is ``(user, tag)``.  A user counts once per category: pairs are
    made distinct before they are lifted to the ancestors and after, with
    partial aggregates, so a category that everybody is in is no hot key.
    """
    side, _ = maybe_broadcast(paths.select(F.col("id").alias(tag), "ancestors"))
    held = holders.select(F.col(user), F.col(tag).cast("bigint").alias(tag)).distinct().join(side, tag)
    lifted = held.select(user, F.explode("ancestors").alias("id")).distinct()
    return lifted.groupBy("id").agg(F.count(user).alias("users"))
