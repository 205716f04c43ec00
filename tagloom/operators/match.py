"""Rule matching: exact value -> tag, and value within an inclusive range -> tag.

Both are joins of a large source (one row per user or event) with a small
rule frame.  The rule frame is broadcast after its size is measured, so the
large side is never shuffled and a hot value (say half of all users share
one gender code) costs nothing extra.  Above the size bound the rule frame is
shuffled instead (AQE splits skewed partitions).  A range match is an
equi-join on aligned intervals for any rules, never a nested loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.operators.broadcast import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, measure

UNMATCHED_POLICIES = ("error", "null", "drop")


def exact_rules(rules: DataFrame, id_col: str = "id", rule_col: str = "rule") -> DataFrame:
    """``(rule, tagsId)`` with one row per rule text; on repeated text the highest id wins."""
    return (
        rules.where(F.col(rule_col).isNotNull())
        .groupBy(F.col(rule_col).alias("__rule"))
        .agg(F.max(F.col(id_col).cast("bigint")).alias("__tag"))
    )


def exact_match(
    source: DataFrame,
    rules: DataFrame,
    value_col: str,
    key_col: str,
    on_unmatched: str = "error",
    id_col: str = "id",
    rule_col: str = "rule",
    out_key: str = "userId",
    out_tag: str = "tagsId",
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Tag each source row whose ``value_col`` equals a rule's text.

    Output ``(out_key string, out_tag string)``, one row per source row.
    ``on_unmatched``: ``"error"`` raises on a value with no rule (or a null
    value), ``"null"`` keeps the row with a null tag, ``"drop"`` drops it.
    """
    if on_unmatched not in UNMATCHED_POLICIES:
        raise ValueError(f"on_unmatched must be one of {UNMATCHED_POLICIES}")
    dedup = exact_rules(rules, id_col, rule_col)
    # the raw rule frame bounds the de-duplicated one, and measuring it needs
    # no shuffle
    raw = rules.select(F.col(id_col).cast("bigint"), F.col(rule_col).cast("string")).where(F.col(rule_col).isNotNull())
    small = measure(raw).fits(max_broadcast_rows, max_broadcast_bytes)
    side = F.broadcast(dedup) if small else dedup
    src = source.select(
        F.col(key_col).cast("string").alias("__key"), F.col(value_col).cast("string").alias("__val")
    )
    how = "inner" if on_unmatched == "drop" else "left"
    joined = src.join(side, src["__val"] == side["__rule"], how)
    tag: Column = joined["__tag"].cast("string")
    if on_unmatched == "error":
        tag = F.when(
            joined["__tag"].isNull(),
            F.raise_error(
                F.concat(F.lit("no rule matches value '"), F.coalesce(joined["__val"], F.lit("null")),
                         F.lit("' of key "), F.coalesce(joined["__key"], F.lit("null")))
            ),
        ).otherwise(tag).cast("string")
    return joined.select(joined["__key"].alias(out_key), tag.alias(out_tag))


TOP_LEVEL = 62  # intervals of 2^62 values: four of them hold every 64-bit number


def dyadic_pieces(start: str, end: str) -> Column:
    """The aligned intervals that make up ``[start, end]``, as structs (level, index).

    Interval (k, i) holds the values from i·2^k to (i+1)·2^k - 1.  At most two
    of each level are needed, so a range of length n has about 2·log2(n), they
    do not overlap, and a value lies in the range if and only if one of them is
    its own interval of that level.  Bounds are bigint; null or inverted bounds
    have no pieces.
    """
    mask = "(shiftleft(1L, k) - 1)"
    # first and last index of the whole intervals of level k inside the range
    first = f"shiftright({start}, k) + if(({start} & {mask}) != 0, 1, 0)"
    last = f"shiftright({end}, k) - if(({end} & {mask}) = {mask}, 0, 1)"
    levels = f"least({TOP_LEVEL}, coalesce(length(bin(try_subtract({end}, {start}))), {TOP_LEVEL}))"  # none is longer
    spans = f"transform(sequence(0, {levels}), k -> named_struct('k', k, 'l', {first}, 'r', {last}))"
    # an odd first one has no parent inside the range, nor has an even last one
    inner = (
        "array_compact(array("
        "if((x.l & 1L) = 1, named_struct('k', x.k, 'i', x.l), null), if((x.r & 1L) = 0, named_struct('k', x.k, 'i', x.r), null)))"
    )
    top = "transform(sequence(x.l, x.r), i -> named_struct('k', x.k, 'i', i))"
    pieces = f"transform(filter({spans}, x -> x.l <= x.r), x -> if(x.k < {TOP_LEVEL}, {inner}, {top}))"
    return F.expr(f"if({start} <= {end}, flatten({pieces}), array())")


def range_match(
    values: DataFrame,
    rules: DataFrame,
    value_col: str,
    start_col: str = "start",
    end_col: str = "end",
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    require_bounds: bool = True,
) -> DataFrame:
    """Inner range join: every (value row, rule) with ``start <= value <= end``.

    Overlapping rules give several rows; a value in no rule (or null) gives
    none, nor does a rule whose start is after its end.  Output: all
    ``values`` columns, then all ``rules`` columns.  ``require_bounds``: a rule
    with a null bound (a malformed rule text) is an error, found in the same
    pass that measures the rule frame.

    One plan for every number, width and overlap of rules: a rule is cut into
    aligned intervals (``dyadic_pieces``), and a value looks up the interval
    that holds it on each level that the rules use, by a hash join.  Whole
    numbers meet exactly the rules that hold them, once each, whatever mix of
    widths the rules have; a value is looked up at most 63 times.  (Fractions
    are looked up by their floor and compared.)  The cut rules are broadcast
    when their measured bound fits; otherwise both sides are shuffled on the
    interval, where AQE splits one that holds a third of all values.
    """
    start, end = F.col(start_col), F.col(end_col)
    invalid = (start.isNull() | end.isNull()) if require_bounds else None
    cut = rules.withColumns({"__s": F.floor(start).cast("bigint"), "__e": F.floor(end).cast("bigint")})
    cut = cut.withColumn("__p", dyadic_pieces("__s", "__e")).drop("__s", "__e")
    levels = F.expr("bit_or(aggregate(__p, 0L, (a, x) -> a | shiftleft(1L, x.k)))")
    extra = {"levels": levels, "pieces": F.sum(F.size("__p")), "most": F.max(F.size("__p"))}
    size = measure(cut, invalid, extra=extra, columns=rules.columns)
    if size.invalid:
        raise ValueError(f"{size.invalid} malformed range rule(s) (expected 'start-end')")
    mask = size.extra["levels"] or 0
    used = [k for k in range(TOP_LEVEL + 1) if mask >> k & 1]

    side = cut.select(*rules.columns, F.explode("__p").alias("__p")).select(
        *rules.columns, F.col("__p.k").alias("__k"), F.col("__p.i").alias("__i")
    )
    pieces, most = size.extra["pieces"] or 0, size.extra["most"] or 0
    if pieces <= max_broadcast_rows and most * (size.bytes + 12 * size.rows) <= max_broadcast_bytes:
        side = F.broadcast(side)
    # the interval of each used level that holds the value
    probes = F.array(*[F.struct(F.lit(k).alias("k"), F.shiftright(F.floor(F.col(value_col)).cast("bigint"), k).alias("i")) for k in used])
    none = F.array().cast("array<struct<k:int,i:bigint>>")
    valued = values.withColumn("__v", F.explode(probes if used else none))
    met = (valued["__v.k"] == side["__k"]) & (valued["__v.i"] == side["__i"])
    joined = valued.join(side, met & F.col(value_col).between(side[start_col], side[end_col]), "inner")
    return joined.drop("__v", "__k", "__i")
