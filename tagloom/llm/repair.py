"""Repair of conversation structure by iterative-deepening A*.

A conversation's turns, in order, are edited until their roles read as an
optional system turn and then user and assistant in turn.  A turn is kept (K),
given another role (R), or deleted (D), and empty turns are inserted (I).
Blank and repeated turns must go; a truncated turn that stays costs extra.  The
cheapest edits are taken, of equal ones those whose letters are least in ASCII.

The search is depth first in the order D, I, K, R under a cost bound that
starts at an admissible floor and rises to what the failed search has proved;
failed states are remembered with the cost proved for them, across bounds.  A
path found first under the least bound is the answer.  A conversation is
searched in blocks of 64 turns from its end: the proved costs at the head of a
block end the search of the block before it.  So work and memory grow with a
conversation's turns, at about three bytes a turn.

How it runs: faults come from row-local expressions and, for repeats, from an
aggregate on (conversation, digest of role and text) that is joined back with
a salt.  Narrow rows (no texts) are sorted by conversation and stream through
the search, which holds one byte a turn.  Texts are shuffled once, to meet
their conversation's edits, and stream through as well: no conversation is
collected, though one conversation's turns pass through one task in order.

Defined cases: a null role or text is one space; turns are taken by ``turn``,
nulls first, then by role and text (its first 64 characters, then its digest);
a null conversation id is a conversation of its own, as is every other value;
a role is read by its first character, and an empty role fits nowhere; an
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.common import OWN, arrow_schema, give_back, to_batch, with_package

KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3  # costs of the edits
TRUNCATED = 3  # of a truncated turn that stays
BLOCK = 64
SALTS = 16
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
NEVER = 1 << 60

# fixed values: role initials and faults, coded as 4 * initial + fault
INITIALS = "sua"
SOUND, CUT, BLANK, REPEATED = 0, 1, 2, 3

# states of a repaired conversation: nothing yet, after system, after user, after assistant
NEXT = ((1, 2, -1, -1), (-1, 2, -1, -1), (-1, -1, 3, -1), (-1, 2, -1, -1))
NEEDS = (2, 2, 3, 2)  # the state after the turn that is due: user, or assistant after user
AT_END = (0, 6, 3, 0)  # cost of the inserts that complete a conversation
TAIL = ("", "II", "I", "")
ROLE = {2: "user", 3: "assistant"}


# --- the search -----------------------------------------------------------------


def _moves(code: int, q: int) -> list[tuple[str, int, int, int]]:
    """(letter, cost, rows used, state) of the edits of a turn in state ``q``, in ASCII order."""
    initial, fault = divmod(code, 4)
    out = [("D", DELETE, 1, q), ("I", INSERT, 0, NEEDS[q])]
    if fault < BLANK:
        extra = TRUNCATED if fault == CUT else 0
        if NEXT[q][initial] >= 0:
            out.append(("K", KEEP + extra, 1, NEXT[q][initial]))
        out.append(("R", REROLE + extra, 1, NEEDS[q]))
    return out


MOVES = [[_moves(code, q) for q in range(4)] for code in range(16)]
FLOOR = [min(m[1] for q in range(4) for m in MOVES[code][q] if m[2]) for code in range(16)]


@lru_cache(maxsize=1 << 16)
def search(codes: bytes, q: int, exits: tuple[int, int, int, int]) -> tuple[int, str, int]:
    """Least cost of a block from state ``q``, its first path in ASCII order, and the state it ends in.

    ``exits`` are the costs that follow the block, by its last state.
    """
    n = len(codes)
    floor = [min(exits)] * (n + 1)
    for i in range(n - 1, -1, -1):
        floor[i] = floor[i + 1] + FLOOR[codes[i]]
    proved: dict[int, int] = {}  # failed states: no completion costs less
    path: list[str] = []

    def least(i: int, q: int) -> int:
        return exits[q] if i == n else proved.get(4 * i + q, floor[i])

    def within(i: int, q: int, left: int) -> int:
        """The last state of the first path that costs at most ``left``, or -1."""
        if i == n:
            return q if exits[q] <= left else -1
        if least(i, q) > left:
            return -1
        best = NEVER
        for letter, cost, rows, to in MOVES[codes[i]][q]:
            if cost + least(i + rows, to) <= left:
                path.append(letter)
                end = within(i + rows, to, left - cost)
                if end >= 0:
                    return end
                path.pop()
            best = min(best, cost + least(i + rows, to))
        proved[4 * i + q] = best
        return -1

    bound = least(0, q)
    while (end := within(0, q, bound)) < 0:
        bound = least(0, q)
    return bound, "".join(path), end


def _block(codes: bytes, q: int, exits: tuple) -> tuple[int, str, int]:
    base = min(exits)  # equal blocks are searched once, whatever follows them
    cost, path, end = search(codes, q, tuple(x - base for x in exits))
    return cost + base, path, end


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """Cost and letters of the cheapest edits of a conversation, given its turns' codes."""
    blocks = [codes[i : i + BLOCK] for i in range(0, len(codes), BLOCK)]
    exits = [AT_END]
    for b in reversed(blocks[1:]):
        exits.append(tuple(_block(b, q, exits[-1])[0] for q in range(4)))
    exits.reverse()
    q, letters, total = 0, [], 0
    for k, b in enumerate(blocks):
        cost, path, q = _block(b, q, exits[k])
        total = total if k else cost
        letters.append(path)
    return total, "".join(letters) + TAIL[q]


def illegal_pairs(codes: bytes) -> int:
    """Neighbours whose role initials are not su, ua or au."""
    legal = {(0, 1), (1, 2), (2, 1)}
    initials = [c // 4 for c in codes]
    return sum(p not in legal for p in zip(initials, initials[1:], strict=False))


# --- faults ---------------------------------------------------------------------


def _initial(role: Column) -> Column:
    at = F.instr(F.lit(INITIALS), F.substring(role, 1, 1))  # an empty string is found at 1
    return F.when((F.length(role) == 0) | (at == 0), F.lit(len(INITIALS))).otherwise(at - 1)


def _last_sign(text: Column) -> Column:
    """The last character that is no white space; empty for a blank text."""
    return F.substring(F.rtrim(text, F.lit(BLANKS)), -1, 1)


def digest(role: Column, text: Column) -> Column:
    """128 bits of SHA-256 of a role and a text."""
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(whole.cast("binary"), 256), 1, 32))


def turns(df: DataFrame) -> DataFrame:
    """Conversation, turn, role and text of a table, nulls replaced, and the number of the repeat."""
    blank = F.lit(" ")
    return df.select(
        F.col("conv_id").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
        F.lit(0).alias("copy"),
        F.lit(True).alias("present"),
    )


def damaged(df: DataFrame) -> DataFrame:
    """``turns(df)`` with planted faults, chosen by a checksum of conversation and turn.

    Dropped turns stay as rows that are not present, so their conversation is known.
    """
    blank = F.lit(" ")
    t = turns(df)
    key = F.concat(F.coalesce(F.col("conv").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    fault = (F.crc32(key.cast("binary")) % 20).cast("int")
    copies = F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    text = F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(fault == 4, F.lit("user")).otherwise(F.col("role"))
    return t.select("conv", "turn", role.alias("role"), text.alias("text"), copies.alias("copy"), (fault != 0).alias("present"))


ORDER = ("turn", "role", "head", "mark", "copy")


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"head": F.substring("text", 1, 64), "mark": digest(F.col("role"), F.col("text"))})


def _in_order(rows: DataFrame, *before: str) -> DataFrame:
    """Rows of a conversation in one task, in order."""
    by = [F.col(c).asc_nulls_first() for c in ("conv", *before, *ORDER)]
    return rows.repartition(F.col("conv")).sortWithinPartitions(*by)


def facts(rows: DataFrame) -> DataFrame:
    """One narrow row per turn: order columns and the code of its role and first fault (null if dropped)."""
    narrow = _keyed(rows).select(
        "conv", *ORDER, "present", _initial(F.col("role")).alias("initial"), _last_sign(F.col("text")).alias("last")
    )
    place = F.struct(*ORDER)
    solid = F.col("present") & (F.col("last") != "")
    again = narrow.filter(solid).groupBy("conv", "mark").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = again.select(
        F.col("conv").alias("r_conv"), F.col("mark").alias("r_mark"), "first",
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("r_salt"),
    )
    salt = F.pmod(F.xxhash64("turn", "copy"), F.lit(SALTS)).cast("int")
    met = narrow.withColumn("salt", salt).join(
        again, F.col("conv").eqNullSafe(F.col("r_conv")) & (F.col("mark") == F.col("r_mark")) & (F.col("salt") == F.col("r_salt")), "left"
    )
    fault = (
        F.when(F.col("last") == "", F.lit(BLANK))
        .when(F.col("first").isNotNull() & (place > F.col("first")), F.lit(REPEATED))
        .when(~F.col("last").isin(".", "!", "?"), F.lit(CUT))
        .otherwise(F.lit(SOUND))
    )
    return met.select("conv", *ORDER, F.when(F.col("present"), 4 * F.col("initial") + fault).cast("int").alias("code"))


# --- reports --------------------------------------------------------------------

REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _wrapped(x: int) -> int:
    """As a 64-bit integer."""
    return (x + (1 << 63)) % (1 << 64) - (1 << 63)


class _Conversation:
    """What one conversation's turns come to, taken one at a time in order."""

    def __init__(self, key):
        self.key = key
        self.codes = bytearray()
        self.low = self.high = None
        self.distinct = 0
        self.before: tuple | None = None

    def add(self, turn: int | None, mark: bytes, code: int | None) -> None:
        if code is None:
            return
        if (turn, mark) == self.before and code % 4 != BLANK:  # equal rows are neighbours and share their place
            code = code - code % 4 + REPEATED
        self.before = turn, mark
        self.codes.append(code)
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.distinct += 1

    def report(self) -> dict:
        codes = bytes(self.codes)
        faults = [c % 4 for c in codes]
        cost, audit = cheapest_edits(codes) if codes else (0, "")
        return {
            "conv": self.key,
            "gaps": 0 if self.low is None else _wrapped(self.high - self.low + 1 - self.distinct),
            "blank": faults.count(BLANK),
            "duplicate": faults.count(REPEATED),
            "truncated": faults.count(CUT),
            "illegal": illegal_pairs(codes),
            "cost": cost,
            "audit": audit,
        }


def _stream(rows: DataFrame, schema: T.StructType, gather) -> DataFrame:
    """Rows in order through ``gather(iterator of row tuples) -> iterator of dicts``."""
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            for b in batches:
                yield from zip(*[c.to_pylist() for c in b.columns], strict=True)

        out: list[dict] = []
        size = 0
        for row in gather(each()):
            out.append(row)
            size += 64 + sum(len(v) for v in row.values() if isinstance(v, str))
            if size > 1 << 22:
                yield to_batch({n: [r[n] for r in out] for n in schema.names}, arrow)
                out, size = [], 0
        if out:
            yield to_batch({n: [r[n] for r in out] for n in schema.names}, arrow)
        give_back()

    return with_package(rows).mapInArrow(run, schema)


def _schema(rows: DataFrame, fields: str) -> T.StructType:
    return T.StructType([T.StructField("conv", rows.schema["conv"].dataType), *T._parse_datatype_string(fields).fields])


def report(rows: DataFrame) -> DataFrame:
    """Per conversation: faults, illegal neighbours, and the cost and letters of the cheapest edits.

    ``rows`` come from ``turns`` (or ``damaged``).
    """

    def gather(stream):
        now = None
        for conv, turn, mark, code in stream:
            if now is None or conv != now.key:
                if now is not None:
                    yield now.report()
                now = _Conversation(conv)
            now.add(turn, mark, code)
        if now is not None:
            yield now.report()

    given = _in_order(facts(rows)).select("conv", "turn", "mark", "code")
    return _stream(given, _schema(rows, REPORT), gather)


def _edited(stream) -> Iterator[tuple]:
    """(conversation, kind, role, text, letter) per repaired turn; kind None opens a conversation.

    The stream holds a conversation's audit first and then its turns in order.
    """
    audit, at, q = "", 0, 0

    def inserted():
        nonlocal at, q
        while at < len(audit) and audit[at] == "I":
            q = NEEDS[q]
            at += 1
            yield (key, "turn", ROLE[q], "", "I")

    key, open_ = None, False
    for conv, edits, turn, role, text in stream:
        if edits is not None:
            if open_:
                yield from inserted()
            key, open_, audit, at, q = conv, True, edits, 0, 0
            yield (key, None, None, None, None)
            continue
        yield from inserted()
        letter = audit[at]
        at += 1
        if letter == "K":
            q = NEXT[q][INITIALS.index(role[0])]
            yield (key, "turn", role, text, "K")
        elif letter == "R":
            q = NEEDS[q]
            yield (key, "turn", ROLE[q], text, "R")
    if open_:
        yield from inserted()


def _with_edits(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """Audits and present turns together: a conversation's audit comes before its turns."""
    kinds = {f.name: f.dataType for f in _keyed(rows).schema}
    audits = reports.select("conv", "audit", *[F.lit(None).cast(kinds[c]).alias(c) for c in (*ORDER, "text")], F.lit(0).alias("kind"))
    given = _keyed(rows).filter("present").select("conv", F.lit(None).cast("string").alias("audit"), *ORDER, "text", F.lit(1).alias("kind"))
    return _in_order(audits.unionByName(given), "kind").select("conv", "audit", "turn", "role", "text")


def repaired_turns(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """The repaired conversations: one row per turn that is in them, with its place and its edit."""

    def gather(stream):
        n = 0
        for conv, kind, role, text, letter in _edited(stream):
            if kind is None:
                n = 0
                continue
            yield {"conv": conv, "place": n, "role": role, "text": text, "edit": letter}
            n += 1

    schema = _schema(rows, "place long, role string, text string, edit string")
    return _stream(_with_edits(rows, reports), schema, gather).withColumnRenamed("conv", "conv_id")


def repaired_digests(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """SHA-256 of every repaired conversation as ``role:text`` lines."""

    def gather(stream):
        conv = h = None
        first = True
        for key, kind, role, text, _ in _edited(stream):
            if kind is None:
                if h is not None:
                    yield {"conv": conv, "repaired_sha256": h.hexdigest()}
                conv, h, first = key, sha256(), True
                continue
            h.update((role + ":" + text if first else "\n" + role + ":" + text).encode("utf-8", "replace"))
            first = False
        if h is not None:
            yield {"conv": conv, "repaired_sha256": h.hexdigest()}

    return _stream(_with_edits(rows, reports), _schema(rows, "repaired_sha256 string"), gather)


def repair_report(rows: DataFrame, staged_as=None) -> DataFrame:
    """``report`` with the digest of each repaired conversation.

    ``staged_as`` writes the reports to the shared folder, for they are read twice.
    """
    reports = report(rows)
    if staged_as is not None:
        reports = staged_as(reports)
    digests = repaired_digests(rows, reports).select(F.col("conv").alias(OWN + "conv"), "repaired_sha256")
    out = reports.join(digests, F.col("conv").eqNullSafe(F.col(OWN + "conv")), "inner")
    return out.select(F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
