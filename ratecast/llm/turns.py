"""Repair of conversation structure by cheapest edits.

A conversation is its rows by turn. Repaired, its role initials read ``(s?(ua)+)?``. Edits: Keep costs 0, Rerole to user or
assistant 2, Delete 3 (blank and duplicate rows can only be deleted), Insert of an empty user or assistant row 2; a truncated row
that stays adds 1. Of the cheapest edit lists the one with the ASCII-least initials (D, I, K, R) is taken.

The edit lattice of n rows has nodes (rows used, state) for the four states of the pattern: nothing yet, after ``s``, after
``u``, after ``a``. From each node an edit initial leads to one other node, so the initials fix the repaired rows. A
bidirectional Dijkstra search runs over it: a forward heap from the start and a reverse heap from the two ends. They go on until
the sum of their least keys is greater than the best meeting, so that every crossing of that cost is known; then the least concatenated
audit is read off by one walk: forward over edges that still reach a crossing, over the least crossing, and on along the reverse search.

1. Damage, faults and a SHA-256 of each text are column expressions; equal rows of a turn are counted (partial sums) before anything is
   sorted, and a first window, by conversation, role and text, tells rows seen earlier.
2. Rows without their texts are dealt by conversation, sorted, and streamed: a task holds a byte a row of the
   conversation it reads (and two int arrays of four cells a row while it searches), however long its texts are.
3. The repaired text is hashed by a second stream: audits and texts sorted by conversation and row. Its rows are never held together.

A digest of the whole conversation, as dealt, is one sequential hash, so one conversation is one task's stream; Spark's sort spills.

Defined results: null role, text, turn and conv_id count as one space (in the damage's key too); a null conv_id is a conversation, returned as
null. Rows of one turn come by role, then by the SHA-256 of the text; null turns first. Any other first letter than s, u, a
(or none) cannot be kept. gaps above 2**63-1 stay there. Repeated input rows are duplicates. An empty
table gives an empty result; further columns are ignored.
"""
from __future__ import annotations

from array import array
from hashlib import sha256
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import scratch_table, trimmed

BLANKS = " \t\n\x0b\x0c\r"
EDITS = "DIKR"                                 # in ASCII order
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
#: Next state after a row of that initial; roles of inserted and new rows follow from the state.
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
FREE = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
FAR = 2**31 - 1
SUMMARY = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


# ---------------------------------------------------------------- one conversation

def edges(q: int, row: str | None):
    """Edits out of state ``q`` when the next row is ``row`` (None: no row left): (initial, rows used, next state, cost).
    ``row`` is ``-`` for a row that must go, else its role initial, in upper case if the row is truncated."""
    if row is not None:
        yield "D", 1, q, DELETE
    yield "I", 0, FREE[q][1], INSERT
    if row is not None and row != "-":
        more = TRUNCATED if row.isupper() else 0
        if (to := STEP.get((q, row.lower()))) is not None:
            yield "K", 1, to, more
        yield "R", 1, FREE[q][1], REROLE + more


def backward(q: int, row: str | None):
    """Edits into state ``q`` over the row before it: (rows used, previous state, cost)."""
    for p in range(4):
        for _, used, to, cost in edges(p, row):
            if to == q and (used or row is None):
                yield used, p, cost
    if row is not None:
        for p in range(4):
            if FREE[p][1] == q:
                yield 0, p, INSERT


def best_edits(rows: str) -> tuple[int, str]:
    """Cost and audit of the cheapest edits of a conversation, by bidirectional Dijkstra search."""
    n = len(rows)
    ahead, back = array("i", [FAR]) * (4 * n + 4), array("i", [FAR]) * (4 * n + 4)   # costs from the start, to an end
    fixed_a, fixed_b = bytearray(4 * n + 4), bytearray(4 * n + 4)
    ahead[START] = 0
    heap_a, heap_b = [(0, 0, START)], []
    for q in ENDS:
        back[4 * n + q] = 0
        heap_b.append((0, 0, q))
    best, settled = FAR, []
    while heap_a and heap_b and heap_a[0][0] + heap_b[0][0] <= best:
        if heap_a[0][0] <= heap_b[0][0]:
            cost, i, q = heappop(heap_a)
            at = 4 * i + q
            if fixed_a[at]:
                continue
            fixed_a[at] = 1
            settled.append(at)
            if back[at] < FAR:
                best = min(best, cost + back[at])
            for _, used, to, w in edges(q, rows[i] if i < n else None):
                v = at + 4 * used + to - q
                if cost + w < ahead[v]:
                    ahead[v] = cost + w
                    heappush(heap_a, (cost + w, i + used, to))
        else:
            cost, left, q = heappop(heap_b)
            i = n - left
            at = 4 * i + q
            if fixed_b[at]:
                continue
            fixed_b[at] = 1
            if ahead[at] < FAR:
                best = min(best, cost + ahead[at])
            for used, p, w in backward(q, rows[i - 1] if i else None):
                v = at - 4 * used + p - q
                if cost + w < back[v]:
                    back[v] = cost + w
                    heappush(heap_b, (cost + w, left + used, p))
    return best, _least_audit(rows, best, ahead, back, fixed_a, fixed_b, settled)


def _least_audit(rows, best, ahead, back, fixed_a, fixed_b, settled) -> str:
    """The least audit over all crossings of cost ``best``."""
    n = len(rows)

    def ways(at):
        i, q = divmod(at, 4)
        for e, used, to, w in edges(q, rows[i] if i < n else None):
            yield e, at + 4 * used + to - q, w

    # forward nodes that reach a crossing over edges of cheapest forward paths
    alive = bytearray(len(ahead))
    for at in reversed(settled):
        cost = ahead[at]
        alive[at] = (fixed_b[at] or at >= 4 * n) and cost + back[at] == best or any(
            fixed_b[v] and cost + w + back[v] == best or alive[v] and cost + w == ahead[v] for _, v, w in ways(at))
    audit, at, cost = [], START, 0
    while not (at >= 4 * n and at - 4 * n in ENDS and cost == best):
        for e, v, w in ways(at):
            if fixed_b[v] and cost + w + back[v] == best or alive[v] and cost + w == ahead[v]:
                audit.append(e)
                at, cost = v, cost + w
                break
        else:
            raise AssertionError("no edit continues the cheapest path")
    return "".join(audit)


# ---------------------------------------------------------------- DataFrames

def _or_space(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) after the damage; dropped rows stay with 0 copies."""
    code = F.crc32(F.concat_ws(":", _or_space("conv_id"), _or_space("turn"))) % 20
    text = (F.when(code == 1, "").when(code == 2, F.regexp_replace(_or_space("text"), "[.!?]", ""))
            .otherwise(_or_space("text")))
    return conversations.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), F.when(code == 4, "user").otherwise(_or_space("role")).alias("role"),
        text.alias("text"), F.when(code == 0, 0).when(code == 3, 2).otherwise(1).cast("bigint").alias("copies"))


def _coded(rows: DataFrame) -> DataFrame:
    """One row for the equal rows of a turn: (conv_id, turn, role, digest, mark, copies, again)."""
    last = F.right(F.rtrim(F.col("text"), F.lit(BLANKS)), F.lit(1))
    gone = F.col("copies") == 0
    mark = F.when(gone, "").when(last == "", "b").when(last.isin(".", "!", "?"), "k").otherwise("t")
    digest = F.when(~gone, F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)))
    one = (rows.select("conv_id", F.when(~gone, F.col("turn")).alias("turn"), F.when(~gone, F.col("role")).alias("role"),
                       digest.alias("digest"), mark.alias("mark"), "copies")
           .groupBy("conv_id", "turn", "role", "digest", "mark").agg(F.sum("copies").alias("copies")))
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "digest").orderBy(F.col("turn").asc_nulls_first()))
    return one.withColumn("again", seen > 1)


class _Reading:
    """What is kept of a conversation while its rows stream by."""

    def __init__(self):
        self.rows, self.last, self.turns = bytearray(), None, 0
        self.low = self.high = None
        self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn, role, mark, copies, again):
        if not copies:
            return
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        initial = role[:1]
        self.illegal += (self.last is not None and self.last + initial not in ("su", "ua", "au")) + (
            (copies - 1) * (initial + initial not in ("su", "ua", "au")))
        self.last = initial
        if mark == "b":
            self.blank += copies
        else:
            self.duplicate += copies - (not again)
            self.truncated += mark == "t" and not again
        code = initial if initial in ("s", "u", "a") else "x"
        if mark != "b" and not again:
            self.rows += (code.upper() if mark == "t" else code).encode()
            copies -= 1
        self.rows += b"-" * copies

    def result(self):
        cost, audit = best_edits(self.rows.decode())
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, 2**63 - 1)
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def _runs(batches, cols):
    """Rows of record batches as tuples of ``cols``, one batch's values at a time."""
    for b in batches:
        yield from zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in cols))


def _by_conversation(df: DataFrame, *order) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *order)


def _batched(rows, schema: pa.Schema, size: int = 1000, volume: int = 1 << 22):
    """Record batches of at most ``size`` rows, and of some ``volume`` bytes of strings."""
    kept, held = [], 0
    for r in rows:
        kept.append(r)
        held += sum(len(v) for v in r if isinstance(v, str))
        if len(kept) >= size or held >= volume:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept), schema)], schema=schema)
            kept, held = [], 0
    if kept:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept), schema)], schema=schema)


def audits(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit), a row for each original conversation."""
    kind = conversations.schema["conv_id"].dataType
    schema = pa.schema([("conv_id", to_arrow_type(kind)), *((c, pa.int64()) for c in SUMMARY), ("audit", pa.string())])

    def repaired(batches):
        conv, at = None, None
        for c, turn, role, mark, copies, again in _runs(batches, ("conv_id", "turn", "role", "mark", "copies", "again")):
            if at is None or c != conv:
                if at is not None:
                    yield (conv, *at.result())
                conv, at = c, _Reading()
            at.add(turn, role, mark, copies, again)
        if at is not None:
            yield (conv, *at.result())

    coded = _by_conversation(_coded(damaged(conversations)), F.col("turn").asc_nulls_first(), "role", "digest", "mark")
    return coded.mapInArrow(trimmed(lambda batches: _batched(repaired(batches), schema)),
                            ", ".join([f"conv_id {kind.simpleString()}", *(f"{c} bigint" for c in SUMMARY), "audit string"]))


def repaired_rows(audit: str, rows):
    """(role, text) of the repaired conversation; ``rows`` gives (role, text) of the damaged one in order."""
    q, rows = START, iter(rows)
    for e in audit:
        role, text = ("", "") if e == "I" else next(rows)
        if e == "D":
            continue
        role = role if e == "K" else FREE[q][0]
        q = STEP[q, role[:1]]
        yield role, text


def repair(conversations: DataFrame) -> DataFrame:
    """One row for each original conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    found = scratch_table(audits(conversations), "audits")
    kind = found.schema["conv_id"].dataType
    heads = found.select("conv_id", F.struct(*SUMMARY, "audit").alias("head"),
                         *(F.lit(None).cast(t).alias(c) for c, t in (("turn", "bigint"), ("role", "string"), ("text", "string"))),
                         F.lit(0).cast("bigint").alias("copies"))
    rows = damaged(conversations).filter("copies > 0")
    both = heads.unionByName(rows.withColumn("head", F.lit(None).cast(heads.schema["head"].dataType)))
    order = (F.col("head").isNull(), F.col("turn").asc_nulls_first(), "role", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)))
    schema = pa.schema([("conv_id", to_arrow_type(kind)), *((c, pa.int64()) for c in SUMMARY), ("audit", pa.string()),
                        ("repaired_sha256", pa.string())])

    def hashed(batches):
        stream = _runs(batches, ("conv_id", "head", "role", "text", "copies"))
        nxt = next(stream, None)
        while nxt is not None:
            conv, head = nxt[:2]

            def own():
                """The rows of this conversation; leaves the next one's head in ``nxt``."""
                nonlocal nxt
                while (nxt := next(stream, None)) is not None and nxt[1] is None:
                    for _ in range(nxt[4]):
                        yield nxt[2], nxt[3]

            digest, first, left = sha256(), True, own()
            for role, text in repaired_rows(head["audit"], left):
                digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
            for _ in left:                      # no row is left unless its edits end the audit; moves on to the next head
                raise AssertionError("a row without an edit")
            yield (conv, *(head[c] for c in SUMMARY), head["audit"], digest.hexdigest())

    out = ", ".join([f"conv_id {kind.simpleString()}", *(f"{c} bigint" for c in SUMMARY), "audit string", "repaired_sha256 string"])
    return _by_conversation(both, *order).mapInArrow(trimmed(lambda batches: _batched(hashed(batches), schema)), out)
