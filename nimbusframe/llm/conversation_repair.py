"""Conversation structure repair: the cheapest edits that make the roles of a
conversation alternate.

The messages of a conversation and the states of the wanted role sequence span
an edit lattice. Dijkstra's search runs on it from both ends, the forward and
the reverse heap meet, and all crossings of the least cost are finished; of the
cheapest edit sequences the one with the least letters in ASCII order is taken.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nimbusframe.llm.common import checkpointed, column

#: Costs of the edits, and what an undeleted truncated message adds (fixed by the task).
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: White space is space and the five ASCII controls; a whole message ends in one of these.
BLANK, ENDS = "[^\\x20\\x09-\\x0D]", "[.!?][\\x20\\x09-\\x0D]*\\z"

# States of the role sequence (s?(ua)+)?: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where an output of role u or a leads from each state (None: not allowed).
ON_U = (USER, USER, None, USER)
ON_A = (None, None, ASSISTANT, None)
#: A message in a byte: its initial in the two low bits, then what must go, then what is truncated.
OTHER, MUST_GO, CUT_OFF = 3, 4, 8
FAR = 1 << 60


def _steps(code: int) -> list[list[tuple[str, int, int]]]:
    """For each state the edits of a message: (letter, cost, next state)."""
    extra = TRUNCATED if code & CUT_OFF else 0
    out = []
    for q in range(4):
        edits = [("D", DELETE, q)]
        if not code & MUST_GO:
            to = (SYSTEM if q == START else None, ON_U[q], ON_A[q], None)[code & 3]
            if to is not None:
                edits.append(("K", extra, to))
            edits += [("R", REROLE + extra, to) for to in (ON_U[q], ON_A[q]) if to is not None]
        out.append(edits)
    return out


_FORWARD = [_steps(c) for c in range(16)]
_BACKWARD = [
    [[(w, p) for p in range(4) for _, w, to in _FORWARD[c][p] if to == q] for q in range(4)] for c in range(16)
]
_INSERTED = [[to for to in (ON_U[q], ON_A[q]) if to is not None] for q in range(4)]
_INSERTED_FROM = [[p for p in range(4) if q in _INSERTED[p]] for q in range(4)]


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """(cost, audit) of a conversation given as a byte for each message.

    Nodes are (messages consumed, state). Both searches settle nodes in order
    of cost; once the two heaps' least costs add up to more than the best
    crossing, every cheapest path has a node that both have reached at its
    final cost. From these crossings the cheapest paths are marked in both
    directions and read letter by letter, the least letter first; equal audits
    may run through several states at once. Takes some 100 bytes a message."""
    n = len(codes)
    size = 4 * (n + 1)
    ahead, back = array("q", [FAR]) * size, array("q", [FAR]) * size
    done_ahead, done_back = bytearray(size), bytearray(size)
    ahead[0] = 0
    heap_a, heap_b = [(0, 0)], []
    for end in (4 * n + START, 4 * n + ASSISTANT):
        back[end] = 0
        heap_b.append((0, end))
    best = min(ahead[x] + back[x] for x in (0, 4 * n, 4 * n + ASSISTANT))
    while heap_a and heap_b and heap_a[0][0] + heap_b[0][0] <= best:
        if heap_a[0][0] <= heap_b[0][0]:
            cost, x = heappop(heap_a)
            if done_ahead[x]:
                continue
            done_ahead[x] = 1
            i, q = x >> 2, x & 3
            reached = [(cost + INSERT, x - q + to) for to in _INSERTED[q]]
            if i < n:
                reached += [(cost + w, x - q + 4 + to) for _, w, to in _FORWARD[codes[i]][q]]
            for c, y in reached:
                if c < ahead[y]:
                    ahead[y] = c
                    heappush(heap_a, (c, y))
                    best = min(best, c + back[y])
        else:
            cost, x = heappop(heap_b)
            if done_back[x]:
                continue
            done_back[x] = 1
            i, q = x >> 2, x & 3
            reached = [(cost + INSERT, x - q + p) for p in _INSERTED_FROM[q]]
            if i:
                reached += [(cost + w, x - q - 4 + p) for w, p in _BACKWARD[codes[i - 1]][q]]
            for c, y in reached:
                if c < back[y]:
                    back[y] = c
                    heappush(heap_b, (c, y))
                    best = min(best, c + ahead[y])
    return best, _least_audit(codes, ahead, back, best)


def _least_audit(codes: bytes, ahead: array, back: array, best: int) -> str:
    n = len(codes)
    a, b = np.frombuffer(ahead, np.int64), np.frombuffer(back, np.int64)
    crossing = np.flatnonzero(a + b == best).tolist()
    # Nodes from which a crossing is reached by cheapest steps of the forward search, and those after one.
    first, last = bytearray(len(ahead)), bytearray(len(ahead))
    stack = []
    for x in crossing:
        first[x] = last[x] = 1
        stack.append(x)
    while stack:
        x = stack.pop()
        i, q = x >> 2, x & 3
        before = [(INSERT, x - q + p) for p in _INSERTED_FROM[q]]
        if i:
            before += [(w, x - q - 4 + p) for w, p in _BACKWARD[codes[i - 1]][q]]
        for w, y in before:
            if not first[y] and ahead[y] + w == ahead[x]:
                first[y] = 1
                stack.append(y)
    at, out = {0}, []
    while True:
        if any(x >> 2 == n and back[x] == 0 for x in at):
            return "".join(out)
        after: dict[str, set[int]] = {}
        for x in at:
            i, q = x >> 2, x & 3
            edits = [("I", INSERT, x - q + to) for to in _INSERTED[q]]
            if i < n:
                edits += [(letter, w, x - q + 4 + to) for letter, w, to in _FORWARD[codes[i]][q]]
            for letter, w, y in edits:
                if (first[y] and ahead[x] + w == ahead[y]) or (last[x] and back[x] == w + back[y]):
                    after.setdefault(letter, set()).add(y)
                    if last[x] and back[x] == w + back[y]:
                        last[y] = 1
        letter = min(after)
        out.append(letter)
        at = after[letter]


def marked(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """``conv, turn, role, text, key, fault``: the messages with a digest of
    their role and text, and the fault that shows in themselves (``blank``,
    ``truncated`` or null). Null roles and texts count as one space."""
    m = conversations.select(
        column(conversations, conv_id).alias("conv"), column(conversations, turn).cast("long").alias("turn"),
        F.coalesce(column(conversations, role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(column(conversations, text).cast("string"), F.lit(" ")).alias("text"),
    )
    key = F.unhex(F.md5(F.concat_ws("\x00", F.length("role").cast("string"), "role", "text")))
    return m.withColumn("key", key).withColumn(
        "fault",
        F.when(~F.col("text").rlike(BLANK), "blank").when(~F.col("text").rlike(ENDS), "truncated"),
    )


def _by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of a partition sorted by conversation, one by one as tuples."""
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def plan_repairs(messages: DataFrame) -> DataFrame:
    """``conv, gaps, blank, duplicate, truncated, illegal, cost, audit`` of
    every conversation of :func:`marked` messages.

    A message travels as its turn, digest and initial. Which one is the first
    of its kind is found by windows over (conversation, digest), so a long
    conversation is spread over tasks for that; then the rows of a conversation
    come sorted into one task, which keeps a byte of each."""
    kind = "conv " + messages.schema["conv"].dataType.simpleString()
    light = messages.select(
        "conv", "turn", "key", F.substring("role", 1, 1).alias("initial"), "fault", F.col("role")
    )
    again = Window.partitionBy("conv", "key").orderBy(F.col("turn").asc_nulls_first())
    light = light.withColumn("n", F.row_number().over(again))
    light = light.withColumn("fault", F.when((F.col("n") > 1) & ~F.col("fault").eqNullSafe("blank"), "duplicate").otherwise(F.col("fault")))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("key"), F.col("n")]
    rows = light.repartition("conv").sortWithinPartitions(*order).select("conv", "turn", "initial", "fault")
    schema = f"{kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"

    def finish(conv, codes, low, high, distinct, counts, illegal):
        cost, audit = cheapest_edits(bytes(codes))
        gaps = 0 if low is None else high - low + 1 - distinct
        return (conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, own, started = [], None, False
        names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
        kinds = None
        for batch in batches:
            kinds = [batch.schema.field("conv").type, *[pa.int64()] * 6, pa.string()]
            for conv, turn, initial, fault in _by_conversation([batch]):
                if not started or conv != own:
                    if started:
                        out.append(finish(own, codes, low, high, distinct, counts, illegal))
                    own, started = conv, True
                    codes, counts = bytearray(), {"blank": 0, "duplicate": 0, "truncated": 0}
                    low = high = last = None
                    distinct = illegal = 0
                if fault:
                    counts[fault] += 1
                if codes and before + initial not in ("su", "ua", "au"):
                    illegal += 1
                before = initial
                if turn is not None:
                    low = turn if low is None else low
                    high = turn
                    distinct += turn != last
                    last = turn
                codes.append(
                    {"s": 0, "u": 1, "a": 2}.get(initial, OTHER)
                    | (MUST_GO if fault in ("blank", "duplicate") else CUT_OFF if fault else 0)
                )
            if len(out) > 1000:
                yield _batch(out, names, kinds)
                out = []
        if started:
            out.append(finish(own, codes, low, high, distinct, counts, illegal))
            yield _batch(out, names, kinds)

    return rows.mapInArrow(solve, schema)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _edited(messages: DataFrame, plans: DataFrame) -> DataFrame:
    """The plan of a conversation and its messages, sorted into one partition
    with the plan in front."""
    m = messages.select("conv", F.lit(1).alias("part"), "turn", "role", "key", "text", F.lit(None).cast("string").alias("audit"))
    p = plans.select(
        "conv", F.lit(0).alias("part"), *(F.lit(None).cast(messages.schema[c].dataType).alias(c) for c in ("turn", "role", "key", "text")),
        "audit",
    )
    order = [F.col("conv"), F.col("part"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("key")]
    return p.unionByName(m).repartition("conv").sortWithinPartitions(*order).select("conv", "part", "turn", "role", "text", "audit")


def _outputs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv, edit, turn, role, text) of every output message, streamed; the
    start of a conversation is (conv, None, None, None, None)."""
    names = ("user", "assistant")
    audit, at, tail, written, odd, own = "", 0, 0, 0, 0, None

    def inserted() -> Iterator[tuple]:
        nonlocal at, written
        while at < len(audit) and audit[at] == "I":
            yield own, "I", None, names[(written - odd) % 2], ""
            at, written = at + 1, written + 1

    for conv, part, turn, role, text, plan in _by_conversation(batches):
        if part == 0:
            audit, at, written, own = plan, 0, 0, conv
            odd, tail = (len(audit) - audit.count("D")) % 2, len(audit.rstrip("I"))
            yield conv, None, None, None, None
            continue
        yield from inserted()
        edit = audit[at]
        at += 1
        if edit != "D":
            yield conv, edit, turn, role if edit == "K" else names[(written - odd) % 2], text
            written += 1
        if at == tail:  # that was the last message
            yield from inserted()


def repaired(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(plans, messages): what is wrong with every conversation and the edits
    that mend it, and the messages after them.

    ``plans`` is ``conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit``; ``messages`` is ``conv_id, place`` (from 0)``, edit`` (K, R or I)``,
    turn, role, text``, where inserted messages have no turn and an empty text.

    Messages are taken by turn (nulls first), role and digest of the text, so
    repeated rows and equal turns have a fixed order. Null roles and texts count
    as one space; a null ``conv_id`` is a conversation of its own; texts of any
    length pass whole; an empty table gives empty tables; other columns do not
    matter. A conversation's messages meet in one task, as their order counts,
    but stream through it: texts are not held, and planning keeps some 100 bytes
    a message while it solves a conversation."""
    m = marked(conversations, conv_id, turn, role, text)
    plans = checkpointed(plan_repairs(m))
    kind = m.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _texts_out(batches)

    done = _edited(m, plans).mapInArrow(run, f"conv {kind}, place long, edit string, turn long, role string, text string")
    return plans.withColumnRenamed("conv", conv_id), done.withColumnRenamed("conv", conv_id)


def _texts_out(batches: Iterator[pa.RecordBatch], limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    rows, held, place, kind = [], 0, 0, None
    names = ["conv", "place", "edit", "turn", "role", "text"]

    def seen() -> Iterator[pa.RecordBatch]:
        nonlocal kind
        for b in batches:
            kind = b.schema.field("conv").type
            yield b

    for conv, edit, turn, role, text in _outputs(seen()):
        if edit is None:
            place = 0
            continue
        rows.append((conv, place, edit, turn, role, text))
        place, held = place + 1, held + len(text) + 50
        if held > limit:
            yield _batch(rows, names, [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()])
            rows, held = [], 0
    if rows:
        yield _batch(rows, names, [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()])


def digests(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """The plans of :func:`repaired` with ``repaired_sha256``: the hex digest of
    the repaired messages as ``role:text`` lines joined by newlines, fed to the
    hash one by one."""
    m = marked(conversations, conv_id, turn, role, text)
    plans = checkpointed(plan_repairs(m))
    kind = m.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, own, total, first, types = [], None, None, True, None

        def seen() -> Iterator[pa.RecordBatch]:
            nonlocal types
            for b in batches:
                types = [b.schema.field("conv").type, pa.string()]
                yield b

        for conv, edit, _, role_, text_ in _outputs(seen()):
            if edit is None:
                if total is not None:
                    rows.append((own, total.hexdigest()))
                own, total, first = conv, hashlib.sha256(), True
                if len(rows) > 5000:
                    yield _batch(rows, ["conv", "repaired_sha256"], types)
                    rows = []
                continue
            total.update((("" if first else "\n") + role_ + ":" + text_).encode("utf-8", "surrogatepass"))
            first = False
        if total is not None:
            rows.append((own, total.hexdigest()))
            yield _batch(rows, ["conv", "repaired_sha256"], types)

    hashed = _edited(m, plans).mapInArrow(run, f"conv {kind}, repaired_sha256 string")
    out = plans.join(hashed.hint("merge"), plans["conv"].eqNullSafe(hashed["conv"])).drop(hashed["conv"])
    return out.withColumnRenamed("conv", conv_id)


def damaged(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """Messages with faults planted by a hash of ``conv_id:turn`` (nulls are one
    space): of twenty, 0 drops the message, 1 empties its text, 2 removes its
    sentence ends, 3 repeats it, 4 makes it the user's. Columns ``conv_id, turn,
    role, text``."""
    c = conversations.select(
        column(conversations, conv_id).alias("conv_id"), column(conversations, turn).alias("turn"),
        F.coalesce(column(conversations, role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(column(conversations, text).cast("string"), F.lit(" ")).alias("text"),
    )
    named = [F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("conv_id", "turn")]
    what = (F.crc32(F.concat_ws(":", *named)) % 20).cast("int")
    c = c.withColumn("what", what).where("what <> 0")
    c = c.withColumn("text", F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    c = c.withColumn("role", F.when(F.col("what") == 4, "user").otherwise(F.col("role")))
    copies = F.when(F.col("what") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return c.withColumn("copy", F.explode(copies)).select("conv_id", "turn", "role", "text")


def with_all(conversations: DataFrame, found: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """``found`` with a row for every conversation of ``conversations``; those
    of which no message is left have zeros, an empty audit and the digest of
    nothing."""
    ids = conversations.select(column(conversations, conv_id).alias("conv")).distinct()
    joined = ids.join(found, ids["conv"].eqNullSafe(found[conv_id]), "left")
    zero = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        F.col("conv").alias(conv_id), *(F.coalesce(c, F.lit(0)).alias(c) for c in zero),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
