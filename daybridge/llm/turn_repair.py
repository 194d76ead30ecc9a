"""Repair of conversation structure: the cheapest edits that leave an optional system turn, then user and assistant in turn.

A row is kept, given the role that is due (user or assistant), deleted, or preceded by an inserted empty
turn. With four states (nothing yet, after a system, user or assistant turn) a dynamic programme over the
rows from the back gives, at each row, the least cost of finishing from each state. These vectors of four
costs are stored at every square root of n rows only; walking forward, the vectors between two checkpoints
are computed again, and of the edits that are tight (the cost of the edit and of what it leads to add up to
the cost in hand) the ASCII-least is written down. In a state each edit leads to one state, so the letters
fix the repair.

Rows are dealt by ranges of (conversation, turn, role, text) and sorted. A task writes out the conversations
that lie wholly inside its range. What remains, one or two conversations per task and any that is longer than a
block, goes on as blocks: a block's 4 x 4 costs from state to state are composed from the back of the
conversation, which gives every block the vector behind it, its own checkpoint; each block then walks from each
of the four states, and chaining the states they end in picks the walk that counts. No task holds more than
a block of rows; only the digest of a conversation's repaired text, which is one hash over all of it, is taken
by one task, a block at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from hashlib import md5, sha256
from itertools import accumulate
from math import isqrt

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybridge.llm.tables import Tables

# White space, ends of a sentence, edits and their costs, and the roles that are given.
BLANKS, STOPS = " \t\n\v\f\r", ".!?"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, CUT_COST = 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
GIVEN = ("", "", "user", "assistant")
#: The state that an inserted or given role leads to, from each state.
DUE = (USER, USER, ASSISTANT, USER)
#: Rows and characters of a block.
BLOCK_ROWS, BLOCK_CHARS = 65_536, 8 << 20

# A row's code: kind of role (0: none of s, u, a), 4 if it must go, 8 if it is truncated.
_KINDS = {"s": 1, "u": 2, "a": 3}
_MUST, _CUT = 4, 8
_FROM = ((), (START,), (START, SYSTEM, ASSISTANT), (USER,))  # states in which a role of each kind may be kept
_NEVER = 1 << 60
Costs = tuple[int, int, int, int]


def closed(c: Iterable[int]) -> Costs:
    """Costs with insertions before the next row."""
    start, system, user, assistant = c
    user, assistant = min(user, INSERT_COST + assistant), min(assistant, INSERT_COST + user)
    return min(start, INSERT_COST + user), min(system, INSERT_COST + user), user, assistant


#: Costs behind the last row: a conversation may end empty or after an assistant.
END = closed((0, _NEVER, _NEVER, 0))


def before(code: int, after: Costs) -> Costs:
    """Costs in front of a row, from those behind it."""
    out = [DELETE_COST + c for c in after]
    if not code & _MUST:
        more = CUT_COST if code & _CUT else 0
        for s in range(4):
            out[s] = min(out[s], REROLE_COST + more + after[DUE[s]])
        kind = code & 3
        for s in _FROM[kind]:
            out[s] = min(out[s], more + after[kind])
    return closed(out)


def _step(code: int, state: int, here: Costs, after: Costs) -> tuple[str, int]:
    """The ASCII-least tight edit in front of a row, and the state it leads to."""
    left = here[state]
    if left == DELETE_COST + after[state]:
        return DELETE, state
    if left == INSERT_COST + here[DUE[state]]:
        return INSERT, DUE[state]
    kind, more = code & 3, CUT_COST if code & _CUT else 0
    if state in _FROM[kind] and left == more + after[kind]:
        return KEEP, kind
    return REROLE, DUE[state]


def checkpoints(codes: bytes, end: Costs) -> tuple[int, list[Costs]]:
    """Rows between checkpoints, about the square root of all, and the costs at rows 0, that many, twice that many, ..."""
    gap = isqrt(len(codes)) + 1
    out, costs = [], end
    for i in range(len(codes) - 1, -1, -1):
        costs = before(codes[i], costs)
        if i % gap == 0:
            out.append(costs)
    return gap, out[::-1]


def walk(codes: bytes, state: int, end: Costs, last: bool) -> tuple[str, int, int]:
    """Edits of some rows from a state on, the state behind them, and the cost of these and all later rows.

    ``end`` holds the costs behind the rows; ``last`` says that nothing follows, so that insertions at the end belong here.
    """
    gap, marks = checkpoints(codes, end)
    cost = marks[0][state] if marks else end[state]
    edits = []
    for b in range(len(marks)):
        rows = codes[b * gap : (b + 1) * gap]
        costs = [marks[b + 1] if b + 1 < len(marks) else end]
        for code in reversed(rows):
            costs.append(before(code, costs[-1]))
        costs.reverse()
        for i, code in enumerate(rows):
            edit = INSERT
            while edit == INSERT:
                edit, state = _step(code, state, costs[i], costs[i + 1])
                edits.append(edit)
    while last and END[state]:
        edits.append(INSERT)
        state = DUE[state]
    return "".join(edits), state, cost


def transfer(codes: bytes) -> list[Costs]:
    """Least cost through some rows, for each state behind them (outer) and in front of them (inner)."""
    out = []
    for end in range(4):
        costs: Costs = tuple(0 if s == end else _NEVER for s in range(4))  # type: ignore[assignment]
        for code in reversed(codes):
            costs = before(code, costs)
        out.append(costs)
    return out


def repaired(edits: str, state: int, rows: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired rows."""
    rows = iter(rows)
    for e in edits:
        if e == INSERT:
            state = DUE[state]
            yield GIVEN[state], ""
            continue
        role, text = next(rows)
        if e == KEEP:
            state = _KINDS[role[0]]
            yield role, text
        elif e == REROLE:
            state = DUE[state]
            yield GIVEN[state], text


def row_code(role: str, text: str, seen: bool) -> tuple[int, str]:
    """A row's code, and its first fault (blank, duplicate, truncated or none)."""
    kind = _KINDS.get(role[:1], 0)
    end = text.rstrip(BLANKS)[-1:]
    if not end:
        return kind | _MUST, "blank"
    if seen:
        return kind | _MUST, "duplicate"
    return (kind, "") if end in STOPS else (kind | _CUT, "truncated")


def _digest(role: str, text: str) -> bytes:
    return md5(f"{len(role)}:{role}{text}".encode()).digest()


def _initials_illegal(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au")


def _turn_span(turns: list) -> tuple:
    """First, last and number of distinct turns of sorted turns, nulls aside."""
    some = [t for t in turns if t is not None]
    return (some[0], some[-1], 1 + sum(a != b for a, b in zip(some, some[1:]))) if some else (None, None, 0)


def _lines(rows: Iterable[tuple[str, str]]) -> str:
    return "\n".join(f"{role}:{text}" for role, text in rows)


def _small(turns: list, rows: list[tuple[str, str]]) -> dict:
    """All figures of a conversation that one task holds."""
    seen: set[bytes] = set()
    codes, faults = bytearray(), {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
    for role, text in rows:
        d = _digest(role, text)
        code, fault = row_code(role, text, d in seen)
        seen.add(d)
        codes.append(code)
        faults[fault] += 1
    first, last, distinct = _turn_span(turns)
    edits, _, cost = walk(bytes(codes), START, END, True)
    return {
        "gaps": last - first + 1 - distinct if distinct else 0,
        "blank": faults["blank"],
        "duplicate": faults["duplicate"],
        "truncated": faults["truncated"],
        "illegal": sum(_initials_illegal(a[0][:1], b[0][:1]) for a, b in zip(rows, rows[1:])),
        "cost": cost,
        "audit": edits,
        "repaired_sha256": sha256(_lines(repaired(edits, START, rows)).encode()).hexdigest(),
    }


FIGURES = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_FIELDS = [f.split()[0] for f in FIGURES.split(", ")]


def _arrow(schema: pa.Schema, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _cut(schema: pa.Schema, max_rows: int, max_chars: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted rows of a task as finished conversations and, where others may hold the rest, as blocks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        key, turns, rows, chars, open_, any_ = None, [], [], 0, True, False

        def block() -> dict:
            nonlocal number
            number += 1
            return {"conv": key, "part": part, "number": number, "turns": turns, "roles": [r for r, _ in rows], "texts": [t for _, t in rows]}

        for batch in batches:
            out = []
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for conv, turn, role, text in zip(*columns, strict=True):
                if not any_ or conv != key:
                    if any_:
                        out.append(block() if open_ else {"conv": key, "done": True} | _small(turns, rows))
                        open_ = False
                    key, turns, rows, chars, any_ = conv, [], [], 0, True
                if role is None:  # a row that was dropped: it only says that the conversation is there
                    continue
                turns.append(turn)
                rows.append((role, text))
                chars += len(text)
                if len(rows) >= max_rows or chars >= max_chars:
                    out.append(block())
                    turns, rows, chars, open_ = [], [], 0, True
            yield _arrow(schema, out)
        if any_:  # the next task may hold the rest
            yield _arrow(schema, [block()])

    return work


def repair_turns(
    rows: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    *,
    present: Column | None = None,
    block_rows: int = BLOCK_ROWS,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Faults and cheapest repair of every conversation: the id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows of a conversation stand in order of turn (nulls first); rows of one turn by role, then by the first 64
    characters of the text, then by a hash of it. A row's first fault counts: blank, duplicate (role and text
    seen earlier), truncated (no stop at the end). ``audit`` has a letter per edit and fixes the repaired rows
    (see :func:`repaired`); their digest is over role:text lines. ``gaps`` are turns missing between the first and last.

    Null roles and texts are taken as one blank; null turns do not count for gaps; rows without id are one
    conversation. Repeated rows are duplicates. ``present`` may exclude rows whose conversation shall still be reported:
    a conversation without rows has zeros, no edits and the digest of nothing. Other columns are not read.
    """
    spark = rows.sparkSession
    kind = rows.schema[id_col].dataType.simpleString()
    here = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    plain = rows.select(
        F.col(id_col).alias("conv"),
        F.when(here, F.col(turn_col).cast("long")).alias("turn"),
        F.when(here, F.coalesce(F.col(role_col).cast("string"), F.lit(" "))).alias("role"),
        F.when(here, F.coalesce(F.col(text_col).cast("string"), F.lit(" "))).alias("text"),
    )
    order = [F.col("conv"), F.col("turn"), F.col("role"), F.substring("text", 1, 64), F.xxhash64("text")]
    # Rows alike in all of these are equal; their number in the input deals even them to several tasks.
    dealt = plain.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange(*order, "copy")
    dealt = dealt.sortWithinPartitions(*order).drop("copy")
    steps = Tables(spark)
    first = f"conv {kind}, done boolean, {FIGURES}, part int, number int, turns array<long>, roles array<string>, texts array<string>"
    cut = steps.keep("turn-blocks", dealt.mapInArrow(_cut(_schema(spark, first), block_rows, block_chars), first))
    small = cut.where("done").select("conv", *_FIELDS)
    blocks = cut.where("done is null").select("conv", "part", "number", "turns", "roles", "texts")
    return small.union(_joined_blocks(steps, blocks, kind)).withColumnRenamed("conv", id_col)


def _schema(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], ddl).schema)


# --- conversations in several blocks ---------------------------------------------------------------


def _joined_blocks(steps: Tables, blocks: DataFrame, kind: str) -> DataFrame:
    """The figures of conversations whose blocks lie in several tasks, or are many."""
    spark, at = blocks.sparkSession, ["part", "number"]
    digests = blocks.mapInArrow(_block_digests(kind, spark), f"conv {kind}, part int, number int, row int, digest binary")
    digests = steps.keep("turn-digests", digests)
    earliest = digests.groupBy(F.col("conv").alias("c"), F.col("digest").alias("d")).agg(
        F.min(F.struct("part", "number", "row")).alias("first"), F.count("*").alias("n")
    )
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))
    later = digests.join(earliest.where("n > 1"), same).where(F.struct("part", "number", "row") != F.col("first"))
    seen = later.groupBy(*at).agg(F.collect_list("row").alias("seen"))
    coded = blocks.join(seen, at, "left").select("conv", *at, "turns", "roles", "texts", "seen")
    summary = f"conv {kind}, part int, number int, codes binary, faults array<long>, turns array<long>, ends array<string>, costs array<long>"
    coded = steps.keep("turn-codes", coded.mapInArrow(_block_codes(_schema(spark, summary)), summary))

    # From the back: the vector behind every block. A conversation's list holds a short entry per block.
    by_conv = coded.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct(*at, "costs", "faults", "turns", "ends"))).alias("list"))
    totals = f"conv {kind}, {FIGURES}, blocks array<struct<part: int, number: int, last: boolean, behind: array<long>>>"
    ends = steps.keep("turn-ends", by_conv.mapInArrow(_compose(_schema(spark, totals)), totals))
    behind = ends.select(F.inline("blocks"))
    walks = "conv " + kind + ", part int, number int, edits array<string>, states array<int>"
    walked = coded.select("conv", *at, "codes").join(behind, at).select("conv", *at, "codes", "last", "behind")
    walked = steps.keep("turn-walks", walked.mapInArrow(_walks(_schema(spark, walks)), walks))

    # Forward: the state in front of every block, and with it the walk that counts.
    entry = walked.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct(*at, "states"))).alias("list"))
    entry = entry.mapInArrow(_entries, "part int, number int, state int")
    chosen = walked.join(entry, at).select(*at, "state", F.col("edits")[F.col("state")].alias("edits"))
    lines = blocks.join(chosen, at).select("conv", *at, "state", "edits", "roles", "texts")
    # One hash runs over a conversation's lines: its blocks pass through one task, one at a time.
    lines = lines.repartition("conv").sortWithinPartitions("conv", *at)
    hashed = f"conv {kind}, audit string, repaired_sha256 string"
    hashed = lines.mapInArrow(_hashes(_schema(spark, hashed)), hashed)
    rest = [c for c in _FIELDS if c not in ("audit", "repaired_sha256")]
    named = hashed.withColumnRenamed("conv", "c")
    return ends.join(named, F.col("conv").eqNullSafe(F.col("c"))).select("conv", *rest, named["audit"], named["repaired_sha256"])


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows one by one: a block is large."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _block_digests(kind: str, spark) -> Callable:
    schema = _schema(spark, f"conv {kind}, part int, number int, row int, digest binary")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in _rows(batch):
                ids = {k: b[k] for k in ("conv", "part", "number")}
                pairs = enumerate(zip(b["roles"], b["texts"], strict=True))
                yield _arrow(schema, [ids | {"row": i, "digest": _digest(r, t)} for i, (r, t) in pairs])

    return work


def _block_codes(schema: pa.Schema) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in _rows(batch):
                seen = set(b["seen"] or ())
                codes, faults = bytearray(), {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
                for i, (role, text) in enumerate(zip(b["roles"], b["texts"], strict=True)):
                    code, fault = row_code(role, text, i in seen)
                    codes.append(code)
                    faults[fault] += 1
                initials = [r[:1] for r in b["roles"]]
                illegal = sum(_initials_illegal(x, y) for x, y in zip(initials, initials[1:]))
                out = {k: b[k] for k in ("conv", "part", "number")}
                out |= {"codes": bytes(codes), "faults": [faults["blank"], faults["duplicate"], faults["truncated"], illegal]}
                out |= {"turns": _turn_span(b["turns"]), "ends": [initials[0], initials[-1]] if initials else []}
                yield _arrow(schema, [out | {"costs": [c for costs in transfer(bytes(codes)) for c in costs]}])

    return work


def _compose(schema: pa.Schema) -> Callable:
    """Per conversation: the costs behind each of its blocks, and its figures."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in _rows(batch):
                blocks, costs, behind = c["list"], END, []
                for b in reversed(blocks):
                    behind.append(costs)
                    through = [b["costs"][4 * e : 4 * e + 4] for e in range(4)]
                    costs = tuple(min(through[e][s] + costs[e] for e in range(4)) for s in range(4))
                behind.reverse()
                faults = [sum(b["faults"][i] for b in blocks) for i in range(4)]
                ends = [b["ends"] for b in blocks if b["ends"]]
                faults[3] += sum(_initials_illegal(x[1], y[0]) for x, y in zip(ends, ends[1:]))
                spans = [b["turns"] for b in blocks if b["turns"][2]]
                distinct = sum(s[2] for s in spans) - sum(x[1] == y[0] for x, y in zip(spans, spans[1:]))
                out = {"conv": c["conv"], "gaps": spans[-1][1] - spans[0][0] + 1 - distinct if spans else 0, "cost": costs[START]}
                out |= dict(zip(("blank", "duplicate", "truncated", "illegal"), faults, strict=True))
                out["blocks"] = [
                    {"part": b["part"], "number": b["number"], "last": i == len(blocks) - 1, "behind": list(v)}
                    for i, (b, v) in enumerate(zip(blocks, behind, strict=True))
                ]
                yield _arrow(schema, [out])

    return work


def _walks(schema: pa.Schema) -> Callable:
    """Each block's edits from each of the four states, and the states they end in."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in _rows(batch):
                found = [walk(b["codes"], s, tuple(b["behind"]), b["last"]) for s in range(4)]
                out = {k: b[k] for k in ("conv", "part", "number")}
                yield _arrow(schema, [out | {"edits": [f[0] for f in found], "states": [f[1] for f in found]}])

    return work


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("state", pa.int32())])
    for batch in batches:
        for c in _rows(batch):
            states = accumulate(c["list"], lambda s, b: b["states"][s], initial=START)
            yield _arrow(schema, [{"part": b["part"], "number": b["number"], "state": s} for b, s in zip(c["list"], states)])


def _hashes(schema: pa.Schema) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, audit, digest, empty, any_ = None, [], sha256(), True, False

        def done() -> pa.RecordBatch:
            return _arrow(schema, [{"conv": key, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}])

        for batch in batches:
            for b in _rows(batch):
                if any_ and b["conv"] != key:
                    yield done()
                if not any_ or b["conv"] != key:
                    key, audit, digest, empty, any_ = b["conv"], [], sha256(), True, True
                audit.append(b["edits"])
                for role, text in repaired(b["edits"], b["state"], zip(b["roles"], b["texts"], strict=True)):
                    digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
                    empty = False
        if any_:
            yield done()

    return work


# --- the damage of the registered query ----------------------------------------------------------

DAMAGE_OF = 20


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` with the faults that crc32 of conv_id:turn deals out; column present is false for dropped rows.

    Of 20 cases: 0 drops the row, 1 empties its text, 2 takes its stops away, 3 repeats it, 4 makes it a user's.
    """
    blank = F.lit(" ")
    name = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank)
    )
    case = F.crc32(name.cast("binary")) % DAMAGE_OF
    text, role = (F.coalesce(F.col(c).cast("string"), blank) for c in ("text", "role"))
    text = F.when(case == 1, "").when(case == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    times = F.explode(F.when(case == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    out = rows.select(
        "conv_id", "turn", F.when(case == 4, "user").otherwise(role).alias("role"), text.alias("text"),
        (case != 0).alias("present"), times.alias("time"),
    )
    return out.drop("time")
