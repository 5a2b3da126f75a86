"""Conversation structure repair by Four-Russians block tables.

A conversation's rows, in the order of their turns, are turned into one of
``(system? (user assistant)+)?`` at least cost.  Every row is kept (0), given
the role user or assistant (2) or deleted (3; blank and repeated rows must be);
an empty user or assistant row may be put in anywhere (2); a row that is not
deleted though its text is cut off costs 1 more.  Of several cheapest repairs
the one whose edit letters (Delete, Insert, Keep, Rerole) are the ASCII-least is
taken.

The state before a row is the role that was last emitted: none, system, user or
assistant.  The costs to go from the four states differ by a few units only, so
after subtracting the least there are few distinct cost vectors.  For each of
them and each block of ``BLOCK`` row symbols the tables hold the vector on the
block's other side, what was subtracted, and the state in which every entry
state leaves the block.  A conversation is processed from its end, a block a
look-up; then each block is expanded from the vector at its end, and the least
letter that reaches the cost is followed from the front.  The letter decides the
next state, so equal costs never leave a choice open.

Scale: equal rows of a turn are counted first, first mentions of a text are a
minimum per (conversation, role, text digest) joined back, and the rows are
dealt by ranges of (conversation, turn, role, digest).  A task cuts its sorted
rows into segments of one conversation, ``SEGMENT_ROWS`` rows or
``SEGMENT_BYTES`` of text at most.  Conversations that may go on in another task
are solved from one small row per segment (its tables' composition for every
cost vector), so a conversation with a third of all rows is worked on by many
tasks, and only those summaries meet in one.

Edge cases: NULL roles and texts are one blank (so the text is blank and the
role fits nowhere); a NULL turn comes first; a NULL conversation id is a
conversation.  Rows of equal turn are in the order of role and text digest
(SHA-256).  A conversation without rows gives one empty segment when it is
announced by a row with ``absent`` true.  An empty table gives no rows.  Columns
other than the four named are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlens.llm.common import materialize, own_exchange
from streamlens.llm.words import giving_back

BLOCK = 4
SEGMENT_ROWS = 1 << 16
SEGMENT_BYTES = 4 << 20
BLANKS = " \t\n\x0b\x0c\r"

# fixed values: states, costs and letters of the edits
NONE, SYSTEM, USER, ASSISTANT = range(4)
RETYPE, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
NEXT = (USER, USER, ASSISTANT, USER)  # what an inserted or re-roled row becomes after each state
ROLE = {USER: "user", ASSISTANT: "assistant"}
# symbols: must-delete, then role initial s, u, a, other, each whole or cut off
MUST_DELETE = 0
N_SYMBOLS = 9
LEGAL = ("su", "ua", "au")
END = (0, 4, 2, 0)  # costs to go after the last row: one or two insertions, or none


def symbol(initial: str, cut_off: bool, must_delete: bool) -> int:
    return MUST_DELETE if must_delete else 1 + 2 * ("sua".find(initial) if initial in ("s", "u", "a") else 3) + cut_off


def _kept(state: int, sym: int) -> int | None:
    """The state after keeping a row, or None if its role does not fit there."""
    role = (sym - 1) // 2  # 0 s, 1 u, 2 a, 3 other
    if role == 0:
        return SYSTEM if state == NONE else None
    if role == 1:
        return USER if state != USER else None
    if role == 2:
        return ASSISTANT if state == USER else None
    return None


def _choices(state: int, sym: int, after: tuple) -> list[tuple[int, str, int]]:
    """(cost to go, letter, next state) of the edits that consume a row."""
    found = [(DELETE + after[state], "D", state)]
    if sym != MUST_DELETE:
        cut = (sym - 1) % 2 * CUT_OFF
        to = _kept(state, sym)
        if to is not None:
            found.append((cut + after[to], "K", to))
        found.append((RETYPE + cut + after[NEXT[state]], "R", NEXT[state]))
    return found


def _before(sym: int, after: tuple) -> tuple:
    """Costs to go before a row from those after it."""
    own = [min(c for c, _, _ in _choices(q, sym, after)) for q in range(4)]
    out = []
    for q in range(4):
        best, paid, at = own[q], 0, q
        for _ in range(3):  # more insertions come back to a state already seen
            at, paid = NEXT[at], paid + INSERT
            best = min(best, paid + own[at])
        out.append(best)
    return tuple(out)


def _walk(state: int, sym: int, after: tuple) -> tuple[str, int]:
    """The least letters that take a state over one row, and the state reached."""
    costs, letters = _before(sym, after), ""
    while True:
        found = [(letter, to) for c, letter, to in _choices(state, sym, after) if c == costs[state]]
        if INSERT + costs[NEXT[state]] == costs[state]:
            found.append(("I", None))
        letter, to = min(found, key=lambda x: x[0])
        letters += letter
        if to is not None:
            return letters, to
        state = NEXT[state]


class Tables:
    """Look-ups for single symbols and for blocks, by number of a cost vector."""

    def __init__(self):
        vectors, number, todo = [END], {END: 0}, [END]
        one = {}
        while todo:
            v = todo.pop()
            for s in range(N_SYMBOLS):
                w = _before(s, v)
                low = min(w)
                w = tuple(c - low for c in w)
                if w not in number:
                    number[w] = len(vectors)
                    vectors.append(w)
                    todo.append(w)
                one[number[v], s] = (number[w], low)
        self.vectors = vectors
        n = len(vectors)
        # columns are symbols: vector before, what was subtracted, state after each state
        self.before1 = np.array([[one[v, s][0] for s in range(N_SYMBOLS)] for v in range(n)], np.int16)
        self.low1 = np.array([[one[v, s][1] for s in range(N_SYMBOLS)] for v in range(n)], np.int32)
        self.leave1 = np.array([[[_walk(q, s, vectors[v])[1] for q in range(4)] for s in range(N_SYMBOLS)]
                                for v in range(n)], np.int8)
        blocks = np.array(np.unravel_index(np.arange(N_SYMBOLS ** BLOCK), (N_SYMBOLS,) * BLOCK))
        at = np.repeat(np.arange(n)[:, None], N_SYMBOLS ** BLOCK, 1)
        self.low, after = np.zeros(at.shape, np.int32), []
        for s in blocks[::-1]:
            after.append(at)
            self.low += self.low1[at, s]
            at = self.before1[at, s]
        self.before = at.astype(np.int16)
        state = np.broadcast_to(np.arange(4), (*at.shape, 4))
        for s, v in zip(blocks, after[::-1]):
            state = np.take_along_axis(self.leave1[v, s], state.astype(np.int64), 2)
        self.leave = state.astype(np.int8)
        self._expanded: dict[tuple[int, int, int], tuple[str, int]] = {}

    def expanded(self, after: int, block: int, state: int) -> tuple[str, int]:
        """Letters and leaving state of a block, expanded once: costs from its
        end to its front, then the least letters from its front."""
        key = (after, block, state)
        if key not in self._expanded:
            syms, costs = [], []
            for _ in range(BLOCK):
                block, s = divmod(block, N_SYMBOLS)
                syms.append(s)
            v = after
            for s in syms:
                costs.append(self.vectors[v])
                v = self.before1[v, s]
            letters = ""
            for s, c in zip(syms[::-1], costs[::-1]):
                more, state = _walk(state, s, c)
                letters += more
            self._expanded[key] = letters, state
        return self._expanded[key]


@lru_cache(1)
def tables() -> Tables:
    return Tables()


def _blocks(symbols: bytes) -> tuple[list[int], list[int]]:
    """Whole blocks as numbers, and the symbols after them."""
    s = np.frombuffer(symbols, np.uint8).astype(np.int64)
    whole = len(s) // BLOCK * BLOCK
    return (s[:whole].reshape(-1, BLOCK) @ (N_SYMBOLS ** np.arange(BLOCK - 1, -1, -1))).tolist(), s[whole:].tolist()


def solve(symbols: bytes, after: int = 0, state: int = NONE, last: bool = True) -> tuple[int, str, int]:
    """(cost, letters, leaving state) of a run of rows, from the cost vector
    after it and the state before it; ``last`` closes the conversation."""
    t = tables()
    blocks, rest = _blocks(symbols)
    v, low, stack = after, 0, []
    for s in reversed(rest):
        stack.append(v)
        low, v = low + int(t.low1[v, s]), int(t.before1[v, s])
    for b in reversed(blocks):
        stack.append(v)
        low, v = low + int(t.low[v, b]), int(t.before[v, b])
    cost, letters = low + t.vectors[v][state], []
    for b in blocks:
        more, state = t.expanded(stack.pop(), b, state)
        letters.append(more)
    for s in rest:
        more, state = _walk(state, s, t.vectors[stack.pop()])
        letters.append(more)
    if last:
        while END[state]:
            letters.append("I")
            state = NEXT[state]
    return cost, "".join(letters), state


def composed(symbols: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every cost vector after a run: the vector before it, what was
    subtracted, and the state in which each state leaves the run."""
    t = tables()
    blocks, rest = _blocks(symbols)
    v = np.arange(len(t.vectors))
    low, steps = np.zeros(len(v), np.int64), []
    for s in reversed(rest):
        steps.append(t.leave1[v, s])
        low, v = low + t.low1[v, s], t.before1[v, s]
    for b in reversed(blocks):
        steps.append(t.leave[v, b])
        low, v = low + t.low[v, b], t.before[v, b]
    state = np.tile(np.arange(4, dtype=np.int8), (len(v), 1))
    for leave in reversed(steps):
        state = np.take_along_axis(leave, state.astype(np.int64), 1)
    return v, low, state


def edited(rows: list[tuple[str, str]], letters: str, state: int = NONE) -> list[tuple[str, str]]:
    """The repaired (role, text) rows that the letters make of the rows."""
    out, at = [], 0
    for letter in letters:
        if letter == "I":
            state = NEXT[state]
            out.append((ROLE[state], ""))
            continue
        role, text = rows[at]
        at += 1
        if letter == "D":
            continue
        if letter == "K":
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
        else:
            state = NEXT[state]
            role = ROLE[state]
        out.append((role, text))
    return out


_SEGMENT = (
    "part int, uid long, head string, tail string, blank long, duplicate long, truncated long, illegal long, "
    "n_rows long, first_turn long, last_turn long, n_turns long, open boolean, symbols binary, "
    "rows array<struct<role:string,text:string>>")


def faults(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           absent: Column | None = None) -> DataFrame:
    """(conv, turn, role, text, digest, n, fault, absent): one row per distinct
    row, ``n`` times in the conversation; ``fault`` is that of the first of
    them (the others are blank as it is, or duplicates)."""
    one = F.lit(" ")
    narrow = rows.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), one).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), one).alias("text"),
        F.coalesce(absent if absent is not None else F.lit(False), F.lit(False)).alias("absent"))
    narrow = narrow.select("conv", *[F.when(~F.col("absent"), F.col(c)).alias(c) for c in ("turn", "role", "text")],
                           "absent")
    counted = narrow.withColumn("digest", F.sha2("text", 256)).groupBy(
        "conv", "turn", "role", "digest", "text", "absent").agg(F.count(F.lit(1)).alias("n"))
    # one key that is never NULL: rows without a conversation id join too
    keyed = counted.withColumn("k", F.sha2(F.to_json(F.struct("conv", "role", "digest")), 256))
    order = F.struct(F.col("turn").isNotNull().alias("later"), F.col("turn").alias("t"))
    first = (keyed.where("not absent").groupBy("k").agg(F.min(order).alias("first")))
    joined = keyed.join(own_exchange(first, "k"), "k", "left")
    bare = F.rtrim("text", F.lit(BLANKS))
    is_first = order.eqNullSafe(F.col("first"))
    fault = (F.when(bare == "", "blank").when(~is_first, "duplicate")
             .when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated"))
    return joined.select("conv", "turn", "role", "text", "digest", "n", fault.alias("fault"), "absent")


class _Segment:
    """The rows of one conversation that a task has met since the last cut."""

    def __init__(self, conv, part: int, uid: int):
        self.conv, self.part, self.uid = conv, part, uid
        self.symbols, self.rows, self.bytes = bytearray(), [], 0
        self.count = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal = self.n_turns = 0
        self.first_turn = self.last_turn = self.head = self.tail = None

    def full(self, rows: int) -> bool:
        return len(self.symbols) >= rows or self.bytes >= SEGMENT_BYTES

    def add(self, turn, role: str, text: str, fault: str | None, n: int) -> None:
        initial, again = role[:1], "blank" if fault == "blank" else "duplicate"
        if self.tail is None:
            self.head = initial
        else:
            self.illegal += self.tail + initial not in LEGAL
        self.illegal += n - 1  # no role may follow itself
        self.tail = initial
        must = fault in ("blank", "duplicate")
        self.symbols.append(symbol(initial, fault == "truncated", must))
        self.symbols.extend(bytes([MUST_DELETE]) * (n - 1))
        self.rows.append((role, "" if must else text))  # the text of a deleted row is not wanted again
        self.rows.extend([(role, "")] * (n - 1))
        if fault:
            self.count[fault] += 1
        self.count[again] += n - 1
        self.bytes += len(self.rows[-n][1]) + 16 * n
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
            self.n_turns += 1

    def row(self, is_open: bool) -> tuple:
        return (self.conv, self.part, self.uid, self.head, self.tail, *self.count.values(), self.illegal,
                len(self.symbols), self.first_turn, self.last_turn, self.n_turns, is_open, bytes(self.symbols),
                [{"role": r, "text": t} for r, t in self.rows])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*[c.to_pylist() for c in b.columns])


def _cut(batches: Iterator[pa.RecordBatch], schema: pa.Schema, segment_rows: int) -> Iterator[pa.RecordBatch]:
    """Segments of sorted rows.  The first and the last conversation of a task
    may go on in another, and one may have several segments: these are open."""
    from pyspark import TaskContext
    part = TaskContext.get().partitionId()
    done: list[tuple] = []
    size = uid = 0
    cur, first_conv, several = None, True, False
    for conv, turn, role, text, n, fault, absent in _rows(batches):
        if cur is not None and conv != cur.conv:
            done.append(cur.row(first_conv or several))
            size += cur.bytes
            cur, first_conv, several = None, False, False
        if cur is None:
            cur, uid = _Segment(conv, part, uid), uid + 1
        while n and not absent:
            if cur.full(segment_rows):
                done.append(cur.row(True))
                size += cur.bytes
                cur, uid, several = _Segment(conv, part, uid), uid + 1, True
            m = min(n, segment_rows)
            cur.add(turn, role, text, fault, m)
            fault, n = "blank" if fault == "blank" else "duplicate", n - m
        if size >= SEGMENT_BYTES or len(done) >= 4096:
            yield _batch(done, schema)
            done, size = [], 0
    if cur is not None:
        done.append(cur.row(True))
    if done:
        yield _batch(done, schema)


def _with_conv(rows: DataFrame, ddl: str) -> T.StructType:
    return T.StructType([rows.schema["conv"], *T.StructType.fromDDL(ddl).fields])


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def _segments(rows: DataFrame, segment_rows: int) -> DataFrame:
    """Sorted rows of ``faults`` as segments."""
    keys = ["conv", "turn", "role", "digest"]
    order = [F.col(k).asc_nulls_first() for k in keys]
    # dealt by ranges: rows that share a conversation, even a turn, may go to several tasks
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    out = _with_conv(rows, _SEGMENT)
    schema = _arrow(out)
    return dealt.select("conv", "turn", "role", "text", "n", "fault", "absent").mapInArrow(
        giving_back(lambda batches: _cut(batches, schema, segment_rows)), out)


def _joints(segments: DataFrame) -> DataFrame:
    """(part, uid, after, state, last, cost) of open segments: the cost vector
    after each and the state before it, from one composed row per segment."""
    light = _with_conv(segments, "part int, uid long, before binary, low binary, leave binary")
    light_arrow = _arrow(light)

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv, part, uid, symbols in _rows(batches):
            before, low, leave = composed(symbols)
            yield _batch([(conv, part, uid, before.astype(np.int16).tobytes(), low.tobytes(), leave.tobytes())], light_arrow)

    out = T.StructType.fromDDL("part int, uid long, after int, state int, last boolean, cost long")
    out_arrow = _arrow(out)

    def joined(run: list[tuple]) -> list[tuple]:
        vectors = tables().vectors
        v, low, afters = 0, 0, []
        for _, _, _, before, minus, _ in reversed(run):
            afters.append(v)
            low += int(np.frombuffer(minus, np.int64)[v])
            v = int(np.frombuffer(before, np.int16)[v])
        state, found = NONE, []
        cost = low + vectors[v][state]
        for i, ((_, part, uid, _, _, leave), after) in enumerate(zip(run, reversed(afters))):
            found.append((part, uid, after, state, i == len(run) - 1, cost if i == 0 else 0))
            state = int(np.frombuffer(leave, np.int8).reshape(-1, 4)[after, state])
        return found

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run: list[tuple] = []
        for row in _rows(batches):
            if run and run[0][0] != row[0]:
                yield _batch(joined(run), out_arrow)
                run = []
            run.append(row)
        if run:
            yield _batch(joined(run), out_arrow)

    composed_rows = segments.select("conv", "part", "uid", "symbols").mapInArrow(giving_back(compose), light)
    # one row of a few hundred bytes per segment of up to SEGMENT_ROWS rows
    return (composed_rows.repartition(F.col("conv")).sortWithinPartitions("conv", "part", "uid")
            .mapInArrow(giving_back(join), out))


_REPAIRED = (
    "part int, uid long, head string, tail string, blank long, duplicate long, truncated long, illegal long, "
    "n_rows long, first_turn long, last_turn long, n_turns long, cost long, audit string, "
    "turns array<struct<role:string,text:string>>")


def _finished(segments: DataFrame) -> DataFrame:
    out = _with_conv(segments, _REPAIRED)
    schema = _arrow(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 64):
                done = []
                for *facts, symbols, rows, after, state, last, cost in _rows([b.slice(s, 64)]):
                    found, audit, _ = solve(symbols, after, state, last)
                    kept = edited([(r["role"], r["text"]) for r in rows], audit, state)
                    done.append((*facts, found if cost is None else cost, audit,
                                 [{"role": r, "text": t} for r, t in kept]))
                yield _batch(done, schema)

    return segments.select(*[f.name for f in out.fields[:-3]], "symbols", "rows", "after", "state", "last",
                           "cost").mapInArrow(giving_back(run), out)


def repair(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", absent: Column | None = None, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """The repaired conversations, one row per segment: the conversation id
    (``conv``), its place (``part``, ``uid``: sort a conversation's rows by
    them), its faults, ``cost`` (the whole conversation's, on its first
    segment), ``audit`` (the segment's edit letters), ``turns`` (the repaired
    rows) and ``whole`` (the segment is the whole conversation).

    ``absent`` marks rows that only announce their conversation.
    """
    segments = materialize(
        _segments(faults(conversations, conv, turn, role, text, absent), segment_rows), "segments")
    alone = segments.where("not open").select(
        "*", F.lit(0).alias("after"), F.lit(NONE).alias("state"), F.lit(True).alias("last"),
        F.lit(None).cast("long").alias("cost"))
    opened = segments.where("open")
    joints = materialize(_joints(opened), "joints")
    joined = opened.join(joints, ["part", "uid"])
    return (_finished(alone).withColumn("whole", F.lit(True))
            .unionByName(_finished(joined).withColumn("whole", F.lit(False))))


def report(repaired: DataFrame) -> DataFrame:
    """One row per conversation: ``gaps``, the counts of faults, ``cost``,
    ``audit`` and ``repaired_sha256`` of its ``role:text`` rows, joined by newlines.

    Whole conversations are hashed in place.  The segments of the others meet
    in order in one task, which adds them to a running hash and keeps none.
    """
    counts = ["blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns"), F.lit(0))
    alone = repaired.where("whole").select(
        "conv", gaps.cast("long").alias("gaps"), *counts, F.sha2(lines, 256).alias("repaired_sha256"))
    out = alone.schema
    schema = _arrow(out)
    rows = (repaired.where("not whole")
            .select("conv", "part", "uid", "head", "tail", "blank", "duplicate", "truncated", "illegal", "first_turn",
                    "last_turn", "n_turns", "cost", "audit", lines.alias("lines"), F.size("turns").alias("n"))
            .repartition(F.col("conv")).sortWithinPartitions("conv", "part", "uid"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        total = None

        def closed() -> pa.RecordBatch:
            lo, hi, n = total["turns"]
            return _batch([(total["conv"], 0 if lo is None else hi - lo + 1 - n, *total["counts"],
                            "".join(total["audit"]), total["sha"].hexdigest())], schema)

        for conv, _, _, head, tail, b, d, t, i, first, last, n_turns, cost, audit, text, n in _rows(batches):
            if total is None or total["conv"] != conv:
                if total is not None:
                    yield closed()
                total = {"conv": conv, "counts": [0] * 5, "audit": [], "sha": hashlib.sha256(), "some": False,
                         "turns": (None, None, 0), "tail": None}
            i += head is not None and total["tail"] is not None and total["tail"] + head not in LEGAL
            total["tail"] = total["tail"] if tail is None else tail
            total["counts"] = [x + y for x, y in zip(total["counts"], (b, d, t, i, cost))]
            total["audit"].append(audit)
            lo, hi, seen = total["turns"]
            if first is not None:
                total["turns"] = (first if lo is None else lo, last, seen + n_turns - (hi == first))
            if n:
                if total["some"]:
                    total["sha"].update(b"\n")
                total["sha"].update(text.encode())
                total["some"] = True
        if total is not None:
            yield closed()

    return alone.unionByName(rows.mapInArrow(giving_back(run), out))


def damaged(conversations: DataFrame) -> tuple[DataFrame, Column]:
    """Conversations with faults made on purpose, to repair: by
    crc32(``conv_id:turn``) modulo 20 a row is dropped (0), emptied (1), loses
    its marks ``.!?`` (2), is there twice (3) or gets the role user (4).
    Returns the rows (dropped ones too) and the column that marks dropped ones."""
    one = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), one), F.coalesce(F.col("turn").cast("string"), one))
    h = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", one), F.coalesce("text", one)
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), h.alias("h"))
    rows = rows.withColumns({
        "text": F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
        "role": F.when(F.col("h") == 4, "user").otherwise(F.col("role"))})
    return rows.withColumn("copy", F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))))), F.col("h") == 0


#: the SQL twin of ``report(repair(damaged(conversations)))``: the cheapest, least
#: letters per state row by row, without blocks
ORACLE = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY n) AS tab
  FROM range(256) t(n)),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
hashed AS (
  SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda c: ascii(c)::BIGINT)),
    lambda x, b: xor(x >> 8, tab[(xor(x, b) & 255) + 1]))) % 20 AS h
  FROM keyed, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN h = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM hashed WHERE h <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM damaged),
judged AS (
  SELECT conv_id, turn, i, role, text, left(role, 1) AS initial,
         CASE WHEN bare = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
         left(role, 1) AS here, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS prior
  FROM placed),
inserts(q, paid, letters, lines, q2) AS (VALUES
  (0, 0, '', []::VARCHAR[], 0), (0, 2, 'I', ['user:'], 2), (0, 4, 'II', ['user:', 'assistant:'], 3),
  (1, 0, '', [], 1), (1, 2, 'I', ['user:'], 2), (1, 4, 'II', ['user:', 'assistant:'], 3),
  (2, 0, '', [], 2), (2, 2, 'I', ['assistant:'], 3), (3, 0, '', [], 3), (3, 2, 'I', ['user:'], 2)),
edits(letter, q, initial, q2, becomes) AS (VALUES
  ('K', 0, 's', 1, NULL), ('K', 0, 'u', 2, NULL), ('K', 1, 'u', 2, NULL), ('K', 3, 'u', 2, NULL), ('K', 2, 'a', 3, NULL),
  ('R', 0, NULL, 2, 'user'), ('R', 1, NULL, 2, 'user'), ('R', 2, NULL, 3, 'assistant'), ('R', 3, NULL, 2, 'user'),
  ('D', 0, NULL, 0, NULL), ('D', 1, NULL, 1, NULL), ('D', 2, NULL, 2, NULL), ('D', 3, NULL, 3, NULL)),
steps AS (
  SELECT c.conv_id, 0::BIGINT AS i, n.q2 AS q, {'cost': n.paid::BIGINT, 'audit': n.letters, 'lines': n.lines} AS b
  FROM (SELECT DISTINCT conv_id FROM judged) c JOIN inserts n ON n.q = 0
  UNION ALL
  SELECT conv_id, i, q, b FROM (
    SELECT s.conv_id, j.i, n.q2 AS q, min({
      'cost': s.b.cost + n.paid + CASE e.letter WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END
        + CASE WHEN e.letter <> 'D' AND j.fault = 'truncated' THEN 1 ELSE 0 END,
      'audit': s.b.audit || e.letter || n.letters,
      'lines': list_concat(s.b.lines, CASE WHEN e.letter = 'D' THEN []::VARCHAR[]
        ELSE [coalesce(e.becomes, j.role) || ':' || j.text] END, n.lines)}) AS b
    FROM steps s JOIN judged j ON j.conv_id IS NOT DISTINCT FROM s.conv_id AND j.i = s.i + 1
    JOIN edits e ON e.q = s.q AND (e.letter <> 'K' OR e.initial = j.initial)
      AND (e.letter = 'D' OR coalesce(j.fault, '') NOT IN ('blank', 'duplicate'))
    JOIN inserts n ON n.q = e.q2
    GROUP BY s.conv_id, j.i, n.q2)),
facts AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (prior IS NOT NULL AND prior || here NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
ended AS (
  SELECT f.*, min(s.b) AS b FROM facts f
  JOIN steps s ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND s.i = f.n AND s.q IN (0, 3) GROUP BY ALL)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.cost, 0)::BIGINT AS cost, coalesce(b.audit, '') AS audit,
       sha256(coalesce(array_to_string(b.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""
