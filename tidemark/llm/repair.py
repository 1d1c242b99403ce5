"""Conversation structure repair: the cheapest edits that make the turns alternate.

A row may be kept, given another role or deleted, and empty turns may be inserted, so that
the roles read ``(s?(ua)+)?``.  What has been said so far is one of four states, and a run
of rows is described by what it costs to come from each state to each.  The edits follow by
Hirschberg's divide and conquer: a forward and a backward vector of four costs meet in the
middle of a run, the crossing that is least in the audit among the cheapest is chosen, and
both halves are solved alone, so that no table of all rows and states is kept.

Rows are sorted in ranges of (conversation, turn).  A conversation inside one range is
repaired where it lies.  One that spreads over ranges, or is long, becomes segments of
bounded size whose vectors are composed; then every segment is solved in a task of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import cut, partitions

#: A longer run of rows of one conversation is cut into segments; changes no result.
SEGMENT_ROWS, SEGMENT_CHARS = 4096, 1 << 22
SPACES = " \t\n\x0b\x0c\r"
CLOSES = (".", "!", "?")

EMPTY, SYSTEM, USER, ASSISTANT = range(4)
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
CUT_SHORT = 1  # added where a truncated row stays
FAR = 1 << 60

_NAMES = {USER: "user", ASSISTANT: "assistant"}
_FOLLOWS = {EMPTY: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
_NEXT = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_INITIALS = "sua"
_LEGAL = {"su", "ua", "au"}


def _moves(initial: str, fault: int) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, audit) of the cheapest ways past one row; inserts stand before it."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for start in range(4):
        state, before, cost = start, "", 0
        for _ in range(3):  # more than two inserts come back to a state
            ways = [(state, COST[DELETE], DELETE)]
            if fault not in (BLANK, DUPLICATE):
                late = CUT_SHORT if fault == TRUNCATED else 0
                if initial in _FOLLOWS[state]:
                    ways.append((_FOLLOWS[state][initial], COST[KEEP] + late, KEEP))
                ways.append((_NEXT[state], COST[REROLE] + late, REROLE))
            for to, price, op in ways:
                way = (cost + price, before + op)
                best[start, to] = min(way, best.get((start, to), way))
            state, before, cost = _NEXT[state], before + INSERT, cost + COST[INSERT]
    return [(a, b, cost, audit) for (a, b), (cost, audit) in sorted(best.items())]


def _row_code(initial: str, fault: int) -> int:
    """One byte for all that the edits depend on: 0 to 3 is the role of a fine row, 4 a row
    that must go, 5 to 8 the role of a truncated one."""
    if fault in (BLANK, DUPLICATE):
        return 4
    return (5 if fault == TRUNCATED else 0) + 1 + (_INITIALS.find(initial) if initial else -1)


_ROWS = [(i, f) for i in ("-", *_INITIALS) for f in (FINE, TRUNCATED)] + [("-", BLANK)]
MOVES = dict(sorted((_row_code(i, f), _moves(i, f)) for i, f in _ROWS))
#: What it takes to end in each state.
ENDING = [(0, ""), (4, INSERT * 2), (2, INSERT), (0, "")]


def forward(rows: bytes, start: int) -> tuple[list[int], list[int]]:
    """(cost, place of the audit among those of all states) for every state after ``rows``.

    No audit of these is the beginning of another, as each ends with the edit of the last
    row; so their order is that of (place before, edits at the row).
    """
    costs, places = [FAR] * 4, [0] * 4
    costs[start] = 0
    for code in rows:
        found: list = [None] * 4
        for a, b, price, audit in MOVES[code]:
            if costs[a] < FAR:
                way = (costs[a] + price, places[a], audit)
                if found[b] is None or way < found[b]:
                    found[b] = way
        order = sorted((f[1], f[2], s) for s, f in enumerate(found) if f)
        costs = [f[0] if f else FAR for f in found]
        places = [0] * 4
        for i, (_, _, s) in enumerate(order):
            places[s] = i
    return costs, places


def backward(rows: bytes, ends: list[int]) -> list[int]:
    """What it costs from every state before ``rows`` to the end, given the costs after."""
    for code in reversed(rows):
        before = [FAR] * 4
        for a, b, price, _ in MOVES[code]:
            if price + ends[b] < before[a]:
                before[a] = price + ends[b]
        ends = before
    return ends


def crossing(costs: list[int], places: list[int], ends: list[int]) -> int:
    """The state in which the cheapest edits of least audit cross."""
    return min((costs[s] + ends[s], places[s], s) for s in range(4))[2]


def audit_between(rows: bytes, start: int, end: int) -> str:
    """The least audit among the cheapest edits that lead past ``rows`` from one state to
    another."""
    parts, todo = [], [(0, len(rows), start, end)]
    while todo:
        i, j, a, b = todo.pop()
        if j - i == 1:
            parts.append(next(audit for x, y, _, audit in MOVES[rows[i]] if (x, y) == (a, b)))
        elif j > i:
            mid = (i + j) // 2
            ends = [FAR] * 4
            ends[b] = 0
            s = crossing(*forward(rows[i:mid], a), backward(rows[mid:j], ends))
            todo += [(mid, j, s, b), (i, mid, a, s)]
    return "".join(parts)


def solve(rows: bytes) -> tuple[int, str]:
    """(cost, audit) of a whole conversation."""
    if not rows:
        return 0, ""
    costs, places = forward(rows, EMPTY)
    end = crossing(costs, places, [c for c, _ in ENDING])
    return costs[end] + ENDING[end][0], audit_between(rows, EMPTY, end) + ENDING[end][1]


_solve_short = lru_cache(200_000)(solve)


def apply_audit(audit: str, turns: list[dict], start: int = EMPTY) -> list[dict]:
    """The turns that the edits make of ``turns`` (role, text) from a state on."""
    out, state, rows = [], start, iter(turns)
    for op in audit:
        if op == INSERT:
            state = _NEXT[state]
            out.append({"role": _NAMES[state], "text": ""})
            continue
        row = next(rows)
        if op == KEEP:
            state = _FOLLOWS[state][row["role"][:1]]
            out.append(row)
        elif op == REROLE:
            state = _NEXT[state]
            out.append({"role": _NAMES[state], "text": row["text"]})
    return out


TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
PIECE = pa.schema(
    [
        ("conv_id", pa.int64()), ("range", pa.int32()), ("part", pa.int32()), ("whole", pa.bool_()), ("n_rows", pa.int64()),
        ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("n_numbers", pa.int64()), ("blank", pa.int64()),
        ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("first_initial", pa.string()),
        ("last_initial", pa.string()), ("cost", pa.int64()), ("audit", pa.string()), ("codes", pa.binary()),
        ("vectors", pa.list_(pa.int64())), ("turns", TURNS),
    ]
)
PIECE_DDL = (
    "conv_id long, range int, part int, whole boolean, n_rows long, first_turn long, last_turn long, n_numbers long, "
    "blank long, duplicate long, truncated long, illegal long, first_initial string, last_initial string, cost long, "
    "audit string, codes binary, vectors array<long>, turns array<struct<role:string,text:string>>"
)


class _Run:
    """Rows of one conversation that follow each other."""

    def __init__(self, conv_id, part: int, opened: bool) -> None:
        self.conv_id, self.part, self.opened = conv_id, part, opened
        self.codes, self.turns, self.chars = bytearray(), [], 0
        self.faults = [0] * 4
        self.first = self.last = None
        self.numbers = self.illegal = 0

    def add(self, turn, role: str, text: str, fault: int) -> None:
        initial = role[:1]
        if self.turns and self.turns[-1]["role"][:1] + initial not in _LEGAL:
            self.illegal += 1
        if turn is not None:
            self.numbers += self.last is None or turn != self.last
            self.first, self.last = turn if self.first is None else self.first, turn
        self.faults[fault] += 1
        self.codes.append(_row_code(initial, fault))
        self.turns.append({"role": role, "text": text})
        self.chars += len(text) + len(role)

    def piece(self, place: int, closed: bool) -> dict:
        codes, whole = bytes(self.codes), closed and not self.opened
        out = {
            "conv_id": self.conv_id, "range": place, "part": self.part, "whole": whole, "n_rows": len(codes),
            "first_turn": self.first, "last_turn": self.last, "n_numbers": self.numbers, "blank": self.faults[BLANK],
            "duplicate": self.faults[DUPLICATE], "truncated": self.faults[TRUNCATED], "illegal": self.illegal,
            "first_initial": self.turns[0]["role"][:1], "last_initial": self.turns[-1]["role"][:1],
        }
        if whole:
            cost, audit = (_solve_short if len(codes) <= 32 else solve)(codes)
            return out | {"cost": cost, "audit": audit, "turns": apply_audit(audit, self.turns)}
        vectors = [x for s in range(4) for part in forward(codes, s) for x in part]
        return out | {"codes": codes, "vectors": vectors, "turns": self.turns}


def _batch(pieces: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(pieces, schema=PIECE)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a range to repaired conversations and open segments."""
    place = TaskContext.get().partitionId()
    run, done, before, held = None, [], None, 0
    for batch in batches:
        for conv_id, turn, role, text, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if run is None:
                run = _Run(conv_id, 0, True)  # it may have begun in the range before
            elif conv_id != run.conv_id:
                done.append(run.piece(place, True))
                held += run.chars
                run, before = _Run(conv_id, 0, False), None
            elif len(run.codes) >= SEGMENT_ROWS or run.chars >= SEGMENT_CHARS:
                done.append(run.piece(place, False))
                held += run.chars
                run = _Run(conv_id, run.part + 1, True)
            row = (turn, role, text)
            if row == before and fault != BLANK:
                fault = DUPLICATE
            run.add(turn, role, text, fault)
            before = row
            if held >= SEGMENT_CHARS or len(done) >= 5_000:
                yield _batch(done)
                done, held = [], 0
    if run is not None:
        done.append(run.piece(place, False))
    if done:
        yield _batch(done)


def _faulty(rows: DataFrame) -> DataFrame:
    """``rows`` with the first fault of each but for copies of one row, which follow each
    other after sorting.  Repeats are found by counting, joined back if there are any."""
    core = F.rtrim(F.col("text"), F.lit(SPACES))
    digest = F.sha2(F.encode("text", "UTF-8"), 256)
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    repeats = (
        rows.select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), digest.alias("_d"), order.alias("_o"))
        .groupBy("_c", "_r", "_d")
        .agg(F.min("_o").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .drop("_n")
    )
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("_digest") == F.col("_d"))
    fault = (
        F.when(core == "", BLANK)
        .when(F.coalesce(order > F.col("_first"), F.lit(False)), DUPLICATE)
        .when(~F.right(core, F.lit(1)).isin(*CLOSES), TRUNCATED)
        .otherwise(FINE)
    )
    return rows.withColumn("_digest", digest).join(repeats, same, "left").select(*rows.columns, fault.alias("fault"))


PATH_DDL = (
    "conv_id long, range int, part int, start int, end int, last boolean, cost long, gaps long, blank long, "
    "duplicate long, truncated long, illegal long"
)


def _paths(table: pa.Table) -> pa.Table:
    """The states in which the cheapest edits cross from segment to segment of one
    conversation, and its sums."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["range"], r["part"]))
    steps = [[(r["vectors"][8 * s : 8 * s + 4], r["vectors"][8 * s + 4 : 8 * s + 8]) for s in range(4)] for r in rows]
    ends = [[c for c, _ in ENDING]]
    for step in reversed(steps):
        after = ends[-1]
        ends.append([min(c + e for c, e in zip(step[s][0], after, strict=True)) for s in range(4)])
    ends.reverse()
    sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    state, first, last, numbers, before, out = EMPTY, None, None, 0, None, []
    for row, step, after in zip(rows, steps, ends[1:], strict=True):
        end = crossing(*step[state], after)
        out.append({"conv_id": row["conv_id"], "range": row["range"], "part": row["part"], "start": state, "end": end, "last": False})
        state = end
        for name in sums:
            sums[name] += row[name]
        sums["illegal"] += before is not None and before + row["first_initial"] not in _LEGAL
        before = row["last_initial"]
        if row["n_numbers"]:
            numbers += row["n_numbers"] - (row["first_turn"] == last)
            first, last = row["first_turn"] if first is None else first, row["last_turn"]
    out[-1] |= {"last": True, "cost": ends[0][EMPTY], "gaps": last - first + 1 - numbers if numbers else 0} | sums
    fields = [(n, {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}[k]) for n, k in (x.split() for x in PATH_DDL.split(", "))]
    return pa.Table.from_pylist(out, schema=pa.schema(fields))


SOLVED_DDL = "conv_id long, range int, part int, audit string, turns array<struct<role:string,text:string>>"


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and repaired turns of segments whose crossings are known."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            audit = audit_between(row["codes"], row["start"], row["end"])
            turns = apply_audit(audit, row["turns"], row["start"])
            if row["last"]:
                more = ENDING[row["end"]][1]
                audit, turns = audit + more, turns + apply_audit(more, [], row["end"])
            out.append({"conv_id": row["conv_id"], "range": row["range"], "part": row["part"], "audit": audit, "turns": turns})
        schema = pa.schema([PIECE.field(n) for n in ("conv_id", "range", "part", "audit", "turns")])
        yield pa.RecordBatch.from_pylist(out, schema=schema)


SUMS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
KEY = ["conv_id", "range", "part"]


def repaired(turns: DataFrame) -> DataFrame:
    """The repaired conversations of ``turns`` (conv_id, turn, role, text), in pieces.

    A piece has conv_id, range, part, the edits' initials ``audit`` and the repaired
    ``turns`` as an array of (role, text).  A conversation is one piece (``whole``), or
    several to be read in order of (range, part) if it is long.  Its only or last piece has
    its sums: gaps in the turn numbers, blank, duplicate, truncated and illegal rows, and
    the cost of the edits; they are null in other pieces.

    Rows go by turn, nulls first, then by role and text; a null role or text is one space; a
    null conv_id is a conversation as any other, however long.  Repeated rows are
    duplicates.  Other columns are not looked at; an empty table gives an empty one.
    """
    n = partitions(turns.sparkSession)
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
    )
    # The beginning of a text orders as the text does, and keeps the sampled bounds small.
    ranges = _faulty(rows).repartitionByRange(n, "conv_id", "turn", "role", F.left("text", F.lit(32)))
    ordered = ranges.sortWithinPartitions("conv_id", "turn", "role", "text")
    found = cut(ordered.mapInArrow(_pieces, PIECE_DDL), "conversations")
    gaps = F.when(F.col("n_numbers") > 0, F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_numbers"))
    columns = [*KEY, "whole", "audit", "turns", *SUMS]
    whole = found.where("whole").withColumn("gaps", F.coalesce(gaps, F.lit(0))).select(*columns)

    open_ = found.where("NOT whole")
    small = open_.drop("whole", "cost", "audit", "codes", "turns")
    paths = cut(small.groupBy("conv_id").applyInArrow(_paths, PATH_DDL), "crossings")
    sums = paths.where("last").select(*KEY, *SUMS)
    ways = paths.select(*KEY, "start", "end", "last")
    parts = _beside(open_.select(*KEY, "codes", "turns"), ways, ["start", "end", "last"])
    solved = _beside(parts.mapInArrow(_solved, SOLVED_DDL), sums, SUMS, "left")
    return whole.unionByName(solved.withColumn("whole", F.lit(False)).select(*columns))


def _beside(rows: DataFrame, more: DataFrame, columns: list[str], how: str = "inner") -> DataFrame:
    """``rows`` with columns of the row of ``more`` that has the same key; a conv_id may be
    null."""
    renamed = more.select(*[F.col(k).alias(f"_{k}") for k in KEY], *columns)
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id"))
    for k in KEY[1:]:
        same = same & (F.col(k) == F.col(f"_{k}"))
    return rows.join(renamed, same, how).drop(*[f"_{k}" for k in KEY])


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` with faults put in by a hash of ``conv_id:turn`` (nulls: one space): a
    twentieth each is dropped, emptied, robbed of its closing marks, repeated, or said by
    the user."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(F.encode(name, "UTF-8")) % 20
    text, role = (F.coalesce(F.col(c), F.lit(" ")) for c in ("text", "role"))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).where("kind <> 0")
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "")
        .when(F.col("kind") == 2, F.translate("text", "".join(CLOSES), ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def _said() -> Column:
    return F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit(":"), t.text)), "\n")


REPORT = ["conv_id", *SUMS, "audit", "repaired_sha256"]
REPORT_DDL = "conv_id long, " + "".join(f"{c} long, " for c in SUMS) + "audit string, repaired_sha256 string"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The report's rows of conversations whose pieces follow each other in order; a digest
    is taken up piece by piece."""
    digest, audit, lines = hashlib.sha256(), [], 0
    for batch in batches:
        for row in batch.to_pylist():
            audit.append(row["audit"])
            if row["n"]:
                digest.update(("\n" if lines else "").encode() + row["said"].encode())
                lines += row["n"]
            if row["cost"] is not None:  # the last piece
                done = {"audit": "".join(audit), "repaired_sha256": digest.hexdigest()}
                out = pa.Table.from_pylist([{c: row.get(c) for c in REPORT} | done])
                kinds = [pa.int64()] * (1 + len(SUMS)) + [pa.string()] * 2
                yield from out.select(REPORT).cast(pa.schema(zip(REPORT, kinds, strict=True))).to_batches()
                digest, audit, lines = hashlib.sha256(), [], 0


def repair_report(turns: DataFrame) -> DataFrame:
    """One row per conv_id of ``turns`` before they are damaged: the sums of ``repaired``,
    the audit, and the digest of the repaired ``role:text`` lines.

    A conversation without rows after the damage has zeros, an empty audit and the digest of
    nothing.  A digest and an audit are one value each, so the pieces of a long conversation
    are read in order by one task, one at a time.
    """
    pieces = repaired(damaged(turns))
    n = partitions(turns.sparkSession)
    short = pieces.where("whole").select(
        "conv_id", *SUMS, "audit", F.sha2(F.encode(_said(), "UTF-8"), 256).alias("repaired_sha256")
    )
    long_ = (
        pieces.where("NOT whole")
        .select(*KEY, *SUMS, "audit", _said().alias("said"), F.size("turns").alias("n"))
        .repartition(n, "conv_id")
        .sortWithinPartitions(*KEY)
        .mapInArrow(_digests, REPORT_DDL)
    )
    found = short.unionByName(long_).withColumnRenamed("conv_id", "_of")
    every = turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    out = every.join(found, F.col("conv_id").eqNullSafe(F.col("_of")), "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(
        "conv_id",
        *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in SUMS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
