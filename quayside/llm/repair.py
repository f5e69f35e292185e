"""Repair of conversations' structure: lightest derivations by Knuth's agenda.

A repaired conversation has no roles at all, or an optional system turn and then one or more pairs of user and
assistant turns. An edit keeps a turn, changes its role, deletes it or inserts an empty one; blank turns and repeats must go.
Items are places of a conversation with a state of that pattern; a deduction has a place's item and a row's item
as its tail, adds an edit, and weighs (cost, audit), the audit being the edits' initials. Appending an edit never makes a weight
less and keeps the order of two weights of one item (with equal costs neither audit begins with the other, as an insertion always
costs), so the deductions are superior functions, and an agenda that pops the least weight finalises each item when it is first
popped. It ends with the goal.

A conversation may be of any size, so it is cut: all rows are dealt by ranges of (conversation, turn) and cut into pieces of at
most ``PIECE_ROWS`` rows, each repaired from every state that it can be entered in. A second agenda of the same kind runs over
the pieces' weights and decides how each is entered and left; then every piece edits its own rows. Repeats are found by
an aggregate over all rows, whose first rows are joined back by their number. So no key's rows are gathered, and what comes together for
a conversation are its pieces' audits, which are the result.

Rows are ordered by turn, nulls first; ties by role, then a hash of the text, then as they are read. Null roles and texts count as
one space. A null conversation is one like any other. Empty texts are blank. Very long texts are held one piece at a time. An empty
table gives no conversations. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Callable, Hashable, Iterable, Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import small_batches, snapshot

PIECE_ROWS = 512

SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
#: Costs of edits, by the initial that stands for them.
COSTS = {"K": 0, "R": 2, "D": 3, "I": 2}
TRUNCATED_COST = 1
#: By state: what each initial of a role leads to. No turn yet, a system turn, a user turn, whole pairs.
STATES = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ACCEPTED = (0, 3)
_LEGAL = frozenset(("su", "ua", "au"))
NAMES = {"u": "user", "a": "assistant"}

Weight = tuple[int, str]


class Deduction(NamedTuple):
    """If all items of the tail are derived, so is the head; weigh is superior in the tail's weights."""

    tail: tuple[Hashable, ...]
    head: Hashable
    weigh: Callable[..., Weight]


def lightest(
    axioms: dict[Hashable, Weight], deductions: Iterable[Deduction], goals: Iterable[Hashable]
) -> dict[Hashable, tuple[Weight, Deduction | None]]:
    """The least weight of each item popped until all goals that can be derived are, and its last deduction."""
    waiting = defaultdict(list)
    for deduction in deductions:
        open_tail = [len(set(deduction.tail)), deduction]
        for item in set(deduction.tail):
            waiting[item].append(open_tail)
    agenda = [(weight, serial, item, None) for serial, (item, weight) in enumerate(axioms.items())]
    heapq.heapify(agenda)
    serial, final, left = len(agenda), {}, set(goals)
    while agenda and left:
        weight, _, item, by = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = weight, by
        left.discard(item)
        for open_tail in waiting[item]:
            open_tail[0] -= 1
            deduction = open_tail[1]
            if not open_tail[0] and deduction.head not in final:
                found = deduction.weigh(*(final[t][0] for t in deduction.tail))
                heapq.heappush(agenda, (found, serial, deduction.head, deduction))
                serial += 1
    return final


def _edit(cost: int, initial: str) -> Callable[..., Weight]:
    return lambda before, *_: (before[0] + cost, before[1] + initial)


class Row(NamedTuple):
    role: str
    text: str
    blank: bool
    duplicate: bool
    truncated: bool


def classified(role: str, text: str, seen_before: bool) -> Row:
    """A row with its first fault: blank, else duplicate, else truncated."""
    ink = text.rstrip(SPACE)
    return Row(role, text, not ink, bool(ink) and seen_before, bool(ink) and not seen_before and ink[-1] not in ENDS)


def _deductions(rows: list[Row]) -> Iterator[Deduction]:
    for place in range(len(rows) + 1):
        for state, following in enumerate(STATES):
            here = ("at", place, state)
            for name in NAMES:
                if name in following:
                    yield Deduction((here,), ("at", place, following[name]), _edit(COSTS["I"], "I"))
            if place == len(rows):
                continue
            row, tail = rows[place], (here, ("row", place))
            yield Deduction(tail, ("at", place + 1, state), _edit(COSTS["D"], "D"))
            if row.blank or row.duplicate:
                continue
            more = TRUNCATED_COST * row.truncated
            if row.role[:1] in following:
                yield Deduction(tail, ("at", place + 1, following[row.role[:1]]), _edit(COSTS["K"] + more, "K"))
            for name in NAMES:
                if name in following:
                    yield Deduction(tail, ("at", place + 1, following[name]), _edit(COSTS["R"] + more, "R"))


def ways(rows: list[Row], entered: Iterable[int] = (0,)) -> dict[tuple[int, int], Weight]:
    """The least weight from each state at a piece's beginning to each state at its end."""
    deductions, found = list(_deductions(rows)), {}
    goals = [("at", len(rows), state) for state in range(len(STATES))]
    present = {("row", k): (0, "") for k in range(len(rows))}
    for enter in entered:
        final = lightest({("at", 0, enter): (0, ""), **present}, deductions, goals)
        found.update({(enter, goal[2]): final[goal][0] for goal in goals if goal in final})
    return found


def joined(pieces: list[dict[tuple[int, int], Weight]]) -> tuple[Weight, list[tuple[int, int]]]:
    """The lightest derivation through all pieces: its weight, and the states in which each piece is entered and left."""

    def through(weight: Weight) -> Callable[..., Weight]:
        return lambda before, *_: (before[0] + weight[0], before[1] + weight[1])

    deductions = [
        Deduction((("at", k, a), ("piece", k)), ("at", k + 1, b), through(w)) for k, p in enumerate(pieces) for (a, b), w in p.items()
    ]
    goal = ("goal",)
    deductions += [Deduction((("at", len(pieces), state),), goal, lambda w: w) for state in ACCEPTED]
    axioms = {("at", 0, 0): (0, ""), **{("piece", k): (0, "") for k in range(len(pieces))}}
    final = lightest(axioms, deductions, [goal])
    passed, item = [], final[goal][1].tail[0]
    while final[item][1] is not None:
        before = final[item][1].tail[0]
        passed.append((before[2], item[2]))
        item = before
    return final[goal][0], passed[::-1]


def edited(rows: list[tuple[str, str]], enter: int, audit: str) -> Iterator[tuple[str, str]]:
    """The (role, text) rows that an audit's edits leave of a piece entered in a state."""
    state, given = enter, iter(rows)
    for edit in audit:
        role, text = next(given) if edit != "I" else (None, "")
        if edit == "D":
            continue
        if edit != "K":
            role = NAMES["u" if "u" in STATES[state] else "a"]
        state = STATES[state][role[:1]]
        yield role, text


_ROWS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_WAYS = pa.list_(pa.struct([("enter", pa.int32()), ("leave", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
_PIECE = pa.schema(
    [
        ("conv", pa.string()), ("part", pa.int32()), ("piece", pa.int64()), ("rows", _ROWS), ("ways", _WAYS),
        *((c, pa.int64()) for c in _COUNTS), ("first_turn", pa.int64()), ("last_turn", pa.int64()),
        ("first_role", pa.string()), ("last_role", pa.string()),
    ]
)
_PIECE_DDL = (
    "conv string, part int, piece long, rows array<struct<role: string, text: string>>,"
    " ways array<struct<enter: int, leave: int, cost: long, audit: string>>,"
    " blank long, duplicate long, truncated long, illegal long, turns long, first_turn long, last_turn long,"
    " first_role string, last_role string"
)


def _known_turns(turns: list[int | None]) -> list[int]:
    """Distinct turns, in order, without nulls."""
    return [t for t, _ in groupby(t for t in turns if t is not None)]


def _piece(conv: str | None, part: int, piece: int, held: list[dict], first: bool) -> dict:
    rows = [classified(r["role"], r["text"], not r["first"]) for r in held]
    initials, turns = [r.role[:1] for r in rows], _known_turns([r["turn"] for r in held])
    found = ways(rows, (0,) if first else range(len(STATES)))
    return {
        "conv": conv, "part": part, "piece": piece, "rows": [{"role": r.role, "text": r.text} for r in rows],
        "ways": [{"enter": a, "leave": b, "cost": c, "audit": audit} for (a, b), (c, audit) in found.items()],
        "blank": sum(r.blank for r in rows), "duplicate": sum(r.duplicate for r in rows),
        "truncated": sum(r.truncated for r in rows),
        "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:])),
        "turns": len(turns), "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None,
        "first_role": initials[0], "last_role": initials[-1],
    }


def pieces(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """The conversations cut into pieces of at most so many rows, each with its rows, their faults and its ways."""
    small_batches(rows.sparkSession)
    own = rows.select(
        F.col(conv).cast("string").alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
    ).withColumn("n", F.monotonically_increasing_id())
    own = snapshot(own, "turns")  # what is read again has the same numbers
    firsts = own.groupBy("conv", "role", F.sha2("text", 256)).agg(F.min(F.struct("turn", "n")).alias("f"))
    firsts = firsts.select(F.col("f.n").alias("n"), F.lit(True).alias("first"))
    order = ["conv", "turn", "role", "tie", "n"]
    marked = own.join(firsts, "n", "left").withColumns({"first": F.coalesce("first", F.lit(False)), "tie": F.xxhash64("text")})
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = marked.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("tie", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, piece, groups = TaskContext.get().partitionId(), 0, 0
        given = (r for batch in batches for r in batch.to_pylist())
        for name, group in groupby(given, lambda r: r["conv"]):
            first = groups > 0  # the first group of a task may have begun in the one before
            groups += 1
            while held := [r for _, r in zip(range(piece_rows), group)]:
                yield pa.RecordBatch.from_pylist([_piece(name, part, piece, held, first)], _PIECE)
                first, piece = False, piece + 1

    return snapshot(dealt.mapInArrow(run, _PIECE_DDL), "pieces")


_DECIDED = (
    "conv string, part int, piece long, enter int, audit string,"
    " facts struct<gaps: long, blank: long, duplicate: long, truncated: long, illegal: long, cost: long, audit: string>"
)
_DECIDED_ARROW = pa.schema(
    [
        ("conv", pa.string()), ("part", pa.int32()), ("piece", pa.int64()), ("enter", pa.int32()), ("audit", pa.string()),
        ("facts", pa.struct([*((c, pa.int64()) for c in ("gaps", *_COUNTS[:4], "cost")), ("audit", pa.string())])),
    ]
)


def _decision(conv: str | None, parts: list[dict]) -> Iterator[dict]:
    """How each piece of a conversation is entered and edited; the last one also has what holds for all."""
    by_way = [{(w["enter"], w["leave"]): (w["cost"], w["audit"]) for w in p["ways"]} for p in parts]
    (cost, audit), passed = joined(by_way)
    known = [p for p in parts if p["turns"]]
    facts = {c: sum(p[c] for p in parts) for c in _COUNTS[:4]} | {"cost": cost, "audit": audit, "gaps": 0}
    facts["illegal"] += sum(a["last_role"] + b["first_role"] not in _LEGAL for a, b in zip(parts, parts[1:]))
    if known:
        distinct = sum(p["turns"] for p in known) - sum(a["last_turn"] == b["first_turn"] for a, b in zip(known, known[1:]))
        facts["gaps"] = known[-1]["last_turn"] - known[0]["first_turn"] + 1 - distinct
    for k, (piece, way) in enumerate(zip(parts, passed)):
        own = {"conv": conv, "part": piece["part"], "piece": piece["piece"], "enter": way[0], "audit": by_way[k][way][1]}
        yield own | {"facts": facts if k == len(parts) - 1 else None}


def decided(found: DataFrame) -> DataFrame:
    """(conv, part, piece, enter, audit, facts) for every piece; facts of a conversation stand at its last piece."""
    narrow = found.drop("rows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = (r for batch in batches for r in batch.to_pylist())
        for name, group in groupby(given, lambda r: r["conv"]):
            yield pa.RecordBatch.from_pylist(list(_decision(name, list(group))), _DECIDED_ARROW)

    # rows are few and small but take long: a stated number of tasks is not made fewer for their size
    parts = max(1, int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = narrow.repartition(parts, "conv").sortWithinPartitions("conv", "part", "piece")
    return snapshot(dealt.mapInArrow(run, _DECIDED), "decided")


def facts(decisions: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit) for every conversation with rows; conv as text."""
    return decisions.where("facts is not null").select("conv", "facts.*")


def repaired(found: DataFrame, decisions: DataFrame) -> DataFrame:
    """(conv, part, piece, place, role, text) for every repaired row; part, piece and place give a conversation's order."""
    own = decisions.select("part", "piece", "enter", F.col("audit").alias("edits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                left = list(edited([(x["role"], x["text"]) for x in r["rows"]], r["enter"], r["edits"]))
                yield pa.RecordBatch.from_pydict(
                    {
                        "conv": pa.array([r["conv"]] * len(left), pa.string()),
                        "part": pa.array([r["part"]] * len(left), pa.int32()),
                        "piece": pa.array([r["piece"]] * len(left), pa.int64()),
                        "place": pa.array(range(len(left)), pa.int32()),
                        "role": pa.array([x for x, _ in left], pa.string()),
                        "text": pa.array([x for _, x in left], pa.string()),
                    }
                )

    rows = found.select("conv", "part", "piece", "rows").join(own, ["part", "piece"]).select("conv", "part", "piece", "rows", "enter", "edits")
    return rows.mapInArrow(run, "conv string, part int, piece long, place int, role string, text string")


def said(role: Column, text: Column) -> Column:
    return F.concat(role, F.lit(":"), text)
