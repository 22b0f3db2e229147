"""Repair of conversations by the cheapest edits, found by depth-first branch-and-bound.

Each row of a conversation, taken by turn, is kept (0), given the role that fits, user or assistant (1), or deleted (2), and
an empty user or assistant row may be inserted anywhere (5). Blank rows and those with role and text seen earlier must be
deleted; a row that is cut off and stays costs 5 more. What is left must be a system row or none, then user and assistant
in turns, or nothing at all. Of equally cheap repairs the one whose audit, the initials of its edits in order, is least in
ASCII counts.

The search keeps an explicit stack of nodes: (rows done, role state, cost, audit). Branches are tried in order of their
cost plus a lower bound of the rest. The bounds come from the rows alone: the rest is cut into stretches of up to three
rows, each at the least that it costs from whatever state. The best complete repair so far, (cost, audit), is the
incumbent; a node goes if its bound is above it, or equal with an audit that is already above. Per (rows done, state) a
table holds the best prefix seen, and prefixes no better than it go. An empty stack proves the incumbent.

Scale. Equal rows of a conversation are merged before the shuffle, with their number. A conversation of more than ``BLOCK``
rows is searched block by block, once per state at its end, for what follows depends on the state alone; so the work grows
in proportion to the rows. A task holds one block and four open repairs, of which it keeps the part that they do not share.
The digest of a repair is one sequential hash, so the rows of one conversation pass through one task, in order and without
being collected.

Results for odd input: nulls in role and text count as one space, and so do nulls in the text of a key that ``damage``
hashes; a null conversation id is a conversation of its own; null turns come first. Rows of the same turn go by role,
then text. A row whose role is empty has no initial and can't be kept as it is. Repeated rows are duplicates. A gap count
beyond a long is the largest long. An empty table gives an empty one. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby
from os.path import commonprefix
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
BLOCK = 64
STRETCH = 3
RESULTS_AT_ONCE = 1 << 20
LARGEST = (1 << 63) - 1
REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
# Role states: nothing yet, after the system row, after a user, after an assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
GOALS = (EMPTY, ASSISTANT)
LEGAL_PAIRS = {"su", "ua", "au"}


class Step(NamedTuple):
    """A row, or ``copies`` equal rows that all must go."""

    role: str
    text: str
    must_go: bool
    cut_off: bool
    copies: int = 1


def after(state: int, initial: str) -> int | None:
    """The state after a kept row, none if the row is out of place."""
    if initial == "s":
        return SYSTEM if state == EMPTY else None
    return FOLLOWS[state] if initial == NAMES[FOLLOWS[state]][0] else None


@lru_cache(maxsize=1 << 12)
def least_cost(stretch: tuple[tuple[str, bool], ...]) -> int:
    """The least that rows (initial, cut off) cost from any state to any state."""
    costs = dict.fromkeys(FOLLOWS, 0)
    for initial, cut_off in stretch:
        extra, reached = CUT_OFF * cut_off, {}
        for state, cost in costs.items():
            ways = [(state, DELETE), (FOLLOWS[state], REROLE + extra)]
            kept = after(state, initial)
            if kept is not None:
                ways.append((kept, extra))
            for there, more in ways:
                reached[there] = min(reached.get(there, cost + more), cost + more)
        # Insertions lead on to other states, for the price of one at least.
        least = min(reached.values()) + INSERT
        costs = {state: min(reached.get(state, least), least) for state in FOLLOWS}
    return min(costs.values())


def lower_bounds(steps: list[Step]) -> list[int]:
    """Per number of rows done, what the rest costs at least."""
    bounds = [0] * (len(steps) + 1)
    live: list[tuple[int, tuple[str, bool]]] = []  # rows that may stay, last first
    forced = 0
    best = [0]  # over the last rows that may stay, without the forced ones
    for k in range(len(steps) - 1, -1, -1):
        step = steps[k]
        if step.must_go:
            forced += DELETE * step.copies
        else:
            initial = step.role[:1] if step.role[:1] in ("s", "u", "a") else ""
            live.append((k, (initial, step.cut_off)))
            stretches = range(1, min(STRETCH, len(live)) + 1)
            best.append(max(least_cost(tuple(x for _, x in reversed(live[-n:]))) + best[-n] for n in stretches))
        bounds[k] = best[-1] + forced
    return bounds


Entry = tuple[int, str]  # cost and audit so far


def cheapest(steps: list[Step], entries: dict[int, Entry], goals: Iterable[int]) -> tuple[int, str, int, int] | None:
    """The best way from one of the entries over all steps to a goal state: cost, audit, state at its start and at its end."""
    bounds, goals = lower_bounds(steps), frozenset(goals)
    incumbent: tuple[int, str] | None = None
    found = None
    table: dict[tuple[int, int], Entry] = {}
    stack = [(0, state, cost, audit, state) for state, (cost, audit) in entries.items()]
    stack.sort(key=lambda node: node[2:4], reverse=True)
    while stack:
        done, state, cost, audit, start = stack.pop()
        if incumbent is not None:
            bound = cost + bounds[done]
            if bound > incumbent[0] or (bound == incumbent[0] and audit > incumbent[1][: len(audit)]):
                continue
        known = table.get((done, state))
        if known is not None and known <= (cost, audit):
            continue
        table[done, state] = (cost, audit)
        branches = [(done, FOLLOWS[state], cost + INSERT, audit + "I", start)]
        if done == len(steps):
            if state in goals and (incumbent is None or (cost, audit) < incumbent):
                incumbent, found = (cost, audit), (cost, audit, start, state)
        else:
            step = steps[done]
            branches.append((done + 1, state, cost + DELETE * step.copies, audit + "D" * step.copies, start))
            if not step.must_go:
                extra = CUT_OFF * step.cut_off
                branches.append((done + 1, FOLLOWS[state], cost + REROLE + extra, audit + "R", start))
                kept = after(state, step.role[:1])
                if kept is not None:
                    branches.append((done + 1, kept, cost + extra, audit + "K", start))
        branches.sort(key=lambda node: (node[2] + bounds[node[0]], node[3]), reverse=True)
        stack.extend(branches)
    return found


def replay(steps: Iterable[Step], edits: str, state: int) -> Iterator[tuple[int, str, str, str]]:
    """The rows that edits leave: the state before each, its edit, role and text."""
    at = 0
    for step in steps:
        while edits[at] == "I":
            yield state, "I", NAMES[FOLLOWS[state]], ""
            state, at = FOLLOWS[state], at + 1
        edit = edits[at]
        at += step.copies
        if edit == "D":
            continue
        there = after(state, step.role[:1]) if edit == "K" else FOLLOWS[state]
        yield state, edit, step.role if edit == "K" else NAMES[there], step.text
        state = there
    while at < len(edits):
        yield state, "I", NAMES[FOLLOWS[state]], ""
        state, at = FOLLOWS[state], at + 1


class Conversation:
    """Takes the rows of one conversation in order, a block at a time."""

    def __init__(self, key):
        self.key = key
        self.steps: list[Step] = []
        self.entries: dict[int, Entry] = {EMPTY: (0, "")}
        self.digests = {EMPTY: hashlib.sha256()}
        self.settled, self.paid = [], 0
        self.first = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.initial: str | None = None

    def add(self, turn, role: str, text: str, copies: int, blank: bool, seen: bool, cut_off: bool) -> None:
        if turn is not None:
            self.turns += turn != self.last
            self.first, self.last = turn if self.first is None else self.first, turn
        initial = role[:1]
        self.illegal += (self.initial is not None and self.initial + initial not in LEGAL_PAIRS) + copies - 1
        self.initial = initial
        if blank or seen:
            self.blank += copies * blank
            self.duplicate += copies * (not blank)
            self.steps.append(Step(role, "", True, False, copies))
        else:
            self.truncated += cut_off
            self.duplicate += copies - 1
            self.steps.append(Step(role, text, False, cut_off))
            if copies > 1:
                self.steps.append(Step(role, "", True, False, copies - 1))
        if len(self.steps) >= BLOCK:
            self.close_block([(state,) for state in FOLLOWS])

    def close_block(self, goals: list[tuple[int, ...]]) -> None:
        """Carry on the best repair to each of the goals."""
        entries, digests = {}, {}
        for goal in goals:
            found = cheapest(self.steps, self.entries, goal)
            if found is None:
                continue
            cost, audit, start, end = found
            digest = self.digests[start].copy()
            for state, _, role, text in replay(self.steps, audit[len(self.entries[start][1]) :], start):
                digest.update(f"{'' if state == EMPTY else chr(10)}{role}:{text}".encode())
            entries[end], digests[end] = (cost, audit), digest
        shared, least = commonprefix([audit for _, audit in entries.values()]), min(cost for cost, _ in entries.values())
        self.settled.append(shared)
        self.paid += least
        self.entries = {state: (cost - least, audit[len(shared) :]) for state, (cost, audit) in entries.items()}
        self.digests, self.steps = digests, []

    def result(self) -> tuple:
        gaps = 0 if self.first is None else min(self.last - self.first + 1 - self.turns, LARGEST)
        self.close_block([GOALS])
        ((state, (cost, audit)),) = self.entries.items()
        audit = "".join([*self.settled, audit])
        counts = (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.paid + cost)
        return (self.key, *counts, audit, self.digests[state].hexdigest())


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows as a seeded fault leaves them, with ``copies``: 0 for those that it drops, which still name their conversation."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn)]
    fate = F.crc32(F.concat(named[0], F.lit(":"), named[1]).cast("binary")) % 20
    whole_role, whole_text = (F.coalesce(F.col(c), F.lit(" ")) for c in (role, text))
    return rows.select(
        F.col(conv).alias(conv),
        F.col(turn).alias(turn),
        F.when(fate == 4, "user").otherwise(whole_role).alias(role),
        F.when(fate == 1, "").when(fate == 2, F.regexp_replace(whole_text, "[.!?]", "")).otherwise(whole_text).alias(text),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).cast("bigint").alias("copies"),
    )


def _in_order(rows: DataFrame, conv: str, turn: str, role: str, text: str, copies: Column) -> DataFrame:
    """Distinct rows with their copies and faults, those of a conversation together and in order.

    Rows without copies become one without a role, so that a conversation of which nothing is left is still there.
    """
    there = copies > 0
    plain = rows.select(
        F.col(conv).alias("conv"),
        F.when(there, F.col(turn)).alias("turn"),
        F.when(there, F.coalesce(F.col(role), F.lit(" "))).alias("role"),
        F.when(there, F.coalesce(F.col(text), F.lit(" "))).alias("text"),
        F.greatest(copies, F.lit(0)).cast("bigint").alias("copies"),
    )
    merged = plain.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    together = merged.repartition("conv")
    earlier = Window.partitionBy("conv", "role", "text").orderBy(F.asc_nulls_first("turn"))
    ended = F.rtrim("text", F.lit(BLANKS))
    judged = together.select(
        "*",
        (ended == "").alias("blank"),
        (F.row_number().over(earlier) > 1).alias("seen"),
        (~F.right(ended, F.lit(1)).isin(".", "!", "?")).alias("cut_off"),
    )
    return judged.sortWithinPartitions("conv", F.asc_nulls_first("turn"), F.asc_nulls_first("role"), "text")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def repair(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: str | None = None
) -> DataFrame:
    """Per conversation: its faults, the least cost, the edits (``audit``) and the digest of what they leave.

    ``copies`` names a column with how often a row is there, 0 included.
    """
    kind = dict(rows.select(F.col(conv).alias("conv")).dtypes)["conv"]
    names = ["conv", *COUNTS, "audit", "repaired_sha256"]
    schema = f"conv {kind}, {', '.join(f'{c} bigint' for c in COUNTS)}, audit string, repaired_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        results, held, current, key_type = [], 0, None, None

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*results))
            types = [key_type, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            key_type = batch.schema.field(0).type
            for key, turn_, role_, text_, n, blank, seen, cut_off in _records([batch]):
                if current is None or current.key != key:
                    if current is not None:
                        results.append(current.result())
                        held += len(results[-1][-2]) + 200
                    current = Conversation(key)
                if role_ is not None:
                    current.add(turn_, role_, text_, n, blank, seen, cut_off)
                if held > RESULTS_AT_ONCE:
                    yield flushed()
                    results, held = [], 0
        if current is not None:
            results.append(current.result())
            yield flushed()

    ordered = _in_order(rows, conv, turn, role, text, F.col(copies) if copies else F.lit(1))
    found = ordered.mapInArrow(run, schema)
    return found.select(F.col("conv").alias(conv), *names[1:])


def repaired_rows(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: str | None = None
) -> DataFrame:
    """The rows that the repair leaves, with their ``place`` from 0 and ``edit``."""
    kind = dict(rows.select(F.col(conv).alias("conv")).dtypes)["conv"]
    given = F.col(copies) if copies else F.lit(1)
    ordered = _in_order(rows, conv, turn, role, text, given).where("role is not null")
    audits = repair(rows, conv, turn, role, text, copies).select(F.col(conv).alias("conv"), "audit")
    audits = audits.select("conv", F.lit(True).alias("heads"), "audit")
    both = ordered.withColumn("heads", F.lit(False)).unionByName(audits, allowMissingColumns=True).repartition("conv")
    both = both.sortWithinPartitions("conv", F.desc("heads"), F.asc_nulls_first("turn"), "role", "text")
    both = both.select("conv", "heads", "audit", "role", "text", "copies", "blank", "seen", "cut_off")

    def steps(records: Iterator[tuple]) -> Iterator[Step]:
        for _, _, _, role_, text_, n, blank, seen, cut_off in records:
            if blank or seen:
                yield Step(role_, "", True, False, n)
            else:
                yield Step(role_, text_, False, cut_off)
                if n > 1:
                    yield Step(role_, "", True, False, n - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list = []

        def noted() -> Iterator[tuple]:
            for batch in batches:
                types[:] = [batch.schema.field(0).type]
                yield from _records([batch])

        out, held = [], 0
        for key, records in groupby(noted(), key=lambda r: r[0]):
            audit = next(records)[2]
            for place, (_, edit, role_, text_) in enumerate(replay(steps(records), audit, EMPTY)):
                out.append((key, place, role_, text_, edit))
                held += len(text_) + 100
                if held > RESULTS_AT_ONCE:
                    yield _rows_out(out, types[0])
                    out, held = [], 0
        if out:
            yield _rows_out(out, types[0])

    found = both.mapInArrow(run, f"conv {kind}, place bigint, role string, text string, edit string")
    return found.select(F.col("conv").alias(conv), "place", F.col("role").alias(role), F.col("text").alias(text), "edit")


def _rows_out(rows: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
    types = [key_type, pa.int64(), pa.string(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["conv", "place", "role", "text", "edit"])
