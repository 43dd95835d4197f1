"""Chat formatting: minimum-cost repair of the roles, then rendering.

Legal conversations are ``system? (user assistant)+``.  For every turn a dynamic programme
over the states of that automaton chooses to keep it, to merge it into the turn before, to
relabel it, and to insert empty turns before it; the last turn must be the assistant's.  The
cheapest path is rendered, one segment per input turn: the segments of a conversation in
order are its text.

A step is a matrix over (min, +), so a conversation need not be in one place.  Turns are
range-partitioned by (conv_id, turn): a conversation that holds a third of all rows is spread
over many partitions.  One pass reduces each partition's part of each conversation to a
matrix of four by four.  The matrices of a conversation (one small row per partition and
conversation) are folded in order, its last state is chosen, and a walk back over the parts
fixes one state at every border, which both neighbours use; a second pass traces each part
back between its two states.  No task holds more than one part.  With every matrix goes the
order of its equally cheap paths, so the repair does not depend on where the parts end.

Defined cases: unknown, null or empty roles must be relabelled, at the cost of any other
relabel (case and blanks around a role are ignored); a null text is an empty one; rows
without a conversation or a turn number keep a place: nulls sort first; repeated (conv_id,
turn) rows are separate turns in the order of role and text; ties between repairs go to
keep, then merge, then relabel, then insertion, and between states to the first in the order
of ``ROLES``, from the last turn back; a conversation without turns does not appear; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks.plans.workspace import write_table

# States: nothing yet, and the role of the last turn.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
# Turns that may follow directly (fixed by the format).
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
# Names that mean one of the three roles (fixed values).
ALIASES = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}
KEEP, MERGE, RELABEL = "keep", "merge", "relabel"
INF = float("inf")


@dataclass(frozen=True)
class Costs:
    merge: float = 1.0
    relabel: float = 2.0
    insert: float = 3.0


@dataclass(frozen=True)
class Template:
    """Texts around a turn."""

    before: str = "<|im_start|>{role}\n"
    after: str = "<|im_end|>\n"
    between: str = "\n"  # between merged turns


@dataclass(frozen=True)
class Step:
    cost: float
    action: str
    role: int  # of the turn, after the repair
    inserted: tuple[int, ...]  # empty turns before it


def _paths(state: int) -> list[tuple[int, ...]]:
    """Shortest runs of empty turns that may be inserted after ``state``, with ``()``."""
    out, seen, edge = [()], {state}, [((), state)]
    while edge:
        fresh = []
        for path, at in edge:
            for role in NEXT[at]:
                if role not in seen:
                    seen.add(role)
                    out.append((*path, role))
                    fresh.append(((*path, role), role))
        edge = fresh
    return out


@lru_cache
def steps(role: int, costs: Costs) -> dict[tuple[int, int], Step]:
    """The cheapest step for a turn of ``role`` (0: unknown), by (state before, after)."""
    best: dict[tuple[int, int], Step] = {}
    for state in range(4):
        options = []
        if state != START:
            options.append(
                Step(costs.merge + (costs.relabel if role != state else 0), MERGE, state, ())
            )
        for inserted in _paths(state):
            at = inserted[-1] if inserted else state
            for target in NEXT[at]:
                options.append(
                    Step(
                        len(inserted) * costs.insert + (costs.relabel if target != role else 0),
                        KEEP if target == role else RELABEL, target, inserted,
                    )
                )
        rank = {KEEP: 0, MERGE: 1, RELABEL: 2}
        for option in sorted(options, key=lambda s: (s.cost, len(s.inserted), rank[s.action], s.inserted)):
            best.setdefault((state, option.role), option)
    return best


def ending(state: int, costs: Costs) -> tuple[float, tuple[int, ...]]:
    """Cost and empty turns that make ``state`` a legal end."""
    if state == ASSISTANT:
        return 0.0, ()
    path = next(p for p in _paths(state) if p and p[-1] == ASSISTANT)
    return len(path) * costs.insert, path


def role_number(role: str | None) -> int:
    return ALIASES.get((role or "").strip().lower(), START)


@lru_cache
def _matrices(costs: Costs) -> np.ndarray:
    """Step costs by role, state before and state after."""
    out = np.full((4, 4, 4), INF)
    for role in range(4):
        for (a, b), step in steps(role, costs).items():
            out[role, a, b] = step.cost
    return out


def _unit() -> np.ndarray:
    return np.where(np.eye(4, dtype=bool), 0.0, INF)


@dataclass(frozen=True)
class Part:
    """Costs of a run of turns by state before and after.

    ``order`` ranks, for each state after, the cheapest paths from the states before as
    :func:`trace` would: by the states they pass, from the last one back.
    """

    costs: np.ndarray
    order: np.ndarray

    @staticmethod
    def empty() -> Part:
        return Part(_unit(), np.repeat(np.arange(4)[:, None], 4, axis=1))

    def then(self, step: np.ndarray) -> Part:
        """The run with one more turn."""
        total = self.costs[:, :, None] + step[None, :, :]
        through = total.argmin(axis=1)
        rank = through * 4 + np.take_along_axis(self.order, through, axis=1)
        return Part(total.min(axis=1), rank.argsort(axis=0).argsort(axis=0))


def borders(parts: list[Part], costs: Costs) -> list[int]:
    """The state before each part of a conversation, and the last one."""
    before = [_unit()[START]]
    for part in parts:
        before.append((before[-1][:, None] + part.costs).min(axis=0))
    states = [int((before[-1] + [ending(s, costs)[0] for s in range(4)]).argmin())]
    for enter, part in zip(before[-2::-1], parts[::-1]):
        total = enter + part.costs[:, states[-1]]
        cheapest = np.where(total == total.min(), part.order[:, states[-1]], 4)
        states.append(int(cheapest.argmin()))
    return states[::-1]


def trace(roles: list[int], enter: np.ndarray, leave: np.ndarray, costs: Costs) -> list[tuple[int, Step]]:
    """The cheapest (state before, step) of each turn.

    ``enter`` and ``leave`` are the costs of all that comes before and after, by state.
    """
    matrices = _matrices(costs)
    best, back = enter.copy(), np.zeros((len(roles), 4), np.int8)
    for k, role in enumerate(roles):
        total = best[:, None] + matrices[role]
        back[k] = total.argmin(axis=0)
        best = total.min(axis=0)
    state = int((best + leave).argmin())
    out: list[tuple[int, Step]] = []
    for k in range(len(roles) - 1, -1, -1):
        before = int(back[k, state])
        out.append((before, steps(roles[k], costs)[before, state]))
        state = before
    return out[::-1]


def repair(roles: list[str | None], costs: Costs = Costs()) -> tuple[float, list[tuple[int, Step]]]:
    """Cost and steps of one conversation in memory."""
    numbers = [role_number(r) for r in roles]
    enter = _unit()[START]
    leave = np.array([ending(s, costs)[0] for s in range(4)])
    found = trace(numbers, enter, leave, costs)
    last = found[-1][1].role if found else START
    return sum(s.cost for _, s in found) + ending(last, costs)[0], found


def segment(before: int, step: Step, text: str, last: bool, costs: Costs, template: Template) -> str:
    """What the turn adds to the rendering; the last one also ends it."""
    start = lambda role: template.before.format(role=ROLES[role])
    if step.action == MERGE:
        out = template.between + text
    else:
        out = template.after if before != START else ""
        out += "".join(start(r) + template.after for r in step.inserted) + start(step.role) + text
    if last:
        out += template.after
        out += "".join(start(r) + template.after for r in ending(step.role, costs)[1])
    return out


# --- on tables ------------------------------------------------------------------

OUT_ROWS = 4000  # rows of one output batch


def _runs(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[list[dict]]:
    """The rows of each run of equal keys; rows arrive in order."""
    key, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            now = tuple(row[k] for k in keys)
            if held and now != key:
                yield held
                held = []
            key = now
            held.append(row)
    if held:
        yield held


def _reducer(costs: Costs):
    schema = pa.schema(
        [
            ("part", pa.int32()), ("conv_id", pa.int64()), ("matrix", pa.list_(pa.float64())),
            ("order", pa.list_(pa.int32())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrices, done = _matrices(costs), []
        for turns in _runs(batches, "part", "conv_id"):
            whole = Part.empty()
            for turn in turns:
                whole = whole.then(matrices[role_number(turn["role"])])
            first = turns[0]
            done.append(
                {
                    "part": first["part"], "conv_id": first["conv_id"],
                    "matrix": whole.costs.ravel().tolist(), "order": whole.order.ravel().tolist(),
                }
            )
            if len(done) >= OUT_ROWS:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        yield pa.RecordBatch.from_pylist(done, schema)

    return run


def _bounder(costs: Costs):
    schema = pa.schema(
        [
            ("part", pa.int32()), ("conv_id", pa.int64()), ("enter", pa.int32()),
            ("leave", pa.int32()), ("is_end", pa.bool_()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        for rows in _runs(batches, "conv_id"):
            parts = [
                Part(np.reshape(r["matrix"], (4, 4)), np.reshape(r["order"], (4, 4))) for r in rows
            ]
            states = borders(parts, costs)
            for k, row in enumerate(rows):
                done.append(
                    {
                        "part": row["part"], "conv_id": row["conv_id"], "enter": states[k],
                        "leave": states[k + 1], "is_end": k == len(rows) - 1,
                    }
                )
            if len(done) >= OUT_ROWS:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        yield pa.RecordBatch.from_pylist(done, schema)

    return run


def _ends(parts: DataFrame, costs: Costs) -> DataFrame:
    """States before and after every part of every conversation.

    A conversation has a row per partition it lies in; few lie in more than two.
    """
    gathered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    schema = "part int, conv_id long, enter int, leave int, is_end boolean"
    return gathered.mapInArrow(_bounder(costs), schema)


OUT = (
    "conv_id long, turn long, role string, action string, new_role string, "
    "inserted array<string>, cost double, rendered string"
)
_OUT = pa.schema(
    [
        ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()),
        ("action", pa.string()), ("new_role", pa.string()), ("inserted", pa.list_(pa.string())),
        ("cost", pa.float64()), ("rendered", pa.string()),
    ]
)


def _traced(turns: list[dict], costs: Costs, template: Template) -> Iterator[dict]:
    first, last = turns[0], len(turns) - 1
    enter, leave = _unit()[first["enter"]], _unit()[first["leave"]]
    found = trace([role_number(t["role"]) for t in turns], enter, leave, costs)
    for k, (turn, (before, step)) in enumerate(zip(turns, found)):
        ends = k == last and first["is_end"]
        more, added = ending(step.role, costs) if ends else (0.0, ())
        yield {
            "conv_id": turn["conv_id"], "turn": turn["turn"], "role": turn["role"],
            "action": step.action, "new_role": ROLES[step.role],
            "inserted": [ROLES[r] for r in step.inserted + added], "cost": step.cost + more,
            "rendered": segment(before, step, turn["text"] or "", ends, costs, template),
        }


def _tracer(costs: Costs, template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        for turns in _runs(batches, "part", "conv_id"):
            done += _traced(turns, costs, template)
            if len(done) >= OUT_ROWS:
                yield pa.RecordBatch.from_pylist(done, _OUT)
                done = []
        yield pa.RecordBatch.from_pylist(done, _OUT)

    return run


def format_conversations(
    turns: DataFrame, costs: Costs = Costs(), template: Template = Template()
) -> DataFrame:
    """One row per input turn: its action, role, inserted turns, cost and rendered segment."""
    narrow = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
    )
    order = ["conv_id", "turn", "role", "text"]
    ranged = narrow.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    ranged = write_table(ranged, "chat-turns").select("part", *order)
    # a part of the written table is one range of turns; sorting it again gathers its files
    sorted_parts = ranged.repartition("part").sortWithinPartitions("part", *order)
    schema = "part int, conv_id long, matrix array<double>, order array<int>"
    roles = sorted_parts.select("part", "conv_id", "role")
    parts = write_table(roles.mapInArrow(_reducer(costs), schema), "chat-parts")
    ends = _ends(parts, costs).withColumnsRenamed({"part": "_part", "conv_id": "_conv"})
    joined = ranged.join(
        ends, (F.col("part") == F.col("_part")) & F.col("conv_id").eqNullSafe(F.col("_conv"))
    ).drop("_part", "_conv")
    again = joined.repartition("part").sortWithinPartitions("part", *order)
    return again.mapInArrow(_tracer(costs, template), OUT)
