"""Repair of the structure of conversations, with an audit of the edits.

A conversation is legal if it has at most one system turn, at its beginning, and then pairs of
a user's and an assistant's turn, at least one.  A dynamic programme over the states of this
rule finds the cheapest edits: keep a turn, give it another role, delete it or insert an empty one.  The
edits' initials are the audit; of the cheapest audits the least one counts.  Audits are not stored
as texts: each is a node that is linked to the one it continues, so all share their
beginnings.  A node has its ancestors at distances of powers of two and a rolling hash, so two audits of
the same cost are compared by searching their longest common prefix in logarithmic
time; since hashes can collide, the prefix that they claim is verified letter by letter down to what is
linked in common, and linked in common from then on.

Turns are counted first, so a turn that comes a million times is one row; turns seen earlier are found by
digests.  Rows are then sorted over ranges of (conversation, turn), whatever the size of a
conversation.  One that lies within a range and has at most ``BLOCK`` turns is repaired at once.  Any other is
cut into blocks: each is solved from every state to every state, and these small tables are folded in
order, by conversation.  Only costs and audits pass there; the texts are edited block by block.

Faults and costs: a blank turn (no character but white space) and one whose role and text
came earlier must be deleted (2); giving another role costs 1, inserting 5; a truncated turn (its last
character but white space is none of ``.!?``) costs 5 more if it is not deleted.

Defined cases: null roles, texts and, in the seed of the damage, ids and turn numbers are one space; a null
id is a conversation of its own; rows are ordered by turn (nulls first), role and text; a kept turn with an empty role
leaves the state as it is; a conversation without rows, or all of whose turns are deleted, is legal and
empty; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks.llm.common import CRC32_CHECKS, crc32_sql, handing_back
from claimworks.plans.workspace import write_lookup, write_table

WHITE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
# States: nothing yet, after the system's turn, after the user's, after the assistant's (fixed values).
NOTHING, SYSTEM, USER, ASSISTANT = STATES = range(4)
LEGAL_ENDS = (NOTHING, ASSISTANT)
STEPS = {
    (NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER,
}
# The only turn that may be inserted, or made by another role, in each state.
NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL_NEIGHBOURS = ("su", "ua", "au")
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5  # costs
BLOCK = 1024  # turns
BLOCK_CHARS = 4_000_000
BLANK, DUPLICATE, CUT_OFF, SOUND = "b", "d", "t", ""
MODULUS, BASE = 2**61 - 1, 1_000_003


class Audits:
    """Audits as nodes that continue one another; node 0 is the empty audit."""

    def __init__(self, modulus: int = MODULUS) -> None:
        self.modulus = modulus
        self.parent, self.letter, self.depth, self.hash = [0], [""], [0], [0]
        self.up: list[list[int]] = [[]]  # ancestors 1, 2, 4, ... letters before

    def add(self, parent: int, letter: str) -> int:
        node = len(self.parent)
        self.parent.append(parent)
        self.letter.append(letter)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * BASE + ord(letter)) % self.modulus)
        self.up.append(self._ancestors(parent))
        return node

    def _ancestors(self, parent: int) -> list[int]:
        up, found, k = self.up, [parent], 0
        while k < len(up[found[k]]):
            found.append(up[found[k]][k])
            k += 1
        return found

    def text(self, node: int) -> str:
        letters = []
        while node:
            letters.append(self.letter[node])
            node = self.parent[node]
        return "".join(reversed(letters))

    def ancestor(self, node: int, depth: int) -> int:
        """The beginning of ``depth`` letters."""
        while self.depth[node] > depth:
            distance = self.depth[node] - depth
            node = self.up[node][distance.bit_length() - 1]
        return node

    def _same(self, a: int, b: int) -> bool:
        """Whether two audits of one length with one hash are equal in every letter."""
        first_a, first_b = a, b
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.parent[a], self.parent[b]
        if first_a != first_b:
            # equal audits continue the same node from now on
            self.parent[first_a] = self.parent[first_b]
            self.up[first_a] = self.up[first_b]
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether audit ``a`` comes before ``b``."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        hashes, up = self.hash, self.up
        if hashes[x] == hashes[y]:
            if not self._same(x, y):
                return self.text(a) < self.text(b)
            return self.depth[a] < self.depth[b]
        # climb past the longest differing ends, keeping to nodes that differ
        for k in range(len(up[x]) - 1, -1, -1):
            if k < len(up[x]) and hashes[up[x][k]] != hashes[up[y][k]]:
                x, y = up[x][k], up[y][k]
        if not self._same(self.parent[x], self.parent[y]):
            return self.text(a) < self.text(b)
        return self.letter[x] < self.letter[y]


Step = tuple[str, str]  # a turn's role initial and fault
Table = dict[int, tuple[int, str]]  # state at the end -> cost and audit of the cheapest edits


def cheapest_edits(turns: list[Step], start: int = NOTHING, modulus: int = MODULUS) -> Table:
    """Cost and least audit of the cheapest edits of ``turns`` from ``start`` to each state."""
    audits = Audits(modulus)
    best: dict[int, tuple[int, int]] = {}

    def offer(held: dict[int, tuple[int, int]], state: int, cost: int, parent: int, letter: str) -> bool:
        known = held.get(state)
        if known is not None and known[0] < cost:
            return False
        node = audits.add(parent, letter)
        if known is not None and known[0] == cost and not audits.less(node, known[1]):
            return False
        held[state] = cost, node
        return True

    def insertions(held: dict[int, tuple[int, int]]) -> None:
        changed = list(held)
        while changed:
            state = changed.pop()
            cost, node = held[state]
            if offer(held, NEXT[state], cost + INSERT, node, "I"):
                changed.append(NEXT[state])

    best[start] = 0, 0
    insertions(best)
    for initial, fault in turns:
        after: dict[int, tuple[int, int]] = {}
        more = TRUNCATED if fault == CUT_OFF else 0
        for state, (cost, node) in best.items():
            offer(after, state, cost + DELETE, node, "D")
            if fault in (BLANK, DUPLICATE):
                continue
            kept = STEPS.get((state, initial)) if initial else state
            if kept is not None:
                offer(after, kept, cost + more, node, "K")
            offer(after, NEXT[state], cost + REROLE + more, node, "R")
        insertions(after)
        best = after
    return {state: (cost, audits.text(node)) for state, (cost, node) in best.items()}


def edited(turns: list[tuple[str, str]], audit: str, state: int) -> tuple[list[dict], int]:
    """The repaired turns that an audit makes of (role, text) rows, and the state after them."""
    rows, found = iter(turns), []
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        if letter == "K":
            state = STEPS[state, role[0]] if role else state
        else:
            state = NEXT[state]
            role = NAMES[state]
        found.append({"edit": letter, "role": role, "text": text})
    return found, state


@dataclass
class Figures:
    """What is counted of a run of turns; two runs that follow one another add up."""

    rows: int = 0
    least: int | None = None
    most: int | None = None
    distinct: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: str = ""
    last: str = ""

    def __add__(self, other: Figures) -> Figures:
        if not self.rows or not other.rows:
            return self if self.rows else other
        meet = self.most is not None and self.most == other.least
        return Figures(
            self.rows + other.rows,
            other.least if self.least is None else self.least,
            self.most if other.most is None else other.most,
            self.distinct + other.distinct - meet,
            self.blank + other.blank, self.duplicate + other.duplicate, self.truncated + other.truncated,
            self.illegal + other.illegal + (self.last + other.first not in LEGAL_NEIGHBOURS),
            self.first, other.last,
        )

    @property
    def gaps(self) -> int:
        return 0 if self.least is None else self.most - self.least + 1 - self.distinct

    @classmethod
    def of(cls, turn: int | None, initial: str, fault: str) -> Figures:
        return cls(
            1, turn, turn, int(turn is not None), int(fault == BLANK), int(fault == DUPLICATE), int(fault == CUT_OFF),
            0, initial, initial,
        )


NAMED = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
TURNS = "array<struct<edit: string, role: string, text: string>>"
# A whole conversation has its ``audit``; a block of a longer one has ``tables``, for each state at its
# start the states at its end, costs and audits, and its turns as they were.
RUN = "struct<rows: long, least: long, most: long, distinct: long, blank: long, duplicate: long, truncated: long, \
illegal: long, first: string, last: string>"
TABLES = "array<struct<start: int, end: int, cost: long, audit: string>>"
SOLVED = f"conv_id long, part int, no int, run {RUN}, cost long, audit string, tables {TABLES}, turns {TURNS}"


@dataclass
class Gathered:
    """Turns of one conversation that are not solved yet."""

    conv_id: int | None
    at_border: bool  # whether the range before may hold turns of it
    blocks: int = 0
    figures: Figures = field(default_factory=Figures)
    steps: list[Step] = field(default_factory=list)
    turns: list[tuple[str, str]] = field(default_factory=list)
    chars: int = 0

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        initial = role[:1]
        self.figures += Figures.of(turn, initial, fault)
        self.steps.append((initial, fault))
        # what must be deleted needs no text
        gone = fault in (BLANK, DUPLICATE)
        self.turns.append((role, "" if gone else text))
        self.chars += 0 if gone else len(text)

    def _record(self, part: int, **values) -> dict:
        record = {"conv_id": self.conv_id, "part": part, "no": self.blocks, "run": vars(self.figures)}
        return {**dict.fromkeys(("cost", "audit", "tables")), **record, **values}

    def whole(self, part: int) -> dict:
        cost, audit = finished(cheapest_edits(self.steps))
        return self._record(part, cost=cost, audit=audit, turns=edited(self.turns, audit, NOTHING)[0])

    def block(self, part: int) -> dict:
        tables = [
            {"start": start, "end": end, "cost": cost, "audit": audit}
            for start in STATES
            for end, (cost, audit) in cheapest_edits(self.steps, start).items()
        ]
        turns = [{"edit": None, "role": role, "text": text} for role, text in self.turns]
        record = self._record(part, tables=tables, turns=turns)
        self.blocks += 1
        self.figures, self.steps, self.turns, self.chars = Figures(), [], [], 0
        return record


def finished(table: Table) -> tuple[int, str]:
    """The cheapest legal edits."""
    return min(table[state] for state in LEGAL_ENDS if state in table)


def _solver(schema: pa.Schema, size: int):
    def records(batches: Iterator[pa.RecordBatch], part: int) -> Iterator[dict]:
        held: Gathered | None = None
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("conv_id", "turn", "role", "text", "copies", "fault")]
            for conv_id, turn, role, text, copies, fault in zip(*columns):
                if held is None or held.conv_id != conv_id:
                    if held is not None:
                        alone = not held.at_border and not held.blocks
                        yield held.whole(part) if alone else held.block(part)
                    held = Gathered(conv_id, at_border=held is None)
                for copy in range(copies):
                    if len(held.steps) >= size or held.chars >= BLOCK_CHARS:
                        yield held.block(part)
                    again = BLANK if fault == BLANK else DUPLICATE
                    held.add(turn, role, text, again if copy else fault)
        if held is not None:
            yield held.block(part)  # the range after may go on with it

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, waiting, chars = TaskContext.get().partitionId(), [], 0
        for record in records(batches, part):
            waiting.append(record)
            chars += sum(len(turn["text"]) for turn in record["turns"])
            if len(waiting) >= 1000 or chars > BLOCK_CHARS:
                yield pa.RecordBatch.from_pylist(waiting, schema)
                waiting, chars = [], 0
        if waiting:
            yield pa.RecordBatch.from_pylist(waiting, schema)

    return run


@dataclass(frozen=True)
class Chosen:
    """The cheapest edits of the blocks so far, the last one's first."""

    before: Chosen | None
    start: int
    cost: int  # of all
    audit: str  # of the last one

    def whole(self, until: Chosen | None = None) -> str:
        pieces, at = [], self
        while at is not until:
            pieces.append(at.audit)
            at = at.before
        return "".join(reversed(pieces))

    def key(self, other: Chosen) -> tuple[int, str]:
        """Orders this choice against another one of as many blocks, by what they do not share."""
        a, b = self, other
        while a is not b:
            a, b = a.before, b.before
        return self.cost, self.whole(a)


def fold_blocks(blocks: Iterator[list[dict]]) -> list[Chosen]:
    """The choice of each block; takes the blocks' tables in order."""
    best: dict[int, Chosen | None] = {NOTHING: None}
    for tables in blocks:
        after: dict[int, Chosen] = {}
        for row in tables:
            if row["start"] not in best:
                continue
            before = best[row["start"]]
            cost = row["cost"] + (before.cost if before else 0)
            held = after.get(row["end"])
            if held is None or cost <= held.cost:
                new = Chosen(before, row["start"], cost, row["audit"])
                if held is None or cost < held.cost or new.key(held) < held.key(new):
                    after[row["end"]] = new
        best = after
    ends = [best[state] for state in LEGAL_ENDS if state in best]
    at = ends[0] if len(ends) == 1 or ends[0].key(ends[1]) <= ends[1].key(ends[0]) else ends[1]
    chosen = []
    while at is not None:
        chosen.append(at)
        at = at.before
    return chosen[::-1]


CHOICES = f"conv_id long, part int, no int, block int, blocks int, {', '.join(f'{n} long' for n in NAMED)}, \
start int, audit string"


def _folder(schema: pa.Schema):
    def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["conv_id"] != row["conv_id"]:
                    yield held
                    held = []
                held.append(row)
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blocks in conversations(batches):
            chosen = fold_blocks(block["tables"] for block in blocks)
            figures = Figures()
            for block in blocks:
                figures += Figures(**block["run"])
            counted = {name: getattr(figures, name) for name in NAMED[:-1]}
            for k in range(0, len(blocks), 100):
                rows = [
                    {
                        "conv_id": block["conv_id"], "part": block["part"], "no": block["no"], "block": k + i,
                        "blocks": len(blocks), **counted, "cost": chosen[-1].cost, "start": choice.start,
                        "audit": choice.audit,
                    }
                    for i, (block, choice) in enumerate(zip(blocks[k : k + 100], chosen[k : k + 100]))
                ]
                yield pa.RecordBatch.from_pylist(rows, schema)

    return run


REPAIRED = f"conv_id long, block int, blocks int, {', '.join(f'{n} long' for n in NAMED)}, audit string, turns {TURNS}"


def _editor(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rows = [(turn["role"], turn["text"]) for turn in row["turns"]]
                row["turns"] = edited(rows, row["audit"], row["start"])[0]
                yield pa.RecordBatch.from_pylist([{name: row[name] for name in schema.names}], schema)

    return run


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies after the damage that the hash of conversation and turn
    decides: a row dropped (0 copies), emptied, stripped of its sentence ends, repeated (2) or made the
    user's."""
    space = F.lit(" ")
    key = F.concat_ws(
        ":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space)
    )
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(name).cast("string"), space) for name in ("role", "text"))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _with_faults(turns: DataFrame) -> DataFrame:
    """Distinct turns with their copies and first fault; a conversation without any has a row without a role."""
    there, space = F.col("copies") > 0, F.lit(" ")
    kept = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.when(there, F.col("turn").cast("long")).alias("turn"),
        *[F.when(there, F.coalesce(F.col(name).cast("string"), space)).alias(name) for name in ("role", "text")],
        "copies",
    )
    counted = kept.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    ended = F.rtrim("text", F.lit(WHITE))
    digest = F.unhex(F.sha2("text", 256))
    rows = write_table(counted.withColumns({"ended": F.right(ended, F.lit(1)), "digest": digest}), "audit-turns")
    order = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn")
    met = rows.filter(F.col("copies") > 0).groupBy("conv_id", "role", "digest")
    repeats = met.agg(F.count(F.lit(1)).alias("turns"), F.min(order).alias("earliest")).filter("turns > 1")
    renamed = repeats.select(
        F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"),
        F.col("earliest.turn").alias("_turn"), F.lit(True).alias("_repeats"),
    )
    lookup = write_lookup(renamed, "audit-repeats")
    known = F.broadcast(lookup.frame) if lookup.fits_broadcast() else lookup.frame
    same = (
        F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role"))
        & (F.col("digest") == F.col("_digest"))
    )
    later = F.col("_repeats") & ~F.col("turn").eqNullSafe(F.col("_turn"))
    fault = (
        F.when(F.col("ended") == "", BLANK).when(later, DUPLICATE)
        .when(~F.col("ended").isin(*ENDS), CUT_OFF).otherwise(SOUND)
    )
    joined = rows.join(known, same, "left")
    return joined.select("conv_id", "turn", "role", "text", "copies", fault.alias("fault"))


def repair(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """The repaired conversations in blocks: conv_id, block, blocks; the figures and the cost of the whole
    conversation; the block's part of the audit and its repaired turns.

    ``turns`` has conv_id, turn, role, text and copies; 0 copies only say that there is such a
    conversation.  Most conversations are one block.
    """
    spark = turns.sparkSession
    arrow = lambda ddl: spark.createDataFrame([], ddl).toArrow().schema
    begin = F.substring("text", 1, 64)
    ranged = _with_faults(turns).repartitionByRange("conv_id", "turn", "role", begin)
    ordered = ranged.sortWithinPartitions("conv_id", "turn", "role", "text")
    solved = write_table(ordered.mapInArrow(handing_back(_solver(arrow(SOLVED), block)), SOLVED), "audit-blocks")

    whole = solved.filter(F.col("tables").isNull())
    gaps = F.coalesce(F.col("run.most") - F.col("run.least") + 1 - F.col("run.distinct"), F.lit(0))
    one = whole.select(
        "conv_id", F.lit(0).alias("block"), F.lit(1).alias("blocks"), gaps.alias("gaps"),
        *[F.col(f"run.{name}") for name in NAMED[1:-1]], "cost", "audit", "turns",
    )
    cut = solved.filter(F.col("tables").isNotNull())
    tables = cut.select("conv_id", "part", "no", "run", "tables")
    in_order = tables.repartition("conv_id").sortWithinPartitions("conv_id", "part", "no")
    choices = write_table(in_order.mapInArrow(handing_back(_folder(arrow(CHOICES))), CHOICES), "audit-choices")
    # a block is found by its range and number, so those of one conversation are spread
    texts = cut.select(F.col("part").alias("_part"), F.col("no").alias("_no"), F.col("conv_id").alias("_conv"), "turns")
    same = (
        (F.col("part") == F.col("_part")) & (F.col("no") == F.col("_no")) & F.col("conv_id").eqNullSafe(F.col("_conv"))
    )
    many = choices.join(texts, same).select(*[n for n in choices.columns if n not in ("part", "no")], "turns")
    return one.unionByName(many.mapInArrow(handing_back(_editor(arrow(REPAIRED))), REPAIRED))


def _line(turn: dict) -> str:
    return f"{turn['role']}:{turn['text']}"


DIGESTS = f"conv_id long, {', '.join(f'{n} long' for n in NAMED)}, audit string, repaired_sha256 string"


def _digester(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] == 0:
                    digest, any_line, audit = hashlib.sha256(), False, []
                audit.append(row["audit"])
                for turn in row["turns"]:
                    digest.update((("\n" if any_line else "") + _line(turn)).encode())
                    any_line = True
                if row["block"] == row["blocks"] - 1:
                    found = {**row, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}
                    yield pa.RecordBatch.from_pylist([{name: found[name] for name in schema.names}], schema)

    return run


def digests(repaired: DataFrame) -> DataFrame:
    """One row per conversation: its figures, audit and the digest of its repaired turns.

    A digest of one text is sequential by definition: the blocks of a long conversation pass one task,
    one after the other, and are not held.
    """
    lines = F.transform("turns", lambda turn: F.concat(turn["role"], F.lit(":"), turn["text"]))
    one = repaired.filter(F.col("blocks") == 1).select(
        "conv_id", *NAMED, "audit", F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256")
    )
    schema = repaired.sparkSession.createDataFrame([], DIGESTS).toArrow().schema
    many = repaired.filter(F.col("blocks") > 1).repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return one.unionByName(many.mapInArrow(handing_back(_digester(schema)), DIGESTS))


def audit_conversations(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """:func:`digests` of the repaired conversations after :func:`damaged`."""
    return digests(repair(damaged(conversations), block))


def oracle_sql() -> str:
    """DuckDB SQL for :func:`audit_conversations` over the conversations table: the same rule as a recursion over
    turns whose four states are (cost, audit, lines) in that order."""
    code = "list_transform(string_split(key, ''), lambda c: unicode(c))"  # of ASCII
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    line = "role || ':' || text"

    def go(state: str, cost: str, letter: str, lines: str) -> str:
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'l': {lines}}}"

    def when(condition: str, value: str) -> str:
        return f"case when {condition} then {value} end"

    def drop(state: str) -> str:
        return when(f"{state} is not null", go(state, str(DELETE), "D", f"{state}.l"))

    def keep(state: str, initial: str) -> str:
        return when(
            f"{state} is not null and not forced and initial = '{initial}'",
            go(state, "more", "K", f"list_append({state}.l, {line})"),
        )

    def rerole(state: str, name: str) -> str:
        return when(
            f"{state} is not null and not forced",
            go(state, f"more + {REROLE}", "R", f"list_append({state}.l, '{name}:' || text)"),
        )

    def insert(state: str, name: str) -> str:
        return when(f"{state} is not null", go(state, str(INSERT), "I", f"list_append({state}.l, '{name}:')"))

    def least(*values: str) -> str:
        return f"list_min(list_filter([{', '.join(values)}], lambda x: x is not null))"

    none = "null::struct(c bigint, a varchar, l varchar[])"
    begin = "{'c': 0::bigint, 'a': '', 'l': []::varchar[]}"
    moved = [
        least(drop("n"), keep("n", "")),
        least(drop("s"), keep("n", "s"), keep("s", "")),
        least(
            drop("u"), keep("u", ""), *[keep(x, "u") for x in "nsa"], *[rerole(x, "user") for x in "nsa"],
        ),
        least(drop("a"), keep("a", ""), keep("u", "a"), rerole("u", "assistant")),
    ]
    inserted = least("u", *[insert(x, "user") for x in "nsa"])
    return f"""
with recursive {CRC32_CHECKS},
keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key
  from conversations),
hashed as (
  select *, {crc32_sql(code)} % 20 as kind
  from keyed, checks),
harmed as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
         case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
         unnest(range(case kind when 0 then 0 when 3 then 2 else 1 end)) as copy
  from hashed),
placed as (
  select *, rtrim(text, {white}) as ended, left(role, 1) as initial,
         row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as place,
         row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as met
  from harmed),
judged as (
  select *, ended = '' as blank, ended <> '' and met > 1 as duplicate,
         ended <> '' and met = 1 and right(ended, 1) not in ('.', '!', '?') as truncated,
         (lag(initial) over (partition by conv_id order by place) || initial) not in ('su', 'ua', 'au') as illegal
  from placed),
figures as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count_if(blank) as blank,
         count_if(duplicate) as duplicate, count_if(truncated) as truncated,
         count_if(illegal) as illegal, count(*) as rows
  from judged group by conv_id),
turns as (
  select conv_id, place, role, text, initial, blank or duplicate as forced,
         case when truncated then {TRUNCATED} else 0 end as more
  from judged),
walk as (
  select conv_id, 0::bigint as place, {begin} as n, {none} as s,
         {{'c': {INSERT}::bigint, 'a': 'I', 'l': ['user:']}} as u,
         {{'c': {2 * INSERT}::bigint, 'a': 'II', 'l': ['user:', 'assistant:']}} as a
  from figures
  union all
  select conv_id, place, n, s, u, {least('a', insert('u', 'assistant'))} as a
  from (
    select conv_id, place, n, s, {inserted} as u, a
    from (
      select t.conv_id, t.place, {moved[0]} as n, {moved[1]} as s, {moved[2]} as u, {moved[3]} as a
      from walk w join turns t on w.conv_id is not distinct from t.conv_id and t.place = w.place + 1))),
ends as (
  select w.conv_id, f.gaps, f.blank, f.duplicate, f.truncated, f.illegal, {least('n', 'a')} as best
  from walk w join figures f on w.conv_id is not distinct from f.conv_id and w.place = f.rows)
select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0)::bigint as blank,
       coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
       coalesce(illegal, 0)::bigint as illegal, coalesce(best.c, 0) as cost,
       coalesce(best.a, '') as audit, sha256(coalesce(array_to_string(best.l, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) c left join ends e on c.conv_id is not distinct from e.conv_id"""
