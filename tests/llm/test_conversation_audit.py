import hashlib
import itertools
import random
import re
import zlib

import pytest

from claimworks.llm import conversation_audit as audit
from claimworks.llm import queries
from oracle_compare import connect, difference

ROWS = "conv_id long, turn long, role string, text string, cost string, part string, block string, copies string"
LEGAL = re.compile(r"(s?(ua)+)?\Z")


@pytest.fixture
def conversations(spark):
    """Rows of (conv_id, turn, role, text), with columns whose names clash."""
    return lambda rows: spark.createDataFrame([(*row, "x", "x", "x", "x") for row in rows], ROWS)


def damage(rows):
    """The rows after damage, by conversation, in order."""
    kept = {row[0]: [] for row in rows}
    for conv_id, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        seed = ":".join(" " if v is None else str(v) for v in (conv_id, turn))
        kind = zlib.crc32(seed.encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        kept[conv_id] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, v in kept.items()}


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        words = text.strip(" \t\n\v\f\r")
        found.append("b" if not words else "d" if (role, text) in seen else "" if words[-1] in ".!?" else "t")
        seen.add((role, text))
    return found


def cheapest(steps):
    """(cost, audit) by trying all edits, with at most two insertions in a row."""
    best, inserted = [None], ["", "u", "a", "uu", "ua", "au", "aa"]

    def go(k, cost, letters, initials):
        if best[0] is not None and cost > best[0][0] or not re.match(r"s?(ua)*u?\Z", initials):
            return
        for new in inserted:
            now = cost + 5 * len(new), letters + "I" * len(new), initials + new
            if k == len(steps):
                if LEGAL.match(now[2]) and (best[0] is None or now[:2] < best[0]):
                    best[0] = now[:2]
                continue
            initial, fault = steps[k]
            go(k + 1, now[0] + 2, now[1] + "D", now[2])
            if fault not in ("b", "d"):
                more = 5 if fault == "t" else 0
                go(k + 1, now[0] + more, now[1] + "K", now[2] + initial)
                for role in "ua":
                    go(k + 1, now[0] + more + 1, now[1] + "R", now[2] + role)

    go(0, 0, "", "")
    return best[0]


def repaired(rows, letters):
    lines, rest, initials = [], iter(rows), ""
    for letter in letters:
        role, text = ("", "") if letter == "I" else next(rest)[1:]
        if letter == "D":
            continue
        if letter != "K":
            role = "assistant" if initials.endswith("u") else "user"
        initials += role[:1]
        lines.append(f"{role}:{text}")
    assert LEGAL.match(initials)
    return "\n".join(lines)


def expected(rows, solve=cheapest):
    found = {}
    for conv_id, kept in damage(rows).items():
        turns = [turn for turn, *_ in kept if turn is not None]
        kinds = faults(kept)
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(kept, kept[1:])]
        cost, letters = solve([(r[1][:1], f) for r, f in zip(kept, kinds)])
        found[conv_id] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[kinds.count(k) for k in "bdt"],
            sum(p not in ("su", "ua", "au") for p in pairs), cost, letters,
            hashlib.sha256(repaired(kept, letters).encode()).hexdigest(),
        )
    return found


def found(frame):
    rows = frame.collect()
    assert frame.columns == ["conv_id", *audit.NAMED, "audit", "repaired_sha256"]
    assert len(rows) == len({r.conv_id for r in rows})
    return {r[0]: tuple(r[1:]) for r in rows}


def test_equals_sql(spark, sf_dir):
    frame = queries.QUERIES["op11_conversation_audit"](spark, sf_dir)
    assert difference(frame, connect(sf_dir), queries.ORACLE_SQL["op11_conversation_audit"]) is None


def random_rows(rng, conversations, longest):
    roles = ["user", "assistant", "system", "tool", "u", "", None, " "]
    texts = ["Yes.", "no", "", None, " \n", "Why? ", "a\nb!", "é", "Yes."]
    weights = [8, 8, 3, 1, 1, 1, 1, 1]
    rows = []
    for conv_id in [*range(conversations), None]:
        for turn in range(rng.randrange(longest)):
            turn = rng.choice([turn, turn, turn, turn, None, turn + 3])
            rows.append((conv_id, turn, *rng.choices(roles, weights), rng.choice(texts + [f"t{turn}."] * 9)))
    return rows


def test_equals_brute_force(conversations):
    rows = random_rows(random.Random(1), 150, 6)
    assert found(audit.audit_conversations(conversations(rows))) == expected(rows)


@pytest.mark.parametrize("block", [1024, 7])
def test_conversations_over_many_ranges_and_blocks(conversations, conf, block):
    """A few conversations hold most rows: ranges and blocks cut them anywhere."""
    conf(shuffle__partitions=23)
    rng = random.Random(block)
    rows = random_rows(rng, 4, 150) + [(9, t, "user", f"{t}.") for t in range(200)] + random_rows(rng, 3, 5)[:-3]
    whole = lambda steps: audit.finished(audit.cheapest_edits(steps))
    frame = audit.audit_conversations(conversations(rows), block)
    assert found(frame) == expected(rows, whole)


def test_the_repaired_turns(conversations):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "There?"), (1, 2, "assistant", "Yes."), (2, 5, "system", "Be.")]
    turns = conversations(rows).selectExpr("conv_id", "turn", "role", "text", "1L as copies")
    blocks = {r.conv_id: r for r in audit.repair(turns).collect()}
    assert [tuple(t) for t in blocks[1].turns] == [("K", "user", "There?"), ("K", "assistant", "Yes.")]
    assert (blocks[1].audit, blocks[1].cost, blocks[1].blocks) == ("DKK", 2, 1)
    assert (blocks[2].audit, blocks[2].turns) == ("D", [])


def test_a_turn_repeated_very_often(conversations, conf):
    conf(shuffle__partitions=7)
    rows = [(1, 4, "user", "Same.")] * 5000 + [(1, 5, "assistant", "Well.")]
    turns = conversations(rows).selectExpr("conv_id", "turn", "role", "text", "1L as copies")
    row = audit.digests(audit.repair(turns)).first()
    assert (row.duplicate, row.illegal, row.cost, row.gaps) == (4999, 4999, 2 * 4999, 0)
    assert row.audit == "K" + "D" * 4999 + "K"


def test_empty_and_dropped(conversations):
    assert audit.audit_conversations(conversations([])).count() == 0
    dropped = next(c for c in itertools.count() if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    rows = [(dropped, 1, "user", "Hi.")]
    nothing = hashlib.sha256(b"").hexdigest()
    assert found(audit.audit_conversations(conversations(rows))) == {dropped: (0, 0, 0, 0, 0, 0, "", nothing)}


def test_all_null(conversations):
    rows = [(None, None, None, None)] * 3
    assert found(audit.audit_conversations(conversations(rows))) == expected(rows)


def test_very_long_texts(conversations):
    rows = [(1, k, role, f"{k} " * 1_000_000 + ".") for k, role in enumerate(["user", "assistant"] * 4)]
    whole = lambda steps: audit.finished(audit.cheapest_edits(steps))
    assert found(audit.audit_conversations(conversations(rows))) == expected(rows, whole)


@pytest.mark.parametrize("modulus", [audit.MODULUS, 101, 2, 1])
def test_colliding_hashes_are_found_out(modulus):
    """With a small modulus nearly all hashes collide; audits are compared rightly all the same."""
    rng = random.Random(modulus)
    for _ in range(300):
        texts = ["".join(rng.choices("DIKR", k=rng.randrange(1, 30))) for _ in range(6)]
        texts += [texts[0] + "K", texts[0][:-1] + "R"]
        audits, nodes = audit.Audits(modulus), []
        for text in texts:
            node = 0
            for letter in text:
                node = audits.add(node, letter)
            nodes.append(node)
        for (a, x), (b, y) in itertools.product(zip(texts, nodes), repeat=2):
            assert audits.less(x, y) == (a < b)
        assert [audits.text(n) for n in nodes] == texts


def test_long_conversations_share_their_audits():
    """Ties are everywhere; the table of a thousand turns equals the one folded from blocks."""
    rng = random.Random(4)
    steps = [(rng.choice("uuas"), rng.choice(["", "", "t", "d"])) for _ in range(1500)]
    whole = audit.finished(audit.cheapest_edits(steps))
    cuts = [0, 1, 400, 400, 901, 1500]
    tables = [
        [
            {"start": s, "end": e, "cost": c, "audit": a}
            for s in audit.STATES
            for e, (c, a) in audit.cheapest_edits(steps[x:y], s).items()
        ]
        for x, y in zip(cuts, cuts[1:])
    ]
    chosen = audit.fold_blocks(iter(tables))
    assert (chosen[-1].cost, "".join(c.audit for c in chosen)) == whole
