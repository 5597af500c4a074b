"""Conversation repair against an exhaustive search and a plain version of the whole query."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from conftest import SMALL
from landfall.llm import repair as module
from landfall.llm.queries import op12_repair
from landfall.llm.repair import repair, repair_digests

LEGAL = re.compile(r"(s?(ua)+)?")
CALLS = "conv_id long, turn long, role string, text string, copy int, cell string, report string"


def searched(kinds):
    """The cheapest audit by trying every sequence of edits with few insertions.

    `kinds` lists (initial, must go, truncated).
    """
    best = None
    options = []
    for initial, must_go, cut in kinds:
        more = 3 * cut
        edits = [(4, "D", "")]
        if not must_go:
            edits += [(more, "K", initial), (more + 3, "R", "u"), (more + 3, "R", "a")]
        options.append(edits)
    inserts = [(0, "", ""), (3, "I", "u"), (3, "I", "a"), (6, "II", "ua"), (6, "II", "au")]
    steps = [inserts]
    for edits in options:
        steps += [edits, inserts]
    for way in itertools.product(*steps):
        roles = "".join(w[2] for w in way)
        if LEGAL.fullmatch(roles):
            found = (sum(w[0] for w in way), "".join(w[1] for w in way))
            best = found if best is None else min(best, found)
    return best


def kind_of(initial, must_go, cut):
    return "D" if must_go else initial.upper() if cut else initial


@pytest.mark.parametrize("length", [0, 1, 2, 3])
def test_cells_agree_with_an_exhaustive_search(length):
    turns = [(i, False, c) for i in "suax" for c in (False, True)] + [("s", True, False)]
    chosen = list(itertools.product(turns, repeat=length))
    for kinds in random.Random(length).sample(chosen, min(len(chosen), 60)):
        cells = [module._TURN_CELLS[kind_of(*k)] for k in kinds]
        cost, audit, ways = module._ways(module.parsed(cells))
        assert (cost, audit) == searched(kinds), kinds
        assert "".join(part for _, part in ways) == audit


def dynamic(kinds):
    """The cheapest (cost, audit, roles) from the left, state by state, for long conversations."""
    goes = {("^", "s"): "s", **{(p, "u"): "u" for p in "^sa"}, ("u", "a"): "a"}
    start = {"^": (0, "", "")}

    def closed(states):
        for _ in range(3):
            for state, (cost, audit, roles) in list(states.items()):
                role = "a" if state == "u" else "u"
                new, found = goes[state, role], (cost + 3, audit + "I", roles + role)
                if new not in states or found[:2] < states[new][:2]:
                    states[new] = found
        return states

    states = closed(start)
    for initial, must_go, cut in kinds:
        after = {}
        for state, (cost, audit, roles) in states.items():
            ways = [(state, (cost + 4, audit + "D", roles))]
            if not must_go:
                if (state, initial) in goes:
                    ways.append((goes[state, initial], (cost + 3 * cut, audit + "K", roles + initial)))
                for role in "ua":
                    if (state, role) in goes:
                        ways.append((goes[state, role], (cost + 3 + 3 * cut, audit + "R", roles + role)))
            for new, found in ways:
                if new not in after or found[:2] < after[new][:2]:
                    after[new] = found
        states = closed(after)
    return min(states[s] for s in "^a" if s in states)


def test_every_split_of_a_span_gives_one_cell():
    rng = random.Random(3)
    for _ in range(100):
        cells = [module._TURN_CELLS[rng.choice("suaxSUAXD")] for _ in range(rng.randint(2, 9))]
        whole = module.parsed(cells)[-1][0]
        at = rng.randrange(1, len(cells))
        left, right = module.parsed(cells[:at])[-1][0], module.parsed(cells[at:])[-1][0]
        assert module.combined(left, right) == whole


@pytest.mark.parametrize("number", [1, 2, 3, 7, 64])
def test_many_deletions_are_one_cell(number):
    assert module._deletions(number) == module.parsed([module._TURN_CELLS["D"]] * number)[-1][0]


def expected(turns):
    """Report and digest of one conversation, given its (turn, role, text) rows."""
    rows = sorted(turns, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, kinds = set(), []
    counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        fault = None
        if not last:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif last[0] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        initial = role[:1] if role[:1] in tuple("sua") else "x"
        kinds.append((initial, fault in ("blank", "duplicate"), fault == "truncated"))
    for a, b in zip(rows, rows[1:]):
        counts["illegal"] += a[1][:1] + b[1][:1] not in ("su", "ua", "au")
    numbers = [r[0] for r in rows if r[0] is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    cost, audit, roles = dynamic(kinds)
    lines, left, said = [], iter(rows), iter(roles)
    for edit in audit:
        row = None if edit == "I" else next(left)
        if edit == "D":
            continue
        initial = next(said)
        role = row[1] if edit == "K" else {"u": "user", "a": "assistant"}[initial]
        lines.append(f"{role}:{row[2] if row else ''}")
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return {"gaps": gaps, **counts, "cost": cost, "audit": audit, "repaired_sha256": digest}


def grouped(rows):
    found = {}
    for conv, turn, role, text in rows:
        turns = found.setdefault(conv, [])
        turns.append((turn, " " if role is None else role, " " if text is None else text))
    return found


def check(spark, rows, **options):
    df = spark.createDataFrame([(*row, 1, "c", "r") for row in rows], CALLS)
    found = {r.conv_id: r.asDict() for r in repair_digests(repair(df, **options)).collect()}
    wanted = {conv: expected(turns) for conv, turns in grouped(rows).items()}
    assert found.keys() == wanted.keys()
    for conv, report in wanted.items():
        assert found[conv] == {"conv_id": conv, **report}


def odd_rows(seed):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "s", "ü"]
    texts = ["Yes.", "No!", "cut off", " \t\n", "", None, "Well? \n", "...", "é", "Yes."]
    rows = []
    for conv in [*range(40), None]:
        for _ in range(rng.randint(1, 12)):
            turn = rng.choice([None, -3, 0, 1, 2, 3, 4, 5, 9, 1 << 40])
            rows.append((conv, turn, rng.choice(roles), rng.choice(texts)))
    return rows


def test_odd_conversations_agree_with_plain_python(spark):
    check(spark, odd_rows(1))


def test_conversations_of_many_blocks_agree(spark, monkeypatch):
    rng = random.Random(4)
    long = [(7, i, rng.choice(["user", "assistant", "tool"]), f"t{i % 90}{rng.choice('.!?x')}") for i in range(900)]
    big = [(8, i, "user" if i % 2 else "assistant", "word " * 60_000 + f"{i}.") for i in range(9)]
    check(spark, [*odd_rows(2), *long, *big, *[(9, 1, "user", "same.")] * 50])


def test_small_blocks_change_nothing(spark, settings):
    rows = odd_rows(5)
    df = spark.createDataFrame([(*row, 1, "c", "r") for row in rows], CALLS)
    settings(spark__sql__shuffle__partitions="13", spark__sql__adaptive__coalescePartitions__enabled="false")
    found = {r.conv_id: r.asDict() for r in repair_digests(repair(df)).collect()}
    for conv, turns in grouped(rows).items():
        assert found[conv] == {"conv_id": conv, **expected(turns)}


def test_edited_turns_are_legal_and_tell_their_edit(spark):
    rows = [(1, 1, "user", "Hi."), (1, 2, "user", "Who?"), (1, 3, "assistant", "Me."), (1, 3, "assistant", "Me.")]
    df = spark.createDataFrame([(*row, 1, "c", "r") for row in rows], CALLS)
    (block,) = repair(df).collect()
    assert [tuple(t) for t in block.turns] == [
        ("user", "Hi.", "K"), ("assistant", "", "I"), ("user", "Who?", "K"), ("assistant", "Me.", "K")
    ]
    assert (block.report.cost, block.report.audit) == (7, "KIKKD")


def test_lost_conversations_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 1, "user", "Hi.", 1, "c", "r"), (2, 1, "user", "Hi.", 0, "c", "r")], CALLS)
    found = {r.conv_id: r for r in repair_digests(repair(df.withColumn("copy", df.copy == 1), gone="copy")).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert tuple(found[1]) == (1, 0, 0, 0, 0, 0, 0, "", nothing)
    assert found[2].audit == "KI"
    assert repair(df.where("false")).collect() == []


def test_the_query_agrees_with_plain_python(spark):
    given = spark.read.parquet(f"{SMALL}/conversations.parquet").collect()
    damaged, ids = [], set()
    for r in given:
        ids.add(r.conv_id)
        role, text = r.role or " ", " " if r.text is None else r.text
        kind = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        damaged += [(r.conv_id, r.turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    wanted = {conv: expected(turns) for conv, turns in grouped(damaged).items()}
    for conv in ids - wanted.keys():
        wanted[conv] = expected([])
    assert op12_repair(spark, SMALL).columns[0] == "conv_id"
    found = {r.conv_id: r.asDict() for r in op12_repair(spark, SMALL).collect()}
    assert found == {conv: {"conv_id": conv, **report} for conv, report in wanted.items()}
