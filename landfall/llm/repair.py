"""Conversation repair: the cheapest edits that make the roles of a conversation legal.

Legal roles are an optional system turn and then pairs of user and assistant. A turn is
kept (0), given the role user or assistant (3) or deleted (4), and an empty user or assistant
turn can be inserted anywhere (3). Blank turns and repeated ones must go; a truncated turn
that stays costs 3 more.

The edits are found by weighted CYK parsing. The grammar is in Chomsky normal form: a
nonterminal `pq` stands for edited turns that lead from what was said last, `p`, to `q`; its
rules are `pq -> pr rq`, and the terminals are the edits of one turn. A cell holds, for each
nonterminal, the least (cost, audit) of a span, and is closed under insertions. Cells are
combined bottom-up by span length. As `pq` tells all that matters about a span, every split
of a span gives the same cell, so each span is split once, in its middle, and n turns take
n - 1 combinations. The least audit is well defined: two audits of one span and one cost have
the same number of insertions, so neither starts with the other, and what follows does not
change their order.

Turns are sorted over all tasks, which cut them into blocks and compute each block's cell, so
a conversation of any length is parsed in parallel. A conversation that is one block, with
others before and after it in its task, is whole and edited there. For the rest one pass per
conversation combines the cells of its blocks and writes out the edited turns block by block.

Defined results: a NULL role or text is one space, which is neither a legal role nor a text.
Turns are taken by number, NULL first, then by role and text; repeated rows lie side by side
and all but the first count as duplicates. Rows with a NULL id are one conversation. A gap
count beyond 64 bits is NULL. Extra columns are ignored, whatever their names. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import groupby, islice
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import stored

#: What was said last: nothing, the system, the user, the assistant.
_START, _SYSTEM, _USER, _ASSISTANT = _STATES = range(4)
_LEGAL_END = (_START, _ASSISTANT)
#: Turns and characters after which a block ends.
_BLOCK_TURNS, _BLOCK_CHARS = 1024, 1 << 20

_REROLE, _DELETE, _INSERT, _TRUNCATED = 3, 4, 3, 3

#: A cell: for each pair of states the least (cost, audit), or None.
Cell = tuple[tuple[int, str] | None, ...]


def _after(state: int, initial: str) -> int | None:
    """What was said last once a turn with this role initial follows `state`."""
    if initial == "s" and state == _START:
        return _SYSTEM
    if initial == "u" and state != _USER:
        return _USER
    if initial == "a" and state == _USER:
        return _ASSISTANT
    return None


def _wanted(state: int) -> str:
    """The role that an inserted or changed turn takes."""
    return "assistant" if state == _USER else "user"


def combined(left: Cell, right: Cell) -> Cell:
    """The cell of two spans side by side."""
    found: list[tuple[int, str] | None] = [None] * 16
    for at, first in enumerate(left):
        if first is None:
            continue
        begin, middle = at & ~3, at & 3
        for end in _STATES:
            second = right[4 * middle + end]
            if second is not None:
                both = (first[0] + second[0], first[1] + second[1])
                best = found[begin + end]
                if best is None or both < best:
                    found[begin + end] = both
    return tuple(found)


def _cell(edits: Sequence[tuple[int, int, int, str]]) -> Cell:
    """The cell of single edits, given as (state, next state, cost, audit)."""
    found: list[tuple[int, str] | None] = [None] * 16
    for begin, end, cost, audit in edits:
        best = found[4 * begin + end]
        if best is None or (cost, audit) < best:
            found[4 * begin + end] = (cost, audit)
    return tuple(found)


def _insertions() -> Cell:
    """Any number of insertions; more than two only lead back."""
    none = _cell([(state, state, 0, "") for state in _STATES])
    one = [(p, _after(p, _wanted(p)[0]), _INSERT, "I") for p in _STATES]
    step = _cell([*((p, p, 0, "") for p in _STATES), *one])
    return combined(step, combined(step, none))


_NOTHING = _insertions()


def _turn_cell(kind: str) -> Cell:
    """One turn. Its kind is its initial (in capitals if truncated), or D if it must go."""
    edits = [(state, state, _DELETE, "D") for state in _STATES]
    if kind != "D":
        more = _TRUNCATED if kind.isupper() else 0
        for state in _STATES:
            kept = _after(state, kind.lower())
            if kept is not None:
                edits.append((state, kept, more, "K"))
            edits.append((state, _after(state, _wanted(state)[0]), more + _REROLE, "R"))
    return combined(combined(_NOTHING, _cell(edits)), _NOTHING)


#: Initials other than s, u and a are all x.
_TURN_CELLS = {kind: _turn_cell(kind) for kind in "suaxSUAXD"}


def _deletions(number: int) -> Cell:
    """The cell of so many turns that must go, by doubling."""
    cell = _TURN_CELLS["D"]
    if number == 1:
        return cell
    half = _deletions(number // 2)
    both = combined(half, half)
    return combined(both, cell) if number % 2 else both


def parsed(cells: Sequence[Cell]) -> list[list[Cell]]:
    """Cells of all spans that are used, by length: the given ones first, the whole last."""
    levels = [list(cells) or [_NOTHING]]
    while len(row := levels[-1]) > 1:
        pairs = [combined(a, b) for a, b in zip(row[::2], row[1::2])]
        levels.append(pairs + row[len(row) & ~1 :])
    return levels


def _ways(levels: list[list[Cell]]) -> tuple[int, str, list[tuple[int, str]]]:
    """Cost and audit of the best way to edit the whole, and (state, audit) per given cell."""
    whole = levels[-1][0]
    cost, audit = min(way for end in _LEGAL_END if (way := whole[end]) is not None)
    end = next(end for end in _LEGAL_END if whole[end] == (cost, audit))
    ways = [(_START, end)]
    for row in levels[-2::-1]:
        below = []
        for i, (begin, end) in enumerate(ways):
            if 2 * i + 1 == len(row):
                below.append((begin, end))
                continue
            left, right = row[2 * i], row[2 * i + 1]
            _, middle = min(
                ((a[0] + b[0], a[1] + b[1]), state)
                for state in _STATES
                if (a := left[4 * begin + state]) and (b := right[4 * state + end])
            )
            below += [(begin, middle), (middle, end)]
        ways = below
    return cost, audit, [
        (begin, cell[4 * begin + end][1]) for (begin, end), cell in zip(ways, levels[0])
    ]


#: What is known of a whole conversation.
REPORT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
)
_RESULT_DDL = (
    "turns array<struct<role: string, text: string, edit: string>>,"
    f" report struct<{REPORT.replace(' long', ': bigint').replace(' string', ': string')}>"
)
_OUT_DDL = f"conv_id long, {_RESULT_DDL}"
_OUT = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("turns", pa.list_(pa.struct([(n, pa.string()) for n in ("role", "text", "edit")]))),
        (
            "report",
            pa.struct(
                [
                    (name, pa.string() if kind == "string" else pa.int64())
                    for name, kind in (field.split() for field in REPORT.split(", "))
                ]
            ),
        ),
    ]
)

_ROW = "struct<role: string, text: string, copies: bigint>"
_BLOCK_DDL = (
    "conv_id long, block long, cell array<struct<cost: bigint, audit: string>>, blank long,"
    " duplicate long, truncated long, illegal long, first string, last string, first_turn long,"
    f" last_turn long, distinct_turns long, rows array<{_ROW}>, {_RESULT_DDL}"
)
_CELL_TYPE = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))
_ROWS_TYPE = pa.list_(
    pa.struct([("role", pa.string()), ("text", pa.string()), ("copies", pa.int64())])
)
_BLOCK = pa.schema(
    [("conv_id", pa.int64()), ("block", pa.int64()), ("cell", _CELL_TYPE)]
    + [(name, pa.int64()) for name in ("blank", "duplicate", "truncated", "illegal")]
    + [("first", pa.string()), ("last", pa.string())]
    + [(name, pa.int64()) for name in ("first_turn", "last_turn", "distinct_turns")]
    + [("rows", _ROWS_TYPE), _OUT.field("turns"), _OUT.field("report")]
)


def _legal_pair(first: str, second: str) -> bool:
    return first + second in ("su", "ua", "au")


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _batched(rows: Iterator[dict], schema: pa.Schema, size: int = 64) -> Iterator[pa.RecordBatch]:
    while some := list(islice(rows, size)):
        yield pa.RecordBatch.from_pylist(some, schema=schema)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Cut sorted turns into blocks of one conversation, each with its cell and counts. Blocks
    that are whole conversations are edited at once: they have a report, and no cell."""
    number = TaskContext.get().partitionId() << 32
    alone, first = None, True
    for conv, turns in groupby(_rows_of(batches), key=itemgetter("conv_id")):
        if alone is not None:  # and the task goes on with another conversation
            yield _edited_whole(alone)
            alone = None
        block, size, cut = _new_block(conv, number), 0, False
        for turn in turns:
            if block["rows"] and (len(block["cell"]) >= _BLOCK_TURNS or size >= _BLOCK_CHARS):
                yield _closed(block)
                number += 1
                block, size, cut = _new_block(conv, number), 0, True
            if not turn["gone"]:
                _add(block, turn)
                size += len(turn["text"])
        if first or cut:
            yield _closed(block)
        else:
            alone = block
        number, first = number + 1, False
    if alone is not None:
        yield _closed(alone)


def _edited_whole(block: dict) -> dict:
    """The result of a conversation that is one block."""
    cost, audit, _ = _ways(parsed([parsed(block["cell"])[-1][0]]))
    turns = _edited(block["rows"], _START, audit)
    return {"conv_id": block["conv_id"], "turns": turns, "report": _report([block], cost, audit)}


def _new_block(conv: int | None, number: int) -> dict:
    counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "distinct_turns"), 0)
    bounds = dict.fromkeys(("first", "last", "first_turn", "last_turn"))
    return {"conv_id": conv, "block": number, "cell": [], "rows": [], **counts, **bounds}


def _add(block: dict, turn: dict) -> None:
    """Enter equal turns; only the first of them can be new."""
    copies, initial = turn["copies"], turn["role"][:1]
    if turn["blank"]:
        block["blank"] += copies
    else:
        block["duplicate"] += copies - (not turn["again"])
        block["truncated"] += turn["truncated"] and not turn["again"]
    kind = initial if initial in ("s", "u", "a") else "x"
    kind = "D" if turn["blank"] or turn["again"] else kind.upper() if turn["truncated"] else kind
    block["cell"].append(_TURN_CELLS[kind])
    if copies > 1:
        block["cell"].append(_deletions(copies - 1))
    if block["last"] is None:
        block["first"] = initial
    else:
        block["illegal"] += not _legal_pair(block["last"], initial)
    block["illegal"] += (copies - 1) * (not _legal_pair(initial, initial))
    block["last"] = initial
    if turn["turn"] is not None:
        block["distinct_turns"] += turn["turn"] != block["last_turn"]
        block["last_turn"] = turn["turn"]
        if block["first_turn"] is None:
            block["first_turn"] = turn["turn"]
    block["rows"].append({name: turn[name] for name in ("role", "text", "copies")})


def _closed(block: dict) -> dict:
    whole = parsed(block["cell"])[-1][0]
    cell = [way and {"cost": way[0], "audit": way[1]} for way in whole]
    return {**block, "cell": cell}


def _report(blocks: list[dict], cost: int, audit: str) -> dict:
    """The counts of all blocks, and what only shows where two blocks meet."""
    counts = {n: sum(b[n] for b in blocks) for n in ("blank", "duplicate", "truncated", "illegal")}
    filled = [b for b in blocks if b["last"] is not None]
    for a, b in zip(filled, filled[1:]):
        counts["illegal"] += not _legal_pair(a["last"], b["first"])
    numbered = [b for b in blocks if b["last_turn"] is not None]
    gaps: int | None = 0
    if numbered:
        distinct = sum(b["distinct_turns"] for b in numbered)
        distinct -= sum(a["last_turn"] == b["first_turn"] for a, b in zip(numbered, numbered[1:]))
        gaps = numbered[-1]["last_turn"] - numbered[0]["first_turn"] + 1 - distinct
        gaps = gaps if gaps < 1 << 63 else None
    return {"gaps": gaps, **counts, "cost": cost, "audit": audit}


def _edited(rows: list[dict], state: int, audit: str) -> list[dict]:
    """The turns of a block after its edits."""
    turns = (row for row in rows for _ in range(row["copies"]))
    found = []
    for edit in audit:
        row = None if edit == "I" else next(turns)
        if edit == "D":
            continue
        role = row["role"] if edit == "K" else _wanted(state)
        found.append({"role": role, "text": row["text"] if row else "", "edit": edit})
        state = _after(state, role[:1])
    return found


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """For each conversation first all cells, then the turns, block by block."""
    for conv, parts in groupby(_rows_of(batches), key=itemgetter("conv_id")):
        cells: list[dict] = []
        report, at, ways = None, 0, []
        for part in parts:
            if not part["is_text"]:
                cells.append(part)
                continue
            if report is None:
                given = [
                    tuple(way and (way["cost"], way["audit"]) for way in block.pop("cell"))
                    for block in cells
                ]
                cost, audit, ways = _ways(parsed(given))
                report = _report(cells, cost, audit)
            turns = _edited(part["rows"], *ways[at])
            at += 1
            yield {"conv_id": conv, "turns": turns, "report": report if at == len(ways) else None}


_BLANK, _CUT_OFF = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"


def _order(turn: Column) -> Column:
    """Turn numbers in order, NULL first, as a value that `min` does not skip."""
    return F.struct(turn.isNotNull(), turn)


def repair(turns: DataFrame, gone: str | None = None) -> DataFrame:
    """Conversations (conv_id, turn, role, text) with the cheapest legal roles.

    Returns a row per block of a conversation, blocks in order: the edited turns (role, text,
    and the edit that made it: K, R or I), and in the last block of each conversation the
    report, else NULL. A partition holds whole conversations, one after the other.
    `gone` names a boolean column of rows that only say that their conversation exists.
    """
    lost = F.coalesce(F.col(gone).cast("boolean"), F.lit(False)) if gone else F.lit(False)
    given = turns.select(
        F.col("conv_id").cast("long"), lost.alias("gone"),
        F.when(~lost, F.col("turn")).cast("long").alias("turn"),
        F.when(lost, "").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(lost, "").otherwise(F.coalesce("text", F.lit(" "))).alias("text"),
    )
    digest = F.sha2(F.encode("text", "UTF-8"), 256)
    repeated = (
        given.where("NOT gone")
        .groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), digest.alias("d"))
        .agg(F.min(_order(F.col("turn"))).alias("earliest"), F.count(F.lit(1)).alias("found"))
        .where("found > 1")
    )
    counted = given.groupBy(*given.columns).agg(F.count(F.lit(1)).alias("copies"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (digest == F.col("d"))
    marked = counted.join(repeated, same, "left").select(
        *given.columns, "copies",
        F.coalesce(_order(F.col("turn")) > F.col("earliest"), F.lit(False)).alias("again"),
        (~F.col("text").rlike(_BLANK)).alias("blank"),
        (~F.col("text").rlike(_CUT_OFF)).alias("truncated"),
    )
    order = ["conv_id", "turn", "role", "text"]
    in_order = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    cut = in_order.mapInArrow(lambda rows: _batched(_blocks(rows), _BLOCK), _BLOCK_DDL)
    blocks = stored(cut, "repair_blocks", "zstd")
    parts = blocks.where("report IS NULL").drop("turns", "report")
    cells = parts.drop("rows").withColumn("is_text", F.lit(False))
    texts = parts.select("conv_id", "block", "rows", F.lit(True).alias("is_text"))
    both = cells.unionByName(texts, allowMissingColumns=True)
    per_conversation = both.repartition("conv_id").sortWithinPartitions("conv_id", "is_text", "block")
    combined_parts = per_conversation.mapInArrow(lambda rows: _batched(_repaired(rows), _OUT), _OUT_DDL)
    whole = blocks.where("report IS NOT NULL").select("conv_id", "turns", "report")
    return whole.unionByName(combined_parts)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    state, begun = hashlib.sha256(), False
    for row in _rows_of(batches):
        for turn in row["turns"]:
            line = f"{turn['role']}:{turn['text']}"
            state.update((("\n" if begun else "") + line).encode())
            begun = True
        if row["report"] is not None:
            yield {"conv_id": row["conv_id"], **row["report"], "repaired_sha256": state.hexdigest()}
            state, begun = hashlib.sha256(), False


_DIGEST = pa.schema([_OUT.field("conv_id"), *_OUT.field("report").type, ("repaired_sha256", pa.string())])


def repair_digests(repaired: DataFrame) -> DataFrame:
    """For each conversation of `repair`, its report and the digest of its edited turns, as
    lines `role:text`. It reads the turns as they come, in the same tasks."""
    ddl = f"conv_id long, {REPORT}, repaired_sha256 string"
    return repaired.mapInArrow(lambda rows: _batched(_digested(rows), _DIGEST, 4096), ddl)
