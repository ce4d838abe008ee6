"""Repair of the turn structure of conversations: generalised LR over the role grammar, with edits.

The grammar is ``conversation -> (nothing) | system? pairs``, ``pairs -> user assistant | pairs user
assistant``. After its reductions a stack of the parser ends in one of four tops: nothing yet, a
system turn, an open user turn, a closed pair. All stacks over a conversation's turns form one graph;
stacks that end in the same top are merged, and the cheapest (cost, audit) stays.

A long conversation is parsed in pieces: a piece is parsed from every top it could be entered
with, which gives a small table (top before, top after, cost, audit); the tables of a conversation
are then chained in order. Audits of equal cost over the same turns are never prefixes of each other
(an insertion costs), so the cheapest chain of cheapest pieces is the cheapest whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewarden.llm.common import remainder_of
from tidewarden.session import ship_package, written

BLANKS = " \t\n\x0b\x0c\r"
TOPS = ("", "s", "u", "a")
#: top -> symbols that can be shifted on it; the symbol is the next top, as a closed pair reduces.
SHIFTS = {"": "su", "s": "u", "u": "a", "a": "u"}
ACCEPTED = ("", "a")
ROLES = {"u": "user", "a": "assistant"}
_FIRST = -(1 << 62)


@dataclass(frozen=True)
class RepairOptions:
    """Costs of edits, and the sizes of pieces: turns are cut into chunks of ``chunk_turns`` turn
    numbers, and a chunk is parsed ``piece_rows`` rows at a time."""

    rerole: int = 3
    delete: int = 4
    insert: int = 3
    truncated: int = 3
    chunk_turns: int = 4096
    piece_rows: int = 4096


# Parsing


def _better(tops: dict, top: str, found: tuple[int, str]) -> None:
    if top not in tops or found < tops[top]:
        tops[top] = found


def inserted(tops: dict, options: RepairOptions) -> dict:
    """The tops with those that inserted user or assistant turns lead to."""
    tops = dict(tops)
    for _ in range(2):  # a third insertion would only come back to a top already reached
        for top in TOPS:
            if top in tops:
                cost, audit = tops[top]
                for role in SHIFTS[top]:
                    if role in ROLES:
                        _better(tops, role, (cost + options.insert, audit + "I"))
    return tops


def parsed(tops: dict, initial: str, fault: str, options: RepairOptions) -> dict:
    """The tops after one more turn: {top: (cost, audit)}."""
    after: dict = {}
    extra = options.truncated if fault == "t" else 0
    for top, (cost, audit) in inserted(tops, options).items():
        _better(after, top, (cost + options.delete, audit + "D"))
        if fault in "bd" and fault:
            continue
        for role in SHIFTS[top]:
            if role == initial:
                _better(after, role, (cost + extra, audit + "K"))
            if role in ROLES:
                _better(after, role, (cost + options.rerole + extra, audit + "R"))
    return after


def accepted(tops: dict, options: RepairOptions) -> dict:
    """The tops a conversation may end in, after insertions behind its last turn."""
    return {top: found for top, found in inserted(tops, options).items() if top in ACCEPTED}


def legal(before: str, after: str) -> bool:
    return before + after in ("su", "ua", "au")


# Rows


def damage(turns: DataFrame) -> DataFrame:
    """Damaged copies of (conv_id, turn, role, text), chosen by crc32 of ``conv_id:turn`` modulo 20:
    0 drops the row, 1 empties its text, 2 removes its ``.``, ``!`` and ``?``, 3 repeats it, 4 makes
    it the user's. Nulls read as one space; the ids themselves keep their nulls."""
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = remainder_of(F.concat(space("conv_id"), F.lit(":"), space("turn")), 20)
    rows = turns.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.where("kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def _marked(turns: DataFrame, options: RepairOptions) -> DataFrame:
    """Rows with their chunk, a mark of (role, text) and what the parser needs of both."""
    turn = F.col("turn").cast("bigint")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = turns.select("conv_id", turn.alias("turn"), role.alias("role"), text.alias("text"))
    closed = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = F.when(closed == "", "b").when(~F.substring(closed, -1, 1).isin(".", "!", "?"), "t").otherwise("")
    mark = F.unhex(F.md5(F.concat_ws(":", F.length("role").cast("string"), F.col("role"), F.col("text")).cast("binary")))
    chunk: Column = F.coalesce(F.floor(F.col("turn") / options.chunk_turns).cast("bigint"), F.lit(_FIRST))
    return rows.select("*", chunk.alias("chunk"), mark.alias("mark"), F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))


def _seen_earlier(lean: DataFrame) -> DataFrame:
    """(conv_id, chunk, mark) of marks that an earlier chunk of the conversation holds too."""
    held = lean.select("conv_id", "chunk", "mark").distinct()
    order = F.row_number().over(Window.partitionBy("conv_id", "mark").orderBy("chunk"))
    return held.withColumn("nth", order).where("nth > 1").drop("nth")


def _in_order(rows: DataFrame) -> DataFrame:
    """Rows of a chunk together and in order: what a chunk is told (no row) first, then its turns."""
    return rows.repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", "is_row", "turn", "mark")


def _each(batches, *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names])


def _sent(rows: Iterator[dict], schema: pa.Schema, size: int = 2048, weight=None) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    bytes_held = 0
    for row in rows:
        held.append(row)
        bytes_held += weight(row) if weight else 0
        if len(held) >= size or bytes_held > 8 << 20:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, bytes_held = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


_MOVE = pa.struct([("before", pa.string()), ("after", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])
_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
_MOVE_SQL = "array<struct<before:string,after:string,cost:bigint,audit:string>>"
_COUNTS_SQL = ", ".join(f"{c} bigint" for c in _COUNTS)
_COUNTS_ARROW = [(c, pa.int64()) for c in _COUNTS]


def _arrow_id(kind: str) -> pa.DataType:
    return pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64()


def piece_tables(turns: DataFrame, options: RepairOptions) -> DataFrame:
    """One row for each piece of a conversation: its moves from top to top, and its counts.

    Only marks, initials and faults travel, not texts. What repeats inside a chunk is found there;
    what an earlier chunk holds is told by a row that comes first.
    """
    lean = _marked(turns, options).drop("role", "text")
    kind = lean.schema["conv_id"].dataType.simpleString()
    told = _seen_earlier(lean).select("conv_id", "chunk", "mark", F.lit(False).alias("is_row"))
    rows = _in_order(lean.withColumn("is_row", F.lit(True)).unionByName(told, allowMissingColumns=True))
    arrow = pa.schema([("conv_id", _arrow_id(kind)), ("chunk", pa.int64()), ("piece", pa.int64()), ("moves", pa.list_(_MOVE)), *_COUNTS_ARROW,
                       ("first", pa.string()), ("last", pa.string()), ("first_turn", pa.int64()), ("last_turn", pa.int64())])

    def tables(batches) -> Iterator[dict]:
        group, seen, row, tops = object(), set(), None, {}

        def closed() -> dict:
            moves = [{"before": b, "after": a, "cost": c, "audit": t} for b, found in tops.items() for a, (c, t) in found.items()]
            return {k: v for k, v in row.items() if k != "rows"} | {"moves": moves}

        for conv, chunk, mark, is_row, turn, initial, fault in _each(batches, "conv_id", "chunk", "mark", "is_row", "turn", "initial", "fault"):
            if group != (conv, chunk):
                if row:
                    yield closed()
                group, seen, row, piece, last_turn = (conv, chunk), set(), None, 0, None
            if not is_row:
                seen.add(mark)
                continue
            if row is None or row["rows"] == options.piece_rows:
                if row:
                    yield closed()
                row = dict.fromkeys(_COUNTS, 0) | {"conv_id": conv, "chunk": chunk, "piece": piece, "rows": 0, "first": initial,
                                                   "last": None, "first_turn": turn, "last_turn": turn}
                tops = {top: {top: (0, "")} for top in TOPS}
                piece += 1
            if not fault or fault == "t":
                fault = "d" if mark in seen else fault
                seen.add(mark)
            if fault:
                row[{"b": "blank", "d": "duplicate", "t": "truncated"}[fault]] += 1
            if row["last"] is not None and not legal(row["last"], initial):
                row["illegal"] += 1
            row["last"], row["last_turn"] = initial, turn
            row["turns"] += turn is not None and turn != last_turn
            last_turn = turn
            row["rows"] += 1
            for before in TOPS:
                tops[before] = parsed(tops[before], initial, fault, options)
        if row:
            yield closed()

    def run(batches):
        yield from _sent(tables(batches), arrow, 256, lambda r: sum(len(m["audit"]) for m in r["moves"]))

    return rows.mapInArrow(run, f"conv_id {kind}, chunk bigint, piece bigint, moves {_MOVE_SQL}, {_COUNTS_SQL}, first string, last string, first_turn bigint, last_turn bigint")


def chained(tables: DataFrame, options: RepairOptions) -> DataFrame:
    """The cheapest chain of each conversation's pieces.

    One row a piece with the top it is entered with and its audit (chunk is not null), and one
    for the conversation as a whole (chunk is null). A task holds one conversation's
    audit, which is a value of one row.
    """
    kind = tables.schema["conv_id"].dataType.simpleString()
    rows = tables.repartition("conv_id").sortWithinPartitions("conv_id", "chunk", "piece")
    whole = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    arrow = pa.schema([("conv_id", _arrow_id(kind)), ("chunk", pa.int64()), ("piece", pa.int64()), ("entry", pa.string()), ("audit", pa.string()),
                       *[(c, pa.int64()) for c in whole]])

    def chain(batches) -> Iterator[dict]:
        conv, at = object(), None
        settled: list = []
        tops: dict = {}
        total: dict = {}

        def done() -> Iterator[dict]:
            ends = []
            for top, (cost, tail) in tops.items():
                for _, (more, letters) in accepted({top: (0, "")}, options).items():
                    ends.append((cost + more, "".join(node[3] for node in tail) + letters, tail, top, letters))
            cost, _, tail, top, letters = min(ends)
            nodes = [*settled, *tail, (*at, top, letters)]
            for chunk, piece, entry, audit in nodes:
                yield {"conv_id": conv, "chunk": chunk, "piece": piece, "entry": entry, "audit": audit}
            turns, lowest, highest = total["turns"], total["lowest"], total["highest"]
            yield {c: total[c] for c in whole[1:5]} | {"conv_id": conv, "audit": "".join(n[3] for n in nodes), "cost": cost,
                                                      "gaps": highest - lowest + 1 - turns if turns else 0}

        for row in (r for batch in batches for r in batch.to_pylist()):
            if conv != row["conv_id"] or at is None:
                if at is not None:
                    yield from done()
                conv, settled, tops = row["conv_id"], [], {"": (0, ())}
                total = dict.fromkeys((*_COUNTS, "last"), 0) | {"last": None, "lowest": None, "highest": None}
            for c in _COUNTS:
                total[c] += row[c]
            if total["last"] is not None and not legal(total["last"], row["first"]):
                total["illegal"] += 1
            total["last"] = row["last"]
            for turn in (row["first_turn"], row["last_turn"]):
                if turn is not None:
                    total["lowest"] = turn if total["lowest"] is None else min(turn, total["lowest"])
                    total["highest"] = turn if total["highest"] is None else max(turn, total["highest"])
            after: dict = {}
            for move in row["moves"]:
                if move["before"] in tops:
                    cost, tail = tops[move["before"]]
                    tail = (*tail, (row["chunk"], row["piece"], move["before"], move["audit"]))
                    found = (cost + move["cost"], tail)
                    kept = after.get(move["after"])
                    if kept is None or (found[0], "".join(n[3] for n in tail)) < (kept[0], "".join(n[3] for n in kept[1])):
                        after[move["after"]] = found
            tops, at = after, (row["chunk"], row["piece"] + 1)
            while len({id(tail[0]) if tail else 0 for _, tail in tops.values()}) == 1 and next(iter(tops.values()))[1]:
                settled.append(next(iter(tops.values()))[1][0])
                tops = {top: (cost, tail[1:]) for top, (cost, tail) in tops.items()}
        if at is not None:
            yield from done()

    def run(batches):
        yield from _sent(chain(batches), arrow, 1024, lambda r: len(r["audit"]))

    return rows.mapInArrow(run, f"conv_id {kind}, chunk bigint, piece bigint, entry string, audit string, " + ", ".join(f"{c} bigint" for c in whole))


def repaired_rows(turns: DataFrame, chains: DataFrame, options: RepairOptions) -> DataFrame:
    """(conv_id, chunk, at, turn, role, text, edit) of every turn, also deleted and inserted ones, in the order of
    (chunk, at). An inserted turn has no turn number and an empty text."""
    rows = _marked(turns, options).select("conv_id", "chunk", "mark", "turn", "role", "text", F.lit(True).alias("is_row"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    plan = chains.where("chunk is not null").select(
        "conv_id", "chunk", F.lit(False).alias("is_row"), F.col("piece").alias("turn"), F.col("entry").alias("role"), F.col("audit").alias("text"))
    both = _in_order(rows.unionByName(plan, allowMissingColumns=True))
    arrow = pa.schema([("conv_id", _arrow_id(kind)), ("chunk", pa.int64()), ("at", pa.int64()), ("turn", pa.int64()), ("role", pa.string()),
                       ("text", pa.string()), ("edit", pa.string())])

    def follow(batches) -> Iterator[dict]:
        group, at, top, letters, used = object(), 0, "", "", 0

        def out(turn, role, text, edit) -> dict:
            return {"conv_id": group[0], "chunk": group[1], "at": at, "turn": turn, "role": role, "text": text, "edit": edit}

        def insertions() -> Iterator[dict]:
            nonlocal at, top, used
            while used < len(letters) and letters[used] == "I":
                top = next(r for r in SHIFTS[top] if r in ROLES)
                yield out(None, ROLES[top], "", "I")
                at, used = at + 1, used + 1

        pieces: list[str] = []
        for conv, chunk, is_row, turn, role, text in _each(batches, "conv_id", "chunk", "is_row", "turn", "role", "text"):
            if group != (conv, chunk):
                yield from insertions()
                group, at, top, letters, used, pieces = (conv, chunk), 0, role, "", 0, []
            if not is_row:
                pieces.append(text)
                continue
            if pieces:
                letters, pieces = "".join(pieces), []
            yield from insertions()
            edit = letters[used]
            used += 1
            if edit == "R":
                top = next(r for r in SHIFTS[top] if r in ROLES)
                role = ROLES[top]
            elif edit == "K":
                top = role[:1]
            yield out(turn, role, text, edit)
            at += 1
        yield from insertions()

    def run(batches):
        yield from _sent(follow(batches), arrow, 2048, lambda r: len(r["text"]))

    return both.mapInArrow(run, f"conv_id {kind}, chunk bigint, at bigint, turn bigint, role string, text string, edit string")


@dataclass(frozen=True)
class Repaired:
    """``rows`` as of :func:`repaired_rows`; ``summary`` has (conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit), one row a conversation."""

    rows: DataFrame
    summary: DataFrame


def repair(turns: DataFrame, options: RepairOptions = RepairOptions()) -> Repaired:
    """Cheapest edits that give every conversation of (conv_id, turn, role, text) legal roles.

    Turns are taken by number, nulls first, equal numbers by a hash of role and text. The first
    fault of a turn counts: blank, duplicate (role and text came earlier, by 128-bit hash), or
    truncated. Blank and duplicate turns must go; others are kept, given another role, or
    deleted; user and assistant turns may be inserted anywhere. Of equally cheap edits the
    ASCII-least audit is taken.

    Nulls in role or text read as one space, so a null text is blank and a null role is
    none of the grammar's, like an empty one. A null conv_id is a conversation of its own. Repeated
    rows are duplicates; conversations without rows, and empty tables, have no summary. Very long
    conversations are parsed in pieces by many tasks; only their audit is put together in one.
    Other columns are not looked at.
    """
    ship_package(turns.sparkSession)
    tables = piece_tables(turns, options)
    chains = written(chained(tables, options), "chains")
    summary = chains.where("chunk is null").drop("chunk", "piece", "entry")
    return Repaired(repaired_rows(turns, chains, options), summary)


def digests(rows: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``role:text`` of the turns that stay, joined by new lines. A task
    hashes a conversation as its rows stream by."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    ordered = rows.select("conv_id", "chunk", "at", "role", "text", "edit").repartition("conv_id").sortWithinPartitions("conv_id", "chunk", "at")
    arrow = pa.schema([("conv_id", _arrow_id(kind)), ("repaired_sha256", pa.string())])

    def hashed(batches) -> Iterator[dict]:
        conv, state, first = None, None, True
        for key, role, text, edit in _each(batches, "conv_id", "role", "text", "edit"):
            if state is None or key != conv:
                if state is not None:
                    yield {"conv_id": conv, "repaired_sha256": state.hexdigest()}
                conv, state, first = key, hashlib.sha256(), True
            if edit != "D":
                state.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
        if state is not None:
            yield {"conv_id": conv, "repaired_sha256": state.hexdigest()}

    def run(batches):
        yield from _sent(hashed(batches), arrow)

    return ordered.mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")
