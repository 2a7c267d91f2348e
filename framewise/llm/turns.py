"""Repair of conversations: the cheapest edits that give the role order ``(s?(ua)+)?``.

Every edit script of a conversation is one integer: its high digits carry the cost, and ``WIDTH``
low digits of three bits each carry the letters of the script from the most significant down
(D < I < K < R, as in ASCII), with zeros at the end.  The ordinary minimum of such integers picks the
least cost and, among equal costs, the first script in letter order.  The rows of a conversation and
the four states of the role order (nothing yet, after the system turn, after a user turn, after an
assistant turn) form a directed acyclic graph; its minimum paths come from one backward pass.

Conversations may have any length, so rows are not collected by conversation:

1. Rows get their position with ranges of (conversation, turn), so one long conversation spans tasks.
2. Faults need only roles, digests and neighbours.  A block of ``BLOCK`` rows becomes the least
   integer for every pair of states at its ends, without its texts.
3. The blocks of a conversation are joined by the same addition and minimum.  Only scripts meet here.
   Equal costs cannot hide a prefix of another script (each letter has its cost), so the
   choice inside a block does not depend on what follows.
4. Scripts go back to their blocks, and rows are kept, given another role, deleted, or preceded by
   empty turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import ranked
from .common import saved

BLOCK = 1024  # rows of a block
DIGIT = 3     # bits of a letter
_SHORT = 64   # rows of a block whose table is kept for equal blocks
LETTERS = {"D": 1, "I": 2, "K": 3, "R": 4}
_NAMES = {v: k for k, v in LETTERS.items()}
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1  # costs; CUT for a truncated row that stays

START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
#: What an empty turn, or a turn given another role, becomes after each state: a user turn, but an
#: assistant turn after a user turn.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}

# first fault of a row
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)


def _follows(state: int, initial: str) -> int | None:
    """The state after a kept row, None where the role order forbids it."""
    to = _INITIAL.get(initial)
    if to == SYSTEM:
        return SYSTEM if state == START else None
    return to if to is not None and NEXT[state] == to else None


class Scripts:
    """Integers of one conversation or block: cost above ``width`` letters."""

    def __init__(self, width: int):
        self.bits = DIGIT * width
        self.low = (1 << self.bits) - 1

    def empty(self) -> int:
        return 0

    def before(self, letter: str, cost: int, rest: int) -> int:
        """The script of ``letter`` followed by ``rest``."""
        digits = (LETTERS[letter] << (self.bits - DIGIT)) | ((rest & self.low) >> DIGIT)
        return (((rest >> self.bits) + cost) << self.bits) | digits

    def length(self, script: int) -> int:
        digits = script & self.low
        return (self.bits - ((digits & -digits).bit_length() - 1) // DIGIT * DIGIT) // DIGIT if digits else 0

    def join(self, first: tuple[int, int, int], rest: int) -> int:
        """``first`` (cost, letters as an integer without padding, their number) followed by ``rest``."""
        cost, letters, n = first
        digits = (letters << (self.bits - DIGIT * n)) | ((rest & self.low) >> (DIGIT * n))
        return (((rest >> self.bits) + cost) << self.bits) | digits

    def parts(self, script: int) -> tuple[int, int, int]:
        n = self.length(script)
        return script >> self.bits, (script & self.low) >> (self.bits - DIGIT * n), n

    def letters(self, script: int) -> str:
        digits = script & self.low
        return "".join(_NAMES[(digits >> at) & 7] for at in range(self.bits - DIGIT, self.bits - DIGIT * (self.length(script) + 1), -DIGIT))


def _gap(scripts: Scripts, after: list[int | None]) -> list[int | None]:
    """Least scripts from each state with up to two empty turns put in first.  A third would only
    repeat: without a pair of them the roles are still in order."""
    best, reach = list(after), after
    for _ in range(2):
        reach = [None if reach[NEXT[s]] is None else scripts.before("I", INSERT, reach[NEXT[s]]) for s in range(4)]
        best = [min((x for x in pair if x is not None), default=None) for pair in zip(best, reach)]
    return best


def backward(rows: list[tuple[str, int]], scripts: Scripts, after: list[int | None]) -> list[int | None]:
    """Least scripts from each state in front of ``rows`` (initial, fault), given those behind them."""
    for initial, fault in reversed(rows):
        now: list[int | None] = []
        cut = CUT if fault == TRUNCATED else 0
        for state in range(4):
            ways = [scripts.before("D", DELETE, after[state])] if after[state] is not None else []
            if fault not in (BLANK, DUPLICATE):
                to = _follows(state, initial)
                if to is not None and after[to] is not None:
                    ways.append(scripts.before("K", KEEP + cut, after[to]))
                if after[NEXT[state]] is not None:
                    ways.append(scripts.before("R", REROLE + cut, after[NEXT[state]]))
            now.append(min(ways, default=None))
        after = _gap(scripts, now)
    return after


@lru_cache(maxsize=1 << 12)
def packed_table(rows: tuple[tuple[str, int], ...]) -> bytes:
    """The table of a block, packed; equal blocks are worked out once per worker (short conversations
    are often alike)."""
    return _pack(block_table(list(rows)))


@lru_cache(maxsize=1 << 12)
def joined(tables: tuple[bytes, ...]) -> tuple[int, str, list[tuple[int, str]]]:
    return join_blocks([_unpack(t) for t in tables])


def block_table(rows: list[tuple[str, int]]) -> list[list[tuple[int, int, int] | None]]:
    """For each state in front and each behind: (cost, letters, number) of the least script."""
    scripts = Scripts(3 * len(rows))
    columns = [backward(rows, scripts, [scripts.empty() if s == end else None for s in range(4)]) for end in range(4)]
    return [[None if columns[end][s] is None else scripts.parts(columns[end][s]) for end in range(4)] for s in range(4)]


def join_blocks(tables: list[list[list[tuple[int, int, int] | None]]]) -> tuple[int, str, list[tuple[int, str]]]:
    """(cost, letters, per block its state in front and its letters; the last also has the turns put
    in at the end) of the least script of a conversation."""
    longest = [max((w[2] for row in t for w in row if w), default=0) for t in tables]
    scripts = Scripts(sum(longest) + 2)
    after: list[int | None] = _gap(scripts, [scripts.empty() if s in ENDS else None for s in range(4)])
    choices: list[list[int]] = []
    for table in reversed(tables):
        now, choice = [], []
        for state in range(4):
            ways = [(scripts.join(table[state][end], after[end]), end) for end in range(4) if table[state][end] is not None and after[end] is not None]
            best = min(ways, default=(None, START))
            now.append(best[0])
            choice.append(best[1])
        after = now
        choices.append(choice)
    whole = scripts.letters(after[START])
    out, state, at = [], START, 0
    for table, choice in zip(tables, reversed(choices)):
        n = table[state][choice[state]][2]
        out.append((state, whole[at:at + n]))
        state, at = choice[state], at + n
    out[-1] = (out[-1][0], out[-1][1] + whole[at:])
    return after[START] >> scripts.bits, whole, out


def _table_of(rows: tuple[tuple[str, int], ...]) -> bytes:
    return packed_table(rows) if len(rows) <= _SHORT else packed_table.__wrapped__(rows)


def _text(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(" "))


def damage(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_col``, ``turn_col``, ``role``, ``text`` and ``copy`` of every row after the fixed damage of the
    test contract, by crc32(``conv:turn``) % 20 with nulls as one space: 0 drops a row, 1 empties its
    text, 2 removes its ``.!?``, 3 repeats it, 4 sets its role to user."""
    code = F.pmod(F.crc32(F.concat_ws(":", _text(conv_col), _text(turn_col))), F.lit(20))
    text = F.when(code == 1, F.lit("")).when(code == 2, F.translate(_text(text_col), ".!?", "")).otherwise(_text(text_col))
    role = F.when(code == 4, F.lit("user")).otherwise(_text(role_col))
    copies = F.when(code == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = df.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                     copies.alias("copies"), code.alias("code")).where("code <> 0")
    return rows.select("conv_id", "turn", "role", "text", F.explode("copies").alias("copy"))


_BLOCK = "key string, block long, n long, blank long, duplicate long, truncated long, illegal long, first string, last string, turns long, first_turn long, last_turn long, table binary"


def _pack(table) -> bytes:
    """16 scripts, row by row: flag, cost (8 bytes), number of letters (4 bytes), letters (as many
    bytes as their bits need); a script that does not exist is one zero byte."""
    out = []
    for row in table:
        for way in row:
            if way is None:
                out.append(b"\0")
            else:
                cost, letters, n = way
                out.append(b"\1" + cost.to_bytes(8, "big") + n.to_bytes(4, "big") + letters.to_bytes((DIGIT * n + 7) // 8, "big"))
    return b"".join(out)


def _unpack(data: bytes):
    at, ways = 0, []
    for _ in range(16):
        if not data[at]:
            ways.append(None)
            at += 1
            continue
        cost, n = int.from_bytes(data[at + 1:at + 9], "big"), int.from_bytes(data[at + 9:at + 13], "big")
        size = (DIGIT * n + 7) // 8
        ways.append((cost, int.from_bytes(data[at + 13:at + 13 + size], "big"), n))
        at += 13 + size
    return [ways[i:i + 4] for i in range(0, 16, 4)]


_LEGAL = {"su", "ua", "au"}


def _blocks(facts: DataFrame) -> DataFrame:
    """One row per block of a conversation: counts, what is at its ends, and its table of scripts."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        key, block = table["key"][0].as_py(), table["block"][0].as_py()
        initials, faults = table["initial"].to_pylist(), table["fault"].to_pylist()
        turns = [t for t in table["turn"].to_pylist() if t is not None]
        illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))
        row = (key, block, len(faults), faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED), illegal, initials[0], initials[-1],
               len(set(turns)), turns[0] if turns else None, turns[-1] if turns else None, _table_of(tuple(zip(initials, faults))))
        return pa.table({f.name: pa.array([v], f.type) for f, v in zip(_BLOCK_SCHEMA, row)})

    return facts.groupBy("key", "block").applyInArrow(run, _BLOCK)


_BLOCK_SCHEMA = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t])
                           for n, t in (x.split() for x in _BLOCK.split(", "))])
_SCRIPT = "key string, block long, state int, script string, total_cost long, audit string, gaps long, blank long, duplicate long, truncated long, illegal long"
_SCRIPT_TYPES = (pa.string(), pa.int64(), pa.int32(), pa.string(), *[pa.int64(), pa.string()], *[pa.int64()] * 5)


def _scripts(blocks: DataFrame) -> DataFrame:
    """Per block its state in front and its letters; the first block of a conversation also has the
    conversation's report."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by("block").to_pylist()
        tables = tuple(r["table"] for r in rows)
        cost, audit, parts = joined(tables) if len(tables) == 1 else joined.__wrapped__(tables)
        illegal = sum(r["illegal"] for r in rows) + sum(a["last"] + b["first"] not in _LEGAL for a, b in zip(rows, rows[1:]))
        timed = [r for r in rows if r["turns"]]
        distinct = sum(r["turns"] for r in timed) - sum(a["last_turn"] == b["first_turn"] for a, b in zip(timed, timed[1:]))
        gaps = timed[-1]["last_turn"] - timed[0]["first_turn"] + 1 - distinct if timed else 0
        report = (cost, audit, gaps, *(sum(r[c] for r in rows) for c in ("blank", "duplicate", "truncated")), illegal)
        out = [(r["key"], r["block"], state, script, *(report if i == 0 else [None] * 7)) for i, (r, (state, script)) in enumerate(zip(rows, parts))]
        names = [x.split()[0] for x in _SCRIPT.split(", ")]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, zip(*out), _SCRIPT_TYPES)})

    return blocks.groupBy("key").applyInArrow(run, _SCRIPT)


def _edits(facts: DataFrame, scripts: DataFrame) -> DataFrame:
    """(key, pos, edits): what each row becomes, an array of (role, stays); ``stays``: with the row's text,
    else empty; a null role keeps the row's own."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("pos")
        state, script = right["state"][0].as_py(), right["script"][0].as_py()
        out: list[list[dict]] = [[]]
        initials = left["initial"].to_pylist()
        at = 0
        for letter in script:
            if letter == "I":
                state = NEXT[state]
                out[-1].append({"role": _ROLE[state], "stays": False})
                continue
            if letter == "K":
                state = _INITIAL[initials[at]]
                out[-1].append({"role": None, "stays": True})
            elif letter == "R":
                state = NEXT[state]
                out[-1].append({"role": _ROLE[state], "stays": True})
            at += 1
            out.append([])
        last = out.pop()
        out[-1] += last  # turns put in behind the last row
        kind = pa.list_(pa.struct([("role", pa.string()), ("stays", pa.bool_())]))
        return pa.table({"key": left["key"], "pos": left["pos"], "edits": pa.array(out, kind)})

    return (facts.select("key", "block", "pos", "initial").groupBy("key", "block").cogroup(scripts.select("key", "block", "state", "script").groupBy("key", "block"))
                 .applyInArrow(run, "key string, pos long, edits array<struct<role:string,stays:boolean>>"))


def _key(conv: Column) -> Column:
    return F.when(conv.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), conv.cast("string")))


def repair(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           copy_col: str | None = None, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(report, turns) of the conversations of ``df``.

    Rows are taken by turn (nulls first), then role, text and ``copy_col``.  A row's first fault counts: blank
    (nothing but ASCII white space), duplicate (an earlier row has its role and text), truncated
    (its last character that is no white space is none of ``.!?``).  Edits: Keep 0, Rerole to user or
    assistant 2, Delete 3 (blank and duplicate rows must go), Insert an empty user or assistant turn 2;
    truncated rows that stay cost 1 more.  The result has the role order ``(s?(ua)+)?`` by initials.

    ``report``: conversation, gaps, blank, duplicate, truncated, illegal, cost, audit (the edits' letters;
    the least in letter order among the cheapest).  ``turns``: conversation, pos, part, role, text of the
    repaired rows in the order (pos, part).

    Null conversations are one conversation, null roles and texts one space; a role without a first
    letter fits nowhere and is given another or deleted; an empty table gives empty ones; other
    columns are not read.  The letters of one conversation are in one task when its blocks are joined
    (about 20 bytes a row), as its audit is one value; its texts never are."""
    rows = df.select(_key(F.col(conv_col)).alias("key"), F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                     _text(role_col).alias("role"), _text(text_col).alias("text"),
                     (F.col(copy_col) if copy_col else F.lit(0)).alias("copy"))
    placed = ranked(rows, ["key"], ["turn", "role", "text", "copy"], "pos").select("key", "conv", "pos", "turn", "role", "text")
    body = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    seen = placed.select("key", "pos", "turn", F.substring("role", 1, 1).alias("initial"), same.alias("same"),
                         F.when(F.length(body) == 0, BLANK).when(~F.substring(body, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(NONE).alias("own"))
    seen = saved(seen, "turn-facts")
    first = saved(seen.groupBy("key", "same").agg(F.min("pos").alias("first")), "first-turns")
    fault = F.when(F.col("own") == BLANK, BLANK).when(F.col("pos") > F.col("first"), DUPLICATE).otherwise(F.col("own"))
    facts = saved(seen.join(first, ["key", "same"]).select("key", "pos", "turn", "initial", fault.cast("int").alias("fault"),
                                                           F.floor((F.col("pos") - 1) / block).cast("long").alias("block")), "faults")
    scripts = saved(_scripts(saved(_blocks(facts), "turn-blocks")), "scripts")
    names = placed.groupBy("key").agg(F.first("conv").alias(conv_col))
    report = scripts.where("total_cost is not null").join(names, "key")
    edits = saved(_edits(facts, scripts), "edits")
    role = F.coalesce(F.col("edit.role"), F.col("own_role"))
    turns = (placed.withColumnsRenamed({"conv": conv_col, "role": "own_role", "text": "own_text"}).join(edits, ["key", "pos"])
                   .select("key", conv_col, "pos", "own_role", "own_text", F.posexplode("edits").alias("part", "edit"))
                   .select("key", conv_col, "pos", "part", role.alias("role"), F.when(F.col("edit.stays"), F.col("own_text")).otherwise(F.lit("")).alias("text")))
    return report.select(conv_col, "key", "gaps", "blank", "duplicate", "truncated", "illegal", F.col("total_cost").alias("cost"), "audit"), turns


def digests(turns: DataFrame) -> DataFrame:
    """(key, repaired_sha256): SHA-256 of each conversation's ``role:text`` rows joined by newlines.  A
    digest is one chain over its rows, so a conversation's rows pass through one task in order; they
    are read as a stream and never held."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, chain = None, None
        for batch in batches:
            keys, out = [], []
            for key, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if key != now:
                    if now is not None:
                        keys.append(now)
                        out.append(chain.hexdigest())
                    now, chain = key, hashlib.sha256()
                else:
                    chain.update(b"\n")
                chain.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(out, pa.string())], ["key", "repaired_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([chain.hexdigest()])], ["key", "repaired_sha256"])

    ordered = turns.repartition("key").sortWithinPartitions("key", "pos", "part").select("key", "role", "text")
    return ordered.mapInArrow(run, "key string, repaired_sha256 string")


def repair_report(df: DataFrame, damaged: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per conversation of ``df`` (columns conv_id, turn, role, text): the report on ``damaged``
    and the digest of its repaired rows; zeros, an empty audit and the digest of an empty string for
    conversations without a row in ``damaged``."""
    report, turns = repair(damaged, copy_col="copy", block=block)
    found = report.drop("conv_id").join(digests(turns), "key", "left")
    found = saved(found, "reports")
    own = df.select(F.col("conv_id").alias("conv_id")).distinct().withColumn("key", _key(F.col("conv_id")))
    zero = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return own.join(found, "key", "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in zero], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
