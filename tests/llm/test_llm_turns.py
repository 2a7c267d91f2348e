from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewise.llm import turns
from framewise.llm.queries import QUERIES
from framewise.llm.turns import BLANK, DUPLICATE, NONE, TRUNCATED, block_table, damage, join_blocks, repair, repair_report

ROW = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                    T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
ORDER = re.compile(r"(s?(ua)+)?")


def exhaustive(rows):
    """(cost, audit) over all edit scripts with up to two empty turns in each gap."""
    puts = ["", *"ua", *map("".join, itertools.product("ua", repeat=2))]
    best = None
    for gaps in itertools.product(puts, repeat=len(rows) + 1):
        for edits in itertools.product(("K", "Ru", "Ra", "D"), repeat=len(rows)):
            cost, audit, roles = 0, "", ""
            for gap, edit, (initial, fault) in zip(gaps, edits, rows):
                roles += gap + ("" if edit == "D" else initial if edit == "K" else edit[1])
                audit += "I" * len(gap) + edit[0]
                cost += 2 * len(gap) + {"K": 0, "R": 2, "D": 3}[edit[0]] + (fault == TRUNCATED and edit != "D")
                if fault in (BLANK, DUPLICATE) and edit != "D":
                    break
            else:
                roles += gaps[-1]
                audit += "I" * len(gaps[-1])
                cost += 2 * len(gaps[-1])
                if ORDER.fullmatch(roles) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
    return best


def plain(rows):
    """(cost, audit, repaired) by ordinary pairs of cost and text, forwards."""
    step = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ())}

    def put(found, state, way):
        if state not in found or way[:2] < found[state][:2]:
            found[state] = way

    def gap(found):
        for _ in range(3):
            for state, (cost, audit, out) in list(found.items()):
                put(found, step[state], (cost + 2, audit + "I", (*out, ({"u": "user", "a": "assistant"}[step[state]], ""))))
        return found

    for role, text, fault in rows:
        now: dict = {}
        for state, (cost, audit, out) in gap(best).items():
            cut = fault == TRUNCATED
            put(now, state, (cost + 3, audit + "D", out))
            if fault in (BLANK, DUPLICATE):
                continue
            initial = role[:1]
            if initial in ("u", "a") and step[state] == initial or initial == "s" and state == "":
                put(now, initial, (cost + cut, audit + "K", (*out, (role, text))))
            put(now, step[state], (cost + 2 + cut, audit + "R", (*out, ({"u": "user", "a": "assistant"}[step[state]], text))))
        best = now
    ends = gap(best)
    return min((ends[s] for s in ("", "a") if s in ends), key=lambda w: w[:2])


def slow(rows):
    """The contract's row of every conversation, from (conv, turn, role, text)."""
    out = []
    for conv in dict.fromkeys(r[0] for r in rows):
        own = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
            own += [(turn, "user" if code == 4 else role, text)] * {0: 0, 3: 2}.get(code, 1)
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in own:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append(BLANK if not body else DUPLICATE if (role, text) in seen else TRUNCATED if body[-1] not in ".!?" else NONE)
            seen.add((role, text))
        times = [r[0] for r in own if r[0] is not None]
        gaps = max(times) - min(times) + 1 - len(set(times)) if times else 0
        initials = [r[1][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, fixed = plain([(r, t, f) for (_, r, t), f in zip(own, faults)])
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        out.append((conv, gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED), illegal, cost, audit, digest))
    return sorted(out, key=repr)


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def test_scripts_against_all_edits():
    rng = random.Random(5)
    for _ in range(60):
        rows = [(rng.choice("suax"), rng.choice((NONE, NONE, NONE, BLANK, DUPLICATE, TRUNCATED))) for _ in range(rng.randrange(0, 4))]
        want = exhaustive(rows)
        for size in (1, 2, 5):
            blocks = [rows[i:i + size] for i in range(0, len(rows), size)]
            if blocks:
                assert join_blocks([block_table(b) for b in blocks])[:2] == want, rows


def test_long_scripts_against_pairs():
    rng = random.Random(6)
    for n in (7, 40, 300):
        rows = [(rng.choice(("system", "user", "assistant", "user", "assistant", "", "tool")), f"t{i}.", rng.choice((NONE,) * 6 + (BLANK, DUPLICATE, TRUNCATED)))
                for i in range(n)]
        facts = [(r[:1], f) for r, _, f in rows]
        for size in (3, 64, 1000):
            cost, audit, parts = join_blocks([block_table(facts[i:i + size]) for i in range(0, n, size)])
            assert (cost, audit) == plain(rows)[:2] and "".join(p for _, p in parts) == audit


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    result = QUERIES["op13_conversation_repair"](spark, sf_dir)
    assert result.columns == list(COLUMNS)
    want = slow(rows)
    assert got(result) == want
    assert sum(w[6] for w in want) > 0 and len({w[7] for w in want}) > 10


ODD = [(None, None, None, None), (None, 1, "user", "Hi."), (None, 1, "user", "Hi."), (1, 0, "system", "Be kind."),
       (1, 9, "assistant", "Yes!"), (1, 4, "user", "So"), (2, None, "", "no role."), (2, 3, "tool", "x y z?\n \t"), (2, -5, "user", ""),
       (3, 0, "user", "word " * 100_000), (3, 1, "assistant", None), (3, 2, "système", "É."), (4, 0, "user", "a.\u0085"),
       *[(5, t, r, f"{r} {t // 2}.") for t in range(40) for r in ("user", "assistant")],
       *[(c, t, "user", "?") for c in range(10, 40) for t in range(2)]]


@pytest.mark.parametrize("block", [1024, 3])
def test_odd_rows(spark, block):
    rows = spark.createDataFrame(ODD, ROW)
    clash = rows.select("*", *[F.lit("x").alias(c) for c in ("key", "pos", "copy", "fault", "own")])
    clean = clash.select("conv_id", "turn", "role", "text")
    assert got(repair_report(clean, damage(clash), block)) == slow(ODD)


def test_empty(spark):
    none = spark.createDataFrame([], ROW)
    assert repair_report(none, damage(none)).collect() == []
    gone = spark.createDataFrame([(7, t, "user", "Hi.") for t in range(200) if zlib.crc32(f"7:{t}".encode()) % 20 == 0], ROW)
    assert got(repair_report(gone, damage(gone))) == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Yes."), (1, 2, "assistant", "Yes."), (1, 3, "user", "Why?")]
    report, fixed = repair(spark.createDataFrame(rows, ROW))
    assert [tuple(r) for r in fixed.orderBy("pos", "part").select("role", "text").collect()] == \
        [("system", "Be kind."), ("user", ""), ("assistant", "Yes."), ("user", "Why?"), ("assistant", "")]
    assert [(r.cost, r.audit) for r in report.collect()] == [(7, "KIKDKI")]


def test_one_conversation_in_many_tasks(spark):
    """Half of the rows in one conversation: no group of the block stage holds more than a block."""
    rows = spark.range(6000).selectExpr("if(id % 2 = 0, 0, id) as conv_id", "id as turn", "if(id % 4 = 0, 'user', 'assistant') as role",
                                        "concat('turn ', id, '.') as text")
    report, _ = repair(rows, block=100)
    found = {r.conv_id: r for r in report.collect()}
    assert found[0].cost == 0 and found[0].audit == "K" * 3000 and len(found) == 3001
