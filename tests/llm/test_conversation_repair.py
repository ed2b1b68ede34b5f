from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from shelfwise.llm import conversation_repair, oracles, queries
from shelfwise.llm.conversation_repair import damage, digests, repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def found(rows):
    """Rows of one conversation in order with the first fault of each."""
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def every_repair(rows):
    """All edits with at most two insertions at a place, by brute force."""
    inserted = [[("I", r, "") for r in roles] for n in range(3) for roles in itertools.product(("user", "assistant"), repeat=n)]
    choices = [inserted]
    for role, text, fault in rows:
        kept = [] if fault in ("blank", "duplicate") else [[("K", role, text)], [("R", "user", text)], [("R", "assistant", text)]]
        choices += [[*kept, [("D", None, None)]], inserted]
    best = None
    for way in itertools.product(*choices):
        edits = [e for part in way for e in part]
        lines = [(r, t) for e, r, t in edits if e != "D"]
        if not re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "?" for r, _ in lines)):
            continue
        audit = "".join(e for e, _, _ in edits)
        stays = sum(5 for part, row in zip(way[1::2], rows) if part[0][0] != "D" and row[2] == "truncated")
        weight = (sum({"K": 0, "R": 1, "D": 2, "I": 5}[e] for e in audit) + stays, audit, lines)
        if best is None or weight[:2] < best[:2]:
            best = weight
    return best


def told(repaired):
    lines: dict = {}
    for r in sorted(repaired.rows.collect(), key=lambda r: (r["place"], r["nth"])):
        lines.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    return {r["conv_id"]: (r["cost"], r["audit"], lines.get(r["conv_id"], [])) for r in repaired.conversations.collect()}


def random_turns(random_, n):
    roles, texts = ["user", "assistant", "system", " ", "uncle"], ["a.", "b!", "cut", "", " \n", "c?  "]
    return [(random_.choice(roles), random_.choice(texts)) for _ in range(n)]


def test_against_every_repair(spark):
    random_ = random.Random(3)
    convs = {c: random_turns(random_, c % 4) for c in range(40)}
    rows = [(c, i, *turn) for c, turns in convs.items() for i, turn in enumerate(turns)]
    got = told(repair(spark.createDataFrame(rows, SCHEMA)))
    assert got == {c: every_repair(found(turns)) for c, turns in convs.items() if turns}


@pytest.mark.parametrize("stretch", [1, 3])
def test_stretches_and_blocks_change_nothing(spark, monkeypatch, stretch):
    random_ = random.Random(4)
    rows = [(c, i, *turn) for c, n in enumerate((1, 90, 2, 40, 0, 7, 130)) for i, turn in enumerate(random_turns(random_, n))]
    rows += [(9, 5, "user", "same."), (9, 5, "user", "same."), (9, None, "user", "same."), (None, 1, "user", "x."), (None, 1, "assistant", None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    whole = repair(frame)
    want, counts = told(whole), sorted(map(tuple, whole.conversations.collect()), key=repr)
    plain = {c: every_one(found([(r or " ", t or " ") for k, _, r, t in ordered(rows) if k == c])) for c in {r[0] for r in rows}}
    assert {c: v[:2] for c, v in want.items()} == plain
    monkeypatch.setattr(conversation_repair, "BLOCK_ROWS", 11)
    monkeypatch.setattr(conversation_repair, "STRETCH", stretch)
    # the changed numbers travel with the functions, which are sent by value
    cut = repair(frame)
    assert told(cut) == want
    assert sorted(map(tuple, cut.conversations.collect()), key=repr) == counts


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or " ", r[3] or " "))


def every_one(rows):
    """Cost and audit by a plain table of states."""
    after = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
    gives, states = ["u", "u", "a", "u"], {0: (0, "")}

    def better(table, state, weight):
        if state not in table or weight < table[state]:
            table[state] = weight

    def insert(table):
        for _ in range(3):
            for q, (cost, audit) in list(table.items()):
                better(table, after[q][gives[q]], (cost + 5, audit + "I"))

    for role, _, fault in rows:
        insert(states)
        new: dict = {}
        for q, (cost, audit) in states.items():
            better(new, q, (cost + 2, audit + "D"))
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault else 0
                if role[:1] in after[q]:
                    better(new, after[q][role[:1]], (cost + extra, audit + "K"))
                better(new, after[q][gives[q]], (cost + extra + 1, audit + "R"))
        states = new
    insert(states)
    return min(states[q] for q in (0, 3) if q in states)


def test_damage(spark):
    rows = [(c, t, "assistant", "Yes. No! Who?") for c in range(30) for t in (0, 1, None)]
    got = sorted(map(tuple, damage(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    want = []
    for c, t, role, text in rows:
        fault = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if fault == 4 else role, {1: "", 2: "Yes No Who"}.get(fault, text))
        want += [row] * {0: 0, 3: 2}.get(fault, 1)
    assert got == sorted(want, key=repr)


def test_empty_and_extra_columns(spark):
    empty = repair(spark.createDataFrame([], SCHEMA))
    assert empty.rows.count() == 0 and empty.conversations.count() == 0 and digests(empty.rows).count() == 0
    rows = [(1, 0, "user", "Hi.", "x", "y"), (1, 1, "assistant", "word " * 200_000 + ".", "x", "y")]
    frame = spark.createDataFrame(rows, SCHEMA + ", conv string, place string")
    assert told(repair(frame))[1][:2] == (0, "KK")


def test_digest(spark):
    rows = [(c, t, ("user", "assistant")[t % 2], f"Turn {t}.") for c in range(5) for t in range(c * 2)]
    repaired = repair(spark.createDataFrame(rows, SCHEMA))
    want = {c: hashlib.sha256("\n".join(f"{r}:{x}" for k, _, r, x in rows if k == c).encode()).hexdigest() for c in range(1, 5)}
    assert {r["conv_id"]: r["sha256"] for r in digests(repaired.rows).collect()} == want


def test_against_sql(spark):
    import oracle

    small = "/root/testdata/sf0.001"
    name = "op13_conversation_repair"
    assert oracle.compare(spark, oracle.connect(small), queries.QUERIES[name], oracles.ORACLES[name], small) is None
