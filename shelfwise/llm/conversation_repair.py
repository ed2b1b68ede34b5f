"""Conversations put back into shape at the least cost, by lightest derivations.

An item says that the first i rows of a stretch of a conversation are read, from one state
of the role pattern ``(s?(ua)+)?`` to another. Edits are deductions between items; their
weights (cost, audit) only grow, and the order of two derivations of an item stays under
any further edit, so Knuth's agenda pops every item first by its lightest derivation and
stops when the goal is popped.

Rows are sorted over the cluster by conversation and turn; what a task holds is a block,
and a conversation that crosses blocks is read in stretches. A stretch gives the lightest
derivation from every state to every state. Two stretches join into one: costs add,
and audits compare by their ranks in either part, since no audit of a stretch begins
another one (insertions stand before the row they precede). So of a conversation of any
length only a few numbers a block ever meet in one place.
"""

from __future__ import annotations

import hashlib
import heapq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.batches import bounded
from shelfwise.workspace import write_down

#: Rows of a block, about, and of a stretch whose audits are compared letter by letter.
BLOCK_ROWS, STRETCH = 100_000, 64
BLANKS = " \t\n\x0b\x0c\r"
#: Costs of the edits, and what a truncated row adds where it stays.
RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States: nothing yet, behind s, u and a. What may follow, and the role that an edit gives.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
GIVES = ("u", "u", "a", "u")
#: Insertions that end the pattern.
CLOSING = ("", "II", "I", "")
STATES = range(4)


class Repaired(NamedTuple):
    """``rows``: the repaired turns; ``conversations``: one row each, with faults, cost and audit."""

    rows: DataFrame
    conversations: DataFrame


def damage(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Faults by crc32 of ``conversation:turn`` mod 20, as a test of the repair.

    0 drops a row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes its role
    ``user``. A null is one space, in the key too; repeated rows are damaged alike.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conversation, turn)])
    rows = turns.select(
        F.col(conversation).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("fault"),
    )
    changed = rows.where("fault <> 0").select(
        "conv_id", "turn",
        F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, F.lit(""))
        .when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("_again"),
    )
    return changed.drop("_again")


def lightest(rows: list[tuple[str, str]], entry: int = 0, goal: bool = True) -> dict[int, tuple[int, str]]:
    """Lightest ``(cost, audit)`` by state behind ``rows``; to the goal only, its entry is -1.

    A row is its fault (``""``, ``"delete"`` for blank and duplicate ones, ``"truncated"``) and the initial of its role.
    """
    n = len(rows)
    agenda, done, out = [(0, "", 0, entry)], set(), {}
    while agenda:
        cost, audit, i, state = heapq.heappop(agenda)
        if i > n:
            return {-1: (cost, audit)}
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == n:
            if goal:
                heapq.heappush(agenda, (cost + INSERT * len(CLOSING[state]), audit + CLOSING[state], n + 1, 0))
            else:
                out[state] = (cost, audit)
            continue
        fault, initial = rows[i]
        heapq.heappush(agenda, (cost + DELETE, audit + "D", i + 1, state))
        after = NEXT[state][GIVES[state]]
        if fault != "delete":
            stays = TRUNCATED if fault else 0
            if initial in NEXT[state]:
                heapq.heappush(agenda, (cost + stays, audit + "K", i + 1, NEXT[state][initial]))
            heapq.heappush(agenda, (cost + stays + RENAME, audit + "R", i + 1, after))
        heapq.heappush(agenda, (cost + INSERT, audit + "I", i, after))
    return out


def _walk(rows, audit: str, state: int) -> str:
    """For every letter of ``audit`` the initial that an R or an I gives, ``-`` for the others."""
    out, i = [], 0
    for letter in audit:
        out.append(GIVES[state] if letter in "RI" else "-")
        if letter in "RI":
            state = NEXT[state][GIVES[state]]
        elif letter == "K":
            state = NEXT[state][rows[i][1]]
        i += letter != "I"
    return "".join(out)


def _ranked(arcs: dict) -> dict:
    """``(cost, what orders audits)`` with the latter replaced by ranks."""
    order = {x: i for i, x in enumerate(sorted({a[1] for a in arcs.values()}))}
    return {k: (a[0], order[a[1]]) for k, a in arcs.items()}


def joined(left: dict, right: dict) -> tuple[dict, dict]:
    """Arcs ``(from, to): (cost, rank)`` over two neighbours, and the states between them."""
    best, middle = {}, {}
    for (p, m), (cost, rank) in left.items():
        for q in STATES:
            if (m, q) in right:
                more, then = right[m, q]
                weight = (cost + more, (rank, then))
                if (p, q) not in best or weight < best[p, q]:
                    best[p, q], middle[p, q] = weight, m
    return _ranked(best), middle


def _stretches(rows: list) -> list[list]:
    return [rows[i : i + STRETCH] for i in range(0, len(rows), STRETCH)]


def _arcs_of(rows: list) -> tuple[dict, list, list]:
    """Arcs over ``rows``, those of its stretches with audits, and the states chosen between."""
    parts, total, middles = [], None, []
    for some in _stretches(rows):
        parts.append({(p, q): arc for p in STATES for q, arc in lightest(some, p, False).items()})
        own = _ranked(parts[-1])
        if total is None:
            total = own
        else:
            total, middle = joined(total, own)
            middles.append(middle)
    return total, parts, middles


def _audit_between(rows: list, entry: int, leave: int, last: bool) -> str:
    """The lightest audit of ``rows`` from one state to another, closed if they are the last."""
    _, parts, middles = _arcs_of(rows)
    out, at = [CLOSING[leave] if last else ""], leave
    for i in range(len(parts) - 1, -1, -1):
        before = middles[i - 1][entry, at] if i else entry
        out.append(parts[i][before, at][1])
        at = before
    return "".join(reversed(out))


def _to_goal(arcs: dict, entry: int = 0) -> tuple[int, int]:
    """Cost and last state of the lightest way from ``entry`` to the goal."""
    cost, _, leave = min((arc[0] + INSERT * len(CLOSING[q]), arc[1], q) for (p, q), arc in arcs.items() if p == entry)
    return cost, leave


def _runs(table: pa.Table):
    """``(begin, end, rows)`` of every conversation of a block sorted by place; rows without faults yet."""
    column = table["conv"].combine_chunks() if isinstance(table["conv"], pa.ChunkedArray) else table["conv"]
    codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1], [True]])).tolist()
    initials, keys = table["initial"].to_pylist(), table["key"].to_pylist()
    blank, cut_off = table["blank"].to_pylist(), table["cut_off"].to_pylist()
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield a, b, initials[a:b], keys[a:b], blank[a:b], cut_off[a:b]


def _faults(initials, keys, blank, cut_off, seen: set) -> tuple[list, list[int]]:
    """Rows as :func:`lightest` takes them, and how many are blank, duplicate and truncated."""
    seen, rows, counts = set(seen), [], [0, 0, 0]
    for initial, key, is_blank, is_cut in zip(initials, keys, blank, cut_off):
        which = 0 if is_blank else 1 if key in seen else 2 if is_cut else None
        seen.add(key)
        if which is not None:
            counts[which] += 1
        rows.append(("" if which is None else "truncated" if which == 2 else "delete", initial))
    return rows, counts


def _legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


_SOLVED = "block long, begin long, wide boolean, first_turn long, last_turn long, turns long, blank long, duplicate long, truncated long, illegal long, first string, last string, arcs array<struct<p:int,q:int,cost:long,rank:int>>, cost long, audit string, gives string"
_PLAIN = ("block", "begin", "wide", "first_turn", "last_turn", "turns", "blank", "duplicate", "truncated", "illegal", "first", "last", "arcs", "cost", "audit", "gives")
_ARROW = dict(zip(_PLAIN, (
    pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 7, pa.string(), pa.string(),
    pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32())])), pa.int64(), pa.string(), pa.string(),
), strict=True))


def _table(convs: pa.ChunkedArray, rows: list[dict], names) -> pa.Table:
    return pa.table({"conv": convs, **{n: pa.array([r.get(n) for r in rows], _ARROW[n]) for n in names}})


def _block(facts: pa.Table, again: pa.Table) -> pa.Table:
    """Counts of each conversation of a block; its audit if it lies in this block alone, otherwise its arcs."""
    facts = facts.sort_by("place")
    seen: dict = {}
    for conv, key in zip(again["conv"].to_pylist(), again["key"].to_pylist()):
        seen.setdefault(conv, set()).add(key)
    places, all_turns, wide = facts["place"], facts["turn"].to_pylist(), facts["wide"].to_pylist()
    begins, out = [], []
    for a, b, initials, *rest in _runs(facts):
        rows, counts = _faults(initials, *rest, seen.get(facts["conv"][a].as_py(), ()) if wide[a] else ())
        turns = [t for t in all_turns[a:b] if t is not None]
        begins.append(a)
        one = {
            "block": facts["block"][a].as_py(), "begin": places[a].as_py(), "wide": wide[a],
            "first_turn": min(turns, default=None), "last_turn": max(turns, default=None), "turns": len(set(turns)),
            "blank": counts[0], "duplicate": counts[1], "truncated": counts[2],
            "illegal": sum(not _legal(x, y) for x, y in zip(initials, initials[1:])), "first": initials[0], "last": initials[-1],
        }
        if wide[a] or len(rows) > STRETCH:
            arcs = _arcs_of(rows)[0]
            if wide[a]:
                one["arcs"] = [{"p": p, "q": q, "cost": cost, "rank": rank} for (p, q), (cost, rank) in arcs.items()]
            else:
                one["cost"], leave = _to_goal(arcs)
                one["audit"] = _audit_between(rows, 0, leave, True)
        else:
            one["cost"], one["audit"] = lightest(rows)[-1]
        if one.get("audit") is not None:
            one["gives"] = _walk(rows, one["audit"], 0)
        out.append(one)
    return _table(facts["conv"].take(pa.array(begins)), out, _PLAIN)


_WAY = "block long, entry int, leave int, is_last boolean, extra_illegal long, shared_turns long, cost long"


def _ways(table: pa.Table) -> pa.Table:
    """The states in which each block of one conversation is entered and left, and what the seams add."""
    table = table.sort_by("block")
    blocks = table.select(["block", "first_turn", "last_turn", "first", "last", "arcs"]).to_pylist()
    arcs = [{(x["p"], x["q"]): (x["cost"], x["rank"]) for x in b["arcs"]} for b in blocks]
    total, middles = arcs[0], []
    for own in arcs[1:]:
        total, middle = joined(total, own)
        middles.append(middle)
    _, at = _to_goal(total)
    out = []
    for i in range(len(blocks) - 1, -1, -1):
        before = middles[i - 1][0, at] if i else 0
        last = i == len(blocks) - 1
        out.append({
            "block": blocks[i]["block"], "entry": before, "leave": at, "is_last": last,
            "extra_illegal": int(i > 0 and not _legal(blocks[i - 1]["last"], blocks[i]["first"])),
            "shared_turns": int(i > 0 and blocks[i]["first_turn"] is not None and blocks[i - 1]["last_turn"] == blocks[i]["first_turn"]),
            "cost": arcs[i][before, at][0] + (INSERT * len(CLOSING[at]) if last else 0),
        })
        at = before
    kinds = {"block": pa.int64(), "entry": pa.int32(), "leave": pa.int32(), "is_last": pa.bool_(), "extra_illegal": pa.int64(), "shared_turns": pa.int64(), "cost": pa.int64()}
    convs = table["conv"].take(pa.array(range(len(blocks) - 1, -1, -1)))
    return pa.table({"conv": convs, **{n: pa.array([r[n] for r in out], k) for n, k in kinds.items()}})


def _along(facts: pa.Table, again: pa.Table) -> pa.Table:
    """Audits of the conversations that cross blocks; every row carries the way its block is passed."""
    facts = facts.sort_by("place")
    seen: dict = {}
    for conv, key in zip(again["conv"].to_pylist(), again["key"].to_pylist()):
        seen.setdefault(conv, set()).add(key)
    begins, out = [], []
    for a, b, *rest in _runs(facts):
        rows, _ = _faults(*rest, seen.get(facts["conv"][a].as_py(), ()))
        entry, leave, last = (facts[c][a].as_py() for c in ("entry", "leave", "is_last"))
        audit = _audit_between(rows, entry, leave, last)
        begins.append(a)
        out.append({"block": facts["block"][a].as_py(), "begin": facts["place"][a].as_py(), "audit": audit, "gives": _walk(rows, audit, entry)})
    return _table(facts["conv"].take(pa.array(begins)), out, ("block", "begin", "audit", "gives"))


def _spelt(batches):
    """One row for every letter of an audit but D: the row it stands for, or comes before."""
    for batch in batches:
        begin, audit, gives = batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()
        for i in range(batch.num_rows):
            letters, roles = (np.frombuffer(x[i].encode(), np.uint8) for x in (audit, gives))
            reads = letters != ord("I")
            place = begin[i] + np.cumsum(reads) - reads
            kept = np.flatnonzero(letters != ord("D"))
            if len(kept):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([i] * len(kept))), pa.array(place[kept]), pa.array(kept, pa.int64()),
                        pa.array(letters[kept] == ord("I")), pa.array([{"u": "user", "a": "assistant"}.get(chr(x)) for x in roles[kept]], pa.string()),
                    ],
                    ["conv", "place", "nth", "added", "new_role"],
                )


def repair(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repaired:
    """The turns of every conversation, repaired at the least cost, and what was found and done.

    A conversation's rows are read by turn (nulls first), then role and text. The first of
    these is a row's fault: blank, duplicate (role and text of an earlier row), truncated
    (does not end in ``.!?``). Keeping a row costs 0, a new role (user or assistant) 1,
    deleting it 2 (a must for blank and duplicate ones), inserting an empty turn 5; truncated
    rows that stay add 5. The initials of the roles follow ``(s?(ua)+)?`` afterwards. Of
    the cheapest repairs the one with the smallest audit (initials of the edits) is made.

    ``rows``: ``conv_id, place, nth, role, text, added`` (order: place, nth).
    ``conversations``: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``.
    A null role or text is one space, which makes a role none of the three and a text blank;
    a null conversation is a conversation. Other columns do not come back; repeated rows are
    duplicates; an empty table gives empty ones.
    """
    null = F.lit(" ")
    read = turns.select(
        F.col(conversation).alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), null).alias("role"), F.coalesce(F.col(text), null).alias("text"),
    )
    conf = turns.sparkSession.conf
    blocks = max(int(conf.get("spark.sql.shuffle.partitions")), read.count() // BLOCK_ROWS + 1)
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text", "n"]
    ordered = read.withColumn("n", F.monotonically_increasing_id()).repartitionByRange(blocks, *order).sortWithinPartitions(*order)
    body = F.rtrim(F.col("text"), F.lit(BLANKS))
    placed = write_down(
        ordered.drop("n").select(
            "*", F.monotonically_increasing_id().alias("place"), F.spark_partition_id().cast("long").alias("block"),
            F.substring("role", 1, 1).alias("initial"), (body == "").alias("blank"),
            (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("cut_off"),
            F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))).alias("key"),
        ),
        "turns",
    ).table
    kind = placed.schema["conv"].dataType.simpleString()

    # Conversations that cross blocks: the last of one block and the first of the next. At most one a block.
    edge = placed.groupBy("block").agg(F.min_by(F.struct("conv"), "place").alias("a"), F.max_by(F.struct("conv"), "place").alias("b"))
    edge = edge.select("block", F.explode(F.array("a", "b")).alias("e")).select("block", F.col("e.conv").alias("conv")).distinct()
    wide = write_down(edge.groupBy("conv").agg(F.count("*").alias("n")).where("n > 1").select(F.col("conv").alias("w")), "wide").table
    is_wide = F.col("conv").eqNullSafe(F.col("w"))
    facts = placed.select("conv", "block", "place", "turn", "initial", "blank", "cut_off", "key")
    crossing = facts.join(F.broadcast(wide), is_wide).drop("w")
    # What an earlier block of the conversation has already; a group has at most one row a block.
    once = crossing.select("conv", "block", "key").distinct()
    again = once.withColumn("from", F.min("block").over(Window.partitionBy("conv", "key"))).where("block > from").drop("from")
    again = write_down(again, "again").table

    marked = facts.join(F.broadcast(wide.withColumn("wide", F.lit(True))), is_wide, "left").drop("w")
    marked = marked.withColumn("wide", F.coalesce("wide", F.lit(False)))
    solved = write_down(
        bounded(marked).groupBy("block").cogroup(again.groupBy("block")).applyInArrow(_block, f"conv {kind}, {_SOLVED}"), "solved"
    ).table
    ways = write_down(solved.where("wide").groupBy("conv").applyInArrow(_ways, f"conv {kind}, {_WAY}"), "ways").table
    way = ways.select(F.col("conv").alias("w"), F.col("block").alias("v"), "entry", "leave", "is_last")
    passed = crossing.join(F.broadcast(way), is_wide & (F.col("block") == F.col("v"))).drop("w", "v")
    audited = write_down(
        passed.groupBy("block").cogroup(again.groupBy("block")).applyInArrow(_along, f"conv {kind}, block long, begin long, audit string, gives string"),
        "audited",
    ).table

    own = solved.where("NOT wide")
    audits = own.select("conv", "block", "begin", "audit", "gives").unionByName(audited)
    seams = ways.groupBy("conv").agg(
        F.sum("extra_illegal").alias("extra"), F.sum("shared_turns").alias("shared"), F.sum("cost").alias("wide_cost")
    ).withColumnRenamed("conv", "w")
    spelt = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]), "")
    told = audits.groupBy("conv").agg(spelt.alias("audit")).withColumnRenamed("conv", "c")
    counted = solved.groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost", "turns")],
        F.min("first_turn").alias("low"), F.max("last_turn").alias("high"),
    )
    zero = F.lit(0).cast("long")
    whole = counted.join(F.broadcast(seams), is_wide, "left").join(told, F.col("conv").eqNullSafe(F.col("c")))
    distinct = F.col("turns") - F.coalesce("shared", zero)
    conversations = whole.select(
        F.col("conv").alias("conv_id"), F.coalesce(F.col("high") - F.col("low") + 1 - distinct, zero).alias("gaps"),
        "blank", "duplicate", "truncated", (F.col("illegal") + F.coalesce("extra", zero)).alias("illegal"),
        F.coalesce("wide_cost", "cost").alias("cost"), "audit",
    )

    edits = audits.select("conv", "begin", "audit", "gives").mapInArrow(_spelt, f"conv {kind}, place long, nth long, added boolean, new_role string")
    edits = write_down(edits, "edits").table
    columns = [F.col("conv").alias("conv_id"), "place", "nth", "role", "text", "added"]
    kept = edits.where("NOT added").join(placed.select("place", "role", "text"), "place")
    kept = kept.withColumn("role", F.coalesce("new_role", "role")).select(*columns)
    added = edits.where("added").withColumn("role", F.col("new_role")).withColumn("text", F.lit("")).select(*columns)
    return Repaired(kept.unionByName(added), conversations)


def _hasher(batches):
    """SHA-256 of the lines of each conversation, which come one after the other."""
    current, state = None, None
    for batch in batches:
        names = batch.column(0).to_pylist()
        for conv, line in zip(names, batch.column(1)):
            if state is None or conv != current:
                if state is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([current], batch.schema.types[0]), pa.array([state.hexdigest()])], ["conv_id", "sha256"])
                current, state = conv, hashlib.sha256(line.as_buffer())
            else:
                state.update(b"\n")
                state.update(line.as_buffer())
        kind = batch.schema.types[0]
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([current], kind), pa.array([state.hexdigest()])], ["conv_id", "sha256"])


def digests(rows: DataFrame) -> DataFrame:
    """``conv_id, sha256`` of the repaired ``role:text`` lines of each conversation, joined by newlines.

    The hash of a conversation takes its lines in order, hence one task; they stream through
    it and are never held.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    lines = rows.select("conv_id", F.concat("role", F.lit(":"), "text").alias("line"), "place", "nth")
    lines = bounded(lines).repartition("conv_id").sortWithinPartitions("conv_id", "place", "nth").select("conv_id", "line")
    return lines.mapInArrow(_hasher, f"conv_id {kind}, sha256 string")
