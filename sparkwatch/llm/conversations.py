"""Conversation structure repair by an auction for shortest paths.

The turns of a conversation, in order, span a lattice: a node is (turns read, what the last role was), an arc an edit with an
integer cost. Every node has a price, the dual of its distance to the end. Paths start at the nodes of the last layer
first. At a path's end the cheapest arc decides: where it costs more than the node's price, the price rises and the path
contracts by that node, else it is extended along the arc, until it meets a node whose price has converged. Then all nodes on it
have converged. What is left are tight arcs, those whose cost is the fall in price, and every tight path is a cheapest one;
following them in the order D, I, K, R gives the audit that comes first in ASCII order.

Rows are dealt out by ranges of (conversation, turn), so a conversation of any length is cut into pieces of at most
``piece_rows`` rows. A conversation within a task and a piece is solved there. The pieces of the others are first
reduced to 16 costs (entry state x exit state) and the order of their audits; the same auction runs over the chain of pieces and fixes
entry and exit of each, then the pieces are traced apart from each other. Only these slim summaries of a conversation meet.

Edits: keep (0), rerole to user or assistant (1), delete (2), insert an empty turn (5); a truncated turn that isn't
deleted costs 5 more. Blank and repeated turns have to be deleted. Roles left follow ``(s?(ua)+)?`` by their first letters.

Defined results: a null role or text counts as one space; turns that are null come first; rows with equal turns are ordered by
role and text (64 characters of each, then by hash); rows with a null conversation form one conversation; repeated rows are duplicates; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, union_all

PIECE_ROWS = 2_048  # rows of a conversation solved at once
PIECE_CHARS = 4_000_000  # of text in a piece (a longer turn is a piece of its own)
INSERT, DELETE, REROLE, TRUNCATED = 5, 2, 1, 5  # costs
FAR = 1 << 60  # price of a node from which the end can't be reached
WHITE = " \t\n\x0b\f\r"
# States: nothing kept yet, after s, after u, after a. What each may be followed by, as {first letter: next state}.
FOLLOW = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
NEXT = (2, 2, 3, 2)  # where a turn made user or assistant leads
MADE = ("user", "user", "assistant", "user")
ENDS = (0, 3)
LEGAL = ("su", "ua", "au")

PIECE = "conv_id long, part int, seq int, whole boolean, kinds string, roles array<string>, texts array<string>, copies array<long>, turns array<long>"
WEIGHED = "conv_id long, part int, seq int, costs array<long>, ranks array<int>"
CHAINED = "conv_id long, part int, seq int, entry int, exit int"
REPAIRED = (
    "conv_id long, part int, seq int, first_turn long, last_turn long, distinct_turns long, rows long, blank long, duplicate long, "
    "truncated long, illegal long, first_initial string, last_initial string, cost long, audit string, turns array<struct<role:string,text:string>>"
)


# ---- the lattice of one piece


def steps_of(kinds: str, roles: list[str], copies: list[int]) -> list[tuple]:
    """The rows as lattice steps (must be deleted, first letter, extra cost, number of deletions, row)."""
    steps: list[tuple] = []
    for row, (kind, role, n) in enumerate(zip(kinds, roles, copies)):
        if kind in "bd":
            steps.append((True, "", 0, n, row))
            continue
        steps.append((False, role[:1], TRUNCATED if kind == "t" else 0, 1, row))
        if n > 1:  # its copies repeat it
            steps.append((True, "", 0, n - 1, row))
    return steps


def arcs(step: tuple, state: int) -> list[tuple]:
    """(letter, cost, state, whether the row is passed) of the edits open at a node, by letter."""
    gone, initial, extra, n, _ = step
    found = [("D", DELETE * n, state, True), ("I", INSERT, NEXT[state], False)]
    if not gone:
        if initial in FOLLOW[state]:
            found.append(("K", extra, FOLLOW[state][initial], True))
        found.append(("R", REROLE + extra, NEXT[state], True))
    return found


def settle(out: list[list[tuple]], later: list[int], states: tuple) -> list[int]:
    """Converged prices of one layer by path extension and contraction, given those of the next."""
    floor = min(later)
    price = [floor if s in states else FAR for s in range(4)]
    done = [s not in states for s in range(4)]
    for origin in states:
        path = [origin]
        while not done[origin]:
            at = path[-1]
            best, to, passed = FAR, at, True
            for _, cost, state, onward in out[at]:
                value = min(FAR, cost + (later[state] if onward else price[state]))
                if value < best:
                    best, to, passed = value, state, onward
            if price[at] < best:  # contract
                price[at] = best
                if len(path) > 1:
                    path.pop()
                elif best >= FAR:
                    done[at] = True
            elif passed or done[to]:  # a converged node: so are all on the path
                for s in path:
                    done[s] = True
            else:
                path.append(to)
    return price


def prices(steps: list[tuple], last: list[int], states: tuple = (0, 1, 2, 3)) -> list[list[int]]:
    """The price of every node, layer by layer from the end, whose prices are ``last``."""
    layers = [last]
    for step in reversed(steps):
        out = [[a for a in arcs(step, s) if a[2] in states] for s in range(4)]
        layers.append(settle(out, layers[-1], states))
    return layers[::-1]


def end_prices() -> list[int]:
    """Prices behind the last row, where turns may still be inserted."""
    free = [0 if s in ENDS else FAR for s in range(4)]
    out = [[("", 0, s, True), ("I", INSERT, NEXT[s], False)] for s in range(4)]
    return settle(out, free, (0, 1, 2, 3))


def trace(steps: list[tuple], price: list[list[int]], state: int) -> tuple[list[tuple], int]:
    """The tight arcs from ``state`` on, least letter first: [(letter, row, role made)] and the last state."""
    edits = []
    for i, step in enumerate(steps):
        passed = False
        while not passed:
            for letter, cost, to, passed in arcs(step, state):
                if price[i][state] == cost + (price[i + 1] if passed else price[i])[to]:
                    break
            edits += [(letter, step[4], MADE[state])] * (step[3] if letter == "D" else 1)
            state = to
    return edits, state


def finish(state: int) -> tuple[list[tuple], int]:
    """Turns inserted behind the last row: (edits, cost)."""
    edits, cost = [], 0
    while state not in ENDS:
        edits.append(("I", -1, MADE[state]))
        cost, state = cost + INSERT, NEXT[state]
    return edits, cost


# the states from which an exit state can be reached at all
SOURCES = ((0,), (0, 1), (0, 1, 2, 3), (0, 1, 2, 3))


def to_exit(steps: list[tuple], leave: int) -> list[list[int]]:
    return prices(steps, [0 if s == leave else FAR for s in range(4)], SOURCES[leave])


# ---- tasks


def cut(piece_rows: int):
    """Rows in order of (conversation, turn, role, text) into pieces; ``whole`` where nothing of it can be elsewhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part = TaskContext.get().partitionId()

        def piece(rows: list[dict], seq: int, whole: bool) -> dict:
            lists = {c: [r[c] for r in rows] for c in ("role", "text", "copies", "turn")}
            row = {"conv_id": rows[0]["conv_id"], "part": part, "seq": seq, "whole": whole, "kinds": "".join(r["kind"] for r in rows)}
            return row | {"roles": lists["role"], "texts": lists["text"], "copies": lists["copies"], "turns": lists["turn"]}

        seq, held, chars, conv, broken = 0, [], 0, None, True  # the first conversation may have begun in another task
        for row in rows_in(batches):
            if held and row["conv_id"] != conv:
                yield piece(held, seq, not broken)
                seq, held, chars, broken = seq + 1, [], 0, False
            elif held and (len(held) >= piece_rows or chars + len(row["text"]) > PIECE_CHARS):
                yield piece(held, seq, False)
                seq, held, chars, broken = seq + 1, [], 0, True
            conv = row["conv_id"]
            held.append(row)
            chars += len(row["text"])
        if held:
            yield piece(held, seq, False)  # it may go on in the next task

    return run


def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """For every piece the cost from each entry to each exit state, and the place of its audit among those of an entry."""
    for row in rows_in(batches):
        steps = steps_of(row["kinds"], row["roles"], row["copies"])
        by_exit = [to_exit(steps, e) for e in range(4)]
        costs, ranks = [], []
        for s in range(4):
            open_ = [e for e in range(4) if by_exit[e][0][s] < FAR]
            audits = sorted(("".join(x[0] for x in trace(steps, by_exit[e], s)[0]), e) for e in open_)
            order = [e for _, e in audits]
            costs += [by_exit[e][0][s] for e in range(4)]
            ranks += [order.index(e) if e in open_ else 9 for e in range(4)]
        yield {"conv_id": row["conv_id"], "part": row["part"], "seq": row["seq"], "costs": costs, "ranks": ranks}


def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Entry and exit of every piece: the same auction over the pieces of a conversation, which come one after the other."""
    for _, group in groupby(rows_in(batches), key=lambda r: r["conv_id"]):
        pieces = list(group)
        layers = [end_prices()]
        for p in reversed(pieces):
            out = [[("", p["costs"][4 * s + e], e, True) for e in range(4) if p["costs"][4 * s + e] < FAR] for s in range(4)]
            layers.append(settle(out, layers[-1], (0, 1, 2, 3)))
        layers.reverse()
        state = 0
        for i, p in enumerate(pieces):
            tight = [e for e in range(4) if p["costs"][4 * state + e] < FAR and layers[i][state] == p["costs"][4 * state + e] + layers[i + 1][e]]
            leave = min(tight, key=lambda e: p["ranks"][4 * state + e])
            yield {"conv_id": p["conv_id"], "part": p["part"], "seq": p["seq"], "entry": state, "exit": leave}
            state = leave


def mended(row: dict, entry: int, leave: int | None) -> dict:
    """A piece repaired, with what has to be known of it; ``leave`` is None for the conversation's only piece."""
    steps = steps_of(row["kinds"], row["roles"], row["copies"])
    price = prices(steps, end_prices()) if leave is None else to_exit(steps, leave)
    edits, state = trace(steps, price, entry)
    cost = price[0][entry]
    if leave is None:
        edits += finish(state)[0]
    turns = []
    for letter, at, made in edits:
        if letter == "I":
            turns.append({"role": made, "text": ""})
        elif letter != "D":
            turns.append({"role": row["roles"][at] if letter == "K" else made, "text": row["texts"][at]})
    initials = [r[:1] for r in row["roles"]]
    legal = [x + y in LEGAL for x, y in zip(initials, initials[1:])]
    known = [t for t in row["turns"] if t is not None]
    kinds, n = row["kinds"], row["copies"]
    return {
        "conv_id": row["conv_id"], "part": row["part"], "seq": row["seq"],
        "first_turn": known[0] if known else None, "last_turn": known[-1] if known else None, "distinct_turns": len(set(known)),
        "rows": sum(n),
        "blank": sum(c for k, c in zip(kinds, n) if k == "b"),
        "duplicate": sum(c if k == "d" else 0 if k == "b" else c - 1 for k, c in zip(kinds, n)),
        "truncated": kinds.count("t"),
        "illegal": sum(c - 1 for c in n) + legal.count(False),
        "first_initial": initials[0], "last_initial": initials[-1],
        "cost": cost, "audit": "".join(x[0] for x in edits), "turns": turns,
    }


def mend_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for row in rows_in(batches):
        yield mended(row, 0, None)


def mend_piece(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for row in rows_in(batches):
        yield mended(row, row["entry"], row["exit"])


SUMMARY = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row per conversation from its repaired pieces in order; texts pass through and aren't held."""
    for conv, group in groupby(rows_in(batches), key=lambda r: r["conv_id"]):
        sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)
        audit, digest, written = [], hashlib.sha256(), False
        lowest = highest = last = None
        distinct, state = 0, 0
        for p in group:
            for c in sums:
                sums[c] += p[c]
            if last is not None and last + p["first_initial"] not in LEGAL:
                sums["illegal"] += 1
            last = p["last_initial"]
            if p["first_turn"] is not None:
                distinct += p["distinct_turns"] - (p["first_turn"] == highest)
                lowest = p["first_turn"] if lowest is None else lowest
                highest = p["last_turn"]
            audit.append(p["audit"])
            for t in p["turns"]:
                digest.update(("\n" * written + t["role"] + ":" + t["text"]).encode())
                written = True
                state = FOLLOW[state][t["role"][:1]]
        edits, cost = finish(state)  # of a conversation in pieces; one that is whole has ended
        for _, _, role in edits:
            digest.update(("\n" * written + role + ":").encode())
            written = True
        sums["cost"] += cost
        audit.append("I" * len(edits))
        gaps = 0 if lowest is None else highest - lowest + 1 - distinct
        yield {"conv_id": conv, "gaps": gaps, **sums, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}


def rows_in(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of batches as dictionaries, a few at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, 16):
            yield from batch.slice(start, 16).to_pylist()


ARROW_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
ARROW_TYPES["array<struct<role:string,text:string>>"] = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def arrow_schema(ddl: str) -> pa.Schema:
    named = (field.split(" ") for field in ddl.split(", "))
    return pa.schema([(name, ARROW_TYPES[kind]) for name, kind in named])


def in_batches(task, ddl: str):
    """A task that yields rows as one for ``mapInArrow``, with few rows or characters in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, held, weight = arrow_schema(ddl), [], 0
        for row in task(batches):
            held.append(row)
            weight += len(row.get("audit", "")) + sum(len(t["text"]) for t in row.get("turns", ()) if isinstance(t, dict)) + sum(map(len, row.get("texts", ())))
            if len(held) == 256 or weight > PIECE_CHARS:
                yield pa.RecordBatch.from_pylist(held, schema)
                held, weight = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    return run


def mapped(df: DataFrame, task, ddl: str) -> DataFrame:
    return df.mapInArrow(in_batches(task, ddl), ddl)


# ---- frames


def faulted(df: DataFrame) -> DataFrame:
    """Equal rows as one with their number, and the first fault of each: blank, duplicate, truncated or none.

    Rows are counted before they move. Whether a role and text was seen earlier is found from the earliest turn of each, which is aggregated
    per task first, and a join that may be split where a key is hot.
    """
    space = F.lit(" ")
    rows = df.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    end = F.rtrim("text", F.lit(WHITE))
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    rows = rows.withColumns({"digest": F.sha2("text", 256), "end": F.right(end, F.lit(1)), "conv": conv})
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    earliest = rows.groupBy("conv", "role", "digest").agg(F.min(place).alias("earliest"))
    seen = rows.join(earliest, ["conv", "role", "digest"], "left")
    kind = (
        F.when(F.col("end") == "", "b")
        .when(~F.col("turn").eqNullSafe(F.col("earliest.turn")), "d")
        .when(~F.col("end").isin(".", "!", "?"), "t")
        .otherwise("o")
    )
    return seen.select("conv_id", "turn", "role", "text", "copies", "digest", kind.alias("kind"))


def repair_conversations(df: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """The repaired conversations in pieces: (conv_id, part, seq, ..., cost, audit, turns), in order of part and seq.

    ``df`` has conv_id, turn, role and text. A conversation has one piece unless it is long or lies across two tasks. Turns
    still missing behind the last piece of such a conversation are added by ``summary``.
    """
    # the keys of a range exchange are sampled by the driver: beginnings and a hash stand for texts
    order = [F.col("conv_id"), F.col("turn"), F.substring("role", 1, 64), F.substring("text", 1, 64), F.col("digest"), F.col("role")]
    ordered = faulted(df).repartitionByRange(*order).sortWithinPartitions(*order).drop("digest")
    pieces = stored(mapped(ordered, cut(piece_rows), PIECE), "conversation-pieces")
    whole = mapped(pieces.filter("whole").drop("whole"), mend_whole, REPAIRED)
    rest = pieces.filter("NOT whole").drop("whole")
    weighed = mapped(rest, weigh, WEIGHED)
    chained = mapped(weighed.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq"), chain, CHAINED)
    placed = mapped(rest.join(chained.drop("conv_id"), ["part", "seq"]), mend_piece, REPAIRED)
    return stored(union_all([whole.withColumn("whole", F.lit(True)), placed.withColumn("whole", F.lit(False))]), "conversations-repaired")


def summary(repaired: DataFrame) -> DataFrame:
    """One row per conversation: gaps, faults, cost, audit and the hash of its repaired turns."""
    whole = mapped(repaired.filter("whole").drop("whole"), summarise, SUMMARY)
    pieces = repaired.filter("NOT whole").drop("whole")
    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return whole.unionByName(mapped(ordered, summarise, SUMMARY))


def damaged(df: DataFrame) -> DataFrame:
    """Conversations with the faults of the check: dropped, emptied, unpunctuated, repeated and misattributed turns."""
    space = F.lit(" ")
    name = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    rows = df.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(name.cast("binary")) % 20).alias("fault"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.filter("fault <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")
