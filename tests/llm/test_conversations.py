"""Conversation repair against a search over all edit sequences, whole conversations and pieces of them."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from sparkwatch.llm import conversations as co
from sparkwatch.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string, copies int, kind string, part int, digest string"
ROLES = ("user", "assistant", "system", "tool", "", "user", "assistant")
TEXTS = ("Done.", "Done.", "what", "Is it?", "", " \n", "no end", "Yes!", "a.\n", "Done. ")


def broken(rows):
    """The damage of the check, row by row."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(name.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def repaired(rows):
    """One conversation by brute force: cheapest edits by dynamic programming over suffixes, ties by string."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, kinds = set(), []
    for _, _, role, text in rows:
        left = re.findall(r"[^\x20\x09-\x0D]", text)
        kinds.append("b" if not left else "d" if (role, text) in seen else "t" if left[-1] not in ".!?" else "o")
        seen.add((role, text))
    follow = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    @cache
    def best(i, state, inserted=0):
        """(cost, audit, lines) from here to the end; no more than three turns in a row are worth inserting."""
        found = []
        if i == len(rows):
            if state in (0, 3):
                found.append((0, "", ()))
        else:
            _, _, role, text = rows[i]
            extra = 5 if kinds[i] == "t" else 0
            cost, audit, lines = best(i + 1, state)
            found.append((2 + cost, "D" + audit, lines))
            if kinds[i] not in "bd":
                if role[:1] in follow[state]:
                    cost, audit, lines = best(i + 1, follow[state][role[:1]])
                    found.append((extra + cost, "K" + audit, (f"{role}:{text}", *lines)))
                for made in ("user", "assistant"):
                    if made[0] in follow[state]:
                        cost, audit, lines = best(i + 1, follow[state][made[0]])
                        found.append((1 + extra + cost, "R" + audit, (f"{made}:{text}", *lines)))
        if inserted < 3:
            for made in ("user", "assistant"):
                if made[0] in follow[state]:
                    cost, audit, lines = best(i, follow[state][made[0]], inserted + 1)
                    found.append((5 + cost, "I" + audit, (f"{made}:", *lines)))
        return min(found, default=(10**9, "", ()))

    cost, audit, lines = best(0, 0)
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(x[2][:1] + y[2][:1] not in ("su", "ua", "au") for x, y in zip(rows, rows[1:]))
    return gaps, kinds.count("b"), kinds.count("d"), kinds.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def by_conversation(rows):
    groups: dict = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    return groups


@pytest.fixture(scope="module")
def sample():
    rng = random.Random(3)
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 12)):
            rows.append((conv, turn * rng.choice((1, 1, 2)), rng.choice(ROLES), rng.choice(TEXTS)))
    rows += [(100, None, "user", "first?"), (100, None, None, None), (100, 3, "assistant", "ok."), (None, 1, "system", "s."), (None, 2, "user", None)]
    rows += [(101, 1, "user", "Same."), (101, 1, "user", "Same."), (101, 1, "user", "Same."), (102, None, "user", ""), (103, 0, "assistant", "x" * 70_000 + ".")]
    # one conversation with a third of all rows
    rows += [(104, t, rng.choice(ROLES), rng.choice((*TEXTS, f"turn {t}.", f"{t} open"))) for t in range(220)]
    return rows


def result(frame):
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in frame.collect()}


@pytest.mark.parametrize("piece_rows", [2_048, 3, 1])
def test_repair_agrees_with_brute_force(spark, sample, piece_rows):
    """Whole conversations and, with small pieces, the chain over them."""
    frame = spark.createDataFrame([(*r, 7, "x", 1, "h") for r in sample], SCHEMA)
    got = result(co.summary(co.repair_conversations(frame, piece_rows)))
    as_text = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in sample]
    assert got == {conv: repaired(rows) for conv, rows in by_conversation(as_text).items()}


def test_pieces_hold_the_repaired_turns(spark, sample):
    frame = spark.createDataFrame([(*r, 7, "x", 1, "h") for r in sample], SCHEMA)
    pieces = co.repair_conversations(frame, 16).collect()
    assert max(len(p["turns"]) for p in pieces) <= 3 * 16
    first = {}
    for p in sorted(pieces, key=lambda p: (p["part"], p["seq"])):
        first.setdefault(p["conv_id"], []).extend(t["role"][0] for t in p["turns"])
    assert all(re.fullmatch("s?(ua)*u?", "".join(x)) for x in first.values())


def test_empty_table(spark):
    assert co.summary(co.repair_conversations(spark.createDataFrame([], SCHEMA))).collect() == []


def test_query_agrees_with_brute_force(spark, sample, tmp_path):
    spark.createDataFrame([(*r, 7, "x", 1, "h") for r in sample], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = result(queries.op13_auction_conversation_repair(spark, str(tmp_path)))
    groups = by_conversation(broken(sample))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {conv: repaired(groups[conv]) if conv in groups else nothing for conv in by_conversation(sample)}


def test_converged_prices_are_distances():
    """A truncated, misattributed row between proper ones: the prices fall along the tight arcs by their costs."""
    steps = co.steps_of("otod", ["user", "user", "assistant", "user"], [1, 1, 2, 1])
    price = co.prices(steps, co.end_prices())
    edits, state = co.trace(steps, price, 0)
    assert (price[0][0], "".join(e[0] for e in edits), state) == (6, "KDKDD", 3)
