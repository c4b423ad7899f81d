"""Conversation repair: all edit lists by brute force, chunks, odd rows, the query against plain Python."""

import random
from collections import defaultdict
from hashlib import sha256
from zlib import crc32

import pytest

from iotlake.llm import turn_repair as tr
from iotlake.llm.queries import op12_turn_repair

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\f\r"


def cheapest(initials, faults):
    """(cost, edits, roles) of the best edits: a table of suffixes, from the end."""
    best = {q: ((0, "", ()) if q in (0, 3) else None) for q in range(4)}

    def more(found, cost, edit, role):
        return None if found is None else (found[0] + cost, edit + found[1], (role,) + found[2])

    def inserted(table):
        while True:
            new = {}
            for q in range(4):
                to = tr.FOLLOWS[q]
                options = [x for x in (table[q], more(table[to], 2, "I", ("I", tr.CHOSEN[to]))) if x is not None]
                new[q] = min(options, key=lambda x: x[:2]) if options else None
            if new == table:
                return table
            table = new

    best = inserted(best)
    for initial, fault in zip(reversed(initials), reversed(faults)):
        table = {}
        for q in range(4):
            options = [more(best[q], 3, "D", None)]
            if fault in "kt":
                extra = int(fault == "t")
                to = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(initial, {}).get(q)
                if to is not None:
                    options.append(more(best[to], extra, "K", ("K", None)))
                options.append(more(best[tr.FOLLOWS[q]], 2 + extra, "R", ("R", tr.CHOSEN[tr.FOLLOWS[q]])))
            options = [x for x in options if x is not None]
            table[q] = min(options, key=lambda x: x[:2]) if options else None
        best = inserted(table)
    return best[0]


def plain_repair(rows):
    """The query's columns but conv_id, of the rows (turn, role, text) of one conversation."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2][:64].encode()))
    seen, faults = set(), ""
    for _, role, text in rows:
        shown = text.rstrip(SPACE)
        faults += "b" if not shown else "d" if (role, text) in seen else "t" if shown[-1] not in ".!?" else "k"
        seen.add((role, text))
    initials = [r[1][:1] for r in rows]
    turns = {r[0] for r in rows if r[0] is not None}
    cost, edits, roles = cheapest(initials, faults)
    lines, at = [], 0
    for edit, choice in zip(edits, roles):
        if edit == "I":
            lines.append(choice[1] + ":")
            continue
        if edit != "D":
            lines.append((choice[1] or rows[at][1]) + ":" + rows[at][2])
        at += 1
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost,
            edits, sha256("\n".join(lines).encode()).hexdigest())


def plain_query(rows):
    chats = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        case = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if case == 1 else "".join(c for c in text if c not in ".!?") if case == 2 else text
        chats[conv] += [(turn, "user" if case == 4 else role, text)] * (0 if case == 0 else 2 if case == 3 else 1)
    return {conv: plain_repair(own) for conv, own in chats.items()}


def chats(seed, n, longest):
    pick = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(pick.randint(1, longest)):
            text = pick.choice(["Yes.", "No!", "cut", "", " \t\n", "What?  ", "done.\nmore", "same.", "é…"])
            rows.append((conv, turn, pick.choice(["user", "assistant", "user", "assistant", "system", "", "tool", "User", None]), text))
    return rows


def asked(spark, tmp_path, rows):
    spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", k string").repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    return {r.conv_id: tuple(r)[1:] for r in op12_turn_repair(spark, str(tmp_path)).collect()}


def test_query_equals_plain_python(spark, tmp_path):
    rows = chats(1, 300, 9)
    assert asked(spark, tmp_path, rows) == plain_query(rows)


@pytest.mark.parametrize("shift", [1, 2, 3])
def test_chunks_and_runs_of_chunks_give_the_same(spark, tmp_path, monkeypatch, shift):
    monkeypatch.setattr(tr, "SHIFT", shift)
    rows = chats(shift, 8, 60) + [(99, t, "user" if t % 3 else "assistant", f"t{t}.") for t in range(150)]
    assert asked(spark, tmp_path, rows) == plain_query(rows)


def test_odd_rows(spark, tmp_path):
    rows = [(None, None, None, None), (None, None, "user", "a."), (None, 3, "assistant", "b."), (1, None, "user", "hi."), (1, None, "user", "hi."),
            (1, 5, "assistant", "x" * 200_000), (2, 0, "system", "only."), (3, 2, "user", "same turn."), (3, 2, "assistant", "same turn."),
            (4, -5, "assistant", "."), (4, 9, "user", "?"), (5, 1, "user", "gone")] + [(6, 0, "user", None)] * 40
    assert asked(spark, tmp_path, rows) == plain_query(rows)


def test_a_conversation_without_rows_after_damage(spark, tmp_path):
    gone = next(i for i in range(1000) if crc32(f"{i}:0".encode()) % 20 == 0)
    found = asked(spark, tmp_path, [(gone, 0, "user", "x")])
    assert found == {gone: (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())}


def test_empty_table(spark, tmp_path):
    assert asked(spark, tmp_path, []) == {}


def test_auction_prices_are_distances():
    pick = random.Random(4)
    for _ in range(300):
        n = pick.randint(0, 12)
        initials, faults = "".join(pick.choices("sua-", k=n)), "".join(pick.choices("kktbd", k=n))
        found = tr.Auction(initials, faults, tr.ENDS, True)
        edits, cost, _ = found.trace(tr.START)
        assert (cost, edits) == cheapest(initials, faults)[:2] and found.price[0] == cost
        for node in range(found.end):
            arcs = [c + found.price[to] for _, c, to in found.arcs(node)]
            assert found.price[node] == min([*arcs, tr.FAR])


def test_long_conversation_takes_linear_time():
    import time

    took = []
    for n in (1000, 8000):
        pick = random.Random(n)
        initials, faults = "".join(pick.choices("ua", k=n)), "".join(pick.choices("kktd", k=n))
        start = time.perf_counter()
        tr.Auction(initials, faults, tr.ENDS, True)
        took.append(time.perf_counter() - start)
    assert took[1] < 16 * took[0]
