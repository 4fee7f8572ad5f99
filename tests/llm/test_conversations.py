"""Conversation repair against a plain search over all edits, and over pieces of any size."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from spanloom.llm import conversations as c

GRAMMAR = re.compile(r"(s?(ua)+)?\Z")
ROW = "conv_id long, turn long, role string, text string"


def brute(roles, faults):
    """The least (cost, audit) over all ways of up to three insertions a gap, by trying them all."""
    best = None
    n = len(roles)
    for edits in itertools.product("KRD", repeat=n):
        if any(f in (c.BLANK, c.DUPLICATE) and e != "D" for e, f in zip(edits, faults, strict=True)):
            continue
        for gaps in itertools.product(range(4), repeat=n + 1):
            audit = "".join("I" * gaps[k] + edits[k] for k in range(n)) + "I" * gaps[n]
            slots, at = [], 0
            for e in audit:
                if e == "K":
                    slots.append(roles[at][:1] or "-")
                elif e in "RI":
                    slots.append(None)
                at += e != "I"
            for fill in itertools.product("ua", repeat=slots.count(None)):
                it = iter(fill)
                if GRAMMAR.match("".join(next(it) if s is None else s for s in slots)):
                    cost = sum({"K": 0, "R": 3, "D": 4, "I": 3}[e] for e in audit) + sum(3 for e, f in zip(edits, faults, strict=True) if f == c.CUT and e != "D")
                    best = min(best or (cost, audit), (cost, audit))
                    break
    return best


def test_dijkstra_equals_all_edits_tried():
    draw = random.Random(3)
    for _ in range(25):
        n = draw.randint(0, 3)
        roles = [draw.choice(["system", "user", "assistant", "tool", ""]) for _ in range(n)]
        faults = [draw.choice([0, 0, 0, 1, 2, 3, 3]) for _ in range(n)]
        got = c.cheapest([r[:1] for r in roles], faults)
        assert [min(got.values())] == [next(iter(got.values()))] == [brute(roles, faults)]


def plain(rows):
    """The contract, said row by row: ``rows`` of one conversation before damage."""
    seen, out, white = set(), [], " \t\n\v\f\r"
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults = []
    for _, role, text in out:
        inner = text.strip(white)
        faults.append(c.BLANK if not inner else c.DUPLICATE if (role, text) in seen else c.CUT if inner[-1] not in ".!?" else c.SOUND)
        seen.add((role, text))
    ini = [r[1][:1] for r in out]
    turns = {r[0] for r in out if r[0] is not None}
    # the plain way: least (cost, audit) a state, row by row, insertions closed by repetition
    ways = {c.START: (0, "")}

    def closed(ways):
        for _ in range(6):
            for s, (cost, audit) in list(ways.items()):
                to, new = c.STEPS[s][c.WANTED[s][0]], (cost + 3, audit + "I")
                ways[to] = min(ways.get(to, new), new)
        return ways

    ways = closed(ways)
    for k, f in enumerate(faults):
        new = {}
        for s, (cost, audit) in ways.items():
            options = [(s, cost + 4, "D")]
            if f in (c.SOUND, c.CUT):
                extra = 3 * (f == c.CUT)
                options += [(c.STEPS[s][c.WANTED[s][0]], cost + 3 + extra, "R")] + ([(c.STEPS[s][ini[k]], cost + extra, "K")] if ini[k] in c.STEPS[s] else [])
            for to, price, e in options:
                new[to] = min(new.get(to, (price, audit + e)), (price, audit + e))
        ways = closed(new)
    cost, audit = min(ways[s] for s in c.ENDS if s in ways)
    lines = "\n".join(f"{a}:{b}" for a, b in c.replay(audit, [r[1] for r in out], [r[2] for r in out]))
    count = faults.count
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, count(c.BLANK), count(c.DUPLICATE), count(c.CUT), sum(a + b not in ("su", "ua", "au") for a, b in zip(ini, ini[1:], strict=False)), cost, audit, hashlib.sha256(lines.encode()).hexdigest())


def draw_rows(conversations, turns):
    draw = random.Random(5)
    texts = ["Gut.", "Ja", " ", "", None, "Wie?\n", "Ende! \t", "x" * 50, "Gut.", "Ä."]
    rows = []
    for conv in [*range(conversations), None]:
        for _ in range(draw.randint(1, turns)):
            rows.append((conv, draw.choice([None, *range(12)]), draw.choice(["system", "user", "assistant", "user", "assistant", None, "tool"]), draw.choice(texts)))
    return rows


@pytest.mark.parametrize("block", [512, 3, 1])
def test_repair_equals_the_plain_way(spark, monkeypatch, block):
    monkeypatch.setattr(c, "BLOCK_ROWS", block)
    rows = draw_rows(40, 30)
    got = {r["conv_id"]: tuple(r)[1:] for r in _repaired(spark, rows, block).collect()}
    want = {conv: plain([r for r in rows if r[0] == conv]) for conv in {r[0] for r in rows}}
    assert got == want


def _repaired(spark, rows, block):
    """Workers import the module anew, so a piece's size is set where they run."""
    found = c.pieces

    def sized(batches, part):
        c.BLOCK_ROWS = block
        yield from found(batches, part)

    c.pieces = sized
    try:
        return c.repair(c.damaged(spark.createDataFrame(rows, ROW).repartition(3)))
    finally:
        c.pieces = found


def test_pieces_meet_as_one_search():
    draw = random.Random(9)
    roles = [draw.choice(["system", "user", "assistant", "user", "x"]) for _ in range(300)]
    faults = [draw.choice([0, 0, 0, 0, 1, 2, 3]) for _ in roles]
    texts = [str(k) for k in range(300)]
    cost, audit = next(iter(c.cheapest([r[:1] for r in roles], faults).values()))
    joined = c.Joined(1)
    for at in range(0, 300, 7):
        piece = c.Piece(1, at, opens=False)
        for k in range(at, min(at + 7, 300)):
            piece.add(k, roles[k], texts[k], faults[k])
        record = piece.record(closes=False)
        joined.add(type("R", (), record))
    report = joined.report()
    lines = "\n".join(f"{a}:{b}" for a, b in c.replay(audit, roles, texts))
    assert (report["cost"], report["audit"]) == (cost, audit)
    assert report["repaired_sha256"] == hashlib.sha256(lines.encode()).hexdigest()


def test_empty_table_dropped_rows_and_clashing_columns(spark):
    none = spark.createDataFrame([], ROW + ", fault long, said string, times long, part long")
    assert c.repair(c.damaged(none)).count() == 0
    dropped = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    got = c.repair(c.damaged(spark.createDataFrame([(1, dropped, "user", "Ja.")], ROW))).collect()
    assert [tuple(r) for r in got] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_copies_of_one_row_without_bound(spark):
    rows = [(None, None, "user", "Ja.")] * 3000 + [(None, None, "assistant", "Gut.")]
    got = c.repair(spark.createDataFrame(rows, ROW)).collect()
    assert len(got) == 1 and got[0]["duplicate"] == 2999 and got[0]["cost"] == 2999 * 4 + 6
