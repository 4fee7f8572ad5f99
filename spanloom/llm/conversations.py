"""Repair of the turn structure of conversations by cheapest edits: Dijkstra on the lattice of turns and grammar states."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import table, written

#: Grammar states: which role came last. Conversations are `(s?(ua)+)?`, so they may end in START or ASSISTANT.
START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
WANTED = ("user", "user", "assistant", "user")
ENDS = (START, ASSISTANT)
#: What an edit costs; a truncated row that stays costs more.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SOUND, BLANK, DUPLICATE, CUT = range(4)
#: Longer conversations, and those that lie across a border of partitions, are searched in pieces of up to this many rows or characters.
BLOCK_ROWS, BLOCK_CHARS = 512, 1 << 22

WHITE = r"\x20\x09-\x0D"
PATH = "struct<entry:int,exit:int,cost:long,audit:string>"
PIECE = (
    "conv_id {id}, part long, at long, whole boolean, rows long, blank long, duplicate long, truncated long, illegal long, low {turn}, high {turn}, turns long, first_turn {turn}, last_turn {turn}, "
    f"first string, last string, cost long, audit string, sha string, paths array<{PATH}>, roles array<string>, texts array<string>"
)
REPORT = "conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def cheapest(initials: list[str], faults: list[int], entry: int = START, every_exit: bool = False) -> dict[int, tuple[int, str]]:
    """The cheapest edits from ``entry`` to the end: ``{exit state: (cost, audit)}``.

    Nodes of the lattice are (rows consumed, grammar state); they are made when they
    are reached. The queue is in the order of (cost, audit), so a node's first pop is
    its cheapest way and, of those, the ASCII-least. The search stops at the first
    accepting end popped, or, with ``every_exit``, once all states at the end are popped.

    An audit can't be the start of another one of equal cost at the same node (the
    longer one has more insertions), so what follows never turns their order round.
    """
    n, done, out = len(initials), set(), {}
    queue = [(0, "", 0, entry)]
    while queue:
        cost, audit, at, state = heapq.heappop(queue)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == n:
            if every_exit or state in ENDS:
                out[state] = (cost, audit)
            if out and not every_exit:
                break
        wanted = STEPS[state][WANTED[state][0]]
        heapq.heappush(queue, (cost + INSERT, audit + "I", at, wanted))
        if at == n:
            continue
        heapq.heappush(queue, (cost + DELETE, audit + "D", at + 1, state))
        if (fault := faults[at]) in (SOUND, CUT):
            stays = cost + TRUNCATED * (fault == CUT)
            if (to := STEPS[state].get(initials[at])) is not None:
                heapq.heappush(queue, (stays, audit + "K", at + 1, to))
            heapq.heappush(queue, (stays + REROLE, audit + "R", at + 1, wanted))
    return out


def replay(audit: str, roles: list[str], texts: list[str], state: int = START) -> Iterator[tuple[str, str]]:
    """The rows ``(role, text)`` that the edits of an audit leave, from a grammar state on."""
    at = 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        role = roles[at] if edit == "K" else WANTED[state]
        yield role, "" if edit == "I" else texts[at]
        at += edit != "I"
        state = STEPS[state][role[:1]]


@dataclass
class Piece:
    """Consecutive rows of one conversation."""

    conv_id: object
    at: int
    opens: bool
    rows: int = 0
    chars: int = 0
    counts: list[int] = field(default_factory=lambda: [0, 0, 0, 0])
    turns: list = field(default_factory=list)
    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    faults: list[int] = field(default_factory=list)

    def add(self, turn, role: str, text: str, fault: int) -> None:
        self.rows, self.chars = self.rows + 1, self.chars + len(text)
        self.counts[fault] += 1
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.faults.append(fault)

    def record(self, closes: bool) -> dict:
        initials = [r[:1] for r in self.roles]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        first, last = (self.turns[0], self.turns[-1]) if self.turns else (None, None)
        out = {
            "conv_id": self.conv_id, "at": self.at, "whole": self.opens and closes, "rows": self.rows, "blank": self.counts[BLANK], "duplicate": self.counts[DUPLICATE], "truncated": self.counts[CUT], "illegal": illegal,
            "low": first, "high": last, "turns": len(self.turns), "first_turn": first, "last_turn": last, "first": initials[0] if initials else None, "last": initials[-1] if initials else None,
        }
        if self.opens and closes:
            cost, audit = next(iter(cheapest(initials, self.faults).values()))
            lines = "\n".join(f"{role}:{text}" for role, text in replay(audit, self.roles, self.texts))
            return out | {"cost": cost, "audit": audit, "sha": hashlib.sha256(lines.encode()).hexdigest()}
        entries = (START,) if self.opens else range(len(STEPS))
        paths = [{"entry": s, "exit": e, "cost": c, "audit": a} for s in entries for e, (c, a) in cheapest(initials, self.faults, s, every_exit=True).items()]
        return out | {"paths": paths, "roles": self.roles, "texts": self.texts}


def pieces(batches: Iterator[pd.DataFrame], part: int) -> Iterator[dict]:
    """The pieces of a partition that is sorted by conversation and turn; one that surely holds a whole conversation is repaired at once."""
    piece, seen = None, 0
    for batch in batches:
        for conv_id, turn, role, text, fault, times, again in zip(*(batch[c] for c in ("conv_id", "turn", "role", "text", "fault", "times", "again")), strict=True):
            turn, conv_id = None if pd.isna(turn) else turn, None if pd.isna(conv_id) else conv_id
            if piece is None or piece.conv_id != conv_id:
                if piece is not None:
                    yield piece.record(closes=True)
                    seen += 1
                piece = Piece(conv_id, seen, opens=seen > 0)
            for k in range(times):
                if piece.rows >= BLOCK_ROWS or piece.chars >= BLOCK_CHARS:
                    yield piece.record(closes=False)
                    seen += 1
                    piece = Piece(conv_id, seen, opens=False)
                piece.add(turn, role, text, BLANK if fault == BLANK else DUPLICATE if again or k else fault)
    if piece is not None:
        yield piece.record(closes=False)


class Joined:
    """Pieces of one conversation, in order, put together: four ways so far, each with its digest."""

    def __init__(self, conv_id) -> None:
        self.conv_id, self.rows, self.blank, self.duplicate, self.truncated, self.illegal, self.turns = conv_id, 0, 0, 0, 0, 0, 0
        self.low = self.high = self.last = None
        self.ways = {START: (0, "", None)}

    def add(self, r) -> None:
        self.illegal += r.illegal + (self.last is not None and r.first is not None and self.last + r.first not in ("su", "ua", "au"))
        self.last = self.last if r.last is None else r.last
        for name in ("rows", "blank", "duplicate", "truncated"):
            setattr(self, name, getattr(self, name) + getattr(r, name))
        if r.turns:
            self.turns += r.turns - (self.high is not None and self.high == r.first_turn)
            self.low, self.high = r.first_turn if self.low is None else self.low, r.last_turn
        ways = {}
        for p in r.paths:
            if p["entry"] in self.ways:
                cost, audit, _ = self.ways[p["entry"]]
                new = (cost + p["cost"], audit + p["audit"], p["entry"], p["audit"])
                ways[p["exit"]] = min(ways.get(p["exit"], new), new)
        self.ways = {e: (cost, audit, self._digest(entry, part, r)) for e, (cost, audit, entry, part) in ways.items()}

    def _digest(self, entry: int, audit: str, r):
        digest = self.ways[entry][2]
        out = digest.copy() if digest is not None else None
        for role, text in replay(audit, r.roles, r.texts, entry):
            line = f"{role}:{text}".encode()
            if out is None:
                out = hashlib.sha256(line)
            else:
                out.update(b"\n" + line)
        return out

    def report(self) -> dict:
        cost, audit, digest = min((self.ways[s] for s in ENDS if s in self.ways), key=lambda w: w[:2])
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return {
            "conv_id": self.conv_id, "gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal, "cost": cost, "audit": audit,
            "repaired_sha256": (digest or hashlib.sha256()).hexdigest(),
        }


def repair(rows: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` of ``rows(conv_id, turn, role, text)``.

    A conversation's rows are taken by turn (nulls first), then role and text, in
    the order of their bytes. Null roles and texts count as one space; a null
    ``conv_id`` is a conversation of its own; a row with ``there = false`` only says
    that its conversation exists; other columns play no part; an empty table gives
    an empty one. A role's initial is its first character, and a kept row keeps its
    whole role.

    Equal rows are one row that counts them, so no number of copies is a hot key. Rows are sorted over
    all partitions by ranges, so a conversation of any size spans several tasks.
    One that lies within a partition, and in BLOCK_ROWS rows, is searched from its
    start to its first accepting end. Of others, each piece is searched from all
    four states to all four; a conversation's pieces (one row for up to BLOCK_ROWS)
    then meet in one task, which reads them in order and holds four ways and their
    running digests. That is what an audit and a SHA-256 over the whole need.
    """
    text = F.coalesce("text", F.lit(" "))
    there = F.col("there") if "there" in rows.columns else F.lit(True)
    flat = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), there.alias("there"))
    flat = flat.select("conv_id", *[F.when(F.col("there"), F.col(c)).alias(c) for c in ("turn", "role", "text")], F.col("there").cast("int").alias("there"))
    grouped = flat.groupBy("conv_id", "turn", "role", "text").agg(F.sum("there").alias("times"))
    said = F.md5(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), F.lit("|"), F.length("role").cast("string"), F.lit("|"), "role", F.lit("|"), "text"))
    unsaid = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), F.lit("|"))
    once = written(grouped.withColumn("said", F.when(F.col("times") > 0, said).otherwise(unsaid)), "turns")
    place = F.struct(F.col("turn").isNotNull().alias("t"), "turn")
    firsts = once.where("times > 0").groupBy("said").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("said", "first")
    blank = ~F.col("text").rlike(f"[^{WHITE}]")
    fault = F.when(F.col("times") == 0, SOUND).when(blank, BLANK).when(F.col("text").rlike(rf"[.!?][{WHITE}]*\z"), SOUND).otherwise(CUT)
    judged = once.join(firsts, "said", "left").select("conv_id", "turn", "role", "text", "times", fault.alias("fault"), F.coalesce(place > F.col("first"), F.lit(False)).alias("again"))
    spread = judged.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 128)).sortWithinPartitions("conv_id", "turn", "role", "text")

    kinds = {"id": rows.schema["conv_id"].dataType.simpleString(), "turn": rows.schema["turn"].dataType.simpleString()}
    piece_schema, report_schema = PIECE.format(**kinds), REPORT.format(**kinds)
    piece_columns, report_columns = [c.split()[0] for c in piece_schema.replace(f"<{PATH}>", "").split(", ")], [c.split()[0] for c in report_schema.split(", ")]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        yield from _framed((r | {"part": part} for r in pieces(batches, part)), piece_columns)

    found = written(spread.mapInPandas(cut, piece_schema), "pieces")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    whole = found.where("whole").select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.col("sha").alias("repaired_sha256"))

    def put_together(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _framed(_reports(batches), report_columns)

    parts = found.where("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "at")
    return whole.unionByName(parts.mapInPandas(put_together, report_schema))


def _reports(batches: Iterator[pd.DataFrame]) -> Iterator[dict]:
    joined = None
    for batch in batches:
        for r in batch.astype({c: object for c in ("conv_id", "first_turn", "last_turn")}).itertuples(index=False):
            conv_id = None if pd.isna(r.conv_id) else int(r.conv_id) if isinstance(r.conv_id, float) else r.conv_id
            if joined is None or joined.conv_id != conv_id:
                if joined is not None:
                    yield joined.report()
                joined = Joined(conv_id)
            joined.add(r)
    if joined is not None:
        yield joined.report()


def _framed(records: Iterator[dict], columns: list[str], rows: int = 256) -> Iterator[pd.DataFrame]:
    """Records as frames of so many rows; numbers that may be missing stay integers."""
    held: list[dict] = []
    for record in records:
        held.append(record)
        if len(held) >= rows or len(record.get("texts") or ()) > rows // 4:
            yield pd.DataFrame({c: pd.Series([h.get(c) for h in held], dtype=object) for c in columns})
            held = []
    if held:
        yield pd.DataFrame({c: pd.Series([h.get(c) for h in held], dtype=object) for c in columns})


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with one in five rows damaged, by crc32 of ``conv_id:turn`` (a null is one space) modulo 20.

    0 drops a row (``there`` is false), 1 empties its text, 2 takes its full stops
    and marks away, 3 repeats it, 4 gives it to the user.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    marked = conversations.select("conv_id", "turn", kind.alias("kind"), space("role").alias("role"), space("text").alias("text"))
    text: Column = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    out = marked.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("kind") != 0).alias("there"), F.explode(times).alias("time"))
    return out.drop("time")


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turn structure of damaged conversations, their cheapest repair and its digest."""
    return repair(damaged(table(spark, sf_dir, "conversations")))


_STEPS = """[{'s': w.state, 'c': w.cost + 4, 'a': w.audit || 'D', 'p': w.parts}]
 || case when fault in (1, 2) then [] else [{'s': case w.state when 2 then 3 else 2 end, 'c': w.cost + 3 + fault, 'a': w.audit || 'R', 'p': list_append(w.parts, case w.state when 2 then 'assistant' else 'user' end || ':' || text)}] end
 || case when fault in (1, 2) or keep is null then [] else [{'s': keep, 'c': w.cost + fault, 'a': w.audit || 'K', 'p': list_append(w.parts, role || ':' || text)}] end"""
_CLOSED = """[o, {'s': case o.s when 2 then 3 else 2 end, 'c': o.c + 3, 'a': o.a || 'I', 'p': list_append(o.p, case o.s when 2 then 'assistant:' else 'user:' end)},
 {'s': case o.s when 2 then 2 else 3 end, 'c': o.c + 6, 'a': o.a || 'II', 'p': o.p || case o.s when 2 then ['assistant:', 'user:'] else ['user:', 'assistant:'] end}]"""
#: The same in DuckDB, row by row: the least (cost, audit) of every state; a fault of 3 is a truncated row, and what it costs to keep.
ORACLE_OP12 = rf"""with recursive bits as (select i as b, i as c, 0 as k from range(256) r(i) union all select b, case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from bits where k < 8),
crc as materialized (select list(c order by b) as t from bits where k = 8),
ids as materialized (select conv_id, turn, hex(encode(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '))) as x from conversations group by all),
kinds as materialized (select conv_id, turn, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, len(x) // 2), lambda i: ('0x' || x[2 * i + 1 : 2 * i + 2])::bigint)), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 as kind from ids, crc),
damaged as (select c.conv_id, c.turn, case when kind = 4 then 'user' else coalesce(role, ' ') end as role, case when kind = 1 then '' when kind = 2 then regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') else coalesce(text, ' ') end as text,
 unnest(case when kind = 3 then [1, 2] when kind = 0 then [] else [1] end) as copy from conversations c join kinds k on k.conv_id is not distinct from c.conv_id and k.turn is not distinct from c.turn),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as k from damaged),
judged as materialized (select conv_id, turn, role, text, k, case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 1 when row_number() over (partition by conv_id, role, text order by k) > 1 then 2 when regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') then 0 else 3 end as fault,
 lag(role[1:1]) over (partition by conv_id order by k) || role[1:1] as pair, count(*) over (partition by conv_id) as n from placed),
ways as (select distinct conv_id, 0::bigint as k, o.s as state, o.c as cost, o.a as audit, o.p as parts from judged, (select unnest({_CLOSED}) as o from (select {{'s': 0, 'c': 0, 'a': '', 'p': []::varchar[]}} as o))
 union all select conv_id, k, m.s, m.c, m.a, m.p from (select conv_id, k, arg_min(o, {{'c': o.c, 'a': o.a}}) as m from (select conv_id, k, unnest({_CLOSED}) as o from (select conv_id, k, unnest({_STEPS}) as o
 from (select w.*, r.* exclude (conv_id, k), r.k as k, case when role[1:1] = 's' and w.state = 0 then 1 when role[1:1] = 'u' and w.state <> 2 then 2 when role[1:1] = 'a' and w.state = 2 then 3 end as keep from (select conv_id, k as before, state, cost, audit, parts from ways) w join judged r on r.conv_id is not distinct from w.conv_id and r.k = w.before + 1) w)) group by conv_id, k, o.s)),
ends as (select conv_id, arg_min({{'c': cost, 'a': audit, 'p': parts}}, {{'c': cost, 'a': audit}}) as m from ways join (select distinct conv_id, n from judged) using (conv_id) where k = n and state in (0, 3) group by conv_id),
sums as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count_if(fault = 1) as blank, count_if(fault = 2) as duplicate, count_if(fault = 3) as truncated, count_if(pair not in ('su', 'ua', 'au')) as illegal from judged group by conv_id)
select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cast(m.c as bigint), 0) as cost, coalesce(m.a, '') as audit, sha256(coalesce(array_to_string(m.p, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) c left join sums s on s.conv_id is not distinct from c.conv_id left join ends e on e.conv_id is not distinct from c.conv_id"""
