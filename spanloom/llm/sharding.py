"""Minimax contiguous sharding over atomic groups, in DataFrame operations only."""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.llm.common import table, written

FIRST_BITS, MORE_BITS = 12, 8
SALTS = 1024


@dataclass
class Blocks:
    """Runs of groups in key order, summed: all that the driver ever holds.

    A block is ``(first key, groups, size)``; one that holds a single group can't
    be cut. Splitting only blocks where a cut can fall keeps the list short, with
    any number of groups.
    """

    rows: list[tuple[int, int, int]]
    starts: list[int] = field(init=False)
    prefix: list[int] = field(init=False)

    def __post_init__(self) -> None:
        self.rows.sort()
        self.starts = [r[0] for r in self.rows]
        self.prefix = [0]
        for _, _, size in self.rows:
            self.prefix.append(self.prefix[-1] + size)

    def cuts(self, capacity: int, shards: int, inside: bool) -> list[int] | None:
        """Greedy shard ends (in bytes), or None if they don't reach the end.

        A single group above the capacity is a shard of its own. ``inside``: a cut may
        fall anywhere in a block of several groups, which bounds what is possible from
        above; else only at a block's edge.
        """
        at, ends, total = 0, [], self.prefix[-1]
        for _ in range(shards):
            target = at + capacity
            if target >= total:
                return [*ends, total]
            k = bisect_right(self.prefix, target) - 1
            if self.prefix[k] == at and self.rows[k][1] == 1:
                at = self.prefix[k + 1]
            else:
                at = target if inside and self.rows[k][1] > 1 else self.prefix[k]
            ends.append(at)
            if at == total:
                return ends
        return None

    def smallest(self, least: int, shards: int, inside: bool) -> int:
        low, high = least, max(least, self.prefix[-1])
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if self.cuts(middle, shards, inside) else (middle + 1, high)
        return low

    def open_between(self, low: int, high: int, shards: int) -> set[int]:
        """Blocks of several groups in which a cut can fall for capacities from low to high."""
        total, at, far, found = self.prefix[-1], 0, 0, set()
        for _ in range(shards):
            k = bisect_right(self.prefix, min(at + low, total)) - 1
            at = self.prefix[min(k, len(self.rows))]
            far = max(min(far + high, total), next((e for e in self.prefix if e > far), total))
            found |= {i for i in range(k, min(bisect_right(self.prefix, far), len(self.rows))) if self.rows[i][1] > 1}
        return found


def _summed(groups: DataFrame, bits: int, alone: list[int]) -> list[tuple[int, int, int]]:
    """``(first key, groups, size)`` of key ranges; each key of ``alone`` is a range of its own."""
    block = F.shiftright("h", 64 - bits) if bits < 64 else F.col("h")
    parts = sum(((F.col("h") >= k).cast("int") + (F.col("h") > k).cast("int") for k in alone), F.lit(0))
    return [tuple(r) for r in groups.groupBy(block.alias("block"), parts.alias("parts")).agg(F.min("h"), F.count(F.lit(1)), F.sum("size")).drop("block", "parts").collect()]


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[list[int], int]:
    """``groups(h, size)``, one row a group → the first keys of shards 1.., and the capacity.

    The smallest capacity for which a greedy pass over the groups in key order
    needs no more than ``shards`` shards, where a group above the capacity is a
    shard of its own: no partition in this order has a smaller largest shard, nor,
    beside such groups, smaller other ones. Groups can only be that large if they
    are above the mean of what larger ones leave, so there are fewer than shards.
    Both the search and the passes run over sums of key ranges; ranges where a cut
    can fall are split again until the capacity is exact.
    """
    left = groups.agg(F.sum("size")).first()[0]
    if left is None:
        return [], 0
    alone: list[int] = []
    for h, size in groups.orderBy(F.desc("size"), "h").limit(shards - 1).collect() if shards > 1 else []:
        if size * (shards - len(alone)) <= left:
            break
        alone.append(h)
        left -= size
    blocks, bits = Blocks(_summed(groups, FIRST_BITS, alone)), FIRST_BITS
    least = max(1, -(-left // (shards - len(alone))))
    while True:
        low, high = blocks.smallest(least, shards, True), blocks.smallest(least, shards, False)
        if low == high:
            break
        bits = min(64, bits + MORE_BITS)
        split = blocks.open_between(low, high, shards) or {i for i, r in enumerate(blocks.rows) if r[1] > 1}
        firsts = sorted(split)
        inside = F.lit(False)
        while firsts:  # neighbouring blocks are one range
            i = j = firsts.pop(0)
            while firsts and firsts[0] == j + 1:
                j = firsts.pop(0)
            upper = F.col("h") < blocks.starts[j + 1] if j + 1 < len(blocks.starts) else F.lit(True)
            inside = inside | ((F.col("h") >= blocks.starts[i]) & upper)
        blocks = Blocks([r for i, r in enumerate(blocks.rows) if i not in split] + _summed(groups.where(inside), bits, alone))
    ends = blocks.cuts(high, shards, False) or []
    starts = [blocks.starts[bisect_right(blocks.prefix, e) - 1] for e in ends if e < blocks.prefix[-1]]
    return starts, high


def balanced_cuts(groups: DataFrame, shards: int) -> list[int]:
    """The first keys of shards 1..: as :func:`minimax_cuts`, and as equal as possible beside groups above its capacity.

    Such a group, a shard of its own, parts the order into runs. A run keeps the
    shards that the greedy pass gave it, spare ones go where shards are largest, and
    each run is cut at the smallest capacity of its own.
    """
    starts, capacity = minimax_cuts(groups, shards)
    alone = sorted(r["h"] for r in groups.where(F.col("size") > capacity).collect())  # fewer than shards
    if not alone:
        return starts
    run = sum(((F.col("h") > k).cast("int") for k in alone), F.lit(0))
    totals = {r["run"]: r["total"] for r in groups.where(~F.col("h").isin(alone)).groupBy(run.alias("run")).agg(F.sum("size").alias("total")).collect()}
    ranges = {k: (alone[k - 1] if k else None, alone[k] if k < len(alone) else None) for k in totals}
    counts = {k: sum(a < x and (b is None or x < b) for x in starts) if a is not None else 1 + sum(x < b for x in starts) for k, (a, b) in ranges.items()}
    for _ in range(shards - len(alone) - sum(counts.values())):
        counts[max(counts, key=lambda k: (totals[k] / counts[k], -k))] += 1
    firsts = list(alone)
    for k, (a, b) in ranges.items():
        part = groups.where((F.col("h") > a if a is not None else F.lit(True)) & (F.col("h") < b if b is not None else F.lit(True)))
        firsts += minimax_cuts(part, counts[k])[0] + ([a + 1] if a is not None else [])
    firsts.sort()
    return firsts if 0 in totals else firsts[1:]


def shard(df: DataFrame, key: Column, size: Column, shards: int = 16, salts: int = SALTS) -> DataFrame:
    """``df`` with ``shard`` and ``slot``, gapless from 0 in each shard.

    Rows of an equal key hash stay together; shards are runs of groups in hash
    order, cut by :func:`balanced_cuts`, so a hot group is a shard of its own and the
    others are as equal as this order allows. Rows with a null key are one group;
    repeated rows stay repeated. Slots come from counts by shard and salt (a bounded
    table), so no task numbers a whole shard or a hot group, except that rows equal
    in full have one salt. An empty table gives an empty one; columns named ``shard``
    or ``slot`` are replaced.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    keyed = df.select(F.struct(*df.columns).alias("row"), F.xxhash64(key).alias("h"), size.alias("size"))
    groups = written(keyed.groupBy("h").agg(F.sum("size").alias("size")), "groups")
    starts = balanced_cuts(groups, shards)
    place = sum(((F.col("h") >= start).cast("int") for start in starts), F.lit(0))
    return _slots(keyed.select("row", place.cast("int").alias("shard")), salts)


def _slots(placed: DataFrame, salts: int) -> DataFrame:
    """``placed(row, shard)`` → the columns of ``row``, ``shard`` and ``slot``."""
    fields = placed.schema["row"].dataType.fields
    ids = [F.col("row")[f.name] for f in fields if f.dataType.typeName() not in ("map", "variant")]
    salted = written(placed.withColumn("salt", F.pmod(F.xxhash64(*ids), F.lit(salts)).cast("int")), "sharded")
    before = Window.partitionBy("shard").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = salted.groupBy("shard", "salt").count().select("shard", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    rank = F.row_number().over(Window.partitionBy("shard", "salt").orderBy(*ids)) - 1
    # at most shards x salts rows, so a broadcast is safe at any input size
    numbered = salted.withColumn("rank", rank).join(F.broadcast(firsts), ["shard", "salt"])
    return numbered.select(*[F.col("row")[f.name].alias(f.name) for f in fields if f.name not in ("shard", "slot")], "shard", (F.col("first") + F.col("rank")).alias("slot"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of nearly equal bytes; equal texts are a group (null: the empty text)."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("text_key"))
    placed = shard(docs, F.col("text_key"), F.col("size"), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
