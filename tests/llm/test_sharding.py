import random
import zlib
from collections import Counter

from pyspark.sql import functions as F

from spanloom.llm.sharding import Blocks, minimax_cuts, op6_sharding, shard


def greedy(sizes, capacity):
    """Shards of a pass in order; a group above the capacity is one by itself."""
    out, at = [], capacity + 1
    for s in sizes:
        if at + s > capacity:
            out.append([])
            at = 0
        out[-1].append(s)
        at += s
    return out


def smallest(sizes, shards):
    """The least capacity whose greedy pass needs no more than ``shards``, out of all sums that a shard can have."""
    ends = [0]
    for s in sizes:
        ends.append(ends[-1] + s)
    options = sorted({1} | {b - a for k, a in enumerate(ends) for b in ends[k + 1 :]})
    low, high = 0, len(options) - 1
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if len(greedy(sizes, options[middle])) <= shards else (middle + 1, high)
    return options[low]


def test_capacity_is_the_smallest(spark):
    rnd = random.Random(1)
    for n, shards, heavy in ((1, 4, 0), (50, 7, 0), (1500, 16, 0), (1500, 16, 1), (800, 16, 6), (12, 16, 2), (300, 1, 1)):
        groups = sorted((rnd.getrandbits(64) - 2**63, rnd.randrange(1, 5000)) for _ in range(n))
        for k in rnd.sample(range(n), heavy):
            groups[k] = (groups[k][0], rnd.choice((1, 2, 10)) * 400 * n)
        starts, capacity = minimax_cuts(spark.createDataFrame(groups, "h long, size long"), shards)
        assert capacity == smallest([s for _, s in groups], shards)
        loads = {}
        for h, s in groups:
            loads.setdefault(sum(h >= x for x in starts), []).append(s)
        assert len(loads) <= shards and all(sum(x) <= capacity or len(x) == 1 for x in loads.values())
        assert [s for k in sorted(loads) for s in loads[k]] == [s for _, s in groups]


def test_a_hot_group_stays_in_order(spark):
    """Shards are runs in hash order, also around a group with a third of all bytes."""
    rows = [(k, "hot" if k % 3 == 0 else f"t{k}") for k in range(3000)]
    docs = spark.createDataFrame(rows, "id long, text string")
    found = shard(docs, F.col("text"), F.lit(10).cast("long"), shards=16).withColumn("h", F.xxhash64("text")).orderBy("h").collect()
    order = [r["shard"] for r in found]
    assert order == sorted(order) and set(order) == set(range(16))
    loads = Counter(order)
    hot = next(r["shard"] for r in found if r["text"] == "hot")
    assert loads.pop(hot) == 1000 and max(loads.values()) <= 1.1 * 2000 / 15 and min(loads.values()) >= 0.8 * 2000 / 15


def test_neighbouring_keys_need_every_split(spark):
    groups = [(k, 10 + k % 7) for k in range(400)]
    assert minimax_cuts(spark.createDataFrame(groups, "h long, size long"), 16)[1] == smallest([s for _, s in groups], 16)
    assert minimax_cuts(spark.createDataFrame([], "h long, size long"), 16) == ([], 0)
    assert Blocks([]).prefix == [0]


def test_groups_stay_whole_and_slots_are_gapless(spark):
    rows = [(k, "same" if k % 3 == 0 else f"text {k}" * (k % 9), 1, 2) for k in range(900)] + [(None, None, None, None), (5, "", 0, 0), (5, "", 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int, h int")
    found = shard(docs, F.coalesce("text", F.lit("")), F.coalesce(F.octet_length("text"), F.lit(0)) + 1, shards=16).collect()
    assert len(found) == len(rows)
    slots = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert len({r["shard"] for r in found if r["text"] == "same"}) == 1
    assert set(slots) == set(range(16))
    assert shard(docs.limit(0), F.col("text"), F.length("text"), shards=16).count() == 0


def test_query_over_its_table(spark):
    found = op6_sharding(spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(found) == len(texts) and {r["law"] for r in found} == {"bytes"}
    assert all(r["size"] == len(texts[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in found)
    at = {}
    for r in found:
        at.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
    assert all(len(v) == 1 for v in at.values())
