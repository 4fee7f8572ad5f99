import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from spanloom.llm.packing import Sums, op9_packing, pack, pack_documents, pieces, plan

SCHEMA = "doc_id long, text string, id string, length string"


def test_plan_uses_every_piece_once_and_fits():
    rnd = random.Random(3)
    for _ in range(30):
        capacity = rnd.choice([16, 100, 1024])
        histogram = {rnd.randrange(1, capacity + 1): rnd.randrange(1, 200) for _ in range(rnd.randrange(1, 60))}
        used, bins = Counter(), 0
        for lengths, n in plan(histogram, capacity):
            assert sum(lengths) <= capacity and n > 0
            bins += n
            for x in lengths:
                used[x] += n
        assert used == Counter(histogram)
        total = sum(k * v for k, v in histogram.items())
        assert bins <= max(2 * -(-total // capacity), 1)
    assert plan({}, 8) == []
    assert sorted(plan({5: 1, 3: 1, 2: 3, 1: 1}, 8)) == [((2, 2, 2, 1), 1), ((5, 3), 1)]
    assert plan({6: 2, 1: 4}, 8)[0] == ((6, 1, 1), 2)


def test_sums_are_those_of_brute_force():
    rnd = random.Random(6)
    for _ in range(20):
        histogram = {rnd.randrange(1, 40): rnd.randrange(1, 4) for _ in range(rnd.randrange(1, 8))}
        sums = Sums(histogram, 40)
        bag = sorted(Counter(histogram).elements())
        can = {sum(c) for k in (1, 2, 3) for c in itertools.combinations(bag, k)}
        for total in range(1, 41):
            found = sums.exact(total)
            assert (found is not None) == (total in can)
            assert not found or (sum(found) == total and not Counter(found) - Counter(histogram))
            near = sums.nearest(total)
            assert (sum(near) if near else 0) == max((x for x in can if x <= total), default=0)


def test_plan_is_near_the_least_number():
    rnd = random.Random(9)
    histogram = Counter(min(1024, max(1, int(rnd.lognormvariate(6, 0.8)))) for _ in range(3000))
    least = -(-sum(k * v for k, v in histogram.items()) // 1024)
    assert sum(n for _, n in plan(dict(histogram))) <= least * 1.01 + 1


def test_pieces_are_the_tokenizers_ids(spark):
    texts = [None, "", "a", "It's  odd\t\n x_y 12³ ½ ", "naïve façade – “quotes” 🙂 é", "don't<|endoftext|>stop", "x <|endoftext|> y", "<|endoftext|>", "\x1c\x1d ü\xa0", "long words and more, " * 700]
    docs = spark.createDataFrame([(k, t, "clash", "9") for k, t in enumerate(texts)], SCHEMA)
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert t.encode("x <|endoftext|> y", add_special_tokens=False).ids == [87, 220, 50256, 331]
    found = {}
    for r in pieces(docs).collect():
        assert r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())
        found.setdefault(r["id"], []).append((r["piece"], r["start"], r["ids"]))
    for k, text in enumerate(texts):
        parts = sorted(found[k])
        assert [p[0] for p in parts] == list(range(len(parts)))
        assert sum((p[2] for p in parts), []) == t.encode(text or "", add_special_tokens=False).ids + [2]
        assert [p[1] for p in parts] == [sum(len(q[2]) for q in parts[:i]) for i in range(len(parts))]
        assert all(len(p[2]) == 1024 for p in parts[1:])


def assert_packed(rows):
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return sequences


def test_packing_is_gapless_and_tight(spark):
    rows = op9_packing(spark, "/root/testdata/sf0.001").collect()
    sequences = assert_packed(rows)
    assert len(sequences) <= 1 + sum(r["length"] for r in rows) / 1024 * 1.01
    assert len({(r["doc_id"], r["piece"]) for r in rows}) == len(rows)


def test_odd_tables(spark):
    assert pack_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = pack_documents(spark.createDataFrame([(None, "x", None, None), (1, "x", None, None), (1, "x", None, None)], SCHEMA)).collect()
    assert len(rows) == 3
    assert_packed(rows)
    hot = spark.range(3000).selectExpr("id", "0 as piece", "if(id % 3 = 0, 341L, id % 97 + 1) as length")
    assert_packed(pack(hot).collect())


def test_encoder_gives_the_librarys_ids(spark):
    from spanloom.llm.packing import default_tokenizer, encoder

    e = encoder(default_tokenizer())
    assert e.engine is not None
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()] + ["x" * 30000, "a" + " " * 1000000 + "b", " " * 30000, "\n \t" * 5000, "1" * 999]
    assert [e.ids(t) for t in texts] == [e.library_ids(t) for t in texts]
