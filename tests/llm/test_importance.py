"""Importance resampling against the contract said plainly."""

import collections
import hashlib
import math
import random
import re
import zlib

from spanloom.llm import importance as im

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, target, percent=25, least=20, buckets=10_000):
    def feats(text):
        words = WORD.findall((text or "").translate(LOWER))
        return words, words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]

    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = collections.Counter(), collections.Counter()
    for _, text in docs:
        s.update(map(bucket, feats(text)[1]))
    for text in target:
        t.update(map(bucket, feats(text)[1]))
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text in docs:
        words, fs = feats(text)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in map(bucket, fs)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(words), len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    order = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    drawn = order[: percent * len(order) // 100]
    return sorted(([*r[:1], *r[2:], next((k + 1 for k, x in enumerate(drawn) if x is r), None)] for r in out), key=repr)


def got(spark, docs, target, **more):
    rows = im.resample(spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n", "2 as weight", "3 as key", "4 as score", "5 as rank", "6 as times"), spark.createDataFrame([(t,) for t in target], "text string"), **more)
    return sorted((list(r) for r in rows.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def texts(n):
    draw = random.Random(2)
    words = ["Straße", "the", "OF", "naïve", "x1", "9", "Übung", "end", "a b", "日本", "K", "it's"]
    return [" ".join(draw.choices(words, k=draw.choice([0, 1, 3, 25, 60]))) + draw.choice(["", ".", " \n"]) for _ in range(n)]


def test_equals_the_plain_way_with_copies_and_clashing_columns(spark):
    docs = [(k, t) for k, t in enumerate(texts(60))] + [(100 + k, "the same text " * 10) for k in range(30)] + [(200, None), (201, ""), (202, "..."), (203, "the " * 3000)]
    target = ["the end of the end", None, "", "Übung 9"]
    assert got(spark, docs, target) == plain(docs, target)


def test_null_and_repeated_ids(spark):
    docs = [(None, "a b " * 12), (5, "a b " * 12), (7, "c d " * 15)]
    rows = got(spark, docs, ["a"], percent=100)
    assert rows == plain(docs, ["a"], percent=100)
    twice = got(spark, [(5, "a b " * 12)] * 3, ["a"], percent=100)
    assert sorted(r[4] for r in twice) == [1, 2, 3]


def test_empty_tables(spark):
    assert got(spark, [], ["a"]) == []
    docs = [(1, "a b " * 12), (2, "zz " * 30)]
    assert got(spark, docs, [], percent=50) == plain(docs, [], percent=50)


def test_slices_of_a_long_text_count_like_the_whole(monkeypatch):
    text = " ".join(texts(200)).encode()
    whole = [x for _, h in im.features(text) for x in h]
    monkeypatch.setattr(im, "SLICE", 7)
    sliced = [x for _, h in im.features(text) for x in h]
    assert collections.Counter(whole) == collections.Counter(sliced)
