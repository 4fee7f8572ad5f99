"""The LSH forest against all pairs compared."""

import random

import numpy as np
import pytest

from spanloom.llm import forest
from spanloom.llm.forest import near_duplicates


def sets(text, shingle=5):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {" ".join(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))} if words else set()


def plain(docs, percent):
    """``(id, size of set, smallest id reachable)`` by comparing all with all."""
    made, root = [sets(t) for _, t in docs], list(range(len(docs)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(docs)):
        for b in range(a):
            if made[a] and made[b] and 100 * len(made[a] & made[b]) >= percent * len(made[a] | made[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(k)] = min(least.get(find(k), doc_id), doc_id)
    return sorted(((d, len(made[k]), least.get(find(k)) if made[k] else d) for k, (d, _) in enumerate(docs)), key=repr)


def got(spark, docs, percent=85):
    rows = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' as node", "1 as key", "2 as region", "3 as root", "4 as n", "5 as sig", "6 as id")
    return sorted((tuple(r) for r in near_duplicates(rows, percent=percent).collect()), key=repr)


def edited(draw, words, share):
    return " ".join(draw.choice("abcdefgh") * 3 + str(draw.randint(0, 9**6)) if draw.random() < share else w for w in words)


def base(draw, n):
    return [f"w{draw.randint(0, 9**5)}" for _ in range(n)]


def test_groups_of_edited_copies(spark):
    draw = random.Random(1)
    docs, k = [], 0
    for group in range(25):
        words = base(draw, draw.choice([6, 40, 200, 900]))
        for _ in range(draw.choice([1, 2, 5, 12])):
            docs.append((k, edited(draw, words, draw.choice([0, 0.004, 0.01, 0.02, 0.03]))))
            k += 1
    assert got(spark, docs) == plain(docs, 85)
    assert got(spark, docs, 80) == plain(docs, 80)


def test_crowded_regions_are_exact(spark):
    """Hundreds of copies of one template, more than a window holds, in groups that just are or just aren't alike."""
    draw = random.Random(4)
    template, docs = base(draw, 300), []
    for group in range(60):
        mine = edited(draw, template, 0.035).split()
        docs += [(1000 * group + k, edited(draw, mine, draw.choice([0, 0.004, 0.012]))) for k in range(5)]
    assert got(spark, docs) == plain(docs, 85)


def test_prefix_join_alone_finds_all_links(spark):
    draw = random.Random(6)
    words, n = base(draw, 120), 40
    texts = [edited(draw, words, 0.02) for _ in range(n)]
    grams = [sorted(forest.shingle_set(t.encode(), 5).view(np.int64).tolist()) for t in texts]
    members = spark.createDataFrame([(bytes([k]), len(g), bytes([k % 7])) for k, g in enumerate(grams)], "node binary, n long, root binary")
    made = spark.createDataFrame([(bytes([k]), g) for k, g in enumerate(grams)], "node binary, grams array<long>")
    pairs = {tuple(sorted((r["a"][0], r["b"][0]))) for r in forest._prefix_pairs(members, made, 0.85).collect()}
    want = {(a, b) for b in range(n) for a in range(b) if a % 7 != b % 7 and 100 * len(set(grams[a]) & set(grams[b])) >= 85 * len(set(grams[a]) | set(grams[b]))}
    assert want and want <= pairs


def test_nulls_empty_repeated_and_long_texts(spark):
    draw = random.Random(8)
    words = base(draw, 50)
    docs = [(3, None), (4, ""), (5, " \t\n"), (6, "One"), (7, "one"), (8, "one two"), (None, " ".join(words)), (9, " ".join(words)), (9, " ".join(words)), (None, "nobody else says this"), (None, None), (12, "long " * 200_000), (11, "long " * 150_000)]
    docs += [(100 + k, "the same text again and again") for k in range(200)]
    assert got(spark, docs) == plain(docs, 85)
    assert got(spark, []) == []


@pytest.mark.parametrize("alike", [0.85, 0.6])
def test_signatures_agree_as_sets_are_alike(alike):
    draw = np.random.default_rng(1)
    both = draw.integers(0, 1 << 63, 2000, dtype=np.uint64)
    n = int(2000 * alike)
    rest = (2000 - n) // 2
    a, b = np.unique(np.concatenate([both[:n], both[n : n + rest]])), np.unique(np.concatenate([both[:n], both[n + rest : n + 2 * rest]]))
    agree = (np.frombuffer(forest.signature(a), ">u2") == np.frombuffer(forest.signature(b), ">u2")).mean()
    assert abs(agree - alike) < 0.12
