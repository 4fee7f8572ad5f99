import random

import xxhash
from pyspark.sql import types as T

from spanloom.llm.simhash import fingerprints, near_copies, near_duplicates, simhash, sketch

SCHEMA = "doc_id long, text string, fp string, variant long"


def brute(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps):
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(fps)
    for i in ids:
        for j in ids:
            if i < j and (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_near_duplicates_match_brute_force(spark):
    rnd = random.Random(5)
    words = ["alpha", "Beta", "gamma", "delta", "Ünder", "zeta", "eta", "iota"]
    texts = [None, "", " \t\n", "one", "one two", "One TWO", "A b c", "a  b\nc", "Ä ä", "x " * 40000]
    for _ in range(40):
        base = [rnd.choice(words) + str(rnd.randrange(50)) for _ in range(rnd.randrange(3, 400))]
        texts.append(" ".join(base))
        for _ in range(rnd.randrange(3)):
            copy = list(base)
            copy[rnd.randrange(len(copy))] = "changed"
            texts.append("  ".join(copy))
    rows = [(k, t, "clash", 7) for k, t in enumerate(texts)]
    found = {r["id"]: (r["fp"] & (2**64 - 1), r["component"]) for r in near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    fps = {k: brute(t) for k, t in enumerate(texts)}
    assert {k: v[0] for k, v in found.items()} == fps
    assert {k: v[1] for k, v in found.items()} == components(fps)
    assert found[1][1] == 0 and found[2][1] == 0


def test_close_fingerprints_chain_and_stay_whole(spark):
    from spanloom.llm.components import connected_components
    from spanloom.llm.simhash import ball_links

    rnd = random.Random(9)
    fps = set()
    for _ in range(30):
        at = rnd.getrandbits(64)
        for _ in range(12):
            fps.add(at)
            for b in rnd.sample(range(64), rnd.randrange(1, 4)):
                at ^= 1 << b
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    roots = {r["node"]: r["root"] for r in connected_components(ball_links(spark.createDataFrame([(f,) for f in signed], "fp long"))).collect()}
    expected = components({f: f & (2**64 - 1) for f in signed})
    assert {f: roots.get(f, f) for f in signed} == expected


def test_defined_results_for_odd_tables(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, "a b c d", None, None), (3, "a b c d", None, None), (3, "a b c d", None, None), (None, None, None, None)]
    found = sorted((r["id"] is None, r["component"] is None) for r in near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())
    assert found == [(False, False), (False, False), (True, False), (True, True)]
    assert fingerprints(spark.createDataFrame(rows, SCHEMA)).schema["fp"].dataType == T.LongType()
    assert simhash(b"") == simhash(None) == 0


def shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def groups(sets):
    """The smallest id that links of a cosine similarity of 0.8 reach, by all pairs."""
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            shared = len(sets[i] & sets[j])
            if i < j and (100 * shared**2 >= 64 * len(sets[i]) * len(sets[j]) if sets[i] and sets[j] else sets[i] == sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def edited(rnd, words, every):
    return [w if rnd.random() * every > 1 else f"new{rnd.randrange(10**6)}" for w in words]


def test_near_copies_match_brute_force(spark):
    rnd = random.Random(8)
    passage = [f"p{k}" for k in range(40)]
    texts = [None, "", "one", "ONE", "a b c d e", "a b c d e f", "x " * 40000]
    for _ in range(12):
        base = [f"w{rnd.randrange(3000)}" for _ in range(rnd.randrange(60, 500))]
        texts += [" ".join(base), " ".join(base).upper(), " ".join(base[:100] + passage + base[100:])]
        texts += [" ".join(edited(rnd, base, rnd.choice((20, 40, 80, 200)))) for _ in range(6)]
    rnd.shuffle(texts)
    rows = [(k, t, "clash", 7) for k, t in enumerate(texts)]
    found = {r["id"]: r["component"] for r in near_copies(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == groups({k: shingles(t) for k, t in enumerate(texts)})


def test_a_text_with_many_edited_copies_is_one_group(spark):
    rnd = random.Random(3)
    base = [f"w{rnd.randrange(3000)}" for _ in range(300)]
    texts = [" ".join(edited(rnd, base, 60)) for _ in range(80)] + [" ".join(base)]
    sets = {k: shingles(t) for k, t in enumerate(texts)}
    found = {r["id"]: r["component"] for r in near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert found == groups(sets)
    assert any(100 * len(sets[i] & sets[j]) ** 2 < 64 * len(sets[i]) * len(sets[j]) for i in range(80) for j in range(i) if found[i] == found[j])


def test_sketches_cover_long_texts_in_blocks():
    words = [f"w{k}" for k in range(60000)]
    _, fp, bands, grams = sketch(" ".join(words).encode())
    assert len(grams) in range(59990, 59997) and len(bands) == 24 and fp == simhash(" ".join(words).encode(), 5)
    assert sketch(None) == sketch(b" \n") == (b"", 0, [], [])


def test_near_copies_of_odd_tables(spark):
    assert near_copies(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, "a b c d", None, None), (3, "a b c d", None, None), (3, "a b c d", None, None), (None, None, None, None)]
    found = sorted((r["id"] is None, r["component"] is None) for r in near_copies(spark.createDataFrame(rows, SCHEMA)).collect())
    assert found == [(False, False), (False, False), (True, False), (True, True)]
