import hashlib
import random

import numpy as np
import pandas as pd

from spanloom.llm.fmindex import FMIndex, WaveletMatrix
from spanloom.llm.substrings import _turns, anchors, earliest, kept_words, op5_substrings, repeated_passages

SCHEMA = "doc_id long, text string, version string, runs long, shard int"


def brute(rows, window=20):
    """(doc_id, text) in any order -> doc_id -> (n words, n removed, sha of what stays)."""
    seen, out = {}, {}
    for i, text in sorted(rows):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            if seen.setdefault(tuple(words[k : k + window]), (i, k)) != (i, k):
                gone[k : k + window] = [True] * window
        out[i] = (len(words), sum(gone), hashlib.sha256(b" ".join(w for w, g in zip(words, gone, strict=True) if not g)).hexdigest())
    return out


def results(df):
    return {r["id"]: (r["n_words"], r["n_removed"], r["sha"] if r["kept"] is None else hashlib.sha256(r["kept"]).hexdigest()) for r in df.collect()}


def texts():
    rnd = random.Random(11)
    vocabulary = [f"w{k}" for k in range(3000)]
    say = lambda k: [rnd.choice(vocabulary) for _ in range(k)]
    common, line, base = say(55), say(21), say(400)
    rows = []
    for k in range(90):
        words = say(rnd.randrange(0, 200))
        if k % 3 == 0:
            words[len(words) // 2 : len(words) // 2] = common
        if k % 4 == 0:
            words += line
        if k % 5 == 0:
            words = list(base)
            words[rnd.randrange(400)] = "edited"
        if k % 7 == 0:
            words += words[:60]
        rows.append((k, rnd.choice([" ", "\n", " \t"]).join(words)))
    rows += [(200, None), (201, ""), (202, " \n "), (203, "one two"), (204, " ".join(base)), (205, " ".join(base)), (206, "la " * 3000), (207, "short text of five words"), (208, "short text of five words"), (199, rows[3][1])]
    return rows


def test_matches_brute_force(spark):
    rows = texts()
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA).repartition(3)
    expected = brute(rows)
    assert results(kept_words(repeated_passages(docs))) == expected
    assert results(kept_words(repeated_passages(docs, shard_words=300, hot=3))) == expected


def test_index_counts_and_streams():
    rnd = np.random.default_rng(0)
    codes = rnd.integers(0, 9, 500)
    matrix = WaveletMatrix(codes)
    for c in range(9):
        low, high = np.array([3, 100]), np.array([90, 500])
        first, a, b = matrix.narrow(np.full(2, c), low, high)
        assert (b - a).tolist() == [int((codes[i:j] == c).sum()) for i, j in zip(low, high, strict=True)]
    texts = [rnd.integers(1, 4, rnd.integers(1, 40)).tolist() for _ in range(60)]
    flat = np.array([c for t in texts for c in [*t, 0]], dtype=np.int64)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    index = FMIndex(flat, 6)
    others = [rnd.integers(1, 6, 30).tolist() for _ in range(20)] + texts
    stream = np.array([c for t in others for c in [*t, 0]], dtype=np.int64)
    at, group = index.stream(stream, np.cumsum([len(t) + 1 for t in others]) - 1, np.array([len(t) for t in others]))
    least = index.groups(np.arange(len(flat)))
    windows = {}
    for e, t in zip(ends, texts, strict=True):
        for k in range(len(t) - 5):
            windows.setdefault(tuple(t[k : k + 6]), int(e - len(t) + k))
    expected, start = {}, 0
    for t in others:
        for k in range(len(t) - 5):
            if tuple(t[k : k + 6]) in windows:
                expected[start + k] = windows[tuple(t[k : k + 6])]
        start += len(t) + 1
    assert dict(zip(at.tolist(), least[group].tolist(), strict=True)) == expected


def test_equal_windows_have_equal_anchors():
    rnd = random.Random(3)
    shared = [b"s%d" % k for k in range(30)]
    a = [b"a%d" % rnd.randrange(99) for _ in range(40)] + shared
    b = shared + [b"b%d" % rnd.randrange(99) for _ in range(40)]
    of = lambda words: {f + k: h for h, f, n in zip(*(x.tolist() for x in anchors(words)), strict=True) for k in range(n)}
    assert [of(a)[40 + k] for k in range(11)] == [of(b)[k] for k in range(11)]


def passages():
    """Passages of several keys: those of one key share what is around their anchor, further or less far."""
    rnd = random.Random(5)
    rows = []
    for key in range(12):
        middle = [f"m{key}_{k}" for k in range(30)]
        for part in range(rnd.choice([1, 2, 3, 9, 40])):
            a, b = rnd.randrange(12), rnd.randrange(18, 31)
            words = [f"x{rnd.randrange(5)}" for _ in range(rnd.randrange(4))] + middle[a:b] + [f"y{rnd.randrange(5)}" for _ in range(rnd.randrange(4))]
            if len(words) >= 20:
                rows.append((key, part, rnd.randrange(60), rnd.randrange(200), len(words) - 19, " ".join(words).encode()))
    return pd.DataFrame(rows, columns=["key", "part", "id", "first", "n", "words"])


def own_places(parts):
    return [[(i, f + k) for k in range(n)] for i, f, n in zip(parts["id"], parts["first"], parts["n"], strict=True)]


def test_search_finds_the_earliest_start_of_every_window():
    parts = passages()
    windows = [[tuple(w.split()[k : k + 20]) for k in range(n)] for w, n in zip(parts["words"], parts["n"], strict=True)]
    least = {}
    for mine, places in zip(windows, own_places(parts), strict=True):
        for w, at in zip(mine, places, strict=True):
            least[w] = min(at, least.get(w, at))
    found = earliest(parts, 20)
    # a window that starts earlier names a place before its own, if not always the very first
    for mine, places, ids, at in zip(windows, own_places(parts), found["ids"], found["places"], strict=True):
        for w, own, got in zip(mine, places, zip(ids.tolist(), at.tolist(), strict=True), strict=True):
            assert (got < own) == (least[w] < own) and least[w] <= got <= own
    assert any(g != o for g, o in zip([list(zip(i.tolist(), p.tolist(), strict=True)) for i, p in zip(found["ids"], found["places"], strict=True)], own_places(parts), strict=True))


def test_without_the_search_no_window_is_found(monkeypatch):
    parts = passages()
    monkeypatch.setattr(FMIndex, "stream", lambda *_: (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)))
    found = earliest(parts, 20)
    assert [list(zip(i.tolist(), p.tolist(), strict=True)) for i, p in zip(found["ids"], found["places"], strict=True)] == own_places(parts)


def test_no_passage_is_streamed_through_an_index_that_holds_it():
    parts = passages()
    met = set()
    for held, asking in _turns(parts):
        assert not set(held.tolist()) & set(asking.tolist())
        met |= {(int(h), int(a)) for h in held for a in asking}
    rows = list(zip(parts["key"], parts["id"], parts["first"], strict=True))
    for a, x in enumerate(rows):
        for b, y in enumerate(rows):
            if a != b and x[0] == y[0]:
                assert x >= y or (a, b) in met
                assert x[1] != y[1] or (a, b) in met


def test_versions_of_one_id_are_searched_both_ways(spark):
    shared = " ".join(f"s{k}" for k in range(20))
    rows = [(5, " ".join(f"a{k}" for k in range(4)) + " " + shared, "x", 1, 2), (5, "b0 " + shared, "x", 1, 2), (5, shared + " c0", "x", 1, 2)]
    counts = sorted((r["n_words"], r["n_removed"]) for r in kept_words(repeated_passages(spark.createDataFrame(rows, SCHEMA))).collect())
    assert counts == [(21, 0), (21, 20), (24, 20)]


def test_odd_tables(spark):
    assert kept_words(repeated_passages(spark.createDataFrame([], SCHEMA))).count() == 0
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(None, text, None, None, None), (4, text, None, None, None), (4, text, None, None, None), (9, text, None, None, None)]
    found = sorted((r["id"], r["n_removed"]) for r in kept_words(repeated_passages(spark.createDataFrame(rows, SCHEMA))).collect())
    assert found == [(4, 0), (4, 0), (9, 30), ((1 << 63) - 1, 30)]


def test_query_over_its_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in op5_substrings(spark, "/root/testdata/sf0.001").collect()} == brute(rows)
