import random
import time

import numpy as np

from spanloom.llm.decontam import _cut, align, contaminated, op8_decontam, words_of

DOCS, ITEMS = "doc_id long, text string, item_id long, words string, score double", "item_id long, text string, doc_id long, gram string"


def plain(item, passage):
    best = 0
    rows = [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item, 1):
        for j, b in enumerate(passage, 1):
            rows[i][j] = max(0, rows[i - 1][j - 1] + (2 if a == b else -1), rows[i - 1][j] - 1, rows[i][j - 1] - 1)
            best = max(best, rows[i][j])
    return best / (2 * len(item))


def test_alignment_is_smith_waterman():
    rnd = random.Random(2)
    for _ in range(150):
        item = [rnd.randrange(6) for _ in range(rnd.randrange(1, 12))]
        passage = [rnd.randrange(6) for _ in range(rnd.randrange(0, 25))]
        score, start, end = align(np.array(item), np.array(passage, dtype=np.int64))
        assert abs(score - plain(item, passage)) < 1e-9
        assert abs(plain(item, passage[start:end]) - score) < 1e-9


def cases():
    rnd = random.Random(4)
    vocabulary = [f"w{k}" for k in range(400)] + ["the", "of", "and"] * 40
    say = lambda k: [rnd.choice(vocabulary) for _ in range(k)]
    items = [(k, say(rnd.randrange(15, 50))) for k in range(12)]
    docs, expected = [], set()
    for k in range(120):
        words = say(rnd.randrange(0, 300))
        if k % 6 == 0:
            i, leak = items[k % 12]
            leak = [w if rnd.random() > 0.12 * (k % 4 > 1) else "edit" for w in leak]
            at = rnd.randrange(len(words) + 1)
            words[at:at] = leak
            expected.add((k, i))
        docs.append((k, "  ".join(words).capitalize() + ".", 1, "x", 0.5))
    return docs, [(i, " ".join(w) + "!", 0, "g") for i, w in items], expected


def test_finds_copies_and_edits_by_scan_and_by_join(spark):
    docs, items, expected = cases()
    docs += [(None, None, None, None, None), (900, "", 0, "", 0.0), (901, items[3][1], 0, "", 0.0), (901, items[3][1], 0, "", 0.0), (902, "z " * 60000 + items[4][1], 0, "", 0.0)]
    items += [(None, "w1 w2 w3 w4", None, None), (77, None, None, None), (78, "w1", None, None), (79, "", None, None), (80, "w5 w6", None, None), (81, "z z z", None, None)]
    docs.append((903, "about W5, w6", 0, "", 0.0))
    short = {(k, i) for k, t, *_ in docs if k is not None for i, x in ((78, "w1"), (80, "w5 w6")) if f" {x} " in f" {' '.join(words_of(t))} "}
    assert {i for _, i in short} == {78, 80}
    expected = expected | short | {(901, 3), (902, 4), (902, 81)}
    d, i = spark.createDataFrame(docs, DOCS).repartition(4), spark.createDataFrame(items, ITEMS)
    texts, brute = {k: words_of(t) for k, t, *_ in docs if k is not None and k != 902}, set()
    for k, words in texts.items():
        brute |= {(k, item) for item, t, *_ in items if item is not None and len(words_of(t)) > 2 and plain(words_of(t), words) >= 0.5}
    assert expected - short - {(902, 4), (902, 81)} == brute
    for limit in (1 << 20, 0):
        rows = contaminated(d, i, index_limit=limit).collect()
        assert {(r["doc_id"], r["item_id"]) for r in rows} == expected
        assert len(rows) == len(expected)
        assert next(r for r in rows if r["doc_id"] == 902)["start"] == 60000


def test_many_hits_in_one_text_take_time_in_proportion():
    def seconds(k):
        start = time.perf_counter()
        (passage,) = _cut(["w"] * (k + 3), [(p, "w w w") for p in range(k)], 20, 3)
        assert passage[0] == 0 and passage[2] == ["w w w"]
        return time.perf_counter() - start

    assert seconds(400_000) < 8 * seconds(100_000) + 0.5


def test_empty_tables(spark):
    docs, items, _ = cases()
    assert contaminated(spark.createDataFrame([], DOCS), spark.createDataFrame(items, ITEMS)).count() == 0
    assert contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], ITEMS)).count() == 0


def test_query_finds_every_whole_item(spark):
    sf = "/root/testdata/sf0.001"
    found = {(r["doc_id"], r["item_id"]) for r in op8_decontam(spark, sf).collect()}
    docs = {r["doc_id"]: " ".join(words_of(r["text"])) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r["item_id"]: " ".join(words_of(r["text"])) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    assert found >= {(d, i) for d, t in docs.items() for i, x in items.items() if f" {x} " in f" {t} "}
    assert found


def test_each_item_reaches_as_far_as_it_is_long():
    """A long item doesn't make the passages of short ones long."""
    from spanloom.llm.decontam import _cut_each

    words = [f"w{k}" for k in range(10_000)]
    found = _cut_each(words, [(5000, "short one here"), (5003, "long one here")], {"short one here": 16, "long one here": 4096}.__getitem__, 3)
    assert sorted((start, len(text.split(" ")), grams) for start, text, grams in found) == [(907, 8195, ["long one here"]), (4984, 35, ["short one here"])]
