import zlib
from collections import Counter
from math import log2

import numpy as np

from spanloom.llm import langid, quality, secrets
from spanloom.llm.langid import Contexts, grams_of, op4_langid, predict, score_texts

DOCS = "doc_id long, text string, lang string, source string, score double, letters string"
SF = "/root/testdata/sf0.01"


def plain_bits(training, text, order):
    """Code length by the definition: counts of each context, escapes of method C, no exclusion."""
    counts = {}
    for t in training:
        padded = b"\0" * order + t
        for i in range(order, len(padded)):
            for k in range(order + 1):
                counts.setdefault(padded[i - k : i], Counter())[padded[i]] += 1
    padded, bits = b"\0" * order + text, 0.0
    for i in range(order, len(padded)):
        for k in range(order, -1, -1):
            seen = counts.get(padded[i - k : i])
            if seen and padded[i] in seen:
                bits += log2((sum(seen.values()) + len(seen)) / seen[padded[i]])
                break
            if seen:
                bits += log2((sum(seen.values()) + len(seen)) / len(seen))
        else:
            bits += 8
    return bits


def model_of(training, order):
    lang, gram, n = [], [], []
    for k, texts in enumerate(training):
        keys, counts = np.unique(grams_of(texts, order)[0], return_counts=True)
        lang += [k] * len(keys)
        gram += keys.tolist()
        n += counts.tolist()
    return Contexts.fit([f"l{k}" for k in range(len(training))], order, np.array(lang), np.array(gram, dtype=np.uint64), np.array(n))


def test_code_lengths_are_exact():
    training = [[b"abracadabra", b"", b"abc"], ["über die Brücke".encode(), b"und zur\xff\xff\xff"]]
    texts = [b"abra", "Brücke über".encode(), b"", b"\0\0", b"zzz", b"\xff\xff\xffabc" * 9]
    for order in (1, 3, 4, 7):
        found = score_texts(model_of(training, order), texts)
        for row, text in enumerate(texts):
            for k, t in enumerate(training):
                assert abs(found[row, k] - plain_bits(t, text, order)) < 1e-3


def test_slices_change_nothing(monkeypatch):
    training, text = [[b"hello world " * 30], [b"bonjour monde " * 30]], b"bonjour world \xc3\xa9t " * 120
    model = model_of(training, 3)
    whole = score_texts(model, [text, b"x", text])
    exact = [plain_bits(t, text, 3) for t in training]
    for size in (1, 2, 3, 100, 1000):
        monkeypatch.setattr(langid, "SLICE", size)
        sliced = score_texts(model, [text, b"x", text])
        assert np.abs(whole - sliced).max() < 1e-6 * whole.max()
        assert np.abs(sliced[0] - exact).max() < 1e-4 * max(exact)


def test_language_of_held_out_documents(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op4_langid(spark, SF).collect()
    assert len(rows) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)
    held = [r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in rows if r["held_out"]]
    assert sum(held) / len(held) > 0.98


def test_language_of_odd_tables(spark):
    rows = [(1, None, "en", "s", 0.0, "x"), (2, "", None, None, None, None), (3, "123 !?", "en", "s", 0.0, "x"), (None, "the cat", "en", None, None, None), (4, "the cat sat", "en", None, None, None), (4, "the cat sat", "en", None, None, None), (5, "le chat dort", "fr", None, None, None), (6, "the cat " * 90000, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    model = langid.fit(docs.selectExpr("doc_id as id", "text", "lang"))
    found = {(r["id"], r["lang_pred"], r["score"] > 0) for r in predict(docs, model).collect()}
    assert found == {(1, "und", False), (2, "und", False), (3, "und", False), (None, "en", True), (4, "en", True), (5, "fr", True), (6, "en", True)}
    nothing = langid.fit(docs.where("false").selectExpr("doc_id as id", "text", "lang"))
    assert {(r["lang_pred"], r["score"]) for r in predict(docs, nothing).collect()} == {("und", 0.0)}
    assert predict(docs.where("false"), model).count() == 0


def test_quality_of_held_out_documents(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = quality.op10_quality(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [(labels[r["doc_id"]], r["score"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    good, bad = [s for y, s in held if y], [s for y, s in held if not y]
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.9


def plain_score(net, text):
    """The network by its definition, place by place and chunk by chunk."""
    data = text.ljust(quality.WIDTH, b"\0")
    n = len(data) - quality.WIDTH + 1
    places = [sum(net.filters[k, data[i + k]].astype("f8") for k in range(quality.WIDTH)) for i in range(n)]
    starts = [max(0, min(s, n - quality.CHUNK)) for s in range(0, n, quality.CHUNK)]
    logits = [np.maximum(np.max(places[s : s + quality.CHUNK], axis=0) + net.bias, 0) @ net.out + net.out_bias for s in starts]
    return 1 / (1 + np.exp(-np.mean(logits)))


def test_network_sees_the_whole_text():
    net = quality.Network.new(3)
    rng = np.random.default_rng(1)
    for size in (0, 1, 6, 516, 517, 518, 1024, 1029, 1030, 16388, 16389, 16390, 16429, 40000):
        text = rng.integers(0, 256, size, dtype=np.uint8).tobytes()
        assert abs(net.score(text) - plain_score(net, text)) < 1e-5, size
        chunks = quality.chunks_of(text)
        assert {len(c) for c in chunks} == {quality.CHUNK + quality.WIDTH - 1}
        step = quality.CHUNK
        assert size < 517 or b"".join([c[:step] for c in chunks[:-1]])[: size - 517] + chunks[-1] == text
    assert net.score(b"") == net.score(b"\0" * quality.WIDTH)


def test_training_takes_whole_texts_within_its_bounds(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "train", lambda chunks, labels, weights=None: seen.append((len(labels), weights)))
    docs = spark.createDataFrame([(k, "x" * 1000 * (k + 1)) for k in range(6)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id as id", "int(doc_id % 2) as label")
    quality.fit(docs, labels)
    sizes = [len(quality.chunks_of(b"x" * 1000 * (k + 1))) for k in range(6)]
    assert seen[0][0] == sum(sizes)
    assert sorted(set(np.round(seen[0][1], 6).tolist())) == sorted({round(sum(sizes) / 6 / n, 6) for n in sizes})
    quality.fit(docs, labels, train_bytes=3500)
    assert 0 < seen[1][0] <= 8


def test_gradients_lower_the_loss():
    rng = np.random.default_rng(0)
    chunks = rng.integers(97, 123, (400, quality.CHUNK + quality.WIDTH - 1), dtype=np.uint8)
    labels = np.arange(400) % 2
    chunks[labels == 0, 100:106] = np.frombuffer(b"#$%&!!", dtype=np.uint8)
    net = quality.train(chunks, labels.astype("f4"))
    scores = net.logits(net.convolve(chunks).max(axis=1))
    assert ((scores > 0) == (labels == 1)).mean() > 0.98


def test_quality_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, "en", "s", 0.0, "x"), (2, "", None, None, None, None), (None, "abc", None, None, None, None), (3, "word " * 100000, None, None, None, None), (3, "w", None, None, None, None)], DOCS)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (3, 1), (None, 1), (99, None)], "id long, label int")
    found = quality.score(docs, quality.fit(docs, labels)).collect()
    assert len(found) == 5 and all(0 <= r["score"] <= 1 for r in found)
    assert quality.score(docs, quality.fit(docs, labels.where("false"))).count() == 5
    assert quality.score(docs.where("false"), quality.Network.new()).count() == 0


def test_forest_keeps_secrets_and_drops_lookalikes(spark):
    forest = secrets.train(secrets.labelled_findings(spark))
    held = secrets.labelled_findings(spark, 600, seed=99).collect()
    right = total = 0
    for r in held:
        spans, x = secrets.featured(r["text"], r["path"])
        for score in forest.score(x):
            right += (score >= 0.5) == bool(r["label"])
            total += 1
    assert total > 500 and right / total > 0.95


def test_forest_is_a_plain_walk_of_its_trees(spark):
    forest = secrets.train(secrets.labelled_findings(spark, 600))
    x = np.concatenate([secrets.featured(r["text"], r["path"])[1] for r in secrets.labelled_findings(spark, 60, seed=5).collect()])

    def walk(tree, row):
        feature, threshold, children, share = tree
        at = 0
        while feature[at] >= 0:
            at = children[at][1 if row[feature[at]] > threshold[at] else 0]
        return share[at]

    expected = [sum(walk(t, row) for t in forest.trees) / len(forest.trees) for row in x]
    assert np.abs(forest.score(x) - expected).max() < 1e-12


def test_recall_by_kind(spark):
    """Held-out findings of each kind, drawn with another seed."""
    forest = secrets.train(secrets.labelled_findings(spark))
    hits = {}
    for r in secrets.labelled_findings(spark, 3000, seed=123).collect():
        spans, x = secrets.featured(r["text"], r["path"])
        for (kind, *_), score in zip(spans, forest.score(x), strict=True):
            if r["label"]:
                hits.setdefault(kind, []).append(score >= 0.5)
    assert set(hits) == set(secrets.KINDS)
    assert min(sum(v) / len(v) for v in hits.values()) > 0.9, {k: sum(v) / len(v) for k, v in hits.items()}


def test_candidates_behind_any_name():
    key = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"
    for text in (f"auth={key}", f"x?sig={key}&b", f"AWS_SESSION={key}", f"https://me:{key[:12]}@host/x"):
        assert any(text[s:e] in (key, key[:12]) for _, s, e in secrets.candidates(text)), text


def test_scan_and_redact(spark):
    forest = secrets.train(secrets.labelled_findings(spark))
    key = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"
    rows = [(1, f'le token = "{key}" fin', "fr", "src0", 0.5, "x"), (2, f"commit {key} of test", "en", "tests/a", None, None), (3, None, None, None, None, None), (4, "", None, None, None, None), (None, "plain words only", None, None, None, None), (5, "word " * 60000 + f'api_key: "{key}"', None, None, None, None), (6, f"ü🙂 token={key}", None, None, None, None), (6, f"ü🙂 token={key}", None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    found = secrets.scan(docs, forest).collect()
    kept = {(r["id"], r["start"], r["end"]) for r in found if r["is_secret"]}
    assert kept == {(1, 12, 52), (5, 300010, 300050), (6, 9, 49)}
    assert all(r["secret"] == key for r in found)
    out = secrets.redact(docs, forest)
    assert out.columns == docs.columns and out.count() == len(rows)
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[1] == 'le token = "[REDACTED]" fin' and texts[2] == rows[1][1] and texts[3] is None and texts[None] == "plain words only" and key not in texts[5]
    assert secrets.scan(docs.where("false"), forest).count() == 0


def test_query_finds_what_a_plain_pattern_finds(spark):
    import re

    found = {(r["doc_id"], r["start"], r["end"]) for r in secrets.op3_secrets(spark, SF).collect() if r["is_secret"]}
    plain = set()
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        plain |= {(r["doc_id"], *m.span(1)) for m in re.finditer(r'token = "([0-9a-f]{40})"', r["text"])}
    assert plain and found == plain


def test_candidates_take_time_in_proportion():
    import time

    from spanloom.llm.secrets import candidates

    for part in ("a=", "-eyJabcdefgh", "a", "a1=", "key ", "://a:", "-----BEGIN ", "ghp_" + "a" * 40 + "_", "eyJ" + "a" * 9 + ".", "=", "sk-"):
        began = time.perf_counter()
        found = list(candidates(part * (1_000_000 // len(part))))
        assert time.perf_counter() - began < 10, part
        assert len(found) >= 0
