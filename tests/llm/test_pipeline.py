import corpus_pipeline as p
from spanloom.llm.decontam import words_of
from test_simhash import groups, shingles

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, component long, version string, key int"


def test_stages_decide_on_what_came_before(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, seen = docs, {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in p.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SF)
        assert kept.columns == docs.columns, name
        a, b = {r["doc_id"]: r["text"] for r in before.collect()}, {r["doc_id"]: r["text"] for r in kept.collect()}
        assert set(b) <= set(a)
        if name == "language":
            assert set(a) - set(b) == {i for i, t in a.items() if not any(c.isalpha() for c in t or "")}
        if name == "near_duplicates":
            assert len(set(b.values())) == len(b)
            assert set(b) == set(groups({i: shingles(t) for i, t in a.items()}).values())
        if name == "decontaminate":
            items = [" ".join(words_of(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            whole = {i for i, t in a.items() if any(f" {x} " in f" {' '.join(words_of(t))} " for x in items)}
            assert whole and whole <= set(a) - set(b) and len(set(a) - set(b)) <= 2 * len(whole)
        if name == "without_secrets":
            assert set(a) == set(b)
            assert all(b[i] == a[i] or "[REDACTED]" in b[i] for i in a)
        seen = b
    rows = p.STAGES[-1][1](spark, kept, SF).collect()
    assert {r["doc_id"] for r in rows} == set(seen)


def test_odd_tables(spark):
    rows = [(None, None, None, None, None, None, None, None, None), (1, "", "en", "s", 0, "x", 1, "v", 2), (2, "the same words of it", "en", "s", 3, "x", 1, "v", 2), (3, "the same words of it", None, None, None, None, None, None, None), (3, "the same words of it", None, None, None, None, None, None, None), (None, "the cat of it", None, None, None, None, None, None, None), (7, "the of and to in " * 30000, None, None, None, None, None, None, None)]
    for docs in (spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([], SCHEMA)):
        kept = docs
        for _, stage in p.STAGES[:-1]:
            kept = stage(spark, kept, SF)
            assert kept.columns == docs.columns
        ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect())
        assert ids == ([(False, 2), (False, 7), (True, 0)] if docs.columns and docs.count() else [])
        assert {r["doc_id"] for r in p.STAGES[-1][1](spark, kept, SF).collect()} == {r["doc_id"] for r in kept.collect()}


def test_rows_are_judged_by_what_they_hold(spark):
    """Different texts under one id, rows without an id and rows that repeat in full."""
    item = next(r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if len(words_of(r["text"])) > 12)
    one, two = (" ".join(f"{c}{k}" for k in range(80)) for c in "ab")
    rows = [(5, one), (5, two), (5, two), (None, two + " more"), (None, f"start {item} end"), (6, f"start {item} end of it"), (None, " ".join(f"c{k}" for k in range(50)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r["doc_id"] or 0, r["text"][:2]) for r in p.near_duplicates(spark, docs, SF).collect())
    assert kept in ([(0, "c0"), (5, "a0"), (5, "b0"), (6, "st")], [(0, "c0"), (0, "st"), (5, "a0"), (5, "b0"), (6, "st")])
    clean = sorted((r["doc_id"] or 0, r["text"][:2]) for r in p.decontaminate(spark, docs, SF).collect())
    assert clean == [(0, "b0"), (0, "c0"), (5, "a0"), (5, "b0"), (5, "b0")]


def test_run_covers_the_table(spark):
    rows = p.run(spark, SF).collect()
    assert rows and {"doc_id", "sequence_id", "offset"} <= set(rows[0].asDict())


def test_columns_may_have_any_name(spark):
    rows = [(1, "the same words of it", "mine", 7, "r", "k"), (2, "the same words of it", "yours", 8, "s", "l")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key string, _times int, row string, key string")
    for stage in (p.language, p.near_duplicates, p.decontaminate):
        kept = stage(spark, docs, SF).orderBy("doc_id").collect()
        assert [tuple(r) for r in kept] == (rows[:1] if stage is p.near_duplicates else rows)
