"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.llm.common import bloom, may_hold, table, written

N, LEAST, MATCH, MISMATCH, GAP = 3, 0.5, 2, 1, 1
INDEX_LIMIT = 1 << 20
WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    """Lower-cased words of a whole text; punctuation and white space don't count."""
    return WORD.findall((text or "").lower())


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """Smith-Waterman of two word-code sequences: ``(score, start, end)``.

    ``score`` is the best local alignment's, as a share of the item matched whole;
    start and end are its place in the passage. One row of the matrix is held at a
    time; a row's gaps are a running maximum, and every cell carries the place
    where its alignment began.
    """
    n = len(passage)
    if not n or not len(item):
        return 0.0, 0, 0
    at, height, began = np.arange(n), np.zeros(n, dtype=np.int64), np.arange(n)
    best, span = 0, (0, 0)
    for word in item:
        diagonal = np.concatenate([[0], height[:-1]]) + np.where(passage == word, MATCH, -MISMATCH)
        origin = np.concatenate([[0], began[:-1]])
        origin = np.where(np.concatenate([[0], height[:-1]]) > 0, origin, at)
        down = height - GAP
        cell = np.maximum(np.maximum(diagonal, down), 0)
        origin = np.where(diagonal >= down, origin, began)
        reach = np.maximum.accumulate((cell + GAP * at) * (n + 1) + at)  # the best cell to the left, and which it is
        source = reach % (n + 1)
        height = reach // (n + 1) - GAP * at
        began = origin[source]
        top = int(height.argmax())
        if height[top] > best:
            best, span = int(height[top]), (int(began[top]), int(source[top]) + 1)
    return best / (MATCH * len(item)), *span


def item_words(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    @F.pandas_udf("array<string>")
    def split(texts: pd.Series) -> pd.Series:
        return texts.map(words_of)

    return items.select(F.col(id_col).alias("item_id"), split(text_col).alias("words")).where("item_id is not null")


def _word_counts(docs: DataFrame, vocabulary: set[str] | None) -> DataFrame:
    """``(word, n)`` over all documents; of the words of a bounded ``vocabulary`` only, if one is given."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter[str] = Counter()
            for text in batch.column(0).to_pylist():
                words = words_of(text)
                found.update(words if shared.value is None else filter(shared.value.__contains__, words))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

    return docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def rare_seeds(items: DataFrame, docs: DataFrame, n: int, vocabulary: set[str] | None) -> DataFrame:
    """``(item_id, gram)``: the half of each item's n-grams that its words make rarest; a shorter item is one gram.

    How often an n-gram would occur by chance follows from the counts of its words
    in all documents. A leaked passage that half the corpus holds is still made of
    rare seeds, where its own count would have made it look common. Ties stay in.
    """
    firsts = F.sequence(F.lit(1), F.greatest(F.size("words") - n + 1, F.lit(1)))
    grams = items.where(F.size("words") > 0).select("item_id", F.explode(F.transform(firsts, lambda i: F.slice("words", i, n))).alias("gram")).distinct()
    counts = written(_word_counts(docs, vocabulary), "words")
    chance = grams.select("item_id", "gram", F.explode("gram").alias("word")).join(counts, "word", "left").groupBy("item_id", "gram").agg(F.round(F.sum(F.log(F.coalesce("n", F.lit(0)) + 1.0)), 6).alias("chance"))
    rank = F.percent_rank().over(Window.partitionBy("item_id").orderBy("chance"))
    return chance.withColumn("rank", rank).where("rank <= 0.5").select("item_id", F.array_join("gram", " ").alias("gram"))


def _passages(hits: list[tuple[int, str]], n_words: int, reach: int, n: int) -> list[tuple[int, int, set[str]]]:
    """Hits ``(place, gram)`` in order; those at most ``reach`` words apart share a passage that goes ``reach`` words beyond them."""
    out: list[list] = []
    for p, gram in hits:
        end = min(n_words, p + n + reach)
        if out and p <= out[-1][3] + reach:
            out[-1][1], out[-1][3] = end, p
            out[-1][2].add(gram)
        else:
            out.append([max(0, p - reach), end, {gram}, p])
    return [(start, end, grams) for start, end, grams, _ in out]


PASSAGE = "start int, passage string, grams array<string>"


def _emit(ids: pa.Array, rows: list[tuple[int, int, str, list[str]]], names: list[str]) -> pa.RecordBatch:
    at, starts, texts, grams = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays([ids.take(pa.array(at, pa.int64())), pa.array(starts, pa.int32()), pa.array(texts, pa.string()), pa.array(grams, pa.list_(pa.string()))], names=names)


def _cut(words: list[str], hits: list[tuple[int, str]], reach: int, n: int) -> list[tuple[int, str, list[str]]]:
    return [(start, " ".join(words[start:end]), sorted(grams)) for start, end, grams in _passages(hits, len(words), reach, n)]


def _cut_each(words: list[str], hits: list[tuple[int, str]], reach_of: Callable[[str], int], n: int) -> list[tuple[int, str, list[str]]]:
    """The passages around hits; each n-gram reaches as far as its own items are long, so those of one reach share passages."""
    by_reach: dict[int, list[tuple[int, str]]] = {}
    for p, gram in hits:
        by_reach.setdefault(reach_of(gram), []).append((p, gram))
    return [passage for reach, some in by_reach.items() for passage in _cut(words, some, reach, n)]


def with_reach(seeds: DataFrame, items: DataFrame, n: int) -> DataFrame:
    """``seeds(item_id, gram)`` with ``reach``: how many words beside its n-gram an item can go on, in steps of doubling."""
    long = items.select("item_id", F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.size("words"), F.lit(1)) + F.lit(n)))).cast("int").alias("reach"))
    return seeds.join(long.groupBy("item_id").agg(F.max("reach").alias("reach")), "item_id")


def _key_of(codes: list, base: int):
    key = codes[0]
    for c in codes[1:]:
        key = key * base + c
    return key


def scan(docs: DataFrame, grams: dict[str, int], n: int) -> DataFrame:
    """Passages around seeds, by one pass over whole texts with a bounded index in every task; ``grams`` says how far each reaches."""
    split = [g.split(" ") for g in sorted(grams)]
    vocabulary = {w: k for k, w in enumerate(sorted({w for g in split for w in g}))}
    base = len(vocabulary) + 1
    if base**n >= 1 << 63:
        raise ValueError("the index is too large for its keys")
    index = []
    for size in sorted({len(g) for g in split}):
        keyed = sorted((_key_of([vocabulary[w] for w in g], base), " ".join(g)) for g in split if len(g) == size)
        index.append((size, np.array([k for k, _ in keyed], dtype=np.int64), [g for _, g in keyed]))
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, index, grams))
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *T.StructType.fromDDL(PASSAGE).fields])

    def hits_of(codes: np.ndarray, index: list) -> list[tuple[int, str]]:
        found = []
        for size, keys, names in index:
            if len(codes) < size:
                continue
            views = [codes[k : len(codes) - size + 1 + k] for k in range(size)]
            at = np.flatnonzero(np.minimum.reduce(views) >= 0)
            if len(at):
                wanted = _key_of([v[at] for v in views], base)
                place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                right = keys[place] == wanted
                found += [(p, names[k]) for p, k in zip(at[right].tolist(), place[right].tolist(), strict=True)]
        return sorted(found) if len(index) > 1 else found

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, index, reaches = shared.value
        code = known.get
        for batch in batches:
            rows = []
            for row, text in enumerate(batch.column(1).to_pylist()):
                words = words_of(text)
                codes = np.fromiter((code(w, -1) for w in words), dtype=np.int64, count=len(words))
                if hits := hits_of(codes, index):
                    rows += [(row, *p) for p in _cut_each(words, hits, reaches.__getitem__, n)]
            yield _emit(batch.column(0), rows, schema.names)

    return docs.select("doc_id", "text").mapInArrow(find, schema)


def join_scan(docs: DataFrame, grams: DataFrame, n: int, sizes: list[int] | None = None) -> DataFrame:
    """The same passages where the seeds are too many for a task: a shuffled join on the n-gram.

    N-grams that a filter of fixed size knows to be no seeds stay where they are.
    ``sizes``: the lengths of seeds in words, ``n`` alone if not given.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("version"))
    hit = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *T.StructType.fromDDL("version long, pos int, gram string").fields])
    schema = T.StructType([hit.fields[0], *T.StructType.fromDDL(PASSAGE).fields])
    seeds = grams.groupBy("gram").agg(F.max("reach").alias("reach"))
    shared = docs.sparkSession.sparkContext.broadcast(bloom(seeds.select(F.xxhash64("gram").alias("hash")), "hash"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in enumerate(batch.column(1).to_pylist()):
                words = words_of(text)
                every = [(k, " ".join(words[k : k + m])) for m in sizes or [n] for k in range(len(words) - m + 1)]
                hashes = np.array([xxhash.xxh64_intdigest(g.encode(), 42) for _, g in every], dtype=np.uint64)
                found = [x for x, right in zip(every, may_hold(shared.value, hashes).tolist(), strict=True) if right]
                at = pa.array(np.full(len(found), row))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(2).take(at), pa.array([k for k, _ in found], pa.int32()), pa.array([g for _, g in found], pa.string())], names=hit.names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(row, *p) for row, (text, at) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)) for p in _cut_each(words_of(text), [(x["pos"], x["gram"]) for x in at], {x["gram"]: x["reach"] for x in at}.__getitem__, n)]
            yield _emit(batch.column(0), rows, schema.names)

    hits = keyed.mapInArrow(split, hit).join(seeds, "gram").groupBy("doc_id", "version").agg(F.sort_array(F.collect_set(F.struct("pos", "gram", "reach"))).alias("at"))
    same = hits["doc_id"].eqNullSafe(keyed["doc_id"]) & (hits["version"] == keyed["version"])
    return keyed.join(hits, same).select(keyed["doc_id"], "text", "at").mapInArrow(cut, schema)


def contaminated(docs: DataFrame, items: DataFrame, n: int = N, least: float = LEAST, index_limit: int = INDEX_LIMIT) -> DataFrame:
    """``(doc_id, item_id, score, start, end)``: passages of ``docs`` that hold a test item, edited or not.

    ``docs(doc_id, text)`` and ``items(item_id, text)``. A passage and an item that
    share a rare n-gram are aligned, in as many words around it as that item is long; from a score of ``least`` (a share of the whole
    item) on they are reported, with the words of the document that the alignment
    covers. The best passage is kept for a document and item. Up to ``index_limit``
    n-grams of items are looked up inside the scan; more go through a shuffled
    join. Null texts hold no words, nor do some items: those match nothing. An item
    of fewer than ``n`` words is found where all its words follow each other. Items
    of a null id are passed over; documents of a null id are reported with it;
    repeated rows count once; a very long text takes time in proportion to its
    words and seeds; an empty table on either side gives an empty result.
    """
    items, docs = written(item_words(items), "items"), docs.select("doc_id", "text")
    size = items.agg(F.sum(F.greatest(F.size("words") - n + 1, F.lit(1))).alias("grams"), F.collect_set(F.least(F.size("words"), F.lit(n))).alias("sizes")).first()
    small = (size["grams"] or 0) <= index_limit
    vocabulary = {r["word"] for r in items.select(F.explode("words").alias("word")).distinct().collect()} if small else None
    seeds = written(with_reach(rare_seeds(items, docs, n, vocabulary), items, n), "seeds")
    if small and (len(vocabulary or ()) + 1) ** n < 1 << 63:
        found = scan(docs, {r["gram"]: r["reach"] for r in seeds.groupBy("gram").agg(F.max("reach").alias("reach")).collect()}, n)
    else:
        found = join_scan(docs, seeds, n, sorted(k for k in size["sizes"] if k))
    passages = written(found.withColumn("key", F.xxhash64("doc_id", "start", "passage")), "passages")
    pairs = passages.select("key", F.explode("grams").alias("gram")).join(seeds.select("gram", "item_id"), "gram").select("key", "item_id").distinct()
    both = pairs.join(passages.dropDuplicates(["key"]), "key").join(items, "item_id").select("doc_id", "item_id", "start", "passage", "words")
    schema = T.StructType([both.schema["doc_id"], both.schema["item_id"], *T.StructType.fromDDL("score double, start int, end int").fields])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for start, passage, item in zip(*(batch.column(k).to_pylist() for k in range(2, 5)), strict=True):
                codes = {w: k for k, w in enumerate(dict.fromkeys(item))}
                got, first, last = align(np.array([codes[w] for w in item]), np.array([codes.get(w, -1) for w in passage.split(" ")]))
                out.append((got, start + first, start + last))
            scores, firsts, lasts = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array(firsts, pa.int32()), pa.array(lasts, pa.int32())], names=schema.names)

    aligned = both.mapInArrow(score, schema).where(F.col("score") >= least)
    best = F.max_by(F.struct("score", "start", "end"), F.struct(F.col("score"), -F.col("start"))).alias("best")
    return aligned.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def op8_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of ``benchmark`` in all ``documents``, a row for each document and item."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
