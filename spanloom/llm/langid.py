"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.llm.common import is_held_out, table

ORDER, TRAIN_DOCS, MOST_LANGS, SLICE, UNKNOWN = 4, 500, 1000, 1 << 21, "und"


@dataclass
class Contexts:
    """Frozen byte context trees of all languages, one level per order.

    Level k holds every context of k bytes with its next byte as a sorted key of
    k + 1 bytes; ``hit`` is the code length of that byte there by language (NaN
    where a language never saw it), ``escape`` that of leaving the context for a
    shorter one (0 where the language never saw the context).
    """

    langs: list[str]
    order: int
    grams: list[np.ndarray]
    hit: list[np.ndarray]
    contexts: list[np.ndarray]
    escape: list[np.ndarray]

    @classmethod
    def fit(cls, langs: list[str], order: int, lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Contexts:
        """From counts ``n`` of grams of ``order`` + 1 bytes by language; escapes as in method C."""
        out = cls(langs, order, [], [], [], [])
        for k in range(order + 1):
            keys, at = np.unique(gram & np.uint64((1 << 8 * (k + 1)) - 1), return_inverse=True)
            counts = np.zeros((len(keys), len(langs)))
            np.add.at(counts, (at, lang), n)
            contexts, of = np.unique(keys >> np.uint64(8), return_inverse=True)
            total, distinct = np.zeros((len(contexts), len(langs))), np.zeros((len(contexts), len(langs)))
            np.add.at(total, of, counts)
            np.add.at(distinct, of, counts > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                out.hit.append(np.where(counts > 0, np.log2((total + distinct)[of] / counts), np.nan).astype("f4"))
                out.escape.append(np.where(total > 0, np.log2((total + distinct) / distinct), 0).astype("f4"))
            out.grams.append(keys)
            out.contexts.append(contexts)
        return out

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """The exact code length of the last byte of each gram after the others, by language."""
        out = np.zeros((len(grams), len(self.langs)), dtype="f8")
        rows, open_ = np.arange(len(grams)), np.ones((len(grams), len(self.langs)), dtype=bool)
        for k in range(self.order, -1, -1):
            if not len(rows) or not len(self.grams[k]):
                break
            key = grams[rows] & np.uint64((1 << 8 * (k + 1)) - 1)
            at = np.minimum(np.searchsorted(self.grams[k], key), len(self.grams[k]) - 1)
            cost = np.where((self.grams[k][at] == key)[:, None], self.hit[k][at], np.nan)
            seen = open_ & ~np.isnan(cost)
            out[rows] += np.where(seen, cost, 0)
            open_ &= ~seen
            left = open_.any(axis=1)
            rows, open_, key = rows[left], open_[left], key[left] >> np.uint64(8)
            at = np.minimum(np.searchsorted(self.contexts[k], key), len(self.contexts[k]) - 1)
            out[rows] += np.where(open_ & (self.contexts[k][at] == key)[:, None], self.escape[k][at], 0)
        out[rows] += np.where(open_, 8.0, 0)  # below all orders, every byte is as likely
        return out


def grams_of(texts: list[bytes], order: int, before: list[bytes] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The grams that end at each byte of the texts, and where each text's grams start.

    A text starts after ``order`` zero bytes, or after the ``order`` bytes of ``before``.
    """
    pads = before or [b"\0" * order] * len(texts)
    data = np.frombuffer(b"".join(p + t for p, t in zip(pads, texts, strict=True)), dtype=np.uint8).astype(np.uint64)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(lengths + order)
    keep = np.ones(len(data), dtype=bool)
    for k in range(order):
        keep[ends - lengths - order + k] = False
    grams = np.zeros(max(0, len(data) - order), dtype=np.uint64)
    for k in range(order + 1):
        grams = (grams << np.uint64(8)) | data[k : len(data) - order + k]
    return grams[keep[order:]], np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(texts) else np.zeros(0, dtype=np.int64)


def score_texts(model: Contexts, texts: list[bytes]) -> np.ndarray:
    """Code lengths in bits, by text and language; whole texts, in slices of bounded size.

    A slice starts after the last bytes of the one before, so slices change nothing.
    """
    out, held, size = np.zeros((len(texts), len(model.langs))), [], 0

    def flush() -> None:
        grams, starts = grams_of([p for _, p, _ in held], model.order, [b for _, _, b in held])
        if len(grams):
            unique, at = np.unique(grams, return_inverse=True)
            cost = model.bits(unique)
            for k in range(len(model.langs)):
                sums = np.concatenate([[0.0], np.cumsum(cost[:, k][at])])
                stops = np.append(starts[1:], len(grams))
                np.add.at(out[:, k], [r for r, _, _ in held], sums[stops] - sums[starts])
        held.clear()

    for row, text in enumerate(texts):
        for start in range(0, len(text), SLICE):
            held.append((row, text[start : start + SLICE], text[max(0, start - model.order) : start].rjust(model.order, b"\0")))
            size += len(held[-1][1])
            if size >= SLICE:
                flush()
                size = 0
    flush()
    return out


def fit(labelled: DataFrame, order: int = ORDER, train_docs: int = TRAIN_DOCS) -> Contexts:
    """Learn from ``labelled(id, text, lang)``: about ``train_docs`` documents of each language.

    Which ones is decided by a hash of the id, so the sample is bounded and the
    same in every run; their texts are used whole. Spark counts the grams. Rows
    with a null text or lang are left out; without any row no language is known.
    More than ``MOST_LANGS`` languages raise, as a tree is held for each.
    """
    if not 1 <= order <= 7:
        raise ValueError("a gram has to fit into 64 bits: orders 1 to 7")
    known = labelled.where("text is not null and lang is not null")
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().limit(MOST_LANGS + 1).collect()}
    if len(sizes) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages")
    langs = sorted(sizes)
    if not langs:
        return Contexts([], order, [], [], [], [])
    share = F.coalesce(*[F.when(F.col("lang") == x, F.lit(train_docs / n)) for x, n in sizes.items()])
    number = F.coalesce(*[F.when(F.col("lang") == x, F.lit(k)) for k, x in enumerate(langs)])
    draw = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("train")), F.lit(1 << 30)) / F.lit(1 << 30)
    sample = known.where(draw < share).select(number.alias("lang"), F.col("text").cast("binary").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = np.array(batch.column(0).to_pylist())
            texts = batch.column(1).to_pylist()
            for k in np.unique(lang).tolist():
                grams, n = np.unique(grams_of([t for t, x in zip(texts, lang, strict=True) if x == k], order)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(grams), k, dtype="i4")), pa.array(grams.view("i8")), pa.array(n.astype("i8"))], names=["lang", "gram", "n"])

    counts = sample.mapInArrow(count, "lang int, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    lang, gram, n = (counts.column(c).to_numpy() for c in ("lang", "gram", "n"))
    return Contexts.fit(langs, order, lang, gram.astype("i8").view("u8"), n)


def predict(docs: DataFrame, model: Contexts, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, lang_pred, score, bits_per_byte)`` for every row of ``docs``.

    The language whose trees give the shortest code for the whole text, and its
    posterior probability under equal priors. A text that is null or has no
    letter is ``und`` with score 0, as is any text if no language was learnt.
    Repeated rows get equal results; other columns play no part.
    """
    spark = docs.sparkSession
    if not model.langs:
        return docs.select(F.col(id_col).alias("id"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("bits_per_byte"))
    shared = spark.sparkContext.broadcast(model)  # its size is bounded by the training sample
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("letters", T.BooleanType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits_per_byte", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            texts = [t or b"" for t in batch.column(2).to_pylist()]
            bits = score_texts(trees, texts)
            best = bits.argmin(axis=1)
            least = bits.min(axis=1)
            odds = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
            size = np.array([len(t) for t in texts])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([trees.langs[k] for k in best], pa.string()), pa.array(odds), pa.array(least / np.maximum(size, 1))], names=schema.names)

    whole = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("letters"), F.col(text_col).cast("binary").alias("text"))
    found = whole.mapInArrow(score, schema)
    return found.select("id", F.when(F.col("letters"), F.col("lang_pred")).otherwise(UNKNOWN).alias("lang_pred"), F.when(F.col("letters"), F.col("score")).otherwise(0.0).alias("score"), F.when(F.col("letters"), F.col("bits_per_byte")).alias("bits_per_byte"))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(~is_held_out()).select(F.col("doc_id").alias("id"), "text", "lang")


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predict(docs, fit(training_rows(docs)))
    return found.select(F.col("id").alias("doc_id"), is_held_out("id").alias("held_out"), "lang_pred", "score", "bits_per_byte")
