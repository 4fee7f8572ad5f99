"""Quality scores by a byte-level convolutional network in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.llm.common import is_held_out, table

WIDTH, FILTERS, CHUNK = 6, 16, 512
TRAIN_DOCS, TRAIN_BYTES, EPOCHS, BATCH, RATE = 3000, 1 << 25, 12, 128, 0.01


@dataclass
class Network:
    """Filters over ``WIDTH`` bytes (a weight by place, byte and filter), max-pooled by chunk, then a logistic unit."""

    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: float

    @classmethod
    def new(cls, seed: int = 0) -> Network:
        rnd = np.random.default_rng(seed)
        return cls((rnd.standard_normal((WIDTH, 256, FILTERS)) * 0.1).astype("f4"), np.zeros(FILTERS, "f4"), (rnd.standard_normal(FILTERS) * 0.1).astype("f4"), 0.0)

    def convolve(self, data: np.ndarray) -> np.ndarray:
        """``data``: bytes with WIDTH - 1 of the next chunk behind them; the last axis is the text."""
        n = data.shape[-1] - WIDTH + 1
        total = np.take(self.filters[0], data[..., :n], axis=0)
        part = np.empty_like(total)
        for k in range(1, WIDTH):
            np.take(self.filters[k], data[..., k : k + n], axis=0, out=part, mode="clip")
            total += part
        return total

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled + self.bias, 0) @ self.out + self.out_bias

    def score(self, text: bytes) -> float:
        """The whole text: the mean logit of its chunks, as a probability.

        Chunks overlap by WIDTH - 1 bytes, so every place of a filter is in one;
        a shorter last chunk is moved back to full length where the text allows.
        """
        n = max(len(text) - WIDTH + 1, 1)
        data = np.frombuffer(text.ljust(WIDTH, b"\0"), dtype=np.uint8)
        logits = []
        for start in range(0, n, CHUNK * 32):
            stop = min(start + CHUNK * 32, n)
            total = self.convolve(data[start : stop + WIDTH - 1])
            pooled = np.maximum.reduceat(total, np.arange(0, len(total), CHUNK), axis=0)
            if n > CHUNK and len(total) % CHUNK:
                last = total[-CHUNK:] if len(total) > CHUNK else self.convolve(data[n - CHUNK : n + WIDTH - 1])
                pooled[-1] = last.max(axis=0)
            logits.append(self.logits(pooled))
        return float(1 / (1 + np.exp(-np.clip(np.concatenate(logits).mean(dtype="f8"), -500, 500))))


def train(chunks: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None, epochs: int = EPOCHS, seed: int = 0) -> Network:
    """``chunks``: rows of CHUNK + WIDTH - 1 bytes; ``labels``: 0 or 1 for each; ``weights`` of a mean of 1. Adam on the log loss."""
    net, rnd = Network.new(seed), np.random.default_rng(seed)
    if not len(labels):
        return net
    weights = np.ones(len(labels), "f4") if weights is None else weights.astype("f4")
    share = np.clip((labels * weights).sum() / weights.sum(), 0.01, 0.99)
    net.out_bias = float(np.log(share / (1 - share)))
    params = [net.filters, net.bias, net.out, np.array([net.out_bias], "f4")]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    columns = np.arange(FILTERS)
    for epoch in range(epochs):
        order = rnd.permutation(len(labels))
        rate = RATE * (1 - epoch / epochs)
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            data = chunks[rows]
            total = net.convolve(data)
            best = total.argmax(axis=1)
            pooled = np.take_along_axis(total, best[:, None, :], axis=1)[:, 0] + net.bias
            active = np.maximum(pooled, 0)
            error = ((1 / (1 + np.exp(-(active @ net.out + params[3][0]))) - labels[rows]) * weights[rows] / len(rows)).astype("f4")
            back = error[:, None] * net.out * (pooled > 0)
            into = np.zeros_like(net.filters)
            for k in range(WIDTH):
                np.add.at(into[k], (np.take_along_axis(data, best + k, axis=1), columns[None, :]), back)
            grads = [into + 1e-5 * net.filters, back.sum(axis=0), active.T @ error + 1e-5 * net.out, np.array([error.sum()], "f4")]
            step += 1
            for p, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            net.out_bias = float(params[3][0])
    return net


def chunks_of(text: bytes) -> list[bytes]:
    """All chunks of a text, as :meth:`Network.score` sees them; a shorter text is one, filled up with zeros."""
    size, n = CHUNK + WIDTH - 1, max(len(text) - WIDTH + 1, 1)
    return [text[s : s + size].ljust(size, b"\0") for s in (max(0, min(s, n - CHUNK)) for s in range(0, n, CHUNK))]


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, train_bytes: int = TRAIN_BYTES, id_col: str = "doc_id", text_col: str = "text") -> Network:
    """Learn ``labels(id, label)`` from about ``train_docs`` labelled documents of ``train_bytes`` together at most.

    A hash of the id puts labelled documents in order; they are taken, each with
    its whole text, as long as they fit, so what the driver holds is bounded. All
    chunks of a document weigh as much as those of any other. Labels that are null
    and ids without a document are left out; without any label the network is the
    untrained one.
    """
    known = labels.where("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label"))
    share = min(1.0, train_docs / max(1, known.count()))
    hashed = F.xxhash64(F.col("id").cast("string"), F.lit("train"))
    sample = known.where(F.pmod(hashed, F.lit(1 << 30)) / F.lit(1 << 30) < share)
    # the sample is bounded by train_docs, so it is broadcast and the documents aren't shuffled
    found = docs.join(F.broadcast(sample), docs[id_col] == sample["id"]).select(F.col("id").cast("string").alias("id"), F.col("label").cast("int").alias("label"), F.coalesce(docs[text_col].cast("binary"), F.lit(b"")).alias("text"))
    sizes = found.groupBy("id").agg(F.sum(F.octet_length("text") + 1).alias("size"), F.min(F.xxhash64("id")).alias("order")).orderBy("order", "id").limit(2 * train_docs).collect()
    taken, total = [], 0
    for r in sizes:
        if total + r["size"] <= train_bytes:
            taken.append(r["id"])
            total += r["size"]
    rows = sorted(found.where(F.col("id").isin(taken)).collect() if taken else [], key=lambda r: (r["id"], bytes(r["text"])))
    texts = [chunks_of(bytes(r["text"])) for r in rows]
    counts = np.array([len(t) for t in texts], dtype=np.int64)
    chunks = np.frombuffer(b"".join(c for t in texts for c in t), dtype=np.uint8).reshape(-1, CHUNK + WIDTH - 1)
    weights = np.repeat(counts.sum() / (len(counts) * np.maximum(counts, 1)), counts) if len(counts) else None
    return train(chunks, np.repeat(np.array([r["label"] for r in rows], dtype="f4"), counts), weights)


def score(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` for every row; null and empty texts get the score of a text of zero bytes.

    Repeated rows get equal scores; other columns play no part; an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [shared.value.score(t or b"") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=schema.names)

    return docs.select(id_col, F.col(text_col).cast("binary").alias("text")).mapInArrow(run, schema)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~is_held_out()).select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    found = score(docs, fit(docs, labels))
    return found.select(F.col("id").alias("doc_id"), is_held_out("id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
