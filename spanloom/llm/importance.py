"""Documents drawn towards a target distribution, by importance weights of hashed n-grams."""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.llm.common import table, written

BUCKETS, SEED, PERCENT, LEAST_WORDS = 10_000, 7, 25, 20
#: Every byte that is no part of a word becomes a blank; A-Z become a-z. Bytes from 0x80 on belong to words.
WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
#: A text's words are held so many bytes at a time.
SLICE = 1 << 20


def features(text: bytes | None) -> Iterator[tuple[int, np.ndarray]]:
    """Number of words and crc32 of all features (words, and pairs of neighbours joined by a blank) of a UTF-8 text, slice by slice."""
    flat, at, last = (text or b"").translate(WORD_BYTES), 0, None
    while at < len(flat):
        end = flat.find(b" ", min(at + SLICE, len(flat)))
        end = len(flat) if end < 0 else end
        words = flat[at:end].split()
        at = end
        if words:
            ones = list(map(crc32, words))
            firsts = ones[:-1] if last is None else [last, *ones[:-1]]
            seconds = words[1:] if last is None else words
            yield len(words), np.array(ones + [crc32(word, crc32(b" ", first)) for word, first in zip(seconds, firsts, strict=True)], dtype=np.int64)
            last = ones[-1]


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over ``texts(text, times)``: each task sums its own, and the driver gets one number a bucket."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text, times in zip(batch["text"], batch["times"], strict=True):
                for _, hashes in features(text):
                    total += times * np.bincount(hashes % buckets, minlength=buckets)
        held = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": held, "n": total[held]})

    sums = texts.select(F.col("text").cast("binary"), "times").mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, dtype=np.int64)
    out[sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """How much likelier each bucket is in the target, in thousandths of a natural logarithm, rounded down; counts are smoothed by one."""
    all_s, all_t, size = float(source.sum()), float(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (all_s + size) / ((s + 1.0) * (all_t + size)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def weighted(texts: DataFrame, gain: np.ndarray) -> DataFrame:
    """``texts`` with ``n_words``, ``n_features`` and ``weight``, the floored mean gain of their features (0 without any)."""

    def one(text: bytes | None) -> tuple[int, int, int]:
        words = many = total = 0
        for n, hashes in features(text):
            words, many, total = words + n, many + len(hashes), total + int(gain[hashes % len(gain)].sum())
        return words, many, total // many if many else 0

    @F.pandas_udf("n_words long, n_features long, weight long")
    def of(column: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(t) for t in column], columns=["n_words", "n_features", "weight"])

    return texts.withColumn("w", of(F.col("text").cast("binary"))).select("key", "w.*")


def noise(id_col: str, seed: int = SEED) -> Column:
    """A Gumbel draw in thousandths, fixed by seed and id: the first 32 bits of a SHA-256 as a uniform number. A null id is an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln(uniform)))


def ranked(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3 … for the highest scores of the rows with enough words, null for the rest.

    Scores are whole numbers, so how many rows have each is a table of bounded
    size (noise spans some 26,000 values and weights lie between the least and the
    greatest gain). The driver adds it up to the ranks that each score starts at,
    and rows of one score are numbered by themselves: no global sort.
    """
    enough = F.col("n_words") >= least_words
    counts = scored.where(enough).groupBy("score").agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values("score", ascending=False)
    drawn = percent * int(counts["n"].sum()) // 100
    counts["before"] = counts["n"].cumsum() - counts["n"]
    starts = counts[counts["before"] < drawn]
    spark = scored.sparkSession
    if starts.empty:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    least = int(starts["score"].min())
    table_ = spark.createDataFrame(starts[["score", "before"]].astype("int64"), "score long, before long")
    order = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features", "weight")
    high = scored.where(enough & (F.col("score") >= least)).join(F.broadcast(table_), "score")
    rank = F.col("before") + F.row_number().over(order)
    numbered = high.withColumn("rank", F.when(rank <= drawn, rank)).select(*scored.columns, "rank")
    return numbered.unionByName(scored.where(~(enough & (F.col("score") >= least))).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score, rank)`` for every row of ``docs``.

    Equal texts are grouped by their whole text, so features and weight are worked
    out once a text and count as often as it occurs; the weight goes back to the
    rows by the text's 128-bit hash, and only then the noise of each row is added.
    Words and features are of whole texts; a null or empty text has none, weight 0,
    and only its noise. Ties go to the smaller id (null last); repeated rows each
    have a rank of their own; an empty table gives an empty one; an empty target
    leaves all gains to smoothing; other columns play no part.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    key = F.coalesce(F.md5("text"), F.lit(""))
    texts = written(rows.groupBy("text").agg(F.count(F.lit(1)).alias("times")).withColumn("key", key), "texts")
    goal = target.select(F.col(text_col).alias("text"), F.lit(1).alias("times"))
    gain = gains(bucket_counts(texts, buckets), bucket_counts(goal, buckets))
    weights = written(weighted(texts, gain), "weights")
    joined = rows.select("doc_id", key.alias("key")).join(weights, "key").drop("key")
    scored = written(joined.withColumn("score", F.col("weight") + noise("doc_id", seed)), "scored")
    return ranked(scored, percent, least_words)


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of ``documents``, drawn towards the texts of ``benchmark``."""
    found = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
#: The same in DuckDB, with crc32 spelt out: a table of the 256 bytes, then a fold over the bytes of each distinct feature.
ORACLE_OP11 = f"""with recursive bits as (select i as b, i as c, 0 as k from range(256) r(i) union all select b, case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from bits where k < 8),
crc as materialized (select list(c order by b) as t from bits where k = 8),
words as materialized (select doc_id, 's' as side, {_WORDS} as w from documents union all select row_number() over (), 't', {_WORDS} from benchmark),
feats as materialized (select doc_id, side, unnest(w) as f from words union all select doc_id, side, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from words where len(w) > 1),
once as materialized (select distinct f, hex(encode(f)) as x from feats),
hashed as materialized (select f, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, len(x) // 2), lambda i: ('0x' || x[2 * i + 1 : 2 * i + 2])::bigint)), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 10000 as bucket from once, crc),
counted as (select bucket, count(*) filter (side = 's') as s, count(*) filter (side = 't') as t from feats join hashed using (f) group by bucket),
gain as (select bucket, cast(floor(1000 * ln((t + 1)::double * (sum(s) over () + 10000)::double / ((s + 1)::double * (sum(t) over () + 10000)::double))) as bigint) as g from counted),
sums as (select doc_id, count(*) as n, cast(floor(sum(g)::double / count(*)) as bigint) as weight from feats join hashed using (f) join gain using (bucket) where side = 's' group by doc_id),
scored as (select d.doc_id, len(w) as n_words, coalesce(n, 0) as n_features, coalesce(weight, 0) as weight, coalesce(weight, 0) + cast(floor(-1000 * ln(-ln((('0x' || sha256('7:' || d.doc_id)[1:8])::bigint + 0.5) / 4294967296))) as bigint) as score from words d left join sums using (doc_id) where side = 's'),
placed as (select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id) as r, count(*) filter (n_words >= 20) over () as many from scored)
select doc_id, n_features, weight, score, case when n_words >= 20 and r <= 25 * many // 100 then r end as rank from placed"""
