"""Removal of repeated passages with one FM-index per shard of candidate passages."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import table, written
from spanloom.llm.fmindex import FMIndex

WINDOW, SEED_WORDS, SHARD_WORDS, HOT = 20, 8, 400_000, 2048
LAST = (1 << 63) - 1  # a null id comes after all others
MIX = np.array([0x9E3779B97F4A7C15 * (2 * k + 1) % (1 << 64) for k in range(64)], dtype=np.uint64)


def anchors(words: list[bytes], window: int = WINDOW, seed: int = SEED_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each window's anchor is its least seed of ``seed`` words, so equal windows have equal anchors.

    Runs of windows with one anchor: ``(anchor hash, first window, number of windows)``.
    """
    n = len(words) - window + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes = np.array([zlib.crc32(w) for w in words], dtype=np.uint64)
    m = len(words) - seed + 1
    hashes = np.zeros(m, dtype=np.uint64)
    for k in range(seed):
        hashes += (codes[k : k + m] + np.uint64(k + 1)) * MIX[k]
    hashes ^= hashes >> np.uint64(29)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(32)
    place = np.lib.stride_tricks.sliding_window_view(hashes, window - seed + 1).argmin(axis=1) + np.arange(n)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return hashes[place[first]].view(np.int64), first, np.diff(np.append(first, n))


def _scan(docs: DataFrame, window: int) -> DataFrame:
    """``(id, version, n_words, sha, anchor, first, n)``: the runs of each text; a row without a run if it has none."""
    schema = pa.schema([("id", pa.int64()), ("version", pa.binary()), ("n_words", pa.int64()), ("sha", pa.string()), ("runs", pa.list_(pa.struct([("anchor", pa.int64()), ("first", pa.int32()), ("n", pa.int32())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, shas, offsets, parts = [], [], [0], ([], [], [])
            for text in batch.column(2).to_pylist():
                words = (text or b"").split()
                counts.append(len(words))
                shas.append(hashlib.sha256(b" ".join(words)).hexdigest())
                found = anchors(words, window)
                for part, x in zip(parts, found, strict=True):
                    part.append(x)
                offsets.append(offsets[-1] + len(found[0]))
            a, f, n = (np.concatenate([np.zeros(0, np.int64), *p]) for p in parts)
            runs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(a), pa.array(f.astype("i4")), pa.array(n.astype("i4"))], names=["anchor", "first", "n"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(shas, pa.string()), runs], schema=schema)

    return docs.select("id", "version", "text").mapInArrow(run, "id long, version binary, n_words long, sha string, runs array<struct<anchor:long,first:int,n:int>>")


def _segments(touched: DataFrame, window: int) -> DataFrame:
    """``(key, part, id, version, first, n, words)``: the words of each candidate run.

    Runs of a hot anchor come as single windows, keyed by their words, so that a
    line which very many texts hold is spread over all shards.
    """
    schema = "key long, part long, id long, version binary, first int, n int, words binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [], [])
            for id_, version, text, runs in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                words = text.split()
                for r in runs:
                    for first, n in [(r["first"] + k, 1) for k in range(r["n"])] if r["hot"] else [(r["first"], r["n"])]:
                        part = b" ".join(words[first : first + n + window - 1])
                        digest = xxhash.xxh3_128_digest(part)
                        high, low = np.frombuffer(digest, dtype="<i8").tolist()
                        for column, x in zip(out, (high if r["hot"] else r["anchor"], low, id_, version, first, n, part), strict=True):
                            column.append(x)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["key", "part", "id", "version", "first", "n", "words"])

    return touched.select("id", "version", "text", "runs").mapInArrow(cut, schema)


def _turns(parts: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Which parts are indexed, and which are streamed through that index, so that each part meets all earlier ones of its key.

    Parts of a key are numbered by ``(id, first)``. Of two, the earlier one has a 0 where their numbers first differ in
    binary, so a turn for each bit does, and no part is streamed through an index that holds it. Parts of one id need not
    be in the order of their windows (an id may have several versions), so those also meet the other way round.
    """
    order = np.lexsort((parts["first"], parts["id"], parts["key"]))
    key, id_ = parts["key"].to_numpy()[order], parts["id"].to_numpy()[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(parts)))
    number, most = np.zeros(len(parts), dtype=np.int64), np.zeros(len(parts), dtype=np.int64)
    number[order] = np.arange(len(parts)) - np.repeat(starts, sizes)
    most[order] = np.repeat(sizes - 1, sizes)
    again = ~new & np.concatenate([[False], id_[1:] == id_[:-1]])
    shared = np.zeros(len(parts), dtype=bool)
    shared[order] = again | np.append(again[1:], False)
    for bit in range(int(most.max(initial=0)).bit_length()):
        late = number >> bit & 1 == 1
        early = ~late & ((number >> bit | 1) << bit <= most)
        yield np.flatnonzero(early), np.flatnonzero(late)
        if (late & shared).any() and (early & shared).any():
            yield np.flatnonzero(late & shared), np.flatnonzero(early & shared)


def _batches(turns: Iterator[tuple[np.ndarray, np.ndarray]], sizes: np.ndarray, most: int) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
    """Turns that are searched at once: as many as hold ``most`` words together, and one at least."""
    batch, words = [], 0
    for turn in turns:
        more = int(sizes[turn[0]].sum() + sizes[turn[1]].sum())
        if batch and words + more > most:
            yield batch
            batch, words = [], 0
        batch.append(turn)
        words += more
    if batch:
        yield batch


def _laid(codes: list[np.ndarray], turns: list[np.ndarray], n_codes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The chosen texts of every turn one after another, each ended by a 0; where each ends; their lengths.

    Every turn has codes of its own, so one index serves them all and no search sees another turn's texts.
    """
    chosen, turn = np.concatenate(turns), np.repeat(np.arange(len(turns)), [len(t) for t in turns])
    lengths = np.array([len(codes[k]) for k in chosen], dtype=np.int64)
    ends = np.cumsum(lengths + 1) - 1
    flat = np.zeros(int(lengths.sum()) + len(chosen), dtype=np.int64)
    for k, e, n, t in zip(chosen.tolist(), ends.tolist(), lengths.tolist(), turn.tolist(), strict=True):
        flat[e - n : e] = codes[k] + t * n_codes
    return chosen, flat, ends, lengths


def earliest(parts: pd.DataFrame, window: int) -> pd.DataFrame:
    """Stream a shard's passages through indexes of others, and tell where each of their windows starts first.

    ``parts(key, part, id, first, n, words)``; the result has, for each part, the
    smallest ``(id, place)`` at which each of its windows starts in any part: its own
    unless the search finds the window in another. See ``_turns`` for which parts an
    index holds.
    """
    code: dict[bytes, int] = {}
    codes = [np.array([code.setdefault(w, len(code) + 1) for w in text.split()], dtype=np.int64) for text in parts["words"]]
    ids, ranked = np.unique(parts["id"].to_numpy(), return_inverse=True)
    own = (ranked.astype(np.int64) << 32) + parts["first"].to_numpy().astype(np.int64)
    cuts = np.concatenate([[0], np.cumsum([len(c) - window + 1 for c in codes])]).astype(np.int64)
    best = np.repeat(own - cuts[:-1], np.diff(cuts)) + np.arange(cuts[-1])
    sizes, most = np.diff(cuts) + window, 2 * int((np.diff(cuts) + window).sum())
    for turns in _batches(_turns(parts), sizes, most):
        held, flat, ends, lengths = _laid(codes, [h for h, _ in turns], len(code))
        index = FMIndex(flat, window)
        least = index.groups(np.repeat(own[held] - (ends - lengths), lengths + 1) + np.arange(len(flat)))
        asking, flat, ends, lengths = _laid(codes, [a for _, a in turns], len(code))
        at, group = index.stream(flat, ends, lengths)
        text = np.searchsorted(ends, at)
        np.minimum.at(best, cuts[asking[text]] + at - (ends - lengths)[text], least[group])
    return pd.DataFrame({"key": parts["key"], "part": parts["part"], "ids": np.split(ids[best >> 32], cuts[1:-1]), "places": np.split((best & 0xFFFFFFFF).astype(np.int32), cuts[1:-1])})


def repeated_passages(docs: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, version, n_words, sha, first_id, text, covered)`` for every row of ``docs``.

    ``covered`` lists the first words of the windows that also start earlier, null
    where none does; ``text`` (binary) is there only if ``covered`` is. A row whose
    whole text occurs under a smaller id has that as ``first_id``: all its windows
    start earlier. ``sha`` is that of all words, joined by one space.

    Equal texts, those of one 128-bit hash, enter once. Texts that share no anchor with another, and hold none
    twice, can't hold a repeated window and aren't indexed. The rest is cut into
    passages around repeated anchors; passages of one anchor go to one shard. There
    each distinct content is streamed through FM-indexes of the earlier ones of its
    anchor, which tell the windows that start earlier. A shard holds about ``shard_words`` words; passages around anchors that
    occur ``hot`` times or more are spread by their content instead.

    Null texts have no words; null ids come last; rows that share an id are one
    document in several versions; repeated rows get equal results; an empty table
    gives an empty one.
    """
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("id"), F.col(text_col).cast("binary").alias("text")).withColumn("version", F.unhex(F.md5(F.coalesce("text", F.lit(b"")))))
    scanned = written(_scan(base, window), "runs")
    runs = scanned.select("id", "version", F.explode("runs").alias("run")).select("id", "version", "run.*")
    ends = [f(c).alias(f"{f.__name__}_{name}") for name, c in (("version", F.xxhash64("version")), ("first", F.col("first"))) for f in (F.min, F.max)]
    repeated = written(runs.groupBy("anchor").agg(*ends, F.count(F.lit(1)).alias("times")).where("min_version < max_version or min_first < max_first").select("anchor", (F.col("times") >= hot).alias("hot")), "anchors")
    wanted = written(runs.join(repeated, "anchor").groupBy("version").agg(F.min("id").alias("id"), F.collect_set(F.struct("anchor", "first", "n", "hot")).alias("runs")), "wanted")
    touched = written(base.join(wanted, ["version", "id"]).dropDuplicates(["version"]), "touched")
    parts = _segments(touched, window)
    contents = written(parts.groupBy("key", "part").agg(F.min(F.struct("id", "first")).alias("least"), F.first("n").alias("n"), F.first("words").alias("words")).select("key", "part", "least.*", "n", "words"), "contents")
    total = contents.agg(F.sum(F.col("n") + window)).first()[0] or 0
    shards = max(1, -(-total // shard_words))
    schema = "key long, part long, ids array<long>, places array<int>"
    found = written(contents.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards))).groupBy("shard").applyInPandas(lambda pdf: earliest(pdf, window), schema), "earliest")
    at = F.posexplode(F.arrays_zip("ids", "places")).alias("k", "least")
    placed = parts.select("key", "part", "id", "version", "first").join(found, ["key", "part"]).select("id", "version", "first", at)
    late = placed.where((F.col("least.ids") < F.col("id")) | ((F.col("least.ids") == F.col("id")) & (F.col("least.places") < F.col("first") + F.col("k"))))
    covered = late.groupBy("version").agg(F.sort_array(F.collect_set(F.col("first") + F.col("k"))).alias("covered"))
    cleaned = written(touched.select("version", "text").join(covered, "version"), "covered")
    firsts = written(scanned.groupBy("version").agg(F.min("id").alias("first_id")), "firsts")
    rows = scanned.select("id", "version", "n_words", "sha").join(firsts, "version")
    return rows.join(cleaned, (rows["version"] == cleaned["version"]) & (rows["id"] == rows["first_id"]), "left").select(rows["id"], rows["version"], "n_words", "sha", "first_id", "text", "covered")


def kept_words(found: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(id, n_words, n_removed, kept)``: the rows of ``repeated_passages`` with what stays, in binary.

    ``kept`` is null where the text stays whole, and empty where all of it goes.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept = [], []
            for n, text, covered, copy in zip(*(batch.column(k).to_pylist() for k in ("n_words", "text", "covered", "copy")), strict=True):
                if copy and n >= window:
                    removed.append(n)
                    kept.append(b"")
                elif covered:
                    gone = np.zeros(n + 1, dtype=np.int64)
                    np.add.at(gone, covered, 1)
                    np.add.at(gone, np.array(covered) + window, -1)
                    stays = np.cumsum(gone)[:n] == 0
                    removed.append(int(n - stays.sum()))
                    kept.append(b" ".join(w for w, s in zip(text.split(), stays.tolist(), strict=True) if s))
                else:
                    removed.append(0)
                    kept.append(None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_words"), pa.array(removed, pa.int64()), batch.column("sha"), pa.array(kept, pa.binary())], names=["id", "n_words", "n_removed", "sha", "kept"])

    return found.select("id", "n_words", "sha", "text", "covered", (F.col("first_id") < F.col("id")).alias("copy")).mapInArrow(cut, "id long, n_words long, n_removed long, sha string, kept binary")


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = kept_words(repeated_passages(table(spark, sf_dir, "documents")))
    sha = F.when(F.col("kept").isNull(), F.col("sha")).otherwise(F.sha2("kept", 256))
    return found.select(F.when(F.col("id") != LAST, F.col("id")).alias("doc_id"), "n_words", "n_removed", sha.alias("kept_sha256"))
