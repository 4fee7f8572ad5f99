"""Chroma audio fingerprints, and the alignment of recordings by offset and bit error."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.llm.common import bloom, may_hold, table, written

RATE, FRAME, HOP, LOW_HZ, HIGH_HZ = 4000, 512, 128, 200.0, 1800.0
BANDS, SPAN, FILTERS = 12, 16, 16
SEED_GAP, LEAST_VOTES, MOST_ERROR = 5, 3, 0.25
#: An overlap of fewer integers (two seconds of audio) that isn't all of the shorter recording can be alike by chance.
LEAST_FRAMES = 64
#: Neither does a shorter passage (four seconds) of an overlap count that is unlike as a whole: strangers have those by chance.
LEAST_PASSAGE = 128
EDGES = (-0.25, 0.0, 0.25)
#: Recordings whose seeds a task holds at a time.
AT_ONCE = 64
GRAY = np.array([0, 1, 3, 2], dtype=np.int64)
#: The integer of silence: no filter's areas differ.
SILENT = 0x55555555
#: Seeds as ``(gap, further gap, masks of the three integers, tag)``: a key holds the masked bits and the tag.
#: Equal ones only agree where all 64 bits of two integers do.
EQUAL_SEEDS = ((SEED_GAP, 0, (1 << 32) - 1, (1 << 32) - 1, 0, 0),)
#: The upper bit of a filter's two says which area is louder and flips least. Each of 28 seeds takes those of 14
#: filters of two integers and of six filters of a third one, others each time; the third ones and the tag are put into
#: lower bits, which the other masks don't have.
UPPER = 0xAAAAAAAA
TOLERANT_SEEDS = (*((SEED_GAP + 3 * (k % 8), 36 + 2 * k, UPPER & ~(0xF << 4 * (k % 8)), UPPER & ~(0xF << 4 * ((k + 3 + k // 8) % 8)), sum(2 << 2 * ((5 * k + 3 * i) % 16) for i in range(6)), sum((k >> b & 1) << 32 + 2 * b for b in range(5))) for k in range(28)), *EQUAL_SEEDS)


def filters() -> list[tuple[int, int, int, int]]:
    """``(kind, first band, bands, frames)`` of each filter, by rule: every kind at several places and sizes."""
    return [(k % 4, (5 * k) % (BANDS - (2 + k % 5 * 2) + 1), 2 + k % 5 * 2, 4 + 2 * (k % 7)) for k in range(FILTERS)]


def pitch_classes(rate: int = RATE, frame: int = FRAME) -> np.ndarray:
    """Which pitch class each spectrum bin belongs to, as a matrix of bins by classes."""
    hertz = np.fft.rfftfreq(frame, 1 / rate)
    out = np.zeros((len(hertz), BANDS))
    used = np.flatnonzero((hertz >= LOW_HZ) & (hertz <= HIGH_HZ))
    out[used, np.round(12 * np.log2(hertz[used] / 440.0)).astype(int) % BANDS] = 1
    return out


def fingerprint(pcm: bytes | None, rate: int = RATE) -> np.ndarray:
    """Packed 32-bit integers of 16-bit mono samples, one for each span of SPAN frames.

    Frames become 12 pitch-class energies of unit length. Each filter compares the
    sums of two areas of a span, read off an integral image; its log ratio, to four
    digits so that what leaks into empty areas doesn't count, is put into one of four
    steps, two Gray-coded bits. Null or shorter audio has none.
    """
    usable = len(pcm or b"") // 2 * 2
    samples = np.frombuffer((pcm or b"")[:usable], dtype="<i2").astype(np.float64)
    n = (len(samples) - FRAME) // HOP + 1
    if n < SPAN:
        return np.zeros(0, dtype=np.int64)
    frames = np.lib.stride_tricks.sliding_window_view(samples, FRAME)[::HOP] * np.hanning(FRAME)
    chroma = (np.abs(np.fft.rfft(frames, axis=1)) ** 2) @ pitch_classes(rate)
    chroma /= np.maximum(np.linalg.norm(chroma, axis=1, keepdims=True), 1e-9)
    image = np.zeros((n + 1, BANDS + 1))
    image[1:, 1:] = chroma.cumsum(axis=0).cumsum(axis=1)
    m = n - SPAN + 1

    def area(x: int, y: int, width: int, height: int) -> np.ndarray:
        return image[x + width : x + width + m, y + height] - image[x : x + m, y + height] - image[x + width : x + width + m, y] + image[x : x + m, y]

    out = np.zeros(m, dtype=np.int64)
    for k, (kind, y, height, width) in enumerate(filters()):
        h, w = height // 2, width // 2
        if kind == 0:
            a, b = area(0, y, width, h), area(0, y + h, width, height - h)
        elif kind == 1:
            a, b = area(0, y, w, height), area(w, y, width - w, height)
        elif kind == 2:
            a, b = area(0, y, w, h) + area(w, y + h, width - w, height - h), area(w, y, width - w, h) + area(0, y + h, w, height - h)
        else:
            a = area(width // 3, y, max(1, width // 3), height)
            b = area(0, y, width, height) - a
        out |= GRAY[np.searchsorted(EDGES, np.round(np.log((0.1 + a) / (0.1 + b)), 4))] << (2 * k)
    return out


def fingerprints(recordings: DataFrame, id_col: str = "id", media_col: str = "pcm", rate: int = RATE, decode: Callable[[Any], bytes | None] | None = None) -> DataFrame:
    """``(id, prints)``: the packed integers of each recording; null audio has an empty list.

    ``media_col`` holds 16-bit mono samples, or what ``decode`` turns into them. A
    recording is decoded, fingerprinted and let go of before the next, so a task
    never holds the samples of a batch.
    """
    schema = T.StructType([T.StructField("id", recordings.schema[id_col].dataType), T.StructField("prints", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            media = (x.as_py() for x in batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([fingerprint(decode(x) if decode else x, rate) for x in media], pa.list_(pa.int64()))], names=schema.names)

    return recordings.select(id_col, media_col).mapInArrow(run, schema)


def _mixed(keys: np.ndarray) -> np.ndarray:
    """64-bit keys with their bits mixed, one to one."""
    x = keys.view(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))).view(np.int64)


def seeds_of(prints: np.ndarray, kinds: tuple[tuple[int, ...], ...]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the seeds of every kind in a list of packed integers, and their places.

    Of a run of places with one key the first counts, and none in silence, so a held
    note or a pause doesn't vote for every offset.
    """
    keys, places = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for gap, further, first, second, third, tag in kinds:
        n = len(prints) - max(gap, further)
        if n > 0:
            key = (prints[:n] & first) | ((prints[gap : gap + n] & second) << 32) | ((prints[further : further + n] & third) >> 1) | tag
            at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]) & (prints[:n] != SILENT))
            keys.append(key[at])
            places.append(at)
    return _mixed(np.concatenate(keys)), np.concatenate(places)


def seeds(classes: DataFrame, kinds: tuple[tuple[int, ...], ...], wanted: np.ndarray | None = None) -> DataFrame:
    """``classes(class_id, prints)`` → ``(class_id, key, at)``: a row for every seed that the filter ``wanted`` may hold."""
    fields = [classes.schema["class_id"], *T.StructType.fromDDL("key long, at int").fields]
    shared = classes.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, AT_ONCE) for b in batches for at in range(0, b.num_rows, AT_ONCE)):
            found = [seeds_of(np.array(x.as_py(), dtype=np.int64), kinds) for x in batch.column(1)]
            rows = np.repeat(np.arange(len(found)), [len(k) for k, _ in found])
            keys, places = (np.concatenate([np.zeros(0, dtype=np.int64), *x]) for x in zip(*found, strict=True)) if found else (np.zeros(0, dtype=np.int64),) * 2
            if shared.value is not None:
                right = may_hold(shared.value, keys)
                rows, keys, places = rows[right], keys[right], places[right]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(keys), pa.array(places.astype("i4"))], names=[f.name for f in fields])

    return classes.select("class_id", "prints").mapInArrow(run, T.StructType(fields))


def alike(a: np.ndarray, b: np.ndarray, offset: int, least_votes: int = LEAST_VOTES, most_error: float = MOST_ERROR) -> tuple[int, float] | None:
    """``(frames, bit_error)`` of the longest passage at this offset whose bit error is at most ``most_error``; None if there is none that counts."""
    shorter = min(len(a), len(b))
    a, b = a[max(0, -offset) :], b[max(0, offset) :]
    n = min(len(a), len(b))
    if n < 1:
        return None
    wrong = np.bitwise_count(a[:n] ^ b[:n]).astype(np.int64)
    if n < min(shorter, LEAST_FRAMES) and np.count_nonzero((wrong[SEED_GAP:] == 0) & (wrong[:-SEED_GAP] == 0)) < least_votes:
        return None
    if (whole := float(wrong.sum()) / (32 * n)) <= most_error:
        return n, whole
    if n <= LEAST_PASSAGE:
        return None
    # A passage from i to j is good enough if the excess over the bound is no more at j than at i: the first such i of each j.
    excess = np.concatenate([[0.0], np.cumsum(wrong - 32 * most_error)])
    starts = np.searchsorted(np.maximum.accumulate(excess), excess)
    end = int(np.argmax(np.arange(n + 1) - starts))
    start = int(starts[end])
    return (end - start, float(wrong[start:end].sum()) / (32 * (end - start))) if end - start >= LEAST_PASSAGE else None


def align(recordings: DataFrame, is_query: Column, least_votes: int = LEAST_VOTES, most_error: float = MOST_ERROR, kinds: tuple[tuple[int, ...], ...] = EQUAL_SEEDS) -> DataFrame:
    """``recordings(id, prints)`` → ``(id, class_id, match_id, offset, frames, bit_error)``.

    Recordings of equal prints are one class, named by its smallest id, so copies
    aren't paired with each other: every recording has a row with its class. One
    that ``is_query`` has a row for each other class that it aligns with (none: one
    row of nulls there). Integers some gaps apart whose bits under a seed's masks
    are equal in both recordings vote for the offset between them: all bits of two
    with EQUAL_SEEDS; with TOLERANT_SEEDS, which noisy or shifted copies need, upper
    bits of most filters of three. Offsets that have ``least_votes`` or more, together
    with the better neighbour, are verified,
    most votes first, by the share of differing bits where the two overlap. An
    overlap of under LEAST_FRAMES that isn't a whole recording needs ``least_votes``
    of wholly equal seeds.

    Seeds that no query has, by a filter of fixed size, stay where they are made.
    Empty prints and null ids have no class and no match; repeated ids count once;
    an empty table gives an empty result.
    """
    rows = written(recordings.withColumns({"code": F.when(F.size("prints") > 0, F.xxhash64(F.col("prints"))), "asks": F.coalesce(is_query, F.lit(False))}), "prints")
    sized = rows.where("code is not null and id is not null")
    classes = written(sized.groupBy("code").agg(F.min("id").alias("class_id"), F.max("asks").alias("asks"), F.first("prints").alias("prints")), "classes")
    asking = written(seeds(classes.where("asks"), kinds).select(F.col("class_id").alias("query"), "key", F.col("at").alias("query_at")), "asking")
    votes = asking.join(seeds(classes, kinds, bloom(asking, "key")), "key").where("query != class_id").groupBy("query", "class_id", (F.col("at") - F.col("query_at")).alias("offset")).count()
    # half a hop apart, votes fall on two offsets: those count together
    pairs = votes.groupBy("query", "class_id").agg(F.sum("count").alias("all"), F.map_from_entries(F.collect_list(F.struct("offset", "count"))).alias("by")).where(F.col("all") >= least_votes)
    near = lambda o, d: F.coalesce(F.try_element_at("by", o + d), F.lit(0))
    enough = F.filter(F.map_keys("by"), lambda o: near(o, 0) + F.greatest(near(o, 1), near(o, -1)) >= least_votes)
    order = F.transform(enough, lambda o: F.struct((-near(o, 0)).alias("votes"), F.abs(o).alias("far"), o.alias("offset")))
    best = pairs.select("query", "class_id", F.transform(F.array_sort(order), lambda o: o["offset"]).alias("offsets")).where(F.size("offsets") > 0)
    left, right = classes.select(F.col("class_id").alias("query"), F.col("prints").alias("mine")), classes.select("class_id", F.col("prints").alias("other"))

    @F.pandas_udf("struct<offset:int,frames:int,bit_error:double>")
    def passage(mine: pd.Series, other: pd.Series, offsets: pd.Series) -> pd.DataFrame:
        def first(a: np.ndarray, b: np.ndarray, tried: np.ndarray) -> tuple[int | None, int | None, float | None]:
            for k in map(int, tried):
                if found := alike(a, b, k, least_votes, most_error):
                    return k, *found
            return None, None, None

        return pd.DataFrame([first(np.asarray(a), np.asarray(b), k) for a, b, k in zip(mine, other, offsets, strict=True)], columns=["offset", "frames", "bit_error"]).astype({"offset": "Int32", "frames": "Int32", "bit_error": "float64"})

    checked = best.join(left, "query").join(right, "class_id").select("query", "class_id", passage("mine", "other", "offsets").alias("e")).where("e.offset is not null")
    found = written(checked.select(F.col("query").alias("class_id"), F.col("class_id").alias("match_id"), F.col("e.offset").alias("offset"), F.col("e.frames").alias("frames"), F.col("e.bit_error").alias("bit_error")), "aligned")
    members = written(rows.select("id", "code", "asks").distinct().join(classes.select("code", "class_id"), "code", "left").select("id", "asks", "class_id"), "members")
    return members.join(found.withColumn("asks", F.lit(True)), ["class_id", "asks"], "left").select("id", "class_id", "match_id", "offset", "frames", "bit_error")


def tune(vector: list[float | None] | None, per_note: int = 256) -> bytes | None:
    """A vector played as a tune, a note for each of its numbers.

    It stands in for recordings where a table has none: equal vectors sound equal,
    close ones alike. A null vector is null; null numbers are rests.
    """
    if vector is None:
        return None
    values = np.array([np.nan if v is None else v for v in vector], dtype=np.float64)
    pitch = 220.0 * 2.0 ** (np.round(np.nan_to_num(values) * 32) % 36 / 12)
    wave = np.sin(2 * np.pi * pitch[:, None] * (np.arange(per_note) / RATE)) * np.where(np.isnan(values), 0, 12000)[:, None]
    return wave.astype("<i2").tobytes()


def op7_chroma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector of ``embeddings``, played as a tune: its class, and for ids divisible by 20 what aligns with it."""
    prints = fingerprints(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", decode=tune)
    return align(prints, F.col("id") % 20 == 0, kinds=TOLERANT_SEEDS).withColumnRenamed("id", "vec_id")
