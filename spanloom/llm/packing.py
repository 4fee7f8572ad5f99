"""Best-fit packing of tokenised documents by exact-complement hashing."""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.llm.common import table, written

CAPACITY, END_ID, SALTS = 1024, 2, 256

#: How the byte-level BPE of the tokenizer files splits a text, and texts that show whether an engine follows it.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PROBES = ("", "It's  odd\t\n x_y 12\u00b3 \u00bd ", "na\u00efve \u201cquotes\u201d \U0001f642 \u00e9", "don't<|endoftext|>stop", "THE QUICK brown_fox, 3.14159!!", "\x00\x7f\u0085\u00a0\u3000\u4f60\u597d", " \n \n\n  a")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of() -> dict[str, int]:
    """The character that a byte-level vocabulary writes for each byte: itself if printable, else the next one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Encoder:
    """A text's ids as little-endian bytes, the same as those of the ``tokenizers`` file at ``path``.

    A vocabulary whose ids are its merge ranks runs in the engine that keeps ranks,
    several times faster. Texts that hold the string of an added token, whose id the
    library gives there, go to the library itself, as all do if ids differ on the
    probes or the file is of another kind.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.engine, self.added = None, ()
        try:
            import tiktoken

            model = json.loads(Path(path).read_text(encoding="utf-8"))
            special = {t["content"] for t in model.get("added_tokens", ())}
            self.added = tuple(special)
            byte = _byte_of()
            ranks = {bytes(byte[c] for c in token): rank for token, rank in model["model"]["vocab"].items() if token not in special}
            self.engine = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        except (ImportError, KeyError, ValueError, TypeError):
            pass
        if self.engine and any(self.ids(t) != self.library_ids(t) for t in PROBES):
            self.engine = None

    def library_ids(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def ids(self, text: str) -> bytes:
        if self.engine is not None and not any(t in text for t in self.added):
            try:
                return self.engine.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
            except ValueError:  # its splitter gives up on very long runs of white space
                pass
        return self.library_ids(text)


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder a worker process."""
    return Encoder(path)


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """``(id, piece, start, length, ids_crc32[, ids])``: every document's ids and ``end_id``, cut at ``capacity``.

    Only longer documents are cut; all their pieces are full but the first. A null
    or empty text is the end id alone; repeated rows give repeated pieces; a long
    text is encoded whole, in memory in proportion to it. ``tokenizer`` is the path
    of a byte-level BPE file, the same on all executors; ids are those that the
    library gives with ``add_special_tokens=False``.
    """
    path = tokenizer or default_tokenizer()
    if not Path(path).exists():
        raise ValueError(f"no tokenizer at {path}")
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", id_type), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    if keep_ids:
        schema = schema.add("ids", T.ArrayType(T.LongType()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path).ids, np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            rows, columns = [], ([], [], [], [], [])
            for row, text in enumerate(batch.column(1).to_pylist()):
                data = encode(text or "") + end
                n = len(data) // 4
                start, stop = 0, (n - 1) % capacity + 1
                piece = 0
                while start < n:
                    part = data[4 * start : 4 * stop]
                    rows.append(row)
                    for column, x in zip(columns, (piece, start, stop - start, zlib.crc32(part), np.frombuffer(part, dtype="<u4").astype("i8") if keep_ids else None), strict=True):
                        column.append(x)
                    piece, start, stop = piece + 1, stop, stop + capacity
            out = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(columns[0], pa.int32()), *[pa.array(c, pa.int64()) for c in columns[1:4]]]
            yield pa.RecordBatch.from_arrays([*out, pa.array(columns[4], pa.list_(pa.int64()))] if keep_ids else out, names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(cut, schema)


class Sums:
    """Which sums one, two or three available lengths make, for gaps up to ``capacity``.

    Pairs of lengths are kept under their sum, so a look-up costs those of one sum;
    a triple is a length and the sum of a pair. ``one``, ``two`` and ``three`` say
    which sums can be made at all with the lengths that are left.
    """

    def __init__(self, histogram: dict[int, int], capacity: int) -> None:
        self.capacity, self.counts = capacity, np.zeros(capacity + 1, dtype=np.int64)
        for length, n in histogram.items():
            self.counts[length] += n
        lengths = np.flatnonzero(self.counts)
        a, b = (x.ravel() for x in np.meshgrid(lengths, lengths, indexing="ij"))
        fits = (a >= b) & (a + b <= capacity)
        a, b = a[fits], b[fits]
        order = np.lexsort((-a, a + b))
        self.longer, self.shorter = a[order], b[order]
        self.start = np.searchsorted(self.longer + self.shorter, np.arange(capacity + 2))
        self.refresh()

    def refresh(self) -> None:
        self.one = self.counts > 0
        self.two = np.convolve(self.one.astype("i4"), self.one.astype("i4"))[: self.capacity + 1] > 0
        self.three = np.convolve(self.one.astype("i4"), self.two.astype("i4"))[: self.capacity + 1] > 0

    def pair(self, total: int) -> tuple[int, ...] | None:
        a, b = (x[self.start[total] : self.start[total + 1]] for x in (self.longer, self.shorter))
        there = np.flatnonzero((self.counts[a] > 0) & (self.counts[b] > 0) & ((a != b) | (self.counts[a] > 1)))
        return (int(a[there[0]]), int(b[there[0]])) if len(there) else None

    def exact(self, total: int) -> tuple[int, ...] | None:
        """One, two or three available lengths that sum to ``total``: fewest first, then the longest."""
        if self.one[total] and self.counts[total]:
            return (total,)
        if self.two[total] and (found := self.pair(total)):
            return found
        if not self.three[total]:
            return None
        firsts = np.arange(total - 2, (total + 2) // 3 - 1, -1)
        for a in firsts[(self.counts[firsts] > 0) & self.two[total - firsts]].tolist():
            self.counts[a] -= 1
            found = self.pair(total - a)
            self.counts[a] += 1
            if found:
                return (a, *found)
        return None

    def nearest(self, gap: int) -> tuple[int, ...] | None:
        """The lengths that fill a gap exactly, or else leave the least of it."""
        for total in (np.flatnonzero((self.one | self.two | self.three)[1 : gap + 1]) + 1)[::-1].tolist():
            if found := self.exact(total):
                return found
        return None


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Lengths and their counts → ``(lengths in a sequence, number of such sequences)``.

    From the longest length down, the gap it leaves is filled exactly by a single
    length, a pair or a triple, or else by what leaves the least of it, again and
    again until nothing fits; the sequence is made as many times at once as the
    counts allow, so a length runs out with each. The work depends on the capacity,
    not on the number of documents.
    """
    sums = Sums(histogram, capacity)
    counts, done = sums.counts, []
    for length in range(capacity, 0, -1):
        while counts[length]:
            parts, gap = (length,), capacity - length
            counts[length] -= 1
            while gap and (found := sums.nearest(gap)):
                parts, gap = (*parts, *found), gap - sum(found)
                for x in found:
                    counts[x] -= 1
            for x in parts:
                counts[x] += 1
            times = min(int(counts[x]) // parts.count(x) for x in set(parts))
            for x in parts:
                counts[x] -= times
            sums.refresh()
            done.append((parts, times))
    return done


def pack(parts: DataFrame, capacity: int = CAPACITY, salts: int = SALTS) -> DataFrame:
    """``parts`` (columns ``id``, ``piece``, ``length`` at least) with ``sequence_id`` and ``offset``.

    Only the counts by length reach the driver. A piece finds its place by its
    rank among the pieces of its length; ranks come from counts by length and salt,
    so that a length which a third of all pieces share is numbered by many tasks.
    The table of places, which is broadcast, is bounded by the capacity: a plan has
    at most a few sequences for each length, whatever the number of documents. An empty table gives an empty one; repeated ids are packed as they come.
    """
    spark = parts.sparkSession
    if bad := parts.where((F.col("length") > capacity) | (F.col("length") < 1)).limit(1).count():
        raise ValueError(f"{bad} piece does not fit")
    salted = parts.withColumn("_salt", F.pmod(F.xxhash64("id", "piece"), F.lit(salts)).cast("int"))
    counted = written(salted.groupBy("length", "_salt").count(), "lengths")
    histogram = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    places, taken, sequence = [], dict.fromkeys(histogram, 0), 0
    for lengths, n in plan(histogram, capacity):
        offset = 0
        for length in lengths:
            places.append((length, taken[length], taken[length] + n, sequence, offset))
            taken[length] += n
            offset += length
        sequence += n
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counted.select("length", "_salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_first"))
    rank = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("id", "piece")) - 1
    ranked = salted.withColumn("_rank", rank).join(firsts, ["length", "_salt"]).withColumn("_rank", F.col("_first") + F.col("_rank"))
    slots = spark.createDataFrame(places, "length long, _from long, _to long, _sequence long, offset long")
    inside = (ranked["length"] == slots["length"]) & (ranked["_rank"] >= slots["_from"]) & (ranked["_rank"] < slots["_to"])
    return ranked.join(F.broadcast(slots), inside).select(*[ranked[c] for c in parts.columns], (F.col("_sequence") + F.col("_rank") - F.col("_from")).alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Tokenise once, keep the pieces in the shared folder, and place them."""
    return pack(written(pieces(docs, tokenizer, keep_ids=keep_ids), "pieces"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``, cut and packed into sequences of up to 1024 ids."""
    packed = pack_documents(table(spark, sf_dir, "documents"))
    return packed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
