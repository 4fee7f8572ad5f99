"""Near-duplicate groups by SimHash and meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.llm.common import Scratch, table, written
from spanloom.llm.components import connected_components

SEED = 42
BITS = 64
BLOCK = 1 << 14
#: Bands and least hashes a band: two texts of one size at a cosine of 0.8 (a Jaccard similarity of 2/3) share a band in 995 of 1,000 cases.
BANDS, ROWS = 24, 4
_DRAW = np.random.default_rng(SEED)
FACTORS = _DRAW.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _DRAW.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingle_hashes(text: bytes | None, shingle: int) -> Iterator[np.ndarray]:
    """Hashes of all shingles of a text, block by block; nothing where there is no word."""
    words = (text or b"").lower().split()
    n, digest = max(1, len(words) - shingle + 1), xxhash.xxh64_intdigest
    for at in range(0, n if words else 0, BLOCK):
        part = words[at : min(at + BLOCK, n) + shingle - 1]
        joined = map(b" ".join, zip(*(part[k:] for k in range(shingle)), strict=False)) if len(words) >= shingle else [b" ".join(words)]
        yield np.array([digest(x, SEED) for x in joined], dtype="<u8")


def ones_to_bits(ones: np.ndarray, n: int) -> int:
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def count_ones(hashes: np.ndarray) -> np.ndarray:
    return np.add.reduce(np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"), axis=0, dtype=np.int64)


def simhash(text: bytes | None, shingle: int = 3) -> int:
    """The 64-bit fingerprint of a UTF-8 text, as a signed integer.

    A-Z are lower-cased, words are runs of anything but ASCII white space, and
    every shingle counts as often as it occurs. Shorter texts are one shingle;
    a text without a word (or a null) has the fingerprint 0.
    """
    ones, n = np.zeros(BITS, dtype=np.int64), 0
    for hashes in shingle_hashes(text, shingle):
        ones += count_ones(hashes)
        n += len(hashes)
    return ones_to_bits(ones, n)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(id, fp)`` for every row of ``docs``; whole texts, one scan, no shuffle."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle) for t in texts], dtype="int64")

    return docs.select(F.col(id_col).alias("id"), of(F.col(text_col).cast("binary")).alias("fp"))


def ball_links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fp`` at ``radius`` or fewer differing bits.

    Every fingerprint emits all variants within half the radius, so two that are
    within an even radius meet at a variant halfway. Distinct fingerprints that
    meet at one variant lie in a ball of half the radius around it: for radius 2
    no more than 65 meet, and all of them link to each other. Each links to its
    neighbour in sorted order there, which keeps every component whole without
    all pairs of the ball. Pairs are verified by their differing bits.
    """
    if radius != 2:
        raise ValueError("variants are emitted within one bit: the radius is 2")
    variants = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(1 << k if k < 63 else -(1 << 63)).cast("long")) for k in range(BITS)])
    meets = fps.select("fp", F.explode(variants).alias("variant"))
    ahead = F.lag("fp").over(Window.partitionBy("variant").orderBy("fp"))
    pairs = meets.select(F.col("fp").alias("a"), ahead.alias("b")).where("b is not null").distinct()
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """``(id, fp, component)``: one row per row of ``docs``.

    ``component`` is the smallest id of the rows that links reach. Rows without a
    word share the fingerprint 0 and link like any other. Equal fingerprints are
    one node, so a group of any number of copies costs one node. Null ids are
    passed over when the smallest is taken (a group of null ids only gets null);
    repeated ids stay repeated; an empty table gives an empty one; other columns
    of ``docs`` play no part.
    """
    fps = written(fingerprints(docs, id_col, text_col, shingle), "simhash")
    nodes = written(fps.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    roots = connected_components(ball_links(nodes.select("fp"), radius))
    rooted = written(nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "rooted")
    least = written(rooted.groupBy("root").agg(F.min("least").alias("component")), "least")
    named = written(rooted.join(least, "root").select("fp", "component"), "named")
    return fps.join(named, "fp").select("id", "fp", "component")


def sketch(text: bytes | None, shingle: int = 5) -> tuple[bytes, int, list[int], np.ndarray | list[int]]:
    """The set of a text's shingles as a 128-bit hash, its fingerprint, the keys of its bands
    and the set of its shingles as 32-bit hashes.

    A band key hashes the least values of ``ROWS`` hash functions over all
    shingles of the whole text. A text without a word has no bands.
    """
    parts = list(shingle_hashes(text, shingle))
    if not parts:
        return b"", 0, [], []
    hashes = np.concatenate(parts)
    ones = sum(count_ones(p) for p in parts)
    distinct, least = np.unique(hashes), np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(distinct), BLOCK // 8):
        block = distinct[None, at : at + BLOCK // 8] * FACTORS[:, None] + SHIFTS[:, None]
        np.minimum(least, block.min(axis=1), out=least)
    bands = [xxhash.xxh64_intdigest(row.tobytes(), k) for k, row in enumerate(least.reshape(BANDS, ROWS))]
    keys = np.array(bands, dtype="<u8").view("<i8").tolist()
    return xxhash.xxh3_128_digest(distinct.tobytes(), SEED), ones_to_bits(ones, len(hashes)), keys, np.unique(hashes.astype("<u4")).view("<i4")


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5) -> DataFrame:
    """``(id, node, fp, bands, grams)`` for every row of ``docs``: one scan, no shuffle."""

    @F.pandas_udf("node binary, fp long, bands array<long>, grams array<int>")
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([sketch(t, shingle) for t in texts], columns=["node", "fp", "bands", "grams"])

    return docs.select(F.col(id_col).alias("id"), of(F.col(text_col).cast("binary")).alias("s")).select("id", "s.*")


def _verified(pairs: DataFrame, grams: DataFrame, similarity: float) -> DataFrame:
    """Those ``pairs(a, b)`` whose shingle sets have a cosine similarity of at least ``similarity``."""
    one = pairs.join(grams.select(F.col("node").alias("b"), F.col("grams").alias("gb")), "b")
    two = one.join(grams.select(F.col("node").alias("a"), F.col("grams").alias("ga")), "a")
    return two.where(F.size(F.array_intersect("ga", "gb")) >= similarity * F.sqrt(F.size("ga") * F.size("gb").cast("double")) - 1e-9).select("a", "b")


def _led(members: DataFrame, leaders: DataFrame, similarity: float) -> DataFrame:
    """Each member of a bucket with its leader ``(key, a, m, r)``, where sizes allow the similarity and groups differ."""
    alike = F.least("m", "n") >= similarity**2 * F.greatest("m", "n") - 1e-9
    return members.join(leaders, "key").where(F.col("root") != F.col("r")).where(alike).select("a", F.col("node").alias("b")).distinct()


def _leaders(members: DataFrame) -> DataFrame:
    """Of each bucket, the member that shares most buckets with others: among copies of one text mostly that text."""
    first = members.groupBy("key").agg(F.max_by(F.struct("node", "n", "root"), F.struct("weight", "node")).alias("l"))
    return first.select("key", F.col("l.node").alias("a"), F.col("l.n").alias("m"), F.col("l.root").alias("r"))


def _rooted(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``members`` with the group each is in by now: its own node where nothing links it."""
    return members.drop("root").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _parted(members: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one group."""
    keys = members.groupBy("key").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r != s").select("key")
    return members.join(keys, "key", "left_semi")


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots(node, root)`` after more ``links``: only links between groups are searched for components."""
    left, right = roots.toDF("a", "ra"), roots.toDF("b", "rb")
    between = links.join(left, "a", "left").join(right, "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    moved = connected_components(between).toDF("root", "to")
    known = roots.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return known.unionByName(moved.join(roots.select(F.col("node").alias("root")), "root", "left_anti").select(F.col("root").alias("node"), F.col("to").alias("root")))


def _prefix_pairs(members: DataFrame, grams: DataFrame, similarity: float) -> DataFrame:
    """Pairs of different groups in a bucket that can reach the similarity, by prefixes of their rarest shingles.

    With the shingles of all texts in one order, rarest first, two texts whose
    cosine is at least t share one of the first (1 - t)·n + 1 of the smaller and
    the first (1 - t²)·n + 1 of the larger, and no more than the rest of either can
    follow the first that they share. So a passage that many unlike texts hold
    makes no pairs: their own shingles come before it.
    """
    nodes = members.select("node").distinct()
    tokens = grams.join(nodes, "node", "left_semi").select("node", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    common = tokens.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    listed = tokens.join(common, "gram").groupBy("node").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("ordered"))
    reach = F.col("n") - F.ceil(similarity**2 * F.col("n") - 1e-9) + 1 - F.col("n") + F.size("ordered")
    kept = listed.where(reach >= 1).select("node", "n", F.size("ordered").alias("shared"), F.posexplode(F.slice("ordered", F.lit(1), F.least(reach, F.size("ordered")).cast("int"))).alias("k", "token"))
    placed = kept.select("node", F.col("token.gram").alias("gram"), (F.col("n") - F.col("shared") + F.col("k") + 1).alias("at"))
    rows = members.select("key", "node", "n", "root").join(placed, "node")
    first = rows.where(F.col("at") <= F.col("n") - F.ceil(similarity * F.col("n") - 1e-9) + 1)
    first = first.select("key", "gram", F.col("node").alias("a"), F.col("n").alias("m"), F.col("root").alias("r"), F.col("at").alias("i"))
    ordered = (F.col("r") != F.col("root")) & (F.struct("m", "a") < F.struct("n", "node")) & (F.col("m") >= similarity**2 * F.col("n") - 1e-9)
    enough = 1 + F.least(F.col("m") - F.col("i"), F.col("n") - F.col("at")) >= similarity * F.sqrt(F.col("m") * F.col("n").cast("double")) - 1e-9
    return rows.join(first, ["key", "gram"]).where(ordered & enough).select("a", F.col("node").alias("b")).distinct()


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, radius: int = 2) -> DataFrame:
    """``(id, fp, component)``: groups of rows that are near copies of each other.

    The similarity is the one that fingerprints estimate: the cosine of the sets of
    shingles, their common part over the root of the product of their sizes. Balls
    of ``radius`` bits link what changed very little, as in :func:`near_duplicates`.
    Copies with more edits differ in 4 to 15 bits, which no ball of workable size
    spans, so texts that share a band of least hashes are compared too, by their
    shingle sets. Twice each member of a bucket is compared with a leader of it,
    which joins the copies of one text at a pair or two a member. Buckets that are
    one group then are done; in the others, pairs of different groups are found by
    prefixes of their rarest shingles, exactly, and all are compared.

    Every row appears once; null ids are passed over when the smallest is taken;
    rows without a word share the fingerprint 0 and are one group; repeated ids
    stay repeated; an empty table gives an empty one; other columns play no part.
    """
    keep = Scratch(docs.sparkSession)
    drawn = written(sketches(docs, id_col, text_col, shingle), "sketches")
    nodes = keep.put(drawn.groupBy("node", "fp").agg(F.min("id").alias("least")), "nodes")
    heads = keep.put(nodes.groupBy("fp").agg(F.min("node").alias("head")), "heads")
    balls = ball_links(heads.select("fp"), radius).join(heads.toDF("a", "na"), "a").join(heads.toDF("b", "nb"), "b").select(F.col("na").alias("a"), F.col("nb").alias("b"))
    links = keep.put(nodes.join(heads, "fp").where("node != head").select(F.col("node").alias("a"), F.col("head").alias("b")).unionByName(balls), "balls")
    roots = heads.select(F.col("head").alias("node"), F.col("head").alias("root")).limit(0)

    rows = keep.put(drawn.select("node", F.size("grams").alias("n"), F.explode("bands").alias("key")).distinct(), "bands")
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    rows = keep.put(rows.join(shared, "key"), "bands")
    members = keep.put(_parted(_rooted(rows.join(rows.groupBy("node").agg(F.sum("size").alias("weight")), "node"), roots)), "members")
    keep.drop("bands")
    chosen = members.select("node").distinct().join(nodes.groupBy("node").agg(F.min("least").alias("id")), "node")
    sets = drawn.select("node", "id", "grams").join(chosen, (drawn["node"] == chosen["node"]) & drawn["id"].eqNullSafe(chosen["id"]), "left_semi")
    grams = keep.put(sets.dropDuplicates(["node"]).select("node", "grams"), "grams")

    for others in (False, True):
        led = members.join(_leaders(members).select("key", "r"), "key").where("root != r").drop("r") if others else members
        close = _verified(_led(members, _leaders(led), similarity), grams, similarity)
        roots = keep.put(_merged(roots, close if others else close.unionByName(links)), "roots")
        members = keep.put(_parted(_rooted(members, roots)), "members")
    pairs = keep.put(_prefix_pairs(members, grams, similarity), "pairs")
    roots = keep.put(_merged(roots, _verified(pairs, grams, similarity)), "roots")

    rooted = keep.put(nodes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root")), "rooted")
    least = keep.put(rooted.groupBy("root").agg(F.min("least").alias("component")), "least")
    named = written(rooted.select("node", "root").distinct().join(least, "root").select("node", "component"), "named")
    keep.drop(*list(keep.paths))
    return drawn.select("id", "node", "fp").join(named, "node").select("id", "fp", "component")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
