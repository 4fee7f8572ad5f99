"""Near-duplicate groups by an LSH forest: neighbours in several sorted orders of MinHash signatures, confirmed on full sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import Scratch, bloom, may_hold, table, written
from spanloom.llm.components import connected_components
from spanloom.llm.simhash import _merged, _parted, _rooted, shingle_hashes

SEED = 13
#: Orders, and values of a signature that each sorts by; neighbours share the first LEAST_DEPTH at least.
#: Two sets alike by 0.85 share them in none of 16 orders in 7 of 1,000,000 cases.
TREES, DEPTH, LEAST_DEPTH = 16, 12, 4
VALUES = TREES * DEPTH
#: Neighbours that a set is compared with in a region of an order; larger regions go on with an exact join.
WINDOW = 64
#: Signatures agree in about as many values as the sets are alike: 0.15 below the similarity is nearly six standard deviations.
MARGIN = 0.15
_DRAW = np.random.default_rng(SEED)
FACTORS, SHIFTS = (_DRAW.integers(0, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
MIX = np.uint64(0x9E3779B97F4A7C15)
BLOCK = 1 << 11
PLACES = 1 << 18


def shingle_set(text: bytes | None, shingle: int) -> np.ndarray:
    """The distinct 64-bit hashes of a whole text's shingles, sorted; a text of fewer words is one shingle, one without words has none."""
    parts = list(shingle_hashes(text, shingle))
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, dtype=np.uint64)


def signature(hashes: np.ndarray) -> bytes:
    """16 bits of the least value of each of VALUES hash functions over a set, big-endian, one order's values after the other's."""
    least = np.full(VALUES, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), BLOCK):
        np.minimum(least, (hashes[None, at : at + BLOCK] * FACTORS[:, None] + SHIFTS[:, None]).min(axis=1), out=least)
    return ((least * MIX) >> np.uint64(48)).astype(">u2").tobytes()


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``(id, key, node, n, sig)`` of every row in one scan: ``node`` tells sets apart and is null for a text without words."""

    @F.pandas_udf("node binary, n long, sig binary")
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            hashes = shingle_set(text, shingle)
            rows.append((xxhash.xxh3_128_digest(hashes.tobytes(), SEED), len(hashes), signature(hashes)) if len(hashes) else (None, 0, None))
        return pd.DataFrame(rows, columns=["node", "n", "sig"])

    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), of(F.col(text_col).cast("binary")).alias("s")).select("id", "key", "s.*")


def _alike(similarity: float, size: int, sizes: np.ndarray, sig: np.ndarray, sigs: np.ndarray) -> np.ndarray:
    """In how many values signatures agree, where sizes and agreement allow the similarity; 0 elsewhere."""
    agree = (sigs == sig).sum(axis=1)
    possible = np.minimum(sizes, size) >= similarity * np.maximum(sizes, size) - 1e-9
    return np.where(possible & (agree >= (similarity - MARGIN) * VALUES), agree, 0)


def neighbours(similarity: float, best_only: bool):
    """A function over batches of rows sorted by (region, order): pairs of each row and those up to WINDOW before it in its region.

    ``best_only``: only the pair that agrees most, with its agreement, and rows that
    could only have a partner behind them with themselves (agreement 0). Otherwise
    all pairs whose groups differ.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        region, count = None, 0
        sigs, sizes = np.zeros((WINDOW, VALUES), dtype=np.uint16), np.zeros(WINDOW, dtype=np.int64)
        nodes, roots, told = [b""] * WINDOW, [b""] * WINDOW, [False] * WINDOW
        for batch in batches:
            out = []
            for key, node, n, sig, root in zip(*(batch[c] for c in ("region", "node", "n", "sig", "root")), strict=True):
                if key != region:
                    region, count = key, 0
                mine, held, alone = np.frombuffer(sig, dtype=">u2").astype(np.uint16), min(count, WINDOW), True
                if held:
                    agree = _alike(similarity, n, sizes[:held], mine, sigs[:held])
                    near = np.flatnonzero(agree)
                    if best_only and len(near):
                        k = int(agree.argmax())
                        out.append((node, nodes[k], int(agree[k])))
                        alone = False
                        for k in near.tolist():
                            if not told[k]:
                                told[k] = True
                                out.append((nodes[k], nodes[k], 0))
                    elif len(near):
                        out += [(node, nodes[k], int(agree[k])) for k in near.tolist() if roots[k] != root]
                at = count % WINDOW
                sigs[at], sizes[at], nodes[at], roots[at], told[at] = mine, n, node, root, not alone
                count += 1
            yield pd.DataFrame(out, columns=["a", "b", "agree"])

    return run


def _candidates(members: DataFrame, similarity: float, best_only: bool) -> DataFrame:
    """Pairs ``(a, b, agree)`` of neighbours in all orders.

    Small regions are compared whole; crowded ones are sorted to full depth over
    ranges of partitions, and only for the best of each: the exact join does the rest of them.
    """
    columns = ["region", "node", "n", "sig", "root"]
    small = members.where(F.col("size") <= WINDOW + 1).select(*columns).repartition("region").sortWithinPartitions("region", "node")
    order = F.substring("sig", F.col("tree") * (2 * DEPTH) + 1, F.lit(2 * DEPTH))
    crowded = members.where(F.col("size") > WINDOW + 1).withColumn("order", order).repartitionByRange("region", "order", "node").sortWithinPartitions("region", "order", "node").select(*columns)
    run, pair = neighbours(similarity, best_only), "a binary, b binary, agree long"
    found = small.mapInPandas(run, pair)
    return found.unionByName(crowded.mapInPandas(run, pair)) if best_only else found


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those ``pairs(a, b)`` with 100 · |A ∩ B| ≥ percent · |A ∪ B| on full sets."""
    one = pairs.join(sets.select(F.col("node").alias("b"), F.col("grams").alias("gb")), "b")
    two = one.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("ga")), "a")
    both = F.size(F.array_intersect("ga", "gb")).cast("long")
    return two.where((100 + percent) * both >= percent * (F.size("ga") + F.size("gb"))).select("a", "b")


def _frequencies(sets: DataFrame) -> np.ndarray:
    """How often shingles of each of PLACES remainders occur: what puts all shingles in one order, rare ones first."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(PLACES, dtype=np.int64)
        for batch in batches:
            for grams in batch["grams"]:
                total += np.bincount(grams & (PLACES - 1), minlength=PLACES)
        held = np.flatnonzero(total)
        yield pd.DataFrame({"place": held, "n": total[held]})

    sums = sets.select("grams").mapInPandas(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(PLACES, dtype=np.int64)
    out[sums.column("place").to_numpy()] = sums.column("n").to_numpy()
    return out


def _prefix_pairs(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs of ``members(node, n, root)`` of different groups that can reach the similarity, exactly, by prefixes of their rarest shingles.

    With all shingles in one order, rarest first, two sets alike by t share one of
    the first n - ⌈t·n⌉ + 1 of each, and no more can follow it than is left of
    either. Any order is right, so frequencies are those of a table of fixed size.
    Under each shingle the members of its largest group meet only those of others,
    so a group of any number of copies makes no pairs within itself.
    """
    rows = sets.join(members.select("node", "n", "root").distinct(), "node")
    often = _frequencies(rows)

    @F.pandas_udf("array<long>")
    def prefix(column: pd.Series) -> pd.Series:
        def one(grams: np.ndarray) -> np.ndarray:
            return grams[np.lexsort((grams, often[grams & (PLACES - 1)]))][: len(grams) - math.ceil(similarity * len(grams) - 1e-9) + 1]

        return column.map(one)

    placed = rows.select("node", "n", "root", prefix("grams").alias("first")).select("node", "n", "root", F.posexplode("first").alias("at", "gram"))
    groups = placed.groupBy("gram", "root").agg(F.count(F.lit(1)).alias("c")).groupBy("gram").agg(F.max_by("root", "c").alias("main"), F.count(F.lit(1)).alias("roots")).where("roots > 1")
    met = placed.join(groups.drop("roots"), "gram")
    few = met.where("root != main").select("gram", F.col("node").alias("a"), F.col("n").alias("m"), F.col("root").alias("r"), F.col("at").alias("i"))
    enough = F.least(F.col("m") - F.col("i"), F.col("n") - F.col("at")) * (1 + similarity) >= similarity * (F.col("m") + F.col("n")) - 1e-9
    sizes = F.least("m", "n") >= similarity * F.greatest("m", "n") - 1e-9
    pairs = met.join(few, "gram").where((F.col("r") != F.col("root")) & sizes & enough)
    return _ordered(pairs.select("a", F.col("node").alias("b")))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """``(id, n_shingles, component)``: one row per row of ``docs``.

    Rows are linked where their sets of ``shingle``-word shingles have ``percent``
    of their union in common; ``component`` is the smallest id that links reach.
    Equal sets are one node, so a group of any number of copies costs one. Each of
    TREES orders sorts the signatures; rows that share the first LEAST_DEPTH values
    there are a region. In a region of up to WINDOW + 1 all are compared. In a
    crowded one the order goes on to its full depth and each row is compared with
    the WINDOW before it, those with the longest common prefixes. First each row
    is linked with the neighbour that agrees most, which joins most copies at one
    pair a row; then neighbours of different groups are compared; crowded regions
    that still hold more than one group get an exact join. All links are confirmed
    on full sets.

    Rows without words (null, empty or blank texts) are linked with nothing and
    have their own id; null ids are passed over when the smallest is taken (a group
    of null ids only gets null); repeated ids stay repeated; an empty table gives
    an empty one; other columns of ``docs`` play no part.
    """
    similarity, keep = percent / 100, Scratch(docs.sparkSession)
    drawn = written(signatures(docs, id_col, text_col, shingle), "signatures")
    nodes = keep.put(drawn.where("node is not null").groupBy("node").agg(F.min("id").alias("least"), F.min(F.struct("id", "key")).alias("from"), F.first("n").alias("n"), F.first("sig").alias("sig")), "nodes")

    prefix = lambda t: F.xxhash64(F.lit(t), F.substring("sig", t * 2 * DEPTH + 1, 2 * LEAST_DEPTH))
    placed = nodes.select("node", F.posexplode(F.array(*[prefix(t) for t in range(TREES)])).alias("tree", "region"))
    shared = placed.groupBy("region").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    found = placed.join(shared, "region").join(nodes.select("node", "n", "sig"), "node")
    members = keep.put(found.withColumn("root", F.col("node")), "members")

    best = keep.put(_candidates(members, similarity, best_only=True).groupBy("a").agg(F.max_by("b", F.struct("agree", "b")).alias("b"), F.max("agree").alias("agree")), "best")
    crowded = members.where(F.col("size") > WINDOW + 1)
    wanted = keep.put(nodes.select("node", "from").join(best.select(F.col("a").alias("node")).unionByName(crowded.select("node")).distinct(), "node"), "wanted")
    sets = keep.put(_sets(docs, wanted, id_col, text_col, shingle), "sets")
    links = keep.put(_confirmed(_ordered(best.where("agree > 0")), sets, percent), "links")
    roots = keep.put(connected_components(links), "roots")

    for exact in (False, True):
        members = keep.put(_parted(_rooted(members.withColumnRenamed("region", "key"), roots)).withColumnRenamed("key", "region"), "members")
        left = members.where(F.col("size") > WINDOW + 1)
        if (left if exact else members).isEmpty():
            continue
        pairs = keep.put(_prefix_pairs(left, sets, similarity) if exact else _ordered(_candidates(members, similarity, best_only=False)), "pairs")
        more = keep.put(_confirmed(pairs, sets, percent), "links")
        if not more.isEmpty():
            roots = keep.put(_merged(roots, more), "roots")

    rooted = keep.put(nodes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root")), "rooted")
    least = keep.put(rooted.groupBy("root").agg(F.min("least").alias("component")), "least")
    named = written(rooted.join(least, "root").select("node", "component"), "named")
    keep.drop(*list(keep.paths))
    return drawn.select("id", "node", F.col("n").alias("n_shingles")).join(named, "node", "left").select("id", "n_shingles", F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component")).alias("component"))


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``(node, grams)``: the whole sets of the nodes that may have a partner, made again from one text each.

    Other texts stay where they are read, by a filter of fixed size.
    """

    @F.pandas_udf("array<long>")
    def grams(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(t, shingle).view(np.int64) for t in texts], dtype=object)

    filter_ = docs.sparkSession.sparkContext.broadcast(bloom(wanted.select(F.col("from.key").alias("key")), "key"))

    @F.pandas_udf("boolean")
    def likely(keys: pd.Series) -> pd.Series:
        return pd.Series(may_hold(filter_.value, keys.to_numpy(dtype=np.int64)))

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("key", F.xxhash64("text")).where(likely("key"))
    named = wanted.select("node", F.col("from.id").alias("of"), F.col("from.key").alias("key"))
    texts = rows.join(named, "key").where(F.col("id").eqNullSafe(F.col("of"))).select("node", F.col("text").cast("binary").alias("text")).dropDuplicates(["node"])
    return texts.select("node", grams("text").alias("grams"))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of five-word shingles are alike by 0.85."""
    found = near_duplicates(table(spark, sf_dir, "documents"), percent=85)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"))


#: The same in DuckDB by a plain join on shingles.
ORACLE_OP13 = r"""with recursive words as materialized (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
shingles as materialized (select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) end) as g from words),
sizes as materialized (select doc_id, count(*) as n from shingles group by doc_id),
meets as (select a.doc_id as x, b.doc_id as y, count(*) as c from shingles a join shingles b on a.g = b.g and a.doc_id < b.doc_id group by all),
links as materialized (select x, y from meets join sizes s on s.doc_id = x join sizes t on t.doc_id = y where 100 * c >= 85 * (s.n + t.n - c)),
edges as materialized (select x, y from links union all select y, x from links),
reach as (select doc_id as x, doc_id as y from documents union select reach.x, edges.y from reach join edges on edges.x = reach.y)
select d.doc_id, cast(coalesce(n, 0) as bigint) as n_shingles, component_id, d.doc_id = component_id as kept from documents d left join sizes using (doc_id) join (select x as doc_id, min(y) as component_id from reach group by x) using (doc_id)"""
