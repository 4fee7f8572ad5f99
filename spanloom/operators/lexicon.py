"""Dictionary lookups: whole words, several words, and suffixes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.functions.arrows import Words, in_stretches, row_ends
from spanloom.functions.text import tokens as tokens_of
from spanloom.operators.automaton import MOST_BYTES, MOST_TOKENS, Automaton, found_in_rows, phrase_bytes, phrase_tokens
from spanloom.operators.intervals import without_overlap

#: Lexica up to this size are sent to all executors; larger ones meet the tokens in a shuffled join.
BROADCAST_ROWS = 2_000_000


def _side(lexicon: DataFrame) -> DataFrame:
    """The lexicon, broadcast behind a check of its size."""
    return F.broadcast(lexicon) if lexicon.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else lexicon


def read_lexicon(df: DataFrame) -> DataFrame:
    """Lines ``term<TAB>feature=value…`` with their list's labels → ``(term, major, minor, language, n_tokens)``.

    A byte-order mark, comments and empty lines go; entries count once.
    """
    term = F.trim(F.regexp_replace(F.split("term", "\t")[0], "^﻿", ""))
    return df.select(term.alias("term"), "major", "minor", "language").where("term != '' and not startswith(term, '#')").distinct().withColumn("n_tokens", F.size(phrase_tokens("term")))


def read_lists(spark: SparkSession, folder: str, index: str = "lists.def") -> DataFrame:
    """The lexicon of a folder: its index names a list a line as ``file:major:minor:language``, the last two or the last one may be missing.

    Lists are read together, as one table of lines, and meet the index by their
    path. The index is short and goes to the driver; a list that isn't there raises.
    """
    lines = [r["value"].strip() for r in spark.read.text(f"{folder}/{index}").collect()]
    named = [([*line.split(":"), "", "", ""])[:4] for line in lines if line and not line.startswith("#")]
    labels = spark.createDataFrame([(f"/{f.strip().lstrip('/')}", m, n, lang) for f, m, n, lang in named], "file string, major string, minor string, language string")
    text = spark.read.text([f"{folder}/{f.strip()}" for f in dict.fromkeys(row[0] for row in named)]) if named else spark.createDataFrame([], "value string")
    path = F.replace(F.input_file_name(), F.lit("%20"), F.lit(" "))
    lists = text.select(F.col("value").alias("term"), path.alias("path"))
    return read_lexicon(lists.join(F.broadcast(labels), F.endswith("path", "file")).select("term", "major", "minor", "language"))


#: Lists and their share of the words, in 256ths: stand-ins for lists that a site keeps to itself.
STAND_INS = (
    ("name", "firstname", "frequent", 12), ("name", "firstname", "", 60), ("name", "surname", "frequent", 20), ("name", "surname", "german", 70), ("location", "city", "", 30), ("location", "city_ambiguous", "", 8), ("location", "street", "", 24),
    ("location", "country", "german", 4), ("location", "false_positives", "", 6), ("name", "false_positives", "", 6), ("occupation", "occupation", "", 25), ("medical", "medical", "", 80), ("general", "general", "", 140), ("stop", "stop", "german", 5),
)


def stand_ins(words: DataFrame, lists: tuple[tuple[str, str, str, int], ...] = STAND_INS, seed: int = 0) -> DataFrame:
    """A lexicon out of ``words(term)``: each word is dealt to each list by a hash, so that lists have their shares and overlap.

    The same words and seed give the same lists, on any number of machines. So
    lookups run at the size of real lists, with words in several of them, ambiguous
    cities and false positives.
    """
    table = words.sparkSession.createDataFrame([(k, *row) for k, row in enumerate(lists)], "nr int, major string, minor string, language string, share int")
    drawn = F.conv(F.substring(F.md5(F.concat("term", F.lit(f":{seed}:"), F.col("nr").cast("string"))), 1, 2), 16, 10).cast("int")
    return words.select("term").where("term != ''").distinct().join(F.broadcast(table), drawn < F.col("share")).select("term", "major", "minor", "language", F.size(phrase_tokens("term")).alias("n_tokens"))


class Lists:
    """Entries with their lists, ready to be looked for in tokens; of a list's entries at a place the longest counts."""

    COLUMNS = ("term", "major", "minor", "language")

    def __init__(self, entries: pa.Table) -> None:
        """``entries(term, major, minor, language, words)``, in any order."""
        order = pc.sort_indices(entries, sort_keys=[(name, "ascending") for name in ("term", "language", "major", "minor")], null_placement="at_start")
        entries = entries.take(order).combine_chunks()
        self.payload = {name: entries[name].combine_chunks() for name in self.COLUMNS}
        codes = [pc.dictionary_encode(entries[name].combine_chunks(), null_encoding="encode") for name in ("major", "minor")]
        major, minor = (c.indices.to_numpy(zero_copy_only=False).astype(np.int64) for c in codes)
        self.of_list = major * max(len(codes[1].dictionary), 1) + minor
        # entries of several tokens, and those that they begin with, go by the trie; what all other tokens give is known beforehand
        phrases = entries["words"].combine_chunks()
        begin, behind = row_ends(phrases)
        tokens, length = phrases.flatten(), behind - begin
        first = tokens.take(pa.array(np.where(length > 0, begin, 0), mask=length == 0))
        begins = pc.is_in(first, value_set=pc.unique(first.filter(pa.array(length > 1)))).to_numpy(zero_copy_only=False)
        self.by_trie = np.flatnonzero((length > 0) & begins)
        self.automaton = Automaton.of(phrases.take(pa.array(self.by_trie)).to_pylist())
        alone = np.flatnonzero((length == 1) & ~begins)
        encoded = pc.dictionary_encode(first.take(pa.array(alone)))
        known, made = self.automaton.numbers, encoded.dictionary.to_pylist()
        new = [token for token in made if token not in known]
        self.automaton = replace(self.automaton, vocabulary=self.automaton.vocabulary + new)
        number = np.array([self.automaton.numbers[token] for token in made], dtype=np.int64)[encoded.indices.to_numpy(zero_copy_only=False)] if len(alone) else np.empty(0, np.int64)
        # a list's first entry of a token counts; np.unique gives the first place of each pair
        once = np.sort(np.unique(np.stack([number, self.of_list[alone]]), axis=1, return_index=True)[1]) if len(alone) else np.empty(0, np.int64)
        once = once[np.argsort(number[once], kind="stable")]
        self.flat = alone[once]
        self.sizes = np.bincount(number[once], minlength=len(self.automaton.vocabulary) + 1)
        self.firsts = np.cumsum(self.sizes) - self.sizes
        self.walked = np.zeros(len(self.sizes), dtype=bool)
        self.walked[[token for node, token in self.automaton.edges if node == 0]] = True

    def find(self, words: Words) -> tuple[np.ndarray, dict[str, pa.Array]]:
        """The row of each hit, in order, and its place and entry."""
        numbers = self.automaton.numbered(words.values)
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for at, behind, nth in self.automaton.hits(words, numbers, self.walked):
            entry = self.by_trie[nth]
            held = best.get((at, self.of_list[entry]))
            if held is None or behind > held[0]:
                best[at, self.of_list[entry]] = (behind, entry)
        sizes = self.sizes[numbers]
        alone = np.repeat(np.arange(len(numbers)), sizes)
        nth = np.arange(len(alone)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = np.concatenate([alone, np.array([a for a, _ in best], dtype=np.int64)])
        last = np.concatenate([alone, np.array([behind for behind, _ in best.values()], dtype=np.int64) - 1])
        entry = np.concatenate([self.flat[self.firsts[numbers[alone]] + nth], np.array([e for _, e in best.values()], dtype=np.int64)])
        order = np.argsort(at, kind="stable")
        at, last, chosen = at[order], last[order], pa.array(entry[order])
        places = {"start": pa.array(words.start[at], pa.int32()), "end": pa.array(words.end[last], pa.int32())}
        return words.row[at], places | {name: column.take(chosen) for name, column in self.payload.items()}


#: Bytes of text that share a part of a large lexicon.
TOGETHER = 32 << 20


def text_lookups(docs: DataFrame, lexicon: DataFrame, text_col: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """As ``lookups`` for the texts themselves: all entries in one pass within the row, of any number of words, no shuffle of tokens.

    The lexicon becomes a trie that is built once and broadcast. One of more than
    ``MOST_BYTES`` of text goes in parts, to the groups of texts that need them.
    """
    if phrase_bytes(lexicon, "term", "major", "minor", "language") > MOST_BYTES:
        return _lookups_in_groups(docs, lexicon, text_col, keys)
    entries = lexicon.select(*Lists.COLUMNS, phrase_tokens("term").alias("words")).toArrow()
    shared = docs.sparkSession.sparkContext.broadcast(Lists(entries))
    return found_in_rows(docs, text_col, keys, lambda words: shared.value.find(words), "start:int,end:int,term:string,major:string,minor:string,language:string")


def _lookups_in_groups(docs: DataFrame, lexicon: DataFrame, text_col: str, keys: tuple[str, ...]) -> DataFrame:
    """Texts are dealt to groups of some TOGETHER bytes, and a group gets the entries that begin with a word of it.

    So texts are shuffled once, instead of their tokens, and entries as often as
    groups need them. A group comes as a stream: its entries, then its texts, one
    batch at a time.
    """
    rows = docs.select(*dict.fromkeys([*keys, text_col]))
    groups = max(1, -(-phrase_bytes(rows, text_col) // TOGETHER))
    dealt = rows.where(F.col(text_col).isNotNull()).select(F.pmod(F.xxhash64(*rows.columns), F.lit(groups)).cast("int").alias("_group"), *[F.col(k).alias(f"_k{n}") for n, k in enumerate(keys)], F.col(text_col).alias("_text"))
    words = dealt.select("_group", F.explode(F.array_distinct(tokens_of("_text"))).alias("_word")).distinct()
    first = F.get(phrase_tokens("term"), F.lit(0))
    needed = lexicon.select(*Lists.COLUMNS, first.alias("_word")).where("_word is not null").join(words, "_word").select("_group", *Lists.COLUMNS)
    both = dealt.withColumn("_kind", F.lit(1)).unionByName(needed.withColumn("_kind", F.lit(0)), allowMissingColumns=True)
    stream = both.repartition(groups, "_group").sortWithinPartitions("_group", "_kind")
    names = [f"_k{n}" for n in range(len(keys))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, lists = None, [], None
        for batch in batches:
            both = np.stack([batch["_group"].to_numpy(), batch["_kind"].to_numpy()])
            cuts = [0, *np.flatnonzero((both[:, 1:] != both[:, :-1]).any(axis=0)) + 1, batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if part["_group"][0].as_py() != group:
                    group, held, lists = part["_group"][0].as_py(), [], None
                if part["_kind"][0].as_py() == 0:
                    held.append(part.select([*Lists.COLUMNS, "words"]))
                    continue
                if held:
                    lists, held = Lists(pa.Table.from_batches(held)), []
                for at, strings in in_stretches(part["_strings"], MOST_TOKENS) if lists else ():
                    found, columns = lists.find(Words.of(strings))
                    yield pa.RecordBatch.from_arrays([part[k].take(pa.array(found + at)) for k in names] + list(columns.values()), names=[*keys, *columns])

    schema = T.StructType([*[T.StructField(k, docs.schema[k].dataType) for k in keys], *T.StructType.fromDDL("start int, end int, term string, major string, minor string, language string").fields])
    return stream.select("_group", "_kind", *names, tokens_of("_text").alias("_strings"), *Lists.COLUMNS, phrase_tokens("term").alias("words")).mapInArrow(run, schema)


def lookups(words: DataFrame, lexicon: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``(keys, start, end, term, major, minor, language)``: case-sensitive hits of whole tokens.

    ``words`` are tokens without blanks. Runs of up to as many tokens as the longest
    entry has are joined with single blanks and looked up; the longest hit of a
    list at a place stays.
    """
    longest = lexicon.agg(F.max("n_tokens")).first()[0] or 1
    spaced = lexicon.withColumn("norm", F.array_join(phrase_tokens("term"), " "))
    w = Window.partitionBy(*keys).orderBy("tok_idx")
    ahead = [F.struct(F.col("string"), F.col("end"))] + [F.lead(F.struct("string", "end"), k).over(w) for k in range(1, longest)]
    runs = words.select(*keys, "tok_idx", "start", F.array(*ahead).alias("run"))
    grams = runs.select(*keys, "tok_idx", "start", F.posexplode(F.filter(F.transform(F.sequence(F.lit(1), F.lit(longest)), lambda n: F.struct(F.array_join(F.transform(F.slice("run", 1, n), lambda t: t["string"]), " ").alias("norm"), F.get("run", n - 1)["end"].alias("end"))), lambda g: g["end"].isNotNull())).alias("k", "g")).select(*keys, "start", "g.norm", "g.end")
    hits = grams.join(_side(spaced.select("norm", "term", "major", "minor", "language")), "norm")
    best = Window.partitionBy(*keys, "start", "major", "minor").orderBy(F.desc("end"), "term", "language")
    return hits.withColumn("rank", F.row_number().over(best)).where("rank = 1").select(*keys, "start", "end", "term", "major", "minor", "language")


def suffix_lookups(words: DataFrame, suffixes: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Capitalised tokens that end in an entry of ``suffixes(term, major)``: one row a token and list."""
    lengths = [r[0] for r in suffixes.select(F.length("term")).distinct().collect()]
    ends = F.filter(F.array(*[F.when(F.length("string") > n, F.right("string", F.lit(n))) for n in lengths] or [F.lit(None).cast("string")]), lambda s: s.isNotNull())
    upper = words.where(F.col("string").rlike(r"^\p{Lu}")).select(*keys, "start", "end", "string", F.explode(ends).alias("term"))
    return upper.join(_side(suffixes.select("term", "major").distinct()), "term").select(*keys, "start", "end", "string", "major", F.lit("suffixed").alias("minor")).distinct()


#: Which annotation a lexicon hit becomes by itself.
DIRECT = {
    ("location", "city"): ("Location", "city"),
    ("location", "region"): ("Location", "region"),
    ("location", "cantons"): ("Location", "region"),
    ("location", "country"): ("Location", "country"),
    ("location", "country_adjective"): ("Location", "geographical adjective"),
    ("location", "citizenship"): ("Location", "geographical adjective"),
    ("location", "language"): ("Location", "other"),
    ("location", "other"): ("Location", "other"),
    ("location", "street"): ("Location", "street"),
    ("location", "organisational_unit"): ("Location", "organisational unit"),
    ("organization", "hospital"): ("Location", "organisation"),
    ("organization", "organization"): ("Location", "organisation"),
    ("occupation", "occupation"): ("Occupation", ""),
    ("occupation", "employer"): ("Occupation", ""),
}


def direct_annotations(hits: DataFrame) -> DataFrame:
    """Hits that are an annotation by themselves, as ``(…, type, subtype)``."""
    table = F.create_map(*[x for (major, minor), (kind, subtype) in DIRECT.items() for x in (F.lit(f"{major}/{minor}"), F.struct(F.lit(kind).alias("type"), F.lit(subtype).alias("subtype")))])
    return hits.withColumn("a", F.try_element_at(table, F.concat_ws("/", "major", "minor"))).where("a is not null").select(*hits.columns, "a.*")


def without_false_positives(annotations: DataFrame, hits: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Annotations that no hit of a false-positive list of their type overlaps, nor, for places, an ambiguous city."""
    bad = hits.where("minor = 'false_positives' or minor = 'city_ambiguous'").select(*keys, "start", "end", F.when(F.col("minor") == "city_ambiguous", "location").otherwise(F.lower("major")).alias("type"))
    return without_overlap(annotations, bad, keys, F.lower("type") == F.col("o_type"), ("start", "end", "type"))


#: One letter for what a token can be in a name; the first that holds is taken.
CODES = "L dear, w nach, H salutation, D title, R role, B first and last name, F first name, S last name, M other lexicon, C capitalised, U capitals, I initial, p particle, l lower case, n number, N newline, and marks as themselves"


def name_codes(words: DataFrame, hits: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``(keys, codes, starts, ends)``: a text's tokens as a string of class letters, a letter a token.

    Rules over names become patterns over that string, and a match's place in it
    is its place among the tokens. The join of tokens and hits is shuffled: what is
    exploded from texts is larger than Spark's estimate, by which it would be broadcast.
    """
    flags = hits.groupBy(*keys, "start", "end").agg(F.max((F.col("minor") == "firstname").cast("int")).alias("first"), F.max((F.col("minor") == "surname").cast("int")).alias("last"), F.max(F.col("major").isin("general", "stop", "medical", "location", "occupation").cast("int")).alias("other"))
    t = words.join(flags.hint("merge"), [*keys, "start", "end"], "left")
    s = F.col("string")
    code = (
        F.when(s.rlike("^[Ll]iebe[r]?$"), "L").when(s == "nach", "w").when(s.isin("Herr", "Herrn", "Frau", "Hr", "Fr", "Ehepaar", "Familie"), "H").when(s.isin("Dr", "Prof", "PD", "Professor", "med"), "D").when(s.isin("OA", "AA", "UA", "OÄ", "AÄ", "JA"), "R")
        .when((F.col("first") == 1) & (F.col("last") == 1), "B").when(F.col("first") == 1, "F").when(F.col("last") == 1, "S").when(F.col("other") == 1, "M")
        .when(F.col("kind") == "newline", "N").when(F.col("kind") == "number", "n").when(s.isin("de", "von", "da", "dos"), "p")
        .when(F.col("kind") == "punctuation", F.when(s.rlike(r"^[-.,/()&]$"), s).otherwise("_"))
        .when(s.rlike(r"^\p{Lu}$"), "I").when(F.col("orth") == "upperInitial", "C").when(F.col("orth") == "allCaps", "U").otherwise("l")
    )
    rows = F.array_sort(F.collect_list(F.struct("tok_idx", code.alias("code"), "start", "end")))
    return t.groupBy(*keys).agg(rows.alias("r")).select(*keys, F.array_join("r.code", "").alias("codes"), F.col("r.start").alias("starts"), F.col("r.end").alias("ends"))
