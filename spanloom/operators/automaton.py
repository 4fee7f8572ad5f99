"""Many phrases in many texts at once: a trie over numbered tokens, broadcast and run within the row."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.arrows import Words, in_stretches, list_of
from spanloom.functions.text import tokens

#: A phrase's tokens; blanks separate them and don't count.
PHRASE = r"\p{L}+|\p{N}+|[^\p{L}\p{N}\s]"


@dataclass
class Automaton:
    """A trie of phrases: nodes are numbered, edges are ``(node, token number)``, and each node knows the entries that end there."""

    vocabulary: list[str] = field(default_factory=list)
    edges: dict[tuple[int, int], int] = field(default_factory=dict)
    ends: dict[int, list[int]] = field(default_factory=dict)

    @classmethod
    def of(cls, phrases: Iterable[Sequence[str]]) -> Automaton:
        """Entries are numbered in order; an entry without a token never matches."""
        out, numbers, nodes = cls(), {}, 0
        for entry, tokens in enumerate(phrases):
            node = 0
            for token in tokens:
                step = (node, numbers.setdefault(token, len(numbers)))
                if step not in out.edges:
                    nodes += 1
                    out.edges[step] = nodes
                node = out.edges[step]
            if node:
                out.ends.setdefault(node, []).append(entry)
        out.vocabulary = list(numbers)
        return out

    @cached_property
    def numbers(self) -> dict[str, int]:
        return {token: k for k, token in enumerate(self.vocabulary)}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "numbers"}

    def numbered(self, values: pa.Array) -> np.ndarray:
        """Each token's number in the vocabulary, or -1: looked up once for each different one, so the vocabulary isn't hashed with every batch."""
        encoded = pc.dictionary_encode(values)
        known = np.array([self.numbers.get(token, -1) for token in encoded.dictionary.to_pylist()] or [-1], dtype=np.int64)
        return known[encoded.indices.to_numpy(zero_copy_only=False)]

    def hits(self, words: Words, numbers: np.ndarray | None = None, begins: np.ndarray | None = None) -> Iterator[tuple[int, int, int]]:
        """``(first token, token behind the last, entry)`` for every phrase found, by first token and length.

        All tokens are numbered in one vectorised lookup (or ``numbers`` are theirs);
        the trie is walked only from those that some phrase begins with (``begins``:
        from these alone), and no walk leaves its row.
        """
        numbers = self.numbered(words.values) if numbers is None else numbers
        if begins is None:
            begins = np.zeros(len(self.vocabulary) + 1, dtype=bool)
            begins[[token for node, token in self.edges if node == 0]] = True
        places = np.flatnonzero(begins[numbers])
        if not len(places):
            return
        edges, ends, limits = self.edges, self.ends, words.last[words.row[places]].tolist()
        numbers = numbers.tolist()
        for at, limit in zip(places.tolist(), limits, strict=True):
            node, k = 0, at
            while k < limit and (node := edges.get((node, numbers[k]), -1)) >= 0:
                k += 1
                for entry in ends.get(node, ()):
                    yield at, k, entry


#: Tokens that are worked on at once.
MOST_TOKENS = 1 << 17
#: Tables of phrases are broadcast up to so many bytes of text.
MOST_BYTES = 64 << 20


def phrase_bytes(phrases: DataFrame, *columns: str) -> int:
    return phrases.agg(F.sum(sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in columns), F.lit(0)))).first()[0] or 0


def phrase_tokens(phrase: Column | str) -> Column:
    return F.regexp_extract_all(phrase, F.lit(PHRASE), F.lit(0))


def found_in_rows(docs: DataFrame, text_col: str, keys: tuple[str, ...], find, schema: str) -> DataFrame:
    """``(keys, the columns of schema)``: what ``find(words)`` reports of each batch of texts, no shuffle.

    ``find`` gives the row of each find, in order, and a column for each field. Rows
    are exploded keeping those without any, or Spark would test the size of the
    array, and make it, twice.
    """

    def few(strings: pa.Array) -> pa.Array:
        words = Words.of(strings)
        rows, columns = find(words)
        return list_of(pa.StructArray.from_arrays(list(columns.values()), list(columns)), np.bincount(rows, minlength=len(strings)))

    def run(strings: pa.Array) -> pa.Array:
        return pa.concat_arrays([few(part) for _, part in in_stretches(strings, MOST_TOKENS)])

    udf = F.arrow_udf(run, f"array<struct<{schema}>>")
    rows = docs.select(*dict.fromkeys([*keys, text_col])).select(*keys, udf(tokens(text_col)).alias("_found"))
    return rows.select(*keys, F.explode_outer("_found").alias("_f")).where("_f is not null").select(*keys, "_f.*")
