"""Lexica of many words: what is held, and what a batch costs."""

import pickle

import pyarrow as pa
import pyarrow.compute as pc

from spanloom.functions.arrows import Words
from spanloom.operators.lexicon import Lists


def entries(rows):
    kinds = [pa.string()] * 4 + [pa.list_(pa.string())]
    return pa.table({name: pa.array([r[k] for r in rows], kind) for k, (name, kind) in enumerate(zip(("term", "major", "minor", "language", "words"), kinds, strict=True))})


def test_words_of_one_token_are_no_edges_of_the_trie(monkeypatch):
    rows = [(f"w{k}", major, None, "de", [f"w{k}"]) for k in range(2000) for major in ("m", "n")] + [("w1 w2", "m", None, None, ["w1", "w2"]), ("w1", "m", None, "en", ["w1"]), ("", "m", None, None, [])]
    lists = Lists(entries(rows))
    # each of 2,000 words was a node, an edge and a list of entries, in every worker
    assert len(lists.automaton.edges) == 2 and len(lists.automaton.ends) == 2
    assert b"w1999" in pickle.dumps(lists) and "numbers" not in pickle.loads(pickle.dumps(lists)).automaton.__dict__
    hashed = []
    monkeypatch.setattr(pc, "index_in", lambda *a, **k: hashed.append(1))
    row, found = pickle.loads(pickle.dumps(lists)).find(Words.of(pa.array([["w1", " ", "w2", " ", "x"], ["w3", " ", "w1"]])))
    # the whole vocabulary was hashed again with every batch
    assert not hashed
    got = sorted(zip(row.tolist(), *[found[c].to_pylist() for c in ("start", "end", "term", "major", "language")], strict=True), key=str)
    assert got == sorted([(0, 0, 5, "w1 w2", "m", None), (0, 0, 2, "w1", "n", "de"), (0, 3, 5, "w2", "m", "de"), (0, 3, 5, "w2", "n", "de"), (1, 0, 2, "w3", "m", "de"), (1, 0, 2, "w3", "n", "de"), (1, 3, 5, "w1", "m", "de"), (1, 3, 5, "w1", "n", "de")], key=str)
    assert len(Lists(entries([])).find(Words.of(pa.array([["a"]])))[0]) == 0
