"""Secret scans: pattern candidates, and a random forest that removes false positives."""

from __future__ import annotations

import math
import random
import re
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.llm.common import table

TREES, DEPTH, LEAST_LEAF, MAX_LABELLED, THRESHOLD, AROUND = 40, 10, 3, 20_000, 0.5, 60
REDACTED = "[REDACTED]"

#: Words that name a secret before it, and words that mark a value as none.
NAMING = frozenset("access api apikey auth authorization bearer client credential credentials key passphrase passwd password private pwd secret signing token".split())
HARMLESS = frozenset("blob build checksum commit digest etag example fixture hash id image integrity md5 revision sample sha sha1 sha256 sha512 test tree uuid version".split())
DICTIONARY = frozenset("admin changeme default demo development dummy example fake fixme foobar guest hello here insert letmein localhost mock mypassword none null password placeholder production qwerty redacted replace root sample secret server some staging string test token user username value welcome word your".split())

# No part looks beyond its own run, and runs are tried from their start alone, so the time is in proportion to the text.
CANDIDATE = re.compile(
    r"(?P<private_key>-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END (?:[A-Z]+ )*PRIVATE KEY-----)"
    r"|(?P<provider>\b(?:AKIA|ASIA)[A-Z0-9]{16}\b|\bgh[pousr]_[A-Za-z0-9]{36,}\b|\bxox[abprs]-[A-Za-z0-9-]{10,}|\bsk-[A-Za-z0-9_-]{20,})"
    r"|(?P<web_token>(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})"
    r"|(?:pass(?:word|wd|phrase)|pwd|secret|token|key|credentials?|bearer)[\"']?\s{0,3}[:=]\s{0,3}[\"']?(?P<assigned>[^\s\"']{8,})"
    r"|://[^\s:/@]{1,64}:(?P<in_url>[^\s:/@]{4,})@"
    r"|(?<![A-Za-z0-9+/_-])(?P<opaque>(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{20,}={0,2})(?![A-Za-z0-9+/_=-])",
    re.IGNORECASE,
)
#: Every candidate holds one of these, so other texts are passed over quickly.
HINT = re.compile(r"[A-Za-z0-9+/_-]{20}|[:=]|-----BEGIN|(?i:xox)")
KINDS = ("private_key", "provider", "web_token", "assigned", "in_url", "opaque")
WORD = re.compile(r"[A-Za-z][a-z]+|[A-Z]+(?![a-z])|\d+")
FEATURES = 23


def _class(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def features(kind: str, value: str, path: str | None, before: str, after: str) -> list[float]:
    """Length, character transitions, dictionary coverage, path and neighbouring words, as numbers."""
    n = max(1, len(value))
    kinds = [_class(c) for c in value]
    moves = Counter(zip(kinds, kinds[1:], strict=False))
    counts = Counter(value)
    covered = sum(len(w) for w in WORD.findall(value) if w.lower() in DICTIONARY)
    near, far, places = [w.lower() for w in WORD.findall(before)][-4:], [w.lower() for w in WORD.findall(after)][:4], {w.lower() for w in WORD.findall(path or "")}
    return [
        len(value), math.log(n), len(counts) / n, -sum(c / n * math.log2(c / n) for c in counts.values()),
        kinds.count(0) / n, kinds.count(1) / n, kinds.count(2) / n, kinds.count(3) / n,
        sum(v for (a, b), v in moves.items() if a != b) / n, (moves[0, 2] + moves[2, 0]) / n, (moves[0, 1] + moves[1, 0]) / n, (moves[1, 2] + moves[2, 1]) / n,
        sum(value[i] == value[i - 1] for i in range(1, len(value))) / n, max(counts.values(), default=0) / n,
        covered / n, float(set(value.lower()) <= set("0123456789abcdef")), float(bool(re.fullmatch(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", value))),
        float(any(w in NAMING for w in near)), float(before.rstrip("\"' ")[-1:] in ("=", ":")), float(any(w in HARMLESS for w in near)), float(any(w in HARMLESS for w in far)),
        float(bool(places & (HARMLESS | {"doc", "docs", "spec", "tests", "examples", "fixtures"}))), float(KINDS.index(kind)),
    ]


def candidates(text: str) -> Iterator[tuple[str, int, int]]:
    """Kind, start and end (in characters) of what looks like a secret, over a whole text."""
    if HINT.search(text):
        for m in CANDIDATE.finditer(text):
            kind = m.lastgroup
            start, end = m.span(kind)
            yield kind, start, end


def featured(text: str, path: str | None) -> tuple[list[tuple[str, int, int]], np.ndarray]:
    found = list(candidates(text))
    rows = [features(k, text[s:e], path, text[max(0, s - AROUND) : s], text[e : e + AROUND]) for k, s, e in found]
    return found, np.array(rows, dtype=np.float64).reshape(-1, FEATURES)


@dataclass
class Forest:
    """Trees as arrays: the feature asked (-1 at a leaf), its threshold, the two next nodes, and the leaf's share."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 0) -> Forest:
        """Each tree sees a bootstrap of the rows, and each split a random part of the features."""
        rnd = np.random.default_rng(seed)
        return cls([cls._grow(x[rows], y[rows], depth, rnd) for rows in (rnd.integers(0, len(y), len(y)) for _ in range(trees if len(y) else 0))])

    @staticmethod
    def _grow(x: np.ndarray, y: np.ndarray, depth: int, rnd: np.random.Generator) -> tuple:
        nodes: list[list[float]] = []
        width = max(1, round(math.sqrt(x.shape[1])))
        todo = [(np.arange(len(y)), 0, -1, 0)]
        while todo:
            rows, level, parent, side = todo.pop()
            here, best = len(nodes), (0.0, -1, 0.0)
            nodes.append([-1, 0.0, 0, 0, y[rows].mean()])
            if parent >= 0:
                nodes[parent][2 + side] = here
            if level < depth and len(rows) >= 2 * LEAST_LEAF and 0 < y[rows].mean() < 1:
                for f in rnd.permutation(x.shape[1])[:width]:
                    order = np.argsort(x[rows, f], kind="stable")
                    values, ones = x[rows[order], f], np.cumsum(y[rows[order]])
                    n = np.arange(1, len(rows))
                    left, right = ones[:-1] / n, (ones[-1] - ones[:-1]) / (len(rows) - n)
                    gain = n * (left - y[rows].mean()) ** 2 + (len(rows) - n) * (right - y[rows].mean()) ** 2
                    gain[(values[1:] == values[:-1]) | (n < LEAST_LEAF) | (len(rows) - n < LEAST_LEAF)] = 0
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), int(f), float((values[k] + values[k + 1]) / 2))
            if best[1] >= 0:
                nodes[here][:2] = best[1], best[2]
                goes = x[rows, best[1]] <= best[2]
                todo += [(rows[goes], level + 1, here, 0), (rows[~goes], level + 1, here, 1)]
        a = np.array(nodes)
        return a[:, 0].astype(int), a[:, 1], a[:, 2:4].astype(int), a[:, 4]

    def score(self, x: np.ndarray) -> np.ndarray:
        """The share of the trees' votes for a secret; without training, 1."""
        if not self.trees:
            return np.ones(len(x))
        total = np.zeros(len(x))
        for feature, threshold, children, share in self.trees:
            at = np.zeros(len(x), dtype=int)
            while (inner := feature[at] >= 0).any():
                rows = np.flatnonzero(inner)
                node = at[rows]
                at[rows] = children[node, (x[rows, feature[node]] > threshold[node]).astype(int)]
            total += share[at]
        return total / len(self.trees)


def labelled_findings(spark: SparkSession, n: int = 4000, seed: int = 7) -> DataFrame:
    """Made-up labelled findings ``(text, path, label)``, one candidate a text, where no reviewed ones are at hand.

    Half are secrets of every kind of candidate, with and without a word that names
    them; the rest are what scanners mistake for one: commits, checksums,
    identifiers, placeholders, encoded data, long compound words, and values of
    names that aren't secret.
    """
    rnd = random.Random(seed)
    pick = lambda chars, k: "".join(rnd.choice(chars) for _ in range(k))
    alnum, hexa = string.ascii_letters + string.digits, "0123456789abcdef"
    coded, upper = alnum + "+/", string.ascii_uppercase + string.digits
    filler = "the of with and in on run value set from use see file at line then new build result is".split()
    say = lambda: " ".join(rnd.choice(filler) for _ in range(rnd.randrange(1, 6)))
    plain = lambda k: "".join(rnd.choice(["data", "service", "module", "report", "config", "index", "table", "query", "cache", "stream"]) + rnd.choice(["", "_", "-"]) for _ in range(k))
    paths = ["src0", "src7", "conf/app.env", "deploy/prod.yaml", "", None]
    harmless_paths = ["src0", "src7", "tests/fixtures/a.py", "docs/example.md", "lock.json", "", None]

    def secret() -> str:
        token = rnd.choice([pick(hexa, 40), pick(hexa, 32), pick(hexa, 64), pick(alnum, rnd.randrange(20, 48))])
        provider = rnd.choice(["AKIA" + pick(upper, 16), "ghp_" + pick(alnum, 36), "sk-" + pick(alnum, 32), "xoxb-" + pick(string.digits, 11) + "-" + pick(alnum, 24)])
        name = rnd.choice(["token", "api_key", "secret", "password", "access_key", "client_secret", "auth_token"])
        quote, to = rnd.choice(['"', '"', "'", ""]), rnd.choice([" = ", "=", ": "])
        return rnd.choice([
            f"{name}{to}{quote}{rnd.choice([token, provider, pick(alnum + '!@#$%^&*', rnd.randrange(10, 20)) + '7x'])}{quote}",
            f"{name}{to}{quote}{token}{quote}",
            provider,
            f"-----BEGIN {rnd.choice(['RSA ', 'EC ', ''])}PRIVATE KEY-----\n" + "\n".join(pick(coded, 64) for _ in range(rnd.randrange(3, 12))) + "\n-----END PRIVATE KEY-----",
            f"eyJ{pick(alnum, 33)}.eyJ{pick(alnum, rnd.randrange(40, 90))}.{pick(alnum + '-_', 43)}",
            f"{rnd.choice(['auth', '?sig', '&sig', 'AWS_SESSION', 'SESSION_KEY', 'hmac', 'x-signature'])}{rnd.choice(['=', '=', ': '])}{token}",
            f"{rnd.choice(['https', 'postgres', 'ftp'])}://{rnd.choice(['root', 'admin', 'user7', 'svc'])}:{pick(alnum + '!#$%', rnd.randrange(8, 20))}@{plain(1).strip('_-')}.example/x",
        ])

    def lookalike() -> str:
        return rnd.choice([
            f"commit {pick(hexa, 40)}", f"sha256 {pick(hexa, 64)}", f"checksum md5 {pick(hexa, 32)}", f"id {pick(hexa, 8)}-{pick(hexa, 4)}-{pick(hexa, 4)}-{pick(hexa, 4)}-{pick(hexa, 12)}",
            f"{rnd.choice(['revision', 'commit', 'etag', 'sha1', 'digest', 'build', 'tree'])}{rnd.choice(['=', ': ', ' = '])}{pick(hexa, 40)}",
            f"password = {rnd.choice(['changeme', 'your_password_here', 'examplepassword', 'xxxxxxxxxxxx', '<password>', 'placeholder1', 'null_value_none'])}", f"token: {rnd.choice(['your-token-here', 'example_token_value', '0000000000000000', 'replace_with_token', 'dummydummydummy'])}",
            f"image data {pick(alnum, rnd.randrange(60, 200))}", f"see {plain(4)}2", f"key = {plain(2)}", f"version {rnd.randrange(10)}-{plain(3)}{rnd.randrange(100)}", f"number {pick('0123456789', rnd.randrange(20, 30))}", f"integrity sha512 {pick(alnum, 86)}==",
            f"http://user:{rnd.choice(['password', 'example', 'changeme', 'secret', 'test'])}@localhost/x", f"path={plain(3)}/{plain(2)}7",
        ])

    rows = [(f"{say()} {secret() if k % 2 else lookalike()} {say()}", rnd.choice(paths if k % 2 else harmless_paths), k % 2) for k in range(n)]
    return spark.createDataFrame(rows, "text string, path string, label int")


def train(labelled: DataFrame, max_rows: int = MAX_LABELLED) -> Forest:
    """Learn from ``labelled(text, path, label)``: up to ``max_rows`` findings with the text around them.

    Texts without a candidate and null labels are left out; of several candidates
    all take the label. Without any row every candidate is kept.
    """
    rows = labelled.where("text is not null and label is not null").select("text", "path", "label").orderBy(F.xxhash64("text"), "text", "path", "label").limit(max_rows).collect()
    xs, ys = [], []
    for r in rows:
        _, x = featured(r["text"], r["path"])
        xs.append(x)
        ys += [r["label"]] * len(x)
    return Forest.fit(np.concatenate([np.zeros((0, FEATURES)), *xs]), np.array(ys, dtype=float))


def _scored(texts: list, paths: list, forest: Forest) -> list[list[tuple[str, int, int, float]]]:
    """The candidates of a batch of texts and their scores; the forest sees the batch at once."""
    found = [featured(t or "", p) for t, p in zip(texts, paths, strict=True)]
    scores = forest.score(np.concatenate([np.zeros((0, FEATURES)), *(x for _, x in found)])).tolist()
    out, at = [], 0
    for spans, _ in found:
        out.append([(*span, s) for span, s in zip(spans, scores[at : at + len(spans)], strict=True)])
        at += len(spans)
    return out


def scan(docs: DataFrame, forest: Forest, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """``(id, start, end, kind, secret, score, is_secret)``: one row per candidate of a whole text.

    Start and end count characters. Null and empty texts have no candidate; a null
    path is an empty one; repeated rows give repeated findings; null ids stay null;
    an empty table gives an empty one. One pass, no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(forest)
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *T.StructType.fromDDL("start int, end int, kind string, secret string, score double, is_secret boolean").fields])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rows = batch.column(1).to_pylist(), []
            for row, spans in enumerate(_scored(texts, batch.column(2).to_pylist(), shared.value)):
                rows += [(row, s, e, k, texts[row][s:e], score, score >= threshold) for k, s, e, score in spans]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(columns[0], pa.int64())), *[pa.array(c, t) for c, t in zip(columns[1:], (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.float64(), pa.bool_()), strict=True)]], names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col).alias("_text"), (F.col(path_col).cast("string") if path_col else F.lit(None).cast("string")).alias("_path")).mapInArrow(find, schema)


def redact(docs: DataFrame, forest: Forest, threshold: float = THRESHOLD, text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """``docs`` with every secret in ``text_col`` replaced; all rows and columns stay, in one pass.

    Null and empty texts stay as they are, a null path is an empty one, texts of any
    length are searched whole, and repeated rows stay repeated.
    """
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("string")
    def clean(texts: pd.Series, paths: pd.Series) -> pd.Series:
        out = []
        for text, spans in zip(texts, _scored(list(texts), list(paths), shared.value), strict=True):
            parts, at = [], 0
            for _, s, e, score in spans:
                if score >= threshold:
                    parts += [text[at:s], REDACTED]
                    at = e
            out.append("".join([*parts, text[at:]]) if parts else text)
        return pd.Series(out, dtype=object)

    path = F.col(path_col).cast("string") if path_col else F.lit(None).cast("string")
    return docs.withColumn(text_col, clean(F.col(text_col), path))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate in all ``documents`` with its score, by a forest of generated labelled findings."""
    found = scan(table(spark, sf_dir, "documents"), train(labelled_findings(spark)))
    return found.select(F.col("id").alias("doc_id"), "start", "end", "kind", F.sha2("secret", 256).alias("secret_sha256"), "score", "is_secret")

