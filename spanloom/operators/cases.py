"""Tagged sentences as tests of a rule set."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TAG = re.compile(r"<(/?)([A-Za-z]+)((?:\s+\w+=\"[^\"]*\")*)\s*>")


def parse_case(line: str, types: set[str]) -> tuple[str, list[tuple[int, int, str, dict[str, str]]]]:
    """A line's plain text, and the spans that its tags of the given types mark; ``\\n`` is a newline."""
    text, spans, open_, at = "", [], [], 0
    line = line.replace("\\n", "\n").replace("\\#", "#")
    for m in TAG.finditer(line):
        text += line[at : m.start()]
        at = m.end()
        if m[2] not in types:
            text += m[0]
        elif m[1]:
            start, attributes = open_.pop()
            spans.append((start, len(text), m[2], attributes))
        else:
            open_.append((len(text), dict(re.findall(r"(\w+)=\"([^\"]*)\"", m[3]))))
    return text + line[at:], spans


def read_cases(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``docs(doc_id, text)`` and ``expected(doc_id, start, end, type)`` of a suite's files.

    The first line of a file names the types, then after ``;`` its context tags;
    ``#`` starts a comment. Files are read by Spark, a row a line.
    """
    lines = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    docs, expected = [], []
    for row in lines.orderBy("file").toLocalIterator():
        head, *rest = row["value"].split("\n")
        types = {x.strip() for x in head.split(";")[0].split(",") if x.strip()}
        for n, line in enumerate(rest):
            line = re.sub(r"(?<!\\)#.*$", "", line).rstrip()
            if line:
                text, spans = parse_case(line, types)
                key = f"{row['file'].rsplit('/', 1)[-1]}:{n + 2}"
                docs.append((key, text))
                expected += [(key, s, e, t) for s, e, t, _ in spans]
    return spark.createDataFrame(docs, "doc_id string, text string"), spark.createDataFrame(expected, "doc_id string, start int, end int, type string")


def failures(docs: DataFrame, expected: DataFrame, find: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``(doc_id, start, end, type, problem)``: expected spans that weren't found, and found ones that weren't expected."""
    cols, types = ["doc_id", "start", "end", "type"], expected.select("type").distinct()
    found = find(docs).join(types, "type", "left_semi").select(*cols).distinct()
    missing = expected.select(*cols).join(found, cols, "left_anti").withColumn("problem", F.lit("missing"))
    return missing.unionByName(found.join(expected.select(*cols), cols, "left_anti").withColumn("problem", F.lit("unexpected")))
