"""A pipeline as a file of keys: which stages it has, with which tables, checked before anything runs."""

from __future__ import annotations

import re
from collections.abc import Mapping as Dict
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from spanloom.operators.fields import Mapping
from spanloom.operators.lexicon import read_lists
from spanloom.operators.rules import Rule, rules_of
from spanloom.plans.stages import TEXT_PHASES, Settings, checked, planned

#: What each key of a pipeline names. Keys marked so are known from elsewhere and choose what is built in here.
KEYS = {
    "finalAnnotationSetName": "the name of the set of spans in what is written", "annotationTypes": "the types that are kept", "gazetteer": "an index of lists", "suffixGazetteer": "an index of lists of suffixes",
    "genericTransducer": "built in", "specificTransducer": "a table of rules, as JSON lines", "annotationMapping": "kinds of fields", "structuredFieldMapping": "fields that are a span as a whole", "annotationBlacklist": "types that no span has in a field",
    "contextTriggerConfig": "words that open a context", "stages": "the plan, if not all that the other keys ask for", "tokenizerRules": "built in", "sentenceSplitterGazetteer": "built in", "sentenceSplitterRules": "built in", "schemaDir": "built in", "resource_roots": "built in", "gate_version": "built in",
}
LIST = re.compile(r"\[(.*)\]\Z", re.DOTALL)
PART = re.compile(r'"((?:[^"\\]|\\.)*)"|\$\{(\w+)\}|([^\s"$]+)')


def read_keys(text: str, known: Dict[str, str]) -> dict[str, str | list[str]]:
    """``key = value`` lines, plain or in a block, with ``${name}`` for earlier keys and those that are known.

    Values are strings, put together from their parts, or lists of strings; ``//``
    and ``#`` begin comments. Keys are taken without their blocks' names.
    """
    out: dict[str, str | list[str]] = {}

    def value(raw: str) -> str:
        parts = []
        for quoted, name, plain in PART.findall(raw):
            if name and name not in {**known, **out}:
                raise ValueError(f"nothing is called {name}")
            parts.append(str({**known, **out}[name]) if name else quoted or plain)
        return "".join(parts)

    for line in text.splitlines():
        line = re.sub(r"^\s*(?://|#).*", "", line).strip()
        if not line or line == "}" or re.fullmatch(r"[\w.]+\s*\{", line):
            continue
        m = re.fullmatch(r"([\w.]+)\s*[=:]\s*(.+)", line)
        if not m:
            raise ValueError(f"no key and value: {line}")
        listed = LIST.match(m[2].strip())
        out[m[1].split(".")[-1]] = [value(x) for x in listed[1].split(",") if x.strip()] if listed else value(m[2])
    return out


@dataclass(frozen=True)
class Pipeline:
    """What a configuration comes to: the site's settings, the stages in order, the types kept, and the name of their set."""

    settings: Settings
    plan: list[str]
    types: tuple[str, ...]
    set_name: str
    phases: dict[str, list[Rule]]


def _lines(spark: SparkSession, path: str) -> list[str]:
    return [line for line in (r["value"].strip() for r in spark.read.text(path).collect()) if line and not line.startswith("#")]


def read_triggers(spark: SparkSession, path: str):
    """``(token, context, left, right)`` of lines ``token; context; left; right``."""
    text = spark.read.text(path).where("trim(value) != '' and not startswith(trim(value), '#')")
    cells = F.transform(F.split("value", ";"), lambda c: F.trim(c))
    return text.select(cells[0].alias("token"), cells[1].alias("context"), cells[2].try_cast("int").alias("left"), cells[3].try_cast("int").alias("right")).where("left is not null and right is not null")


def load(spark: SparkSession, path: str) -> Pipeline:
    """The pipeline of a configuration file; unknown keys, and stages out of order or without what they need, raise."""
    folder = path.rsplit("/", 1)[0] + "/"
    text = "\n".join(r["value"] for r in spark.read.text(path).collect())
    keys = read_keys(text, {"config_file_dir": folder})
    if unknown := sorted(k for k in keys if k not in KEYS):
        raise ValueError(f"unknown keys: {', '.join(unknown)}")
    get = keys.get
    mappings = lambda key: tuple(m for m in map(Mapping.parse, _lines(spark, get(key))) if m) if get(key) else ()
    index = lambda key: str(get(key)).rsplit("/", 1)
    blacklist = {p.strip(): [t.strip() for t in types.split(",")] for p, types in (line.split(";", 1) for line in _lines(spark, get("annotationBlacklist")))} if get("annotationBlacklist") else {}
    suffixes = read_lists(spark, *index("suffixGazetteer")).select("term", "major") if get("suffixGazetteer") else None
    rules = rules_of(spark.read.json(get("specificTransducer"), "name string, pattern string, emits array<struct<group:int,type:string,subtype:string>>, priority int, context string, needs array<string>, action string")) if get("specificTransducer") else []
    settings = Settings(
        read_lists(spark, *index("gazetteer")) if get("gazetteer") else None, suffixes, read_triggers(spark, get("contextTriggerConfig")) if get("contextTriggerConfig") else None,
        mappings("annotationMapping"), mappings("structuredFieldMapping"), blacklist, rules=tuple(rules),
    )
    types = get("annotationTypes") or []
    plan = checked(get("stages")) if get("stages") else planned(settings, clean=True)
    phases = {**TEXT_PHASES, "Site": rules} if rules else TEXT_PHASES
    return Pipeline(settings, plan, tuple(types), str(get("finalAnnotationSetName") or "default-annotations"), phases)
