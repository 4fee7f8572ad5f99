"""Sequence rules as declarative patterns, and the choice among their matches.

A rule is a pattern whose groups, one after the other, make up the whole match,
and a list of which groups become annotations. A phase is a list of rules that
compete: at each place the longest match wins, then the higher priority, then the
earlier rule, and the search goes on behind it. A rule that emits nothing only
uses up its text. All of it is one projection over the rows of a table of texts:
no shuffle, and a row's work is bounded by its own text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.functions.text import BLOCK
from spanloom.sources.kept import written

DIGIT = "0-9"
FIELDS = ("start", "end", "type", "subtype", "rule", "text", "other", "action")
ANNOTATION = "struct<start:int,end:int,type:string,subtype:string,rule:string,text:string,other:string,action:string>"


@dataclass(frozen=True)
class Rule:
    """``emits``: (group, type, subtype) of each annotation; ``context``: a field kind that the text has to be in.

    ``needs``: a text that holds none of these can't match, so its pattern isn't
    tried there; DIGIT stands for any digit. ``action`` names what is made of the
    match (see ``actions``); without one the type says it.
    """

    name: str
    pattern: str
    emits: tuple[tuple[int, str, str], ...] = ()
    priority: int = -1
    context: str | None = None
    needs: tuple[str, ...] = ()
    action: str = ""
    groups: int = field(default=0)

    def __post_init__(self) -> None:
        import re

        plain = re.sub(r"\\.|\[[^\]]*\]", "x", self.pattern)
        object.__setattr__(self, "groups", len(re.findall(r"\((?!\?)", plain)))
        if any(g > self.groups or g < 1 for g, _, _ in self.emits):
            raise ValueError(f"{self.name} emits a group it doesn't have")


def needing(rules: list[Rule], default: tuple[str, ...] = (), **named: tuple[str, ...]) -> list[Rule]:
    """The rules with what each needs: by name, or the default."""
    if unknown := named.keys() - {r.name for r in rules}:
        raise ValueError(f"no such rules: {sorted(unknown)}")
    return [replace(r, needs=named.get(r.name, default)) for r in rules]


def rules_of(rows: DataFrame) -> list[Rule]:
    """Rules kept as a table ``(name, pattern, emits, priority, context, needs)``, in the order of their names.

    So a site's rules are data, as JSON lines or Parquet, outside the code. ``emits``
    is an array of ``(group, type, subtype)``, and a column ``action`` may name what
    is made of the match; more than MOST_RULES raise.
    """
    found = rows.orderBy("name").limit(MOST_RULES + 1).collect()
    if len(found) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    return [Rule(r["name"], r["pattern"], tuple((e["group"], e["type"], e["subtype"]) for e in r["emits"] or ()), -1 if r["priority"] is None else r["priority"], r["context"], tuple(r["needs"] or ()), (r["action"] or "") if "action" in rows.columns else "") for r in found]


MOST_RULES = 2000
RULE_ROW = "name string, pattern string, emits array<struct<group:int,type:string,subtype:string>>, priority int, context string, needs array<string>"
#: A match, with all that it would emit.
SPAN = f"struct<start:int,end:int,priority:int,rule_no:int,emits:array<{ANNOTATION}>>"


def quoted(text: str) -> str:
    """A string literal of SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(value: str, name: str, body: str) -> str:
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _sums(lengths: str, start: str) -> str:
    return f"aggregate({lengths}, array({start}), (acc, n) -> concat(acc, array(element_at(acc, -1) + n)))"


def _blocks(items: str) -> str:
    """An array as an array of arrays of up to BLOCK items: folds that append copy what they have, so none gets long."""
    return f"transform(sequence(0, greatest(cast(ceil(size({items}) / {BLOCK}) as int) - 1, 0)), k -> slice({items}, k * {BLOCK} + 1, {BLOCK}))"


def _running(lengths: str) -> str:
    """The sums of an array of lengths before each place, and of all at the end."""
    totals = "transform(bs, b -> aggregate(b, 0, (acc, n) -> acc + n))"
    long = f"flatten(zip_with(bs, {_sums(totals, '0')}, (b, at) -> if(b is not null, slice({_sums('b', 'at')}, 1, size(b)), array(at))))"
    return _let(lengths, "ls", f"if(size(ls) <= {BLOCK}, {_sums('ls', '0')}, {_let(_blocks('ls'), 'bs', long)})")


#: Marks around a match and between its groups: noncharacters, which no text for interchange holds. A text that does holds OTHER in their place while it is searched.
EDGE, BORDER, OTHER = "\ufdd0", "\ufdd1", "\ufdd2"


def _marked(text: str, rule: Rule) -> str:
    """The text with its matches marked, each as the whole and its groups: one pass gives places and groups."""
    return f"regexp_replace({text}, {quoted(rule.pattern)}, {quoted(EDGE + BORDER.join(f'${k}' for k in range(rule.groups + 1)) + EDGE)})"


def _spans(text: str, rule: Rule, number: int) -> str:
    """The matches of one rule, which are marked in the column ``_m<number>``, as spans with what they would emit.

    A text is what lies between the matches and the matches in turn, so offsets are
    running sums of lengths; a group's place follows from those before it.
    """
    starts = f"if(size(ms) = 1, array(length(ps[0])), slice({_running('transform(ms, (m, i) -> length(ps[2 * i]) + if(i = 0, 0, length(ms[i - 1][0])))')}, 2, size(ms)))"
    group, length = lambda g: f"m[{g}]", lambda g: f"length(m[{g}])"

    def emit(g: int, kind: str, subtype: str) -> str:
        at = " + ".join(["at", *[length(k) for k in range(1, g)]])
        whole = lambda g, at: f"if(_own, substring(`{text}`, {at} + 1, {length(g)}), {group(g)})"
        partner = next((x for x, *_ in rule.emits if x != g), None)
        of_partner = "cast(null as string)" if partner is None else whole(partner, " + ".join(["at", *[length(k) for k in range(1, partner)]]))
        made = {"start": at, "end": f"{at} + {length(g)}", "type": quoted(kind), "subtype": quoted(subtype), "rule": quoted(rule.name), "text": whole(g, at), "other": of_partner, "action": quoted(rule.action)}
        return f"named_struct({', '.join(f"'{name}', {value}" for name, value in made.items())})"

    emits = f"filter(array({', '.join(emit(*e) for e in rule.emits)}), a -> a.end > a.start)" if rule.emits else "array()"
    span = f"named_struct('start', at, 'end', at + length(m[0]), 'priority', {rule.priority}, 'rule_no', {number}, 'emits', cast({emits} as array<{ANNOTATION}>))"
    cut = f"transform(filter(ps, (p, i) -> i % 2 = 1), p -> split(p, '{BORDER}', -1))"
    found = _let(f"split(_m{number}, '{EDGE}', -1)", "ps", _let(cut, "ms", f"zip_with(ms, {starts}, (m, at) -> {span})"))
    return f"cast({found} as array<{SPAN}>)"


def _chosen(spans: str) -> str:
    """Left-to-right choice among candidate spans: the longest at a place, then the higher priority, then the earlier rule.

    A chosen span ends the search inside it, so the result doesn't overlap.
    """
    keys = f"array_sort(transform({spans}, c -> named_struct('s', c.start, 'l', c.start - c.end, 'p', -c.priority, 'r', c.rule_no, 'c', c)))"
    step = "(acc, x) -> if(x.s >= acc.at, named_struct('at', x.c.end, 'out', concat(acc.out, array(x.c))), acc)"
    block = f"aggregate(ks, named_struct('at', big.at, 'out', cast(array() as array<{SPAN}>)), {step})"
    first = f"named_struct('at', 0, 'out', cast(array() as array<array<{SPAN}>>))"
    fold = f"aggregate({_let(keys, 'xs', _blocks('xs'))}, {first}, (big, ks) -> {_let(block, 'part', "named_struct('at', part.at, 'out', concat(big.out, array(part.out)))")}, big -> flatten(big.out))"
    return f"if(size({spans}) = 1, {spans}, {fold})"


def with_phase(rows: DataFrame, rules: list[Rule], out: str, text_col: str = "text", contexts_col: str | None = None) -> DataFrame:
    """``rows`` with the annotations of a phase, in order of their place, in the array column ``out``.

    First each rule's matches are found and marked, in one pass over the text.
    Offsets and groups follow only where there are some, and the choice among them
    comes last: projections of their own, so nothing is worked out twice. The expressions are written as SQL
    text: a phase of thirty rules is some thousand calls to the JVM otherwise.
    """
    plain, none = f"coalesce(`{text_col}`, '')", f"cast(array() as array<{SPAN}>)"
    own = f"(contains({plain}, '{EDGE}') or contains({plain}, '{BORDER}'))"
    text = "_text"

    def found(rule: Rule) -> str:
        tried = [" or ".join(f"{text} rlike '[0-9]'" if x == DIGIT else f"contains({text}, {quoted(x)})" for x in rule.needs)] if rule.needs else []
        if rule.context is not None:
            tried.append(f"coalesce(array_contains(`{contexts_col}`, {quoted(rule.context)}), false)" if contexts_col else "false")
        return f"if({' and '.join(f'({t})' for t in [*tried, f'{text} rlike {quoted(rule.pattern)}'])}, {_marked(text, rule)}, null)"

    held = rows.select("*", F.expr(own).alias("_own"), F.expr(f"if({own}, translate({plain}, '{EDGE}{BORDER}', '{OTHER}{OTHER}'), {plain})").alias("_text"))
    seen = held.select(*rows.columns, "_own", *[F.expr(found(r)).alias(f"_m{k}") for k, r in enumerate(rules)])
    each = [f"if(_m{k} is not null, {_spans(text_col, r, k)}, {none})" for k, r in enumerate(rules)]
    spans = seen.select(*rows.columns, F.expr(f"concat({', '.join(each)})").alias("_spans"))
    emitted = f"flatten(transform({_chosen('_spans')}, c -> c.emits))"
    return spans.select(*rows.columns, F.expr(f"if(size(_spans) > 0, {emitted}, cast(array() as array<{ANNOTATION}>))").alias(out))


def annotate(rows: DataFrame, phases: dict[str, list[Rule]], text_col: str = "text", contexts_col: str | None = None, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``(keys, phase, start, end, type, subtype, rule, text, other, action)`` for every text of ``rows``; null texts have none."""
    seen = rows.select(*dict.fromkeys([*keys, text_col, *([contexts_col] if contexts_col else [])]))
    names = {f"_p{k}": name for k, name in enumerate(phases)}
    for column, name in names.items():
        seen = with_phase(seen, phases[name], column, text_col, contexts_col)
    tagged = [f"transform(`{column}`, a -> named_struct('phase', {quoted(name)}, {', '.join(f"'{c}', a.{c}" for c in FIELDS)}))" for column, name in names.items()]
    return seen.select(*keys, F.expr(f"explode_outer(concat({', '.join(tagged)}))").alias("a")).where("a is not null").select(*keys, "a.*")


#: At most so many texts are annotated once for all rows that hold them; longer texts than this are not looked up.
RECURRING, SHORT = 100_000, 256


def annotate_recurring(rows: DataFrame, phases: dict[str, list[Rule]], keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """As ``annotate``, for many short texts of which many are equal, such as fields: a text that recurs is annotated once."""
    return of_recurring(rows, lambda texts, by: annotate(texts, phases, keys=by), keys)


def of_recurring(rows: DataFrame, find: Callable[[DataFrame, tuple[str, ...]], DataFrame], keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``find(rows, keys)``, the spans in texts by keys, for many short texts of which many are equal: what recurs is looked at once.

    Texts are counted; those that make up 1 in RECURRING of all rows, so RECURRING
    of them at most, go through ``find`` and are broadcast with their spans. Rows
    with any other text go through it by themselves, if there are any.
    """
    seen = rows.select(*dict.fromkeys([*keys, "text"]))
    total = seen.count()
    least = max(2, -(-total // RECURRING))
    often = written(seen.where(F.length("text") <= SHORT).groupBy("text").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least))
    spans = find(often.select("text", F.col("text").alias("_text_key")), ("_text_key",))
    columns = [c for c in spans.columns if c != "_text_key"]
    known = written(often.join(spans.groupBy("_text_key").agg(F.collect_list(F.struct(*columns)).alias("_a")), often["text"] == F.col("_text_key"), "left").select(F.col("text").alias("_text_key"), "_a"))
    looked_up = seen.join(F.broadcast(known), F.col("text") == F.col("_text_key")).select(*keys, F.explode_outer("_a").alias("a")).where("a is not null").select(*keys, "a.*")
    if (often.agg(F.sum("_n")).first()[0] or 0) == total:
        return looked_up
    rest = seen.join(F.broadcast(known.select("_text_key")), F.col("text") == F.col("_text_key"), "left_anti")
    return looked_up.unionByName(find(rest, keys))
