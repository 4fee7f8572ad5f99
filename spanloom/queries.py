"""Registered queries of the library's operators, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom import templates as t
from spanloom.functions import dates as fd
from spanloom.functions import names as fn
from spanloom.functions.paths import path_matches
from spanloom.functions.text import TOKEN, context, kind, matches, orth, xml_escape
from spanloom.functions.text import tokens as tokens_of
from spanloom.operators import contexts, diagnosis, evaluate, features, fields, lexicon, lookup_rules, resolve, substitute, tokens
from spanloom.operators.actions import acted, with_features
from spanloom.operators.names import name_annotations
from spanloom.functions import spans as spans_fn
from spanloom.operators.rules import RULE_ROW, Rule, annotate, annotate_recurring, of_recurring, rules_of
from spanloom.plans.deidentify import Settings, deidentify, deidentify_reports, report_spans
from spanloom.plans.stages import written
from spanloom.rulesets import dates, others
from spanloom.sources import reports
from spanloom.sources.spread import spread
from spanloom.streaming.stream import windowed_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
FLAGSHIP = "q_scrub_documents"


def register(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- tokens -----------------------------------------------------------------

SQL_TOKENS = f"""with a as (select doc_id, regexp_extract_all(text, '{TOKEN}') as l from documents),
b as (select doc_id, generate_subscripts(l, 1) - 1 as tok_idx, unnest(l) as string from a),
t as (select doc_id, tok_idx, string, cast(coalesce(sum(length(string)) over (partition by doc_id order by tok_idx rows between unbounded preceding and 1 preceding), 0) as int) as s,
 case when regexp_matches(string, '^\\p{{L}}') then 'word' when regexp_matches(string, '^\\p{{N}}') then 'number' when contains(string, chr(10)) then 'newline' when regexp_matches(string, '^\\s') then 'space' else 'punctuation' end as kind,
 case when regexp_matches(string, '^\\p{{Lu}}\\p{{Ll}}+$') then 'upperInitial' when regexp_matches(string, '^\\p{{Lu}}+$') then 'allCaps' when regexp_matches(string, '^\\p{{Ll}}+$') then 'lowercase' when regexp_matches(string, '^\\p{{L}}+$') then 'mixedCaps' end as orth from b)"""


def doc_tokens(spark, sf):
    return tokens.token_table(read(spark, sf, "documents").select("doc_id", "text"))


@register("q_tokens_per_doc", SQL_TOKENS + " select doc_id, count(*) as n_tokens from t group by doc_id")
def _(spark, sf):
    return doc_tokens(spark, sf).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_tokens"))


@register("q_token_kinds", SQL_TOKENS + " select kind, count(*) as n, cast(sum(length(string)) as bigint) as n_chars from t group by kind")
def _(spark, sf):
    return doc_tokens(spark, sf).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("n_chars"))


@register("q_token_orth", SQL_TOKENS + " select orth, count(*) as n from t where orth is not null group by orth")
def _(spark, sf):
    return doc_tokens(spark, sf).where("orth is not null").groupBy("orth").agg(F.count(F.lit(1)).alias("n"))


@register("q_token_offsets", SQL_TOKENS + ' select doc_id, cast(sum(s) as bigint) as sum_start, cast(max(s + length(string)) as int) as last_end, max(tok_idx) as last_idx from t group by doc_id')
def _(spark, sf):
    return doc_tokens(spark, sf).groupBy("doc_id").agg(F.sum("start").alias("sum_start"), F.max("end").alias("last_end"), F.max("tok_idx").cast("long").alias("last_idx"))


SQL_SENTENCES = SQL_TOKENS + """, u as (select *, lag(string) over (partition by doc_id order by tok_idx) as before from t),
v as (select *, case when string in ('!', '?') or kind = 'newline' or (string = '.' and not coalesce(before in ('bzw','ca','Dr','Prof','St','Nr','Tel','vgl') or regexp_matches(before, '^(\\p{L}|\\p{N}+)$'), false)) then 1 else 0 end as stop from u),
w as (select *, cast(coalesce(sum(stop) over (partition by doc_id order by tok_idx rows between unbounded preceding and 1 preceding), 0) as bigint) as sentence_nr from v),
x as (select doc_id, sentence_nr, min(s) as a, max(s + length(string)) as b, count(*) as n from w where kind not in ('space', 'newline') group by all)"""


@register("q_sentences", SQL_SENTENCES + " select doc_id, count(*) as n_sentences, cast(sum(a) as bigint) as sum_start, cast(sum(b) as bigint) as sum_end, max(n) as longest from x group by doc_id")
def _(spark, sf):
    return tokens.text_sentences(read(spark, sf, "documents").select("doc_id", "text")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_sentences"), F.sum("start").alias("sum_start"), F.sum("end").alias("sum_end"), F.max("token_count").alias("longest"))


@register("q_sentence_adjust", """with l as (select conv_id * 1000 + turn as doc_id, unnest(string_split(text, chr(10))) as line from conversations)
select doc_id, count(*) as n_sentences, cast(sum(length(line)) as bigint) as n_chars from l where length(line) > 0 group by doc_id""")
def _(spark, sf):
    docs = read(spark, sf, "conversations").selectExpr("conv_id * 1000 + turn as doc_id", "text")
    whole = docs.select("doc_id", F.lit(0).alias("start"), F.length("text").alias("end"))
    leaves = docs.select("doc_id", F.explode(matches("text", "[^\n]+")).alias("m")).select("doc_id", "m.start", "m.end")
    return tokens.adjust_sentences(whole, leaves).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_sentences"), F.sum(F.col("end") - F.col("start")).alias("n_chars"))


@register("q_field_sentences", SQL_SENTENCES + """, y as (select *, case when s + length(string) <= 100 * (s // 100 + 1) then s // 100 end as field from w)
select doc_id, count(*) as n_sentences, cast(sum(n) as bigint) as n_tokens, cast(sum(m) as bigint) as n_work_tokens, cast(sum(a) as bigint) as sum_start, cast(sum(b) as bigint) as sum_end, count_if(field is null) as n_between
from (select doc_id, sentence_nr, field, count(*) as n, count_if(kind not in ('space', 'newline')) as m, min(case when kind not in ('space', 'newline') then s end) as a, max(case when kind not in ('space', 'newline') then s + length(string) end) as b from y group by all having count_if(kind not in ('space', 'newline')) > 0) group by doc_id""")
def _(spark, sf):
    """Sentences of whole documents cut at fields of a hundred characters, with their tokens counted."""
    docs = read(spark, sf, "documents").select("doc_id", "text")
    bins = F.sequence(F.lit(0), F.floor(F.length("text") / 100).cast("int"))
    leaves = docs.select("doc_id", F.explode(bins).alias("field_id")).select("doc_id", "field_id", (F.col("field_id") * 100).alias("start"), (F.col("field_id") * 100 + 100).alias("end"))
    found = tokens.text_field_sentences(docs, leaves)
    return found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_sentences"), F.sum("token_count").alias("n_tokens"), F.sum("work_token_count").alias("n_work_tokens"), F.sum("start").alias("sum_start"), F.sum("end").alias("sum_end"), F.count_if(F.col("field_id").isNull()).alias("n_between"))


@register("q_token_window", SQL_TOKENS + """, w as (select doc_id, row_number() over (partition by doc_id order by tok_idx) - 1 as i, string = 'the' as hit from t where kind <> 'space'),
x as (select *, max(hit) over (partition by doc_id order by i rows between 2 preceding and 2 following) as near from w) select doc_id, count_if(near) as n_near from x group by doc_id""")
def _(spark, sf):
    words = tokens.work_tokens(doc_tokens(spark, sf)).withColumn("hit", F.col("string") == "the")
    return tokens.window_flag(words, "hit", 2).groupBy("doc_id").agg(F.count_if("near_hit").alias("n_near"))


# --- lexica -----------------------------------------------------------------

LEXICON = [("the", "stop", "stop", "en"), ("of the", "general", "general", "en"), ("Is", "stop", "stop", "en"), ("and", "stop", "stop", "en"), ("and the", "general", "general", "en"), ("the the", "location", "false_positives", "en"), ("of", "location", "city", "en"), ("la", "location", "city", "fr"), ("la", "location", "city_ambiguous", "fr"), ("der", "medical", "medical", "de"), ("die", "name", "firstname", "de"), ("In", "name", "surname", "de")]
LEXICON_SQL = "lex(term, major, minor, language) as (values " + ", ".join(f"('{a}', '{b}', '{c}', '{d}')" for a, b, c, d in LEXICON) + ")"
SQL_LOOKUPS = SQL_TOKENS + f""", {LEXICON_SQL},
w as (select *, s + length(string) as e from t where kind <> 'space'),
g1 as (select doc_id, s, e, string as gram from w),
g2 as (select doc_id, s, lead(e) over (partition by doc_id order by tok_idx) as e, string || ' ' || lead(string) over (partition by doc_id order by tok_idx) as gram from w),
h as (select doc_id, s, e, term, major, minor, language from (select * from g1 union all select * from g2) join lex on gram = term),
hits as (select * from h qualify row_number() over (partition by doc_id, s, major, minor order by e desc, term, language) = 1)"""


def lex(spark):
    return lexicon.read_lexicon(spark.createDataFrame(LEXICON, "term string, major string, minor string, language string"))


def doc_hits(spark, sf):
    return lexicon.text_lookups(read(spark, sf, "documents").select("doc_id", "text"), lex(spark))


@register("q_lexicon_lookup", SQL_LOOKUPS + ' select doc_id, major, minor, count(*) as n, cast(sum(s) as bigint) as sum_start from hits group by all')
def _(spark, sf):
    return doc_hits(spark, sf).groupBy("doc_id", "major", "minor").agg(F.count(F.lit(1)).alias("n"), F.sum("start").alias("sum_start"))


@register("q_ngram_lookup", SQL_LOOKUPS + " select term, count(*) as n, count(distinct doc_id) as n_docs from hits where contains(term, ' ') group by term")
def _(spark, sf):
    return doc_hits(spark, sf).where(F.col("term").contains(" ")).groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("n_docs"))


STAND_IN_SQL = "ls(nr, major, minor, language, share) as (values " + ", ".join(f"({k}, '{a}', '{b}', '{c}', '{n:02x}')" for k, (a, b, c, n) in enumerate(lexicon.STAND_INS)) + ")"


@register("q_lexicon_stand_ins", SQL_TOKENS + f""", {STAND_IN_SQL}, ws as materialized (select distinct string as term from t where kind = 'word' and length(string) > 2),
lx as materialized (select term, major, minor, min(language) as language from ws, ls where substring(md5(term || ':0:' || cast(nr as varchar)), 1, 2) < share group by all having true)
select major, minor, count(*) as n, count(distinct term) as n_terms, cast(sum(s) as bigint) as sum_start from (select distinct doc_id, s, term, major, minor from t join lx on t.string = lx.term) group by major, minor""")
def _(spark, sf):
    """Lookups at the size of real lists: all words of the documents, dealt to fourteen lists that overlap."""
    docs = read(spark, sf, "documents").select("doc_id", "text")
    words = docs.select(F.explode(F.array_distinct(tokens_of("text"))).alias("term")).distinct().where((kind("term") == "word") & (F.length("term") > 2))
    hits = lexicon.text_lookups(docs, written(lexicon.stand_ins(words)))
    return hits.groupBy("major", "minor").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("term").alias("n_terms"), F.sum("start").alias("sum_start"))


SUFFIXES = [("tion", "medical"), ("ing", "name"), ("eux", "name")]


@register("q_suffix_lookup", SQL_TOKENS + ", suf(term, major) as (values " + ", ".join(f"('{a}', '{b}')" for a, b in SUFFIXES) + ") select major, term, count(*) as n from t join suf on string <> term and ends_with(string, term) where regexp_matches(string, '^\\p{Lu}') group by all")
def _(spark, sf):
    suffixes = spark.createDataFrame(SUFFIXES, "term string, major string")
    found = lexicon.suffix_lookups(tokens.work_tokens(doc_tokens(spark, sf)), suffixes)
    return found.withColumn("term", F.coalesce(*[F.when(F.col("string").endswith(s), F.lit(s)) for s, _ in SUFFIXES])).groupBy("major", "term").agg(F.count(F.lit(1)).alias("n"))


@register("q_direct_annotations", SQL_LOOKUPS + " select 'Location' as type, 'city' as subtype, count(*) as n from hits where major = 'location' and minor = 'city'")
def _(spark, sf):
    return lexicon.direct_annotations(doc_hits(spark, sf)).groupBy("type", "subtype").agg(F.count(F.lit(1)).alias("n"))


@register("q_lookup_false_positive", SQL_LOOKUPS + """, bad as (select * from hits where minor in ('false_positives', 'city_ambiguous')), c as (select * from hits where major = 'location' and minor = 'city')
select term, count(*) as n from c where not exists (select 1 from bad where bad.doc_id = c.doc_id and c.s < bad.e and bad.s < c.e) group by term""")
def _(spark, sf):
    hits = doc_hits(spark, sf)
    return lexicon.without_false_positives(lexicon.direct_annotations(hits), hits).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


NAME_LEXICON = [("Bodo", "name", "firstname", ""), ("Mila", "name", "firstname", ""), ("Nope", "name", "surname", ""), ("Rasu", "name", "surname", ""), ("Tevi", "medical", "medical", "")]


@register("q_rule_names_lexicon", """with n(f, l) as (values ('Bodo', 'Nope'), ('Mila', 'Rasu'))
select cast(s_suppkey as bigint) as doc_id, 4 as "start", cast(4 + length(f) + 1 + length(l) as int) as "end", 'Name' as type, 'other' as subtype, 'UniqueNameOrSurname' as rule from supplier, n where (s_suppkey % 4 < 2) = (f = 'Bodo')""")
def _(spark, sf):
    first, last = "if(s_suppkey % 4 < 2, 'Bodo', 'Mila')", "if(s_suppkey % 4 < 2, 'Nope', 'Rasu')"
    docs = read(spark, sf, "supplier").selectExpr("s_suppkey as doc_id", f"concat('das ', if(s_suppkey % 2 = 0, concat({first}, ' ', {last}), concat({last}, ' ', {first})), ' sagt') as text")
    words = tokens.work_tokens(tokens.token_table(docs))
    found = name_annotations(words, lexicon.lookups(words, lexicon.read_lexicon(spark.createDataFrame(NAME_LEXICON, "term string, major string, minor string, language string"))))
    return found.select("doc_id", "start", "end", "type", "subtype", "rule")


# --- rules over sentences put together from columns --------------------------


def templated(name: str, table: str, key: str, templates: list, phases: dict[str, list[Rule]]) -> None:
    @register(name, t.expected_sql(table, key, templates))
    def _(spark, sf):
        found = t.annotated(spark, read(spark, sf, table), key, templates, phases)
        return found.select("doc_id", "start", "end", "type", "subtype", "text")


templated("q_rule_dates", "orders", "o_orderkey", t.DATES, {"Dates": dates.RULES})
templated("q_rule_age", "part", "p_partkey", t.AGES, {"Age": others.AGE})
templated("q_rule_contacts", "orders", "o_orderkey", t.CONTACTS, {"Contacts": others.CONTACTS, "Internet": others.INTERNET})
templated("q_rule_ids", "orders", "o_orderkey", t.IDS, {"IDs": others.IDS})
templated("q_rule_locations", "customer", "c_custkey", t.LOCATIONS, {"Locations": others.LOCATIONS})
templated("q_rule_occupations", "customer", "c_custkey", t.OCCUPATIONS, {"Occupations": others.OCCUPATIONS})
templated("q_rule_names", "supplier", "s_suppkey", t.PERSONS, {"Names": others.NAMES})

FIELD_CASES: list[tuple[str, list]] = [
    ("PatName", [(f"upper({t.SUPPLIER}) || ' ' || ({t.SUPPLIER})", ("Name", "patient"))]),
    ("AgeField", [("cast(s_suppkey % 90 + 1 as string)", ("Age", ""))]),
    ("AddressField", [(f"({t.SUPPLIER}) || 'weg 3, ' || ({t.SUPPLIER})", ("Address", "other"))]),
    ("LocationDateField", [(t.SUPPLIER, ("Location", "city")), ("', den '", None), ("'0' || cast(s_suppkey % 9 + 1 as string) || '.05.2012'", ("Date", "other"))]),
    ("OrtDat", [(t.SUPPLIER, ("Location", "city")), ("', '", None), ("'01.05.2012'", ("Date", "other")), ("' / '", None), ("'ABC'", ("Name", "medical staff"))]),
    ("Verlauf", [("'Notiz #'", None), ("cast(10000 + s_suppkey as string)", ("ID", "patient ID"))]),
    ("none", [("'Notiz #'", None), ("cast(10000 + s_suppkey as string)", None)]),
]


@register("q_rule_fields", t.expected_sql("supplier", "s_suppkey", [c[1] for c in FIELD_CASES]))
def _(spark, sf):
    kinds = F.array(*[F.lit(c[0]) for c in FIELD_CASES])
    docs = t.texts(spark, read(spark, sf, "supplier"), "s_suppkey", [c[1] for c in FIELD_CASES]).withColumn("contexts", F.array(F.get(kinds, (F.col("doc_id") % 100).cast("int"))))
    kept = {"Fields": [r for r in others.FIELDS + others.IDS if r.context is not None]}
    return annotate(docs, kept, contexts_col="contexts").select("doc_id", "start", "end", "type", "subtype", "text")


# --- rules over the documents -----------------------------------------------

CONTACT_RULES = [others.INTERNET[0], *[r for r in others.CONTACTS + others.IDS if r.name in ("NorthAmericanNumber", "NetworkAddress", "CardNumber")]]
SCRUB = {"Contacts": CONTACT_RULES}
SQL_EMAIL = r"[A-Za-z0-9]+(?:[._][A-Za-z0-9]+)*@(?:[A-Za-z0-9]+(?:-[A-Za-z0-9]+)*\.)+(?:info|com|net|org|ch|de|fr|li|eu)\b"
SQL_PHONE, SQL_IP, SQL_CARD = r"\([0-9]{3}\) [0-9]{3}-[0-9]{4}", r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", "[0-9]{16}"
# A label is marked by chr(1); bounded patterns run twice, as neighbours share what bounds them.
SQL_MARKED = f"regexp_replace(regexp_replace(text, '{SQL_EMAIL}', chr(1) || 'EMAIL', 'g'), '{SQL_PHONE}', chr(1) || 'PHONE', 'g')"
for _pattern, _label in ((SQL_IP, "WEBSITE"), (SQL_CARD, "ID")) * 2:
    SQL_MARKED = f"regexp_replace({SQL_MARKED}, '(^|[^0-9]){_pattern}($|[^0-9])', '\\1' || chr(1) || '{_label}\\2', 'g')"


def contact_spans(spark, sf):
    return annotate(read(spark, sf, "documents").select("doc_id", "text"), SCRUB)


@register("q_scrub_documents", f"with m as (select doc_id, {SQL_MARKED} as t from documents) select doc_id, cast(length(t) - length(replace(t, chr(1), '')) as bigint) as n_spans, md5(replace(t, chr(1), '')) as text_md5 from m")
def scrub_documents(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text")
    spans = contact_spans(spark, sf)
    counts = spans.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_spans"))
    out = substitute.substitute(docs, spans.withColumn("text", F.lit("")), substitute.Policy())
    return out.join(counts, "doc_id", "left").select("doc_id", F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.md5("text").alias("text_md5"))


@register("q_scrub_by_type", f"""with m as (select unnest(regexp_extract_all({SQL_MARKED}, chr(1) || '(EMAIL|PHONE|WEBSITE|ID)', 1)) as label from documents)
select case label when 'ID' then 'ID' else 'Contact' end as type, case label when 'EMAIL' then 'email' when 'PHONE' then 'phone number' when 'WEBSITE' then 'website' else 'other' end as subtype, count(*) as n from m group by all""")
def _(spark, sf):
    return contact_spans(spark, sf).groupBy("type", "subtype").agg(F.count(F.lit(1)).alias("n"))


@register("q_rule_email", f"select doc_id, unnest(regexp_extract_all(text, '{SQL_EMAIL}')) as text from documents")
def _(spark, sf):
    return annotate(read(spark, sf, "documents").select("doc_id", "text"), {"Internet": [others.INTERNET[0]]}).select("doc_id", "text")


@register("q_replacement_tags", f"select doc_id, md5(regexp_replace(text, '({SQL_PHONE})', '[&[Contact;\\1;rule=NorthAmericanNumber;subtype=phone number]&]', 'g')) as text_md5 from documents")
def _(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text")
    spans = annotate(docs, {"c": [r for r in CONTACT_RULES if r.name == "NorthAmericanNumber"]})
    return substitute.substitute(docs, spans, substitute.Policy(substitute.Method.REPLACEMENT_TAGS)).select("doc_id", F.md5("text").alias("text_md5"))


@register("q_tags_valid", "select true as valid, count(*) as n from documents")
def _(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text")
    out = substitute.substitute(docs, contact_spans(spark, sf), substitute.Policy(substitute.Method.REPLACEMENT_TAGS))
    return out.groupBy(substitute.tags_valid(F.col("text")).alias("valid")).agg(F.count(F.lit(1)).alias("n"))


@register("q_identity_roundtrip", "select doc_id, md5(text) as text_md5 from documents")
def _(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text")
    return substitute.substitute(docs, contact_spans(spark, sf), substitute.Policy(substitute.Method.IDENTITY)).select("doc_id", F.md5("text").alias("text_md5"))


@register("q_context_strings", f"""with a as (select doc_id, text, unnest(regexp_extract_all(text, '{SQL_PHONE}')) as m from documents)
select doc_id, m as text, substring(text, greatest(strpos(text, m) - 10, 1), strpos(text, m) - greatest(strpos(text, m) - 10, 1)) as before, substring(text, strpos(text, m) + 14, 10) as after from a""")
def _(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", F.col("text").alias("whole"))
    spans = contact_spans(spark, sf).where("rule = 'NorthAmericanNumber'")
    first = spans.withColumn("start", F.min("start").over(Window.partitionBy("doc_id", "text")))
    before, after = context("whole", F.col("start"), F.col("start") + F.length("text"), 10)
    return first.join(docs, "doc_id").select("doc_id", "text", before.alias("before"), after.alias("after"))


@register("q_context_places", f"""with a as (select doc_id, text, string_split_regex(text, '{SQL_PHONE}') as p from documents),
b as (select doc_id, text, p, unnest(range(1, len(p))) as k from a), c as (select doc_id, text, cast(list_sum(list_transform(p[1:k], lambda x: length(x))) + 14 * (k - 1) as int) as "start" from b)
select doc_id, "start", substring(text, "start" + 1, 14) as text, substring(text, greatest("start" - 10, 0) + 1, "start" - greatest("start" - 10, 0)) as before, substring(text, "start" + 15, 10) as after from c""")
def _(spark, sf):
    """What is around every number, at its own place."""
    docs = read(spark, sf, "documents").select("doc_id", F.col("text").alias("whole"))
    spans = contact_spans(spark, sf).where("rule = 'NorthAmericanNumber'")
    before, after = context("whole", F.col("start"), F.col("end"), 10)
    return spans.join(docs, "doc_id").select("doc_id", "start", "text", before.alias("before"), after.alias("after"))


@register("q_deidentify")
def _(spark, sf):
    """The whole chain over whole documents: all text phases, conflicts, labels. Its SQL would restate every rule; tests hold it against invariants."""
    return deidentify(read(spark, sf, "documents").select("doc_id", "text"), substitute.Policy()).select("doc_id", F.md5("text").alias("text_md5"))


@register("q_appelt_longest", r"""select doc_id, cast(count(*) as bigint) as n, cast(sum(length(m)) as bigint) as n_chars from (select doc_id, unnest(regexp_extract_all(text, 'the [a-z]+|the')) as m from documents) group by doc_id""")
def _(spark, sf):
    rules = [Rule("Short", "()(the)", ((2, "A", ""),), 100), Rule("Long", "()(the [a-z]+)", ((2, "A", ""),))]
    return annotate(read(spark, sf, "documents").select("doc_id", "text"), {"p": rules}).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("n_chars"))


@register("q_appelt_priority", r"""select rule, count(*) as n from (select 'High' as rule, unnest(regexp_extract_all(text, 'tion[a-z]')) as m from documents) group by rule""")
def _(spark, sf):
    rules = [Rule("Low", "()(tion[a-z])", ((2, "A", ""),)), Rule("High", "()(tion)([a-z])", ((2, "A", ""),), 5)]
    return annotate(read(spark, sf, "documents").select("doc_id", "text"), {"p": rules}).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@register("q_negative_rule", r"""select doc_id, cast(count(*) as bigint) as n from (select doc_id, unnest(regexp_extract_all(text, 'ation of|ation')) as m from documents) where m = 'ation' group by doc_id""")
def _(spark, sf):
    rules = [Rule("Positive", "()(ation)", ((2, "A", ""),)), Rule("Negative", "(ation of)")]
    return annotate(read(spark, sf, "documents").select("doc_id", "text"), {"p": rules}).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


# --- dates and names ----------------------------------------------------------

SQL_D = "lpad(cast(day(o_orderdate) as varchar), 2, '0') || '.' || lpad(cast(month(o_orderdate) as varchar), 2, '0') || '.' || cast(year(o_orderdate) as varchar)"


def dotted(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", "o_orderdate", F.date_format("o_orderdate", "dd.MM.yyyy").alias("text"))


@register("q_date_features", f"select o_orderkey, cast(day(o_orderdate) as varchar) as day, cast(month(o_orderdate) as varchar) as month, cast(year(o_orderdate) as varchar) as year, 'dd.MM.yyyy' as format from orders")
def _(spark, sf):
    return dotted(spark, sf).select("o_orderkey", fd.date_parts(F.col("text")).alias("p")).select("o_orderkey", "p.*")


@register("q_date_range_features", """with o as (select o_orderkey, cast(o_orderdate as date) as d, cast(o_orderdate as date) + 9 as e, o_orderkey % 4 as k from orders where year(o_orderdate) between 1990 and 2029),
x as (select o_orderkey, 1 as nr, case when k < 2 then day(d) end as dd, case k when 0 then month(e) when 1 then month(d) when 2 then month(d) end as mm, case when k < 3 then year(e) else year(d) end as yy, case k when 0 then 'dd.' when 1 then 'dd.MM.' when 2 then 'MM' else 'yyyy' end as format from o
union all select o_orderkey, 2, case when k < 2 then day(e) end, case when k < 3 then month(e) end, year(e), case when k < 2 then 'dd.MM.yyyy' when k = 2 then 'MM/yyyy' else 'yy' end from o)
select o_orderkey, cast(nr as int) as nr, cast(dd as varchar) as day, cast(mm as varchar) as month, cast(yy as varchar) as year, format from x""")
def _(spark, sf):
    """Both ends of ranges found by the date rules; what one end lacks is that of the other."""
    d, e = F.to_date("o_orderdate"), F.date_add("o_orderdate", 9)
    put = lambda c, f: F.date_format(c, f)
    text = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.dayofmonth(d).cast("string"), F.lit(". bis "), put(e, "dd.MM.yyyy"))).when(F.col("o_orderkey") % 4 == 1, F.concat(put(d, "dd.MM."), F.lit(" - "), put(e, "dd.MM.yyyy")))
    text = text.when(F.col("o_orderkey") % 4 == 2, F.concat(put(d, "MM"), F.lit(" - "), put(e, "MM/yyyy"))).otherwise(F.concat(put(d, "yyyy"), F.lit("/"), put(e, "yy")))
    docs = read(spark, sf, "orders").where(F.year("o_orderdate").between(1990, 2029)).select(F.col("o_orderkey").alias("doc_id"), text.alias("text"))
    spans = with_features(annotate(docs, {"Dates": dates.RULES}))
    nr = F.row_number().over(Window.partitionBy("doc_id").orderBy("start"))
    told = [F.try_element_at("features", F.lit(k)).alias(k) for k in ("day", "month", "year", "format")]
    return spans.select(F.col("doc_id").alias("o_orderkey"), nr.alias("nr"), *told)


@register("q_rule_actions", """with c as (select c_custkey as doc_id, lpad(cast(c_custkey % 28 + 1 as varchar), 2, '0') || '.03.2012' as d, c_custkey % 3 as k from customer)
select doc_id, 'Date' as type, d as text, cast(doc_id % 28 + 1 as varchar) as day, cast(null as varchar) as lastname from c
union all select doc_id, 'Name', 'Bodo NOPE', null, 'NOPE' from c union all select doc_id, 'Code', 'AB CD EF', null, null from c where k <> 1""")
def _(spark, sf):
    """Rules kept as a table whose rows name their actions: dates and names with features, a run of codes as one span, codes in brackets deleted."""
    table = spark.createDataFrame(
        [("d", r"()([0-9]{2}\.[0-9]{2}\.[0-9]{4})", [(2, "Date", "other")], None, None, None, "emit_date"), ("n", r"(Herr )(\p{Lu}\p{Ll}+ \p{Lu}+)", [(2, "Name", "patient")], None, None, None, "emit_name"), ("c", r"()(\b[A-Z]{2}\b)", [(2, "Code", "")], None, None, None, "merge_sequence"), ("x", r"(\[[A-Z ]+\])", [(1, "Code", "")], 100, None, None, "delete")],
        RULE_ROW + ", action string",
    )
    codes = F.when(F.col("c_custkey") % 3 == 1, "[AB CD EF]").otherwise("AB CD EF")
    docs = read(spark, sf, "customer").select(F.col("c_custkey").alias("doc_id"), F.concat(F.lit("am "), F.lpad((F.col("c_custkey") % 28 + 1).cast("string"), 2, "0"), F.lit(".03.2012 Herr Bodo NOPE, "), codes).alias("text"))
    spans = acted(annotate(docs, {"p": rules_of(table)}))
    return spans.select("doc_id", "type", "text", F.try_element_at("features", F.lit("day")).alias("day"), F.try_element_at("features", F.lit("lastname")).alias("lastname"))


@register("q_date_best_format", "select o_orderkey, case o_orderkey % 3 when 0 then 'dd.MM.yyyy' when 1 then 'yyyy-MM-dd' end as format from orders")
def _(spark, sf):
    text = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "dd.MM.yyyy")).when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("kein Datum")
    return read(spark, sf, "orders").select("o_orderkey", fd.best_format(text).alias("format"))


@register("q_date_formats", """with o as (select o_orderkey, cast(o_orderdate as date) as d, o_orderkey % 16 as k from orders), p as (select *, day(d) >= 10 and month(d) >= 10 as wide, month(d) >= 10 as late, month(d) = 2 and day(d) = 29 as leap from o)
select o_orderkey, case k when 0 then 'dd.MM.yyyy' when 1 then case when wide then 'dd.MM.yyyy' else 'd.M.yyyy' end when 2 then 'dd.MM.yy' when 3 then case when wide then 'dd.MM.yy' else 'd.M.yy' end when 4 then 'dd/MM/yyyy' when 5 then 'dd/MM/yy' when 6 then 'yyyy-MM-dd' when 7 then 'MM/yyyy'
 when 8 then case when late then 'MM/yyyy' else 'M/yyyy' end when 9 then 'MM.yyyy' when 10 then 'MM/yy' when 11 then case when late then 'MM/yy' else 'M/yy' end when 12 then case when not leap then 'dd.MM.' end when 13 then case when leap then null when wide then 'dd.MM.' else 'd.M.' end when 14 then case when not leap then 'dd.MM' end else 'yyyy' end as format from p""")
def _(spark, sf):
    """Every format, written and found again."""
    text = F.coalesce(*[F.when(F.col("o_orderkey") % 16 == k, F.date_format("o_orderdate", f)) for k, f in enumerate(fd.FORMATS)])
    return read(spark, sf, "orders").select("o_orderkey", fd.best_format(text).alias("format"))


@register("q_slash_guard", """select l_orderkey, l_linenumber, case when l_partkey % 9 + 1 > l_suppkey % 90 + 10 then true else l_partkey % 2 = 0 end as is_date from lineitem""")
def _(spark, sf):
    month = F.when(F.col("l_partkey") % 2 == 0, F.concat(F.lit("0"), (F.col("l_partkey") % 9 + 1).cast("string"))).otherwise((F.col("l_partkey") % 9 + 1).cast("string"))
    return read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", fd.is_slash_date(month, (F.col("l_suppkey") % 90 + 10).cast("string")).alias("is_date"))


@register("q_full_year", "select o_orderkey, cast(case when year(o_orderdate) % 100 < 50 then 2000 else 1900 end + year(o_orderdate) % 100 as int) as full_year from orders")
def _(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", fd.full_year(F.date_format("o_orderdate", "yy")).alias("full_year"))


@register("q_month_names", "select o_orderkey, cast(month(o_orderdate) as int) as month_number from orders")
def _(spark, sf):
    name = F.element_at(F.array(*[F.lit(m) for m in fd.MONTHS_DE]), F.month("o_orderdate"))
    return read(spark, sf, "orders").select("o_orderkey", fd.month_number(F.when(F.col("o_orderkey") % 2 == 0, F.upper(name)).otherwise(name)).alias("month_number"))


@register("q_date_shift", "select o_orderkey, strftime(cast(o_orderdate as date) - cast(o_custkey % 30 + 1 as int), '%d.%m.%Y') as shifted from orders")
def _(spark, sf):
    rows = read(spark, sf, "orders").select("o_orderkey", "o_custkey", fd.date_parts(F.date_format("o_orderdate", "dd.MM.yyyy")).alias("p"))
    moved = rows.withColumn("day", fd.as_date(F.col("p"), F.lit(0))).withColumn("moved", F.date_sub("day", (F.col("o_custkey") % 30 + 1).cast("int")))
    return moved.select("o_orderkey", fd.format_date(F.col("moved"), F.col("p.format")).alias("shifted"))


@register("q_date_shift_consistent", "select count(*) as n, true as same_gap from orders")
def _(spark, sf):
    """All dates of a document move by the same number of days, within the bounds."""
    policy = substitute.Policy(substitute.Method.DATE_SHIFT, min_days=10, max_days=200, seed=7)
    docs = read(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"), F.concat(F.date_format("o_orderdate", "dd.MM.yyyy"), F.lit(" bis "), F.date_format(F.date_add("o_orderdate", 9), "dd.MM.yyyy")).alias("text"), F.to_date("o_orderdate").alias("d"))
    spans = annotate(docs, {"d": [dates.RULES[0]]}, keys=("doc_id",))
    out = substitute.substitute(docs, spans, policy)
    first, last = (F.to_date(F.substring("text", k, 10), "dd.MM.yyyy") for k in (1, 16))
    back = F.datediff("d", first)
    return out.select(((F.datediff(last, first) == 9) & (back >= 10) & (back < 200)).alias("ok")).agg(F.count(F.lit(1)).alias("n"), F.bool_and("ok").alias("same_gap"))


@register("q_name_parts", f"select s_suppkey, 'Herr' as salutation, {t.SUPPLIER} as firstname, upper({t.SUPPLIER}) as lastname, 'ff LL' as format from supplier")
def _(spark, sf):
    return read(spark, sf, "supplier").selectExpr("s_suppkey", f"'Herr ' || ({t.SUPPLIER}) || ' ' || upper({t.SUPPLIER}) as text").select("s_suppkey", fn.name_parts(F.col("text")).alias("p")).select("s_suppkey", "p.*")


@register("q_name_format_cleanup", "select s_suppkey, case when s_suppkey % 2 = 0 then 'FF LL' else 'ff ll' end as formats from supplier")
def _(spark, sf):
    value = F.when(F.col("s_suppkey") % 2 == 0, "BODO NOPE").otherwise("Bodo Nope")
    return read(spark, sf, "supplier").select("s_suppkey", F.array_join(fn.clean_formats(F.array(F.lit("ll"), F.lit("ff ll"), F.lit("ff ll")), value), ",").alias("formats"))




def in_contexts(name: str, cases: list[tuple[str, list]], phases: dict[str, list[Rule]]) -> None:
    """Templates that are fields of a kind."""
    @register(name, t.expected_sql("supplier", "s_suppkey", [c[1] for c in cases]))
    def _(spark, sf):
        kinds = F.array(*[F.lit(c[0]) for c in cases])
        docs = t.texts(spark, read(spark, sf, "supplier"), "s_suppkey", [c[1] for c in cases]).withColumn("contexts", F.array(F.get(kinds, (F.col("doc_id") % 100).cast("int"))))
        return annotate(docs, phases, contexts_col="contexts").select("doc_id", "start", "end", "type", "subtype", "text")


templated("q_rule_dates_more", "orders", "o_orderkey", t.MORE_DATES, {"Dates": dates.RULES})
templated("q_rule_contacts_simple", "orders", "o_orderkey", t.MORE_CONTACTS, {"Contacts": others.SIMPLE_CONTACTS})
templated("q_rule_locations_more", "customer", "c_custkey", t.MORE_LOCATIONS, {"Locations": others.LOCATIONS})
templated("q_rule_buildings", "customer", "c_custkey", t.BUILDINGS, {"Buildings": others.BUILDINGS})
templated("q_rule_names_more", "supplier", "s_suppkey", t.MORE_PERSONS, {"Names": others.NAMES})
in_contexts("q_rule_fields_more", t.MORE_FIELDS, {"Fields": [*others.FIELDS, *others.IDS, *[r for r in others.OCCUPATIONS if r.context]]})


def looked_up(spark, docs, keys=("doc_id",)):
    words = tokens.work_tokens(tokens.token_table(docs, keys=keys), keys)
    return words, lexicon.text_lookups(docs, lexicon.read_lexicon(spark.createDataFrame(t.LOOKUP_LEXICON, "term string, major string, minor string, language string")), keys=keys)


def with_texts(docs: DataFrame, spans: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``spans`` with their texts.

    The join is shuffled: texts are exploded from templates, which Spark's
    estimate from the file's size leaves out, so it would broadcast them all.
    """
    return docs.hint("merge").join(spans, list(keys)).select(*keys, "start", "end", "type", "subtype", F.substring("text", F.col("start") + 1, F.col("end") - F.col("start")).alias("text"))


@register("q_rule_lookups", t.expected_sql("customer", "c_custkey", [c[1] for c in t.LOOKUPS]))
def _(spark, sf):
    docs = t.texts(spark, read(spark, sf, "customer"), "c_custkey", [c[1] for c in t.LOOKUPS])
    words, hits = looked_up(spark, docs)
    kinds = F.array(*[F.array(*[F.lit(k) for k in c[0]]).cast("array<string>") for c in t.LOOKUPS])
    where = docs.select("doc_id", F.lit(0).alias("start"), F.length("text").alias("end"), F.explode(F.get(kinds, (F.col("doc_id") % 100).cast("int"))).alias("context"))
    found = annotate_recurring(docs, {"Names": others.NAMES, "Locations": others.LOCATIONS})
    return with_texts(docs, lookup_rules.lookup_annotations(words, hits, where, found).select("doc_id", "start", "end", "type", "subtype").distinct())


@register("q_rule_traps", t.expected_sql("customer", "c_custkey", t.TRAPS))
def _(spark, sf):
    docs = t.texts(spark, read(spark, sf, "customer"), "c_custkey", t.TRAPS)
    words, hits = looked_up(spark, docs)
    spans = lookup_rules.without_traps(lexicon.direct_annotations(hits), words, hits)
    return spans.select("doc_id", "start", "end", "type", "subtype", F.col("term").alias("text"))


@register("q_rule_names_by_lexicon", t.expected_sql("customer", "c_custkey", t.LEXICON_NAMES))
def _(spark, sf):
    docs = t.texts(spark, read(spark, sf, "customer"), "c_custkey", t.LEXICON_NAMES)
    return of_recurring(docs, lambda texts, keys: with_texts(texts, name_annotations(*looked_up(spark, texts, keys), keys=keys).select(*keys, "start", "end", "type", "subtype"), keys))


# --- fields -------------------------------------------------------------------


def orders_with_customers(spark, sf):
    orders = read(spark, sf, "orders")
    return spread(orders.join(read(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")), "o_orderkey", counted=orders)


def order_reports(spark, sf):
    o = orders_with_customers(spark, sf)
    n = F.lit(None).cast("string").alias("Leer")
    content = F.to_json(F.struct(F.struct(F.col("c_name").alias("Name"), F.col("c_mktsegment").alias("Gruppe")).alias("Patient"), F.array(F.struct(F.col("o_orderpriority").alias("Text")), F.struct(F.col("o_orderstatus").alias("Text"))).alias("Eintrag"), n), {"ignoreNullFields": "false"})
    return o.select(F.col("o_orderkey").alias("doc_id"), content.alias("content"))


SQL_REPORTS = "with r as (select o_orderkey as doc_id, c_name, c_mktsegment, o_orderpriority, o_orderstatus from orders join customer on o_custkey = c_custkey)"


@register("q_field_flatten", SQL_REPORTS + """ select doc_id, 0 as field_id, 'Patient/Name' as path, c_name as value, 0 as "start" from r union all select doc_id, 1, 'Patient/Gruppe', c_mktsegment, cast(length(c_name) + 1 as int) from r
union all select doc_id, 2, 'Eintrag/LISTELEMENT/Text', o_orderpriority, cast(length(c_name) + length(c_mktsegment) + 2 as int) from r union all select doc_id, 3, 'Eintrag/LISTELEMENT/Text', o_orderstatus, cast(length(c_name) + length(c_mktsegment) + length(o_orderpriority) + 3 as int) from r
union all select doc_id, 4, 'Leer', null, cast(length(c_name) + length(c_mktsegment) + length(o_orderpriority) + length(o_orderstatus) + 4 as int) from r""")
def _(spark, sf):
    return fields.flatten(order_reports(spark, sf)).select("doc_id", "field_id", F.array_join("path", "/").alias("path"), "value", "start")


CONSTRAINTS = ["Text", "/Patient", "Patient/Name", "Eintrag//", "//LISTELEMENT/Text", "/Name", "//Na.*"]


def order_xml(spark, sf):
    """Orders as XML with attributes, text beside elements, entities and an empty element."""
    o = orders_with_customers(spark, sf)
    put = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    content = put("<report nr='", F.col("o_orderkey").cast("string"), "'>\n <patient group=\"", F.col("c_mktsegment"), "\">", F.col("c_name"), " &amp; <b>", F.col("o_orderpriority"), "</b> nach</patient><empty/></report>")
    return o.select(F.col("o_orderkey").alias("doc_id"), content.alias("content"))


SQL_XML = """with r as (select o_orderkey as doc_id, cast(o_orderkey as varchar) as nr, c_mktsegment as g, c_name as n, o_orderpriority as p from orders join customer on o_custkey = c_custkey)"""


@register("q_xml_leaves", SQL_XML + """ select doc_id, field_id, path, value, "start" from (select doc_id, 0 as field_id, '@nr' as path, nr as value, 0 as "start" from r union all select doc_id, 1, 'patient/@group', g, length(nr) + 1 from r union all select doc_id, 2, 'patient', n || ' & ', length(nr) + length(g) + 2 from r
union all select doc_id, 3, 'patient/b', p, length(nr) + length(g) + length(n) + 6 from r union all select doc_id, 4, 'patient', ' nach', length(nr) + length(g) + length(n) + length(p) + 7 from r union all select doc_id, 5, 'empty', '', length(nr) + length(g) + length(n) + length(p) + 13 from r)""")
def _(spark, sf):
    return fields.flatten(order_xml(spark, sf), xml=True).select("doc_id", "field_id", F.array_join("path", "/").alias("path"), "value", "start")


@register("q_xml_substituted", SQL_XML + """ select doc_id, '<report nr=''ID''>' || chr(10) || ' <patient group="' || g || '">NAME &amp; <b>' || p || '</b> nach</patient><empty/></report>' as content from r""")
def _(spark, sf):
    """XML reports through the substitution: spans are replaced in attributes and beside elements, all else stays as it was."""
    docs = order_xml(spark, sf)
    leaves = fields.flatten(docs, xml=True)
    new = F.when(F.col("field_id") == 0, "ID").when(F.col("field_id") == 2, "NAME & ").otherwise(F.col("value"))
    return fields.rebuild(docs, leaves.withColumn("value", new), xml=True).select("doc_id", "content")


@register("q_token_fields_all", SQL_REPORTS + """, l as (select doc_id, 'Patient/Name' as field_path, c_name as v from r union all select doc_id, 'Patient/Gruppe', c_mktsegment from r union all select doc_id, 'Eintrag/LISTELEMENT/Text', o_orderpriority from r union all select doc_id, 'Eintrag/LISTELEMENT/Text', o_orderstatus from r)
select doc_id, field_path, cast(sum(len(regexp_extract_all(v, '\\p{L}+|\\p{N}+|[ \\t]+|[^\\p{L}\\p{N}\\s]'))) as bigint) as n from l group by all""")
def _(spark, sf):
    """The innermost field over every token of whole reports."""
    docs = order_reports(spark, sf)
    found = fields.token_fields(tokens.token_table(fields.report_texts(docs)), fields.flatten(docs))
    return found.where("field_path is not null").groupBy("doc_id", "field_path").agg(F.count(F.lit(1)).alias("n"))


@register("q_path_match", SQL_REPORTS + """ select c as rule, count(*) as n from r, (select unnest(['Text', 'Text', 'Patient/Name', 'Eintrag//', 'Eintrag//', '//LISTELEMENT/Text', '//LISTELEMENT/Text', '//Na.*']) as c) group by c""")
def _(spark, sf):
    f = fields.flatten(order_reports(spark, sf))
    return f.select(F.explode(F.filter(F.array(*[F.when(path_matches(F.col("path"), c), F.lit(c)) for c in CONSTRAINTS]), lambda x: x.isNotNull())).alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@register("q_structured_annotations", SQL_REPORTS + """ select doc_id, 0 as "start", cast(length(c_name) as int) as "end", 'Name' as type, 'patient' as subtype from r""")
def _(spark, sf):
    maps = [fields.Mapping.parse("Patient/Name; Name; type=patient"), fields.Mapping.parse("Text; Date; type=other; Eintrag")]
    return fields.structured_annotations(fields.flatten(order_reports(spark, sf)), maps).select("doc_id", "start", "end", "type", F.col("features")["type"].alias("subtype"))


@register("q_field_mapping", SQL_REPORTS + " select type, count(*) as n from r, (select unnest(['PatName', 'Entry', 'Entry']) as type) group by type")
def _(spark, sf):
    mapped = fields.map_fields(fields.flatten(order_reports(spark, sf)), [fields.Mapping("Patient/Name", "PatName"), fields.Mapping("Eintrag//", "Entry")])
    return mapped.select(F.explode("types.type").alias("type")).groupBy("type").agg(F.count(F.lit(1)).alias("n"))


@register("q_blacklist_fields", SQL_REPORTS + " select doc_id, cast(length(c_name) + 1 as int) as \"start\" from r")
def _(spark, sf):
    f = fields.flatten(order_reports(spark, sf))
    spans = f.where("not is_null and path[0] = 'Patient'").select("doc_id", "start", "end", F.lit("Name").alias("type"))
    return fields.without_forbidden(spans, f, {"Patient/Name": ["Name", "Location"]}).select("doc_id", "start")


REPORT_SETTINGS = {"mappings": (fields.Mapping("Eintrag//", "Entry"),), "structured": (fields.Mapping.parse("Patient/Name; Name; type=patient"),), "blacklist": {"Patient/Gruppe": ["Name", "Location"]}, "deleted": ("Patient/Gruppe",)}


@register("q_deidentify_reports", SQL_REPORTS + """ select doc_id, '{"Patient": {"Name": "NAME", "Gruppe": ""}, "Eintrag": [{"Text": "' || o_orderpriority || '"}, {"Text": "' || o_orderstatus || '"}], "Leer": null}' as content from r""")
def _(spark, sf):
    """The whole chain from report to report, all stages and rules."""
    return deidentify_reports(order_reports(spark, sf), substitute.Policy(), Settings(**REPORT_SETTINGS))


@register("q_report_spans", SQL_REPORTS + """ select doc_id, 0 as "start", cast(length(c_name) as int) as "end", 'Name' as type, 'patient' as subtype from r""")
def _(spark, sf):
    return report_spans(order_reports(spark, sf), Settings(**REPORT_SETTINGS)).select("doc_id", "start", "end", "type", "subtype")


@register("q_field_deletion", SQL_REPORTS + """ select doc_id, '{"Patient": {"Name": "", "Gruppe": "' || c_mktsegment || '"}, "Eintrag": [{"Text": "' || o_orderpriority || '"}, {"Text": "' || o_orderstatus || '"}], "Leer": null}' as content from r""")
def _(spark, sf):
    docs = order_reports(spark, sf)
    return fields.rebuild(docs, fields.delete_fields(fields.flatten(docs), ["Patient/Name"]))


@register("q_json_roundtrip", "select count(*) as n, cast(0 as bigint) as n_changed from orders")
def _(spark, sf):
    docs = order_reports(spark, sf)
    back = fields.rebuild(docs, fields.flatten(docs)).withColumnRenamed("content", "again")
    same = F.parse_json("content").cast("string") == F.parse_json("again").cast("string")
    return docs.join(back, "doc_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(~same).alias("n_changed"))


@register("q_quarantine", "select event_id from events where event_id % 7 = 3")
def _(spark, sf):
    broken = read(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 7 == 3, F.concat("props", F.lit("}{"))).otherwise(F.col("props")).alias("content"))
    return fields.quarantine(broken).select("event_id")


@register("q_token_fields", SQL_REPORTS + """ select doc_id, 'Name' as field_name, 'Patient/Name' as field_path, cast(len(regexp_extract_all(c_name, '\\p{L}+|\\p{N}+|[^\\p{L}\\p{N}]')) as bigint) as n from r""")
def _(spark, sf):
    f = fields.flatten(order_reports(spark, sf)).where("field_id = 0")
    toks = tokens.token_table(f.select("doc_id", F.col("value").alias("text")))
    return fields.token_fields(toks, f).groupBy("doc_id", "field_name", "field_path").agg(F.count(F.lit(1)).alias("n"))


# --- contexts, metadata, propagation ------------------------------------------

SQL_WORDS = SQL_TOKENS + ", w as materialized (select doc_id, cast(row_number() over (partition by doc_id order by tok_idx) - 1 as int) as i, string, s, s + length(string) as e, count(*) over (partition by doc_id) - 1 as last from t where kind <> 'space')"
TRIGGERS = [("and", "NameContext", 5, 5), ("that", "ExclusionContext", 0, 3), ("of the", "SuspectionContext", 2, 0)]


@register("q_context_windows", SQL_WORDS + """, g as (select doc_id, i, last, string as g, 1 as n from w union all select doc_id, i, last, string || ' ' || lead(string) over (partition by doc_id order by i), 2 from w),
tr(g, c, l, r, n) as (values ('and', 'NameContext', 5, 5, 1), ('that', 'ExclusionContext', 0, 3, 1), ('of the', 'SuspectionContext', 2, 0, 2)),
h as materialized (select doc_id, c, greatest(i - 1 - l, 0) as a, least(i + g.n + r, last) as b from g join tr using (g, n)),
arr as (select doc_id, list(s order by i) as ss, list(e order by i) as ee from w group by doc_id)
select h.doc_id, c as context, count(*) as n, cast(sum(ss[a + 1]) as bigint) as sum_start, cast(sum(ee[b + 1]) as bigint) as sum_end from h join arr on arr.doc_id = h.doc_id group by h.doc_id, c""")
def _(spark, sf):
    triggers = spark.createDataFrame(TRIGGERS, "token string, context string, left int, right int")
    found = contexts.trigger_contexts(read(spark, sf, "documents").select("doc_id", "text"), triggers)
    return found.groupBy("doc_id", "context").agg(F.count(F.lit(1)).alias("n"), F.sum("start").alias("sum_start"), F.sum("end").alias("sum_end"))


@register("q_metadata_annotator", SQL_TOKENS + " select doc_id, string, count(*) as n from t join documents using (doc_id) where kind <> 'space' and string in (upper(lang), upper(substring(lang, 1, 1)) || substring(lang, 2)) group by all")
def _(spark, sf):
    meta = read(spark, sf, "documents").select("doc_id", F.lit("Name").alias("type"), F.col("lang").alias("value"))
    return contexts.text_metadata_annotations(read(spark, sf, "documents").select("doc_id", "text"), meta).groupBy("doc_id", "string").agg(F.count(F.lit(1)).alias("n"))


@register("q_high_confidence_propagation", """with b as (select item_id, text, regexp_extract(text, '^\\S+ \\S+') as m from benchmark)
select item_id as doc_id, m as text, cast(len(string_split(text, m)) - 1 as bigint) as n from b where m <> ''""")
def _(spark, sf):
    docs = read(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    sure = docs.select("doc_id", F.lit(0).alias("start"), F.regexp_extract("text", r"^\S+ \S+", 0).alias("text"), F.lit("Name").alias("type"), F.lit("FieldMapping-x").alias("rule"), F.lit(None).cast("string").alias("confidence"))
    return contexts.propagate(docs, sure).groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("n"))


@register("q_propagation_documents", """with b as (select doc_id, text, regexp_extract(text, '^\\S+ \\S+') as m from documents)
select doc_id, m as text, cast(len(string_split(text, m)) - 1 as bigint) as n from b where m <> ''""")
def _(spark, sf):
    """The first two words of every document, everywhere in it."""
    docs = read(spark, sf, "documents").select("doc_id", "text")
    sure = docs.select("doc_id", F.lit(0).alias("start"), F.regexp_extract("text", r"^\S+ \S+", 0).alias("text"), F.lit("Name").alias("type"), F.lit("FieldMapping-x").alias("rule"), F.lit(None).cast("string").alias("confidence"))
    return contexts.propagate(docs, sure).groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("n"))


# --- conflicts ------------------------------------------------------------------

SPANS_SQL = """with s as (select l_orderkey as doc_id, l_linenumber * 100000000 + l_partkey * 1000 + l_suppkey % 1000 as ann_id, cast(l_partkey % 40 as int) as a, cast(l_partkey % 40 + l_suppkey % 12 as int) as b,
 case l_returnflag when 'A' then 'Name' when 'N' then 'Date' else 'Location' end as type, case when l_linenumber % 3 = 0 then 'other' when l_linenumber % 3 = 1 then 'city' end as subtype, cast(case when l_linenumber = 2 then 90 end as varchar) as confidence from lineitem),
 p as (select distinct * from s where b > a)"""


def line_spans(spark, sf):
    rows = read(spark, sf, "lineitem").selectExpr("l_orderkey as doc_id", "l_linenumber * 100000000 + l_partkey * 1000 + l_suppkey % 1000 as ann_id", "cast(l_partkey % 40 as int) as start", "cast(l_partkey % 40 + l_suppkey % 12 as int) as end", "case l_returnflag when 'A' then 'Name' when 'N' then 'Date' else 'Location' end as type", "case when l_linenumber % 3 = 0 then 'other' when l_linenumber % 3 = 1 then 'city' end as subtype", "cast(case when l_linenumber = 2 then 90 end as string) as confidence")
    return rows.where("end > start").distinct()


@register("q_remove_overlaps", SPANS_SQL + """, q as (select *, coalesce(try_cast(confidence as double), 50) as c, case type when 'Name' then 0 when 'Date' then 2 else 99 end as rk from p)
select doc_id, ann_id from q x where not exists (select 1 from q y where y.doc_id = x.doc_id and y.ann_id <> x.ann_id and x.a >= y.a and x.b <= y.b and (y.c > x.c or (y.c = x.c and (y.b - y.a > x.b - x.a or (y.b - y.a = x.b - x.a and (y.rk < x.rk or (y.rk = x.rk and y.ann_id > x.ann_id)))))))""")
def _(spark, sf):
    return resolve.remove_weaker(line_spans(spark, sf)).select("doc_id", "ann_id")


@register("q_remove_redundant", SPANS_SQL + " select doc_id, ann_id from p x where not exists (select 1 from p y where y.doc_id = x.doc_id and y.ann_id <> x.ann_id and x.a >= y.a and x.b <= y.b and ((y.b - y.a > x.b - x.a) or y.ann_id > x.ann_id))")
def _(spark, sf):
    return resolve.remove_redundant(line_spans(spark, sf)).select("doc_id", "ann_id")


@register("q_span_islands", SPANS_SQL + """, m as (select *, max(b) over (partition by doc_id order by a, b rows between unbounded preceding and 1 preceding) as reach from p), g as (select *, sum(case when reach is null or a > reach then 1 else 0 end) over (partition by doc_id order by a, b rows unbounded preceding) as island from m)
select doc_id, min(a) as "start", max(b) as "end", count(*) as n from g group by doc_id, island""")
def _(spark, sf):
    return resolve.islands(line_spans(spark, sf))


@register("q_any_overlap", SPANS_SQL + " select x.doc_id, bool_or(y.ann_id is not null) as overlaps from p x left join p y on x.doc_id = y.doc_id and x.ann_id <> y.ann_id and x.a < y.b and y.a < x.b group by x.doc_id")
def _(spark, sf):
    return resolve.overlapping(line_spans(spark, sf))


@register("q_split_overlaps", SPANS_SQL + """, m as (select *, max(b) over (partition by doc_id order by a, b desc, ann_id rows between unbounded preceding and 1 preceding) as reach from p) select doc_id, ann_id, greatest(a, coalesce(reach, 0)) as "start", b as "end" from m where b > greatest(a, coalesce(reach, 0))""")
def _(spark, sf):
    return resolve.split_overlaps(line_spans(spark, sf)).select("doc_id", "ann_id", "start", "end")


@register("q_split_at_fields", SPANS_SQL + """, f as (select distinct doc_id, unnest([0, 16, 32, 48]) as fs from p) select p.doc_id, ann_id, greatest(a, fs) as "start", least(b, fs + 16) as "end" from p join f on p.doc_id = f.doc_id and a < fs + 16 and fs < b""")
def _(spark, sf):
    spans = line_spans(spark, sf)
    leaves = spans.select("doc_id").distinct().select("doc_id", F.explode(F.array(*[F.lit(k) for k in (0, 16, 32, 48)])).alias("start")).withColumn("end", F.col("start") + 16)
    return resolve.split_at_fields(spans, leaves).select("doc_id", "ann_id", "start", "end")


@register("q_leaf_spans", SPANS_SQL + " select doc_id, ann_id from p x where not exists (select 1 from p y where y.doc_id = x.doc_id and y.ann_id <> x.ann_id and y.a >= x.a and y.b <= x.b and (not (y.a = x.a and y.b = x.b) or y.ann_id > x.ann_id))")
def _(spark, sf):
    return resolve.leaf_spans(line_spans(spark, sf)).select("doc_id", "ann_id")


@register("q_schema", SPANS_SQL + " select type, case when type = 'Location' or subtype = 'other' then subtype end as subtype, count(*) as n from p group by all")
def _(spark, sf):
    return resolve.enforce_schema(line_spans(spark, sf)).groupBy("type", "subtype").agg(F.count(F.lit(1)).alias("n"))


def fold_sql(apart: bool) -> str:
    """The ordered fold in SQL, span by span; features merge value by value."""
    both = lambda key: f"case when held.{key} <> n.{key} then held.{key} || ',' || n.{key} else held.{key} end"
    agree = "(coalesce(held.subtype, 'other') = 'other' or coalesce(n.subtype, 'other') = 'other' or held.subtype = n.subtype)"
    same, inside = "held.a = n.a and held.b = n.b", "n.b <= held.b"
    merges, skips = f"{agree} and {same}", f"{inside} and ({agree if apart else f'({agree}) or not ({same})'})"
    return SPANS_SQL + f""", r as materialized (select *, 'R' || cast(ann_id % 3 as varchar) as rule, row_number() over (partition by doc_id, type order by a, b desc, ann_id desc) as k, count(*) over (partition by doc_id, type) as n from p),
f as (with recursive held as (select doc_id, type, k, n, ann_id, a, b, subtype, rule, false as moved, k as from_k from r where k = 1 union all
 select n.doc_id, n.type, n.k, n.n, case when ({merges}) or ({skips}) then held.ann_id else n.ann_id end, case when ({merges}) or ({skips}) then held.a else n.a end, case when ({merges}) or ({skips}) then held.b else n.b end,
  case when {merges} then case when coalesce(held.subtype, 'other') = 'other' then coalesce(case when n.subtype <> 'other' then n.subtype end, held.subtype, n.subtype) else held.subtype end when {skips} then held.subtype else n.subtype end,
  case when {merges} then {both('rule')} when {skips} then held.rule else n.rule end, not (({merges}) or ({skips})), 0 from held join r n on n.doc_id = held.doc_id and n.type = held.type and n.k = held.k + 1) select * from held),
out as (select f.* from f left join f g on g.doc_id = f.doc_id and g.type = f.type and g.k = f.k + 1 where f.k = f.n or g.moved)"""


@register("q_cleanup_features", fold_sql(True) + ' select doc_id, type, ann_id, a as "start", b as "end", subtype, rule from out')
def _(spark, sf):
    """Coextensive spans merge with their features; spans inside one of another subtype stay."""
    rule = F.concat(F.lit("R"), (F.col("ann_id") % 3).cast("string"))
    spans = line_spans(spark, sf).withColumn("features", F.create_map(F.lit("rule"), rule))
    return resolve.merge_spans(spans, apart=True).select("doc_id", "type", "ann_id", "start", "end", "subtype", F.col("features")["rule"].alias("rule"))


@register("q_cleanup_merge", fold_sql(False) + ' select doc_id, type, ann_id, a as "start", b as "end", subtype from out')
def _(spark, sf):
    """The ordered fold over a document's spans of a type."""
    return resolve.merge_spans(line_spans(spark, sf)).select("doc_id", "type", "ann_id", "start", "end", "subtype")


@register("q_trim_spans", "select conv_id, turn, cast(length(rtrim(text, ' ' || chr(10) || chr(9) || chr(13))) as int) as \"end\" from conversations where length(rtrim(text, ' ' || chr(10) || chr(9) || chr(13))) > 0")
def _(spark, sf):
    spans = read(spark, sf, "conversations").select("conv_id", "turn", F.lit(0).alias("start"), (F.length("text") + 2).alias("end"), F.concat("text", F.lit(" \n")).alias("text"))
    return resolve.trim_spans(spans).select("conv_id", "turn", "end")


# --- diagnosis --------------------------------------------------------------------

KEYWORDS = {"A1": ["thandble|Thandble", "hation"], "B2": ["edst", "whereas", "anand"]}
SQL_DIAGNOSIS = SQL_WORDS + """, d as (select doc_id, i, string, s, e, case when string in ('thandble', 'Thandble', 'hation') then 'A1' else 'B2' end as code from w where string in ('thandble', 'Thandble', 'hation', 'edst', 'whereas', 'anand')),
c as (select w.doc_id, w.string as trigger, x.s as cs, y.e as ce from w join w x on x.doc_id = w.doc_id and x.i = greatest(w.i - 1, 0) join w y on y.doc_id = w.doc_id and y.i = least(w.i + 4, w.last) where w.string in ('that', 'or')),
m as (select d.doc_id, d.s, d.e, d.string, d.code, case when bool_or(trigger = 'that') then 'excluded' when bool_or(trigger = 'or') then 'suspected' else 'confirmed' end as reliability from d left join c on c.doc_id = d.doc_id and d.s >= c.cs and d.e <= c.ce group by all)"""


def found_diagnoses(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text")
    triggers = spark.createDataFrame([("that", "ExclusionContext", 0, 3), ("or", "SuspectionContext", 0, 3)], "token string, context string, left int, right int")
    around = contexts.trigger_contexts(docs, triggers)
    return diagnosis.certainty(diagnosis.keyword_annotations(docs, KEYWORDS), around)


@register("q_diagnosis_keywords", SQL_DIAGNOSIS + " select doc_id, code, count(*) as n, cast(sum(s) as bigint) as sum_start from d group by all")
def _(spark, sf):
    return diagnosis.keyword_annotations(read(spark, sf, "documents").select("doc_id", "text"), KEYWORDS).groupBy("doc_id", "code").agg(F.count(F.lit(1)).alias("n"), F.sum("start").alias("sum_start"))


@register("q_diagnosis_certainty", SQL_DIAGNOSIS + " select code, reliability, count(*) as n from m group by all")
def _(spark, sf):
    return found_diagnoses(spark, sf).groupBy("code", F.coalesce("reliability", F.lit("confirmed")).alias("reliability")).agg(F.count(F.lit(1)).alias("n"))


@register("q_diagnosis_consolidate", SQL_DIAGNOSIS + " select doc_id, code, reliability, string as text from m qualify row_number() over (partition by doc_id, code, reliability order by s, e, string) = 1")
def _(spark, sf):
    return diagnosis.consolidate(found_diagnoses(spark, sf))


# --- documents ---------------------------------------------------------------------


@register("q_doc_filter_type", "select doc_id from documents where regexp_full_match(source, 'src1[0-9]?|src2')")
def _(spark, sf):
    return reports.filter_types(read(spark, sf, "documents").select("doc_id", "source"), ["src1[0-9]?", "src2"], "source").select("doc_id")


@register("q_doc_filter_id", "select doc_id from documents where doc_id in (select doc_id from labels where quality = 0)")
def _(spark, sf):
    return reports.filter_ids(read(spark, sf, "documents").select("doc_id"), read(spark, sf, "labels").where("quality = 0"))


@register("q_skip_limit", "select doc_id from documents order by doc_id limit 50 offset 25")
def _(spark, sf):
    return reports.skip_limit(read(spark, sf, "documents").select("doc_id"), "doc_id", 25, 50)


@register("q_group_corpora", "select string_split(lang || '-' || cast(doc_id as varchar), '-')[1] as corpus, count(*) as n from documents group by all")
def _(spark, sf):
    return read(spark, sf, "documents").select(reports.corpus_group(F.concat_ws("-", "lang", "doc_id")).alias("corpus")).groupBy("corpus").agg(F.count(F.lit(1)).alias("n"))


@register("q_report_naming", """with d as (select doc_id, source, '0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ' as z from documents), e as (select *, case when doc_id < 46656 then substring(z, cast(doc_id // 1296 + 1 as int), 1) || substring(z, cast(doc_id // 36 % 36 + 1 as int), 1) || substring(z, cast(doc_id % 36 + 1 as int), 1) end as b from d)
select doc_id, source || '-' || cast(doc_id as varchar) || '-' || case when doc_id = 0 then '0' else ltrim(b, '0') end as name from e""")
def _(spark, sf):
    return read(spark, sf, "documents").select("doc_id", reports.report_name(F.col("source"), F.col("doc_id")).alias("name"))


@register("q_xml_escape", """select item_id, md5(replace(replace(replace(replace(replace(text || '<&>', '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&apos;')) as text_md5 from benchmark""")
def _(spark, sf):
    return read(spark, sf, "benchmark").select("item_id", F.md5(xml_escape(F.concat("text", F.lit("<&>")))).alias("text_md5"))


@register("q_orth_names", "select n_nationkey, case when regexp_matches(n_name, '^\\p{Lu}+$') then 'allCaps' when regexp_matches(n_name, '^\\p{Lu}\\p{Ll}+$') then 'upperInitial' when regexp_matches(n_name, '^\\p{L}+$') then 'mixedCaps' end as orth from nation")
def _(spark, sf):
    return read(spark, sf, "nation").select("n_nationkey", orth("n_name").alias("orth"))


# --- evaluation and learning ---------------------------------------------------------

GOLD_SQL = SPANS_SQL + ", g as (select doc_id, type, a, case when doc_id % 3 = 0 then b + 1 else b end as b from p where doc_id % 5 <> 0), y as (select distinct doc_id, type, a, b from p), z as (select distinct * from g)"


@register("q_eval_scores", GOLD_SQL + """, ys as (select y.type, bool_or(z.a = y.a and z.b = y.b) as st, bool_or(z.a is not null) as le from y left join z on z.doc_id = y.doc_id and z.type = y.type and z.a < y.b and y.a < z.b group by y.doc_id, y.type, y.a, y.b),
zs as (select z.type, bool_or(z.a = y.a and z.b = y.b) as st, bool_or(y.a is not null) as le from z left join y on z.doc_id = y.doc_id and z.type = y.type and z.a < y.b and y.a < z.b group by z.doc_id, z.type, z.a, z.b),
sy as (select type, count(*) as ns, count_if(coalesce(st, false)) as m, count_if(le) as l from ys group by rollup (type)), sz as (select type, count(*) as ng, count_if(coalesce(st, false)) as m, count_if(le) as l from zs group by rollup (type))
select sy.type, sy.m as matches, ns as n_system, ng as n_gold, sz.m / ng as recall, sz.l / ng as recall_lenient, sy.m / ns as precision, sy.l / ns as precision_lenient from sy join sz on sy.type is not distinct from sz.type""")
def _(spark, sf):
    system = line_spans(spark, sf)
    gold = system.where("doc_id % 5 != 0").withColumn("end", F.when(F.col("doc_id") % 3 == 0, F.col("end") + 1).otherwise(F.col("end")))
    return evaluate.scores(system, gold)


@register("q_gold_join", "select 'd' || cast(doc_id as varchar) as name, case when doc_id % 2 = 0 then 'd' || cast(doc_id as varchar) || '_1' end as gold_name from documents")
def _(spark, sf):
    docs = read(spark, sf, "documents").select(F.concat(F.lit("d"), "doc_id").alias("name"), "doc_id")
    gold = docs.where("doc_id % 2 = 0").select(F.explode(F.array(F.concat("name", F.lit("_1")), F.concat("name", F.lit("_2")))).alias("name"))
    return evaluate.gold_documents(docs.select("name"), gold)


@register("q_ml_features", SQL_LOOKUPS + """, l as (select w.doc_id, w.tok_idx, w.string, coalesce(string_agg(distinct h.major || '_' || h.minor, ';' order by h.major || '_' || h.minor), 'O') as tags from w left join hits h on h.doc_id = w.doc_id and w.s >= h.s and w.e <= h.e where w.doc_id in (select doc_id from documents) group by all)
select tags, count(*) as n, count_if(regexp_matches(string, '^\\p{Lu}')) as n_capitalized from (select string, array_to_string(list_sort(string_split(tags, ';')), ';') as tags from l) group by tags""")
def _(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text")
    hits = written(doc_hits(spark, sf).select("doc_id", "start", "end", "major", "minor"))
    rows = features.with_flags(features.text_features(docs, lexicon.direct_annotations(hits).select("doc_id", "start", "end", "type"), hits))
    return rows.groupBy(F.array_join(F.array_sort(F.split("lookup_tags", ";")), ";").alias("tags")).agg(F.count(F.lit(1)).alias("n"), F.count_if("is_capitalized").alias("n_capitalized"))


@register("q_ml_table", "with x as (" + t.expected_sql("supplier", "s_suppkey", t.PERSONS) + """), m as (select doc_id, type as label, type || case when subtype = '' then '' else '_' || subtype end as label_extended, len(regexp_extract_all(text, '\\p{L}+|\\p{N}+|[^\\p{L}\\p{N}\\s]')) as n from x)
select doc_id, label, label_extended, cast(sum(n) as bigint) as n_tokens from m group by all""")
def _(spark, sf):
    docs = t.texts(spark, read(spark, sf, "supplier"), "s_suppkey", t.PERSONS)
    rows = features.ml_table(docs, annotate(docs, {"Names": others.NAMES}))
    return rows.where("label != 'O'").groupBy("doc_id", "label", "label_extended").agg(F.count(F.lit(1)).alias("n_tokens"))


@register("q_ml_sentence_tokens", """with w as (select doc_id, len(regexp_extract_all(text, '\\p{L}+|\\p{N}+|[^\\p{L}\\p{N}\\s]')) as n from documents) select doc_id, cast(n as bigint) as n_tokens from w where n > 0""")
def _(spark, sf):
    none = spark.createDataFrame([], "doc_id long, start int, end int, type string, subtype string, rule string")
    return features.ml_table(read(spark, sf, "documents").select("doc_id", "text"), none).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_tokens"))


@register("q_ml_tokens", SQL_SENTENCES + """, y as (select *, row_number() over (partition by doc_id, sentence_nr order by tok_idx) - 1 as nr from w where kind not in ('space', 'newline'))
select doc_id, token_kind, count(*) as n, count(distinct token_text) as n_texts, cast(sum(nr) as bigint) as sum_nr, count_if(nr = 0) as n_first, cast(sum(length(token_text)) as bigint) as n_chars from (select doc_id, kind as token_kind, string as token_text, nr from y) group by doc_id, token_kind""")
def _(spark, sf):
    """The learner's rows of whole documents: kinds, texts, places in sentences, beginnings."""
    docs = read(spark, sf, "documents").select("doc_id", "text")
    rows = features.ml_table(docs, contact_spans(spark, sf))
    return rows.groupBy("doc_id", "token_kind").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("token_text").alias("n_texts"), F.sum("token_nr").alias("sum_nr"), F.count_if("sentence_beginning").alias("n_first"), F.sum(F.length("token_text")).alias("n_chars"))


@register("q_type_projection", "with x as (" + t.expected_sql("customer", "c_custkey", t.LOCATIONS) + ") select subtype, count(*) as n from x group by subtype")
def _(spark, sf):
    docs = t.texts(spark, read(spark, sf, "customer"), "c_custkey", t.LOCATIONS)
    return resolve.of_types(annotate_recurring(docs, {"Locations": others.LOCATIONS, "Internet": others.INTERNET}), ["Location"]).groupBy("subtype").agg(F.count(F.lit(1)).alias("n"))


@register("q_substitution_exploration", f"select cast(o_orderkey as bigint) as doc_id, 'am 31.01.1850 gesehen' as text from orders")
def _(spark, sf):
    docs = dotted(spark, sf).select(F.col("o_orderkey").alias("doc_id"), F.concat(F.lit("am "), "text", F.lit(" gesehen")).alias("text"))
    return substitute.substitute(docs, annotate(docs, {"Dates": dates.RULES}), substitute.Policy(substitute.Method.EXPLORATION)).select("doc_id", "text")


@register("q_rules_from_table", r"""select doc_id, cast(count(*) as bigint) as n from (select doc_id, unnest(regexp_extract_all(text, 'ation of|ation')) as m from documents) where m = 'ation' group by doc_id""")
def _(spark, sf):
    table = spark.createDataFrame([("b", "()(ation)", [(2, "A", "")], None, None, None), ("a", "(ation of)", [], 5, None, ["ation"])], RULE_ROW)
    return annotate(read(spark, sf, "documents").select("doc_id", "text"), {"p": rules_of(table)}).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


@register("q_span_equality", "select l_linenumber % 2 = 0 as same, count(*) as n from lineitem group by 1")
def _(spark, sf):
    span = lambda end, *kv: F.struct(F.lit(0).alias("start"), end.alias("end"), F.lit("Date").alias("type"), F.create_map(*kv).alias("features"))
    a = span(F.col("l_linenumber"), F.lit("x"), F.lit("1"), F.lit("y"), F.lit("2"))
    b = span(F.col("l_linenumber"), F.lit("y"), F.lit("2"), F.lit("x"), F.when(F.col("l_linenumber") % 2 == 0, "1").otherwise("3"))
    return read(spark, sf, "lineitem").select(spans_fn.same(a, b).alias("same")).groupBy("same").agg(F.count(F.lit(1)).alias("n"))


@register("q_windowed_counts", "select date_trunc('hour', ts) as window_start, event_type, count(*) as n from events group by all")
def _(spark, sf):
    """The aggregate of the stream, over the whole table as one batch."""
    return windowed_counts(read(spark, sf, "events"))


@register("q_annotated_json", f"select doc_id, case when len(regexp_extract_all(text, '{SQL_PHONE}')) = 0 then 0 else 1 end as n_types, cast(len(regexp_extract_all(text, '{SQL_PHONE}')) as bigint) as n_spans from documents")
def _(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text")
    out = reports.annotated_json(docs, annotate(docs, {"c": [r for r in CONTACT_RULES if r.name == "NorthAmericanNumber"]}))
    parsed = F.from_json("json", "map<string,array<struct<start:int,end:int,text:string>>>")
    return out.select("doc_id", F.size(F.map_keys(parsed)).alias("n_types"), F.aggregate(F.map_values(parsed), F.lit(0), lambda n, v: n + F.size(v)).cast("long").alias("n_spans"))


@register("q_diagnosis_lines", "select doc_id as \"docId\", replace(text, ';', 'SEP') as \"annotationText\", 'A1' as code, 'confirmed' as reliability from documents")
def _(spark, sf):
    return reports.diagnosis_lines(read(spark, sf, "documents").select("doc_id", "text", F.lit("A1").alias("code"), F.lit("confirmed").alias("reliability")))
