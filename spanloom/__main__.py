"""Commands: annotate, substitute, import, convert, diagnose, test, check."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.operators import cases, fields
from spanloom.operators.diagnosis import keyword_annotations
from spanloom.operators.substitute import Method, Policy
from spanloom.operators.lexicon import read_lexicon
from spanloom.plans.config import load
from spanloom.plans.deidentify import deidentify_reports, diagnoses, find, find_in_reports
from spanloom.plans.stages import Settings
from spanloom.plans.workflow import Concern, Workflow
from spanloom.sources import reports
from spanloom.sources.sinks import upsert_jdbc, write_documents


def _reports(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """``(doc_id, content)``: the reports of a folder or a query, after the filters."""
    if a.jdbc_url:
        raw = reports.read_jdbc(spark, a.jdbc_url, a.query).select(F.col(a.id_column).cast("string").alias("doc_id"), F.col(a.json_column).alias("content"), F.col(a.type_column).alias("doc_type"))
        raw = reports.filter_types(raw, a.doc_type or [])
    else:
        raw = (reports.read_xml_folder if a.xml else reports.read_json_folder)(spark, a.input).withColumnRenamed("name", "doc_id")
    if a.doc_ids:
        raw = reports.filter_ids(raw, spark.read.text(a.doc_ids).select(F.trim("value").alias("doc_id")))
    if a.max_docs or a.skip_docs:
        raw = reports.skip_limit(raw, "doc_id", a.skip_docs, a.max_docs)
    return raw


def _lines(spark: SparkSession, path: str | None) -> list[str]:
    """The lines of a settings file without comments and empty ones."""
    return [r["value"] for r in spark.read.text(path).collect() if r["value"].strip() and not r["value"].lstrip().startswith("#")] if path else []


def _settings(spark: SparkSession, a: argparse.Namespace) -> Settings:
    """What the options name: term tables as ``term;major;minor;language``, the rest a line each."""
    table = lambda path, schema: spark.read.csv(path, sep=";", schema=schema, comment="#") if path else None
    lexicon = table(a.lexicon, "term string, major string, minor string, language string")
    mappings = lambda path: tuple(m for m in map(fields.Mapping.parse, _lines(spark, path)) if m)
    banned = {path.strip(): [x.strip() for x in types.split(",")] for path, types in (line.split(";", 1) for line in _lines(spark, a.blacklist))}
    return Settings(
        read_lexicon(lexicon) if lexicon is not None else None, table(a.suffixes, "term string, major string"), table(a.triggers, "token string, context string, left int, right int"), mappings(a.mappings), mappings(a.structured), banned, tuple(_lines(spark, a.fields_blacklist))
    )


def _input(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Reports as ``(doc_id, text)``: the leaves of each, a line each; reports that can't be read are set aside."""
    raw = _reports(spark, a)
    fields.quarantine(raw, xml=a.xml).write.mode("overwrite").parquet(f"{a.output}_quarantine")
    return fields.report_texts(raw, xml=a.xml)


def _diagnosed(spark: SparkSession, docs: DataFrame, a: argparse.Namespace) -> DataFrame:
    """The places of coded findings as spans of the type Diagnosis, whose subtype is the code."""
    keywords = {code: patterns.split(",") for code, patterns in (line.split(";")[:2] for line in _lines(spark, a.keywords))}
    found = keyword_annotations(docs, keywords)
    return found.select("doc_id", "start", "end", F.lit("Diagnosis").alias("type"), F.col("code").alias("subtype"), F.lit("Keyword").alias("rule"))


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="spanloom", fromfile_prefix_chars="@", epilog="@file takes options from a file, one a line")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("annotate", "substitute", "import", "convert", "diagnose", "check"):
        c = commands.add_parser(name)
        c.add_argument("-i", "--input")
        c.add_argument("-o", "--output", required=True)
        c.add_argument("--xml", action="store_true")
        c.add_argument("--jdbc-url")
        c.add_argument("--query")
        c.add_argument("--id-column", default="reportnr")
        c.add_argument("--json-column", default="content")
        c.add_argument("--type-column", default="fcode")
        c.add_argument("--doc-type", action="append")
        c.add_argument("--max-docs", type=int, default=0)
        c.add_argument("--skip-docs", type=int, default=0)
        c.add_argument("--doc-ids", help="a file of ids, one a line")
        c.add_argument("--fields-blacklist")
        for flag in ("--lexicon", "--suffixes", "--mappings", "--structured", "--blacklist"):
            c.add_argument(flag)
        if name in ("annotate", "substitute"):
            c.add_argument("-c", "--config", help="a file of pipeline keys, in place of the options for tables")
        if name in ("substitute", "diagnose"):
            c.add_argument("--output-jdbc", help="a database that gets the results too")
            c.add_argument("--table")
            c.add_argument("--driver")
        if name == "substitute":
            c.add_argument("--method", choices=[m.value for m in Method], default="Scrubber")
            for flag in ("--keep-dates", "--keep-patient-ids", "--keep-case-ids"):
                c.add_argument(flag, action="store_true")
            for flag in ("--min-days-shift", "--max-days-shift", "--rnd-seed"):
                c.add_argument(flag, type=int)
        if name == "diagnose":
            c.add_argument("--keywords", required=True, help="lines of code;pattern,pattern")
            c.add_argument("--keyword-blacklist", help="paths of fields in which no keyword counts")
        c.add_argument("--triggers", required=name == "diagnose", help="lines of token;context;left;right")
    c = commands.add_parser("test")
    c.add_argument("cases")
    c.add_argument("--pipeline", choices=["Deidentification", "DiagnosisExtraction"], default="Deidentification")
    c.add_argument("--keywords", help="for diagnoses: lines of code;pattern,pattern")
    a = parser.parse_args(args)
    spark = SparkSession.builder.appName("spanloom").getOrCreate()
    if a.command == "test":
        docs, expected = cases.read_cases(spark, a.cases)
        bad = cases.failures(docs, expected, (lambda d: _diagnosed(spark, d, a)) if a.pipeline == "DiagnosisExtraction" else find)
        bad.show(1000, False)
        raise SystemExit(int(not bad.isEmpty()))
    if a.command in ("annotate", "substitute"):
        raw = _reports(spark, a)
        fields.quarantine(raw, xml=a.xml).write.mode("overwrite").parquet(f"{a.output}_quarantine")
        site = load(spark, a.config) if a.config else None
        settings = site.settings if site else _settings(spark, a)
        plan = {"plan": site.plan, "types": site.types, "phases": site.phases} if site else {}
        if a.command == "annotate":
            find_in_reports(raw, settings, xml=a.xml, **plan)[1].write.mode("overwrite").parquet(a.output)
            return
        policy = Policy(Method(a.method), a.keep_dates, a.keep_patient_ids, a.keep_case_ids, min_days=a.min_days_shift, max_days=a.max_days_shift, seed=a.rnd_seed)
        sinks = [Concern("files", merged=lambda df: write_documents(df.withColumn("name", F.col("doc_id")), a.output, "xml" if a.xml else "json"))]
        if a.output_jdbc:
            sinks.append(Concern("database", merged=lambda df: upsert_jdbc(df.select(F.col("doc_id").alias(a.id_column), F.col("content").alias(a.json_column)), a.output_jdbc, a.table, a.id_column, a.driver)))
        Workflow(lambda df: deidentify_reports(df, policy, settings, xml=a.xml, **plan), sinks).run(raw)
        return
    docs = _input(spark, a)
    if a.command == "diagnose":
        lines = [r["value"].split(";") for r in spark.read.text(a.keywords).collect() if r["value"].strip()]
        triggers = spark.read.csv(a.triggers, sep=";", schema="token string, context string, left int, right int", comment="#")
        leaves = fields.flatten(_reports(spark, a), xml=a.xml) if a.keyword_blacklist else None
        found = diagnoses(docs, {code: patterns.split(",") for code, patterns, *_ in lines}, triggers, leaves, tuple(_lines(spark, a.keyword_blacklist)))
        sinks = [Concern("lines", merged=lambda df: reports.write_diagnosis(df, a.output))]
        if a.output_jdbc:
            key = F.concat_ws("|", "doc_id", "code", "reliability").alias("finding")
            sinks.append(Concern("database", merged=lambda df: upsert_jdbc(df.select(key, "doc_id", "code", "reliability", "text"), a.output_jdbc, a.table, "finding", a.driver)))
        Workflow(lambda _: found, sinks).run(docs)
    elif a.command == "check":
        raw = reports.read_json_folder(spark, a.input).withColumnRenamed("name", "doc_id")
        back = fields.rebuild(raw, fields.flatten(raw)).withColumnRenamed("content", "again")
        raw.join(back, "doc_id").where(F.parse_json("content").cast("string") != F.parse_json("again").cast("string")).write.mode("overwrite").parquet(a.output)
    else:
        reports.write_corpus(docs.withColumn("doc_type", reports.corpus_group(F.col("doc_id"))), a.output)


if __name__ == "__main__":
    main()
