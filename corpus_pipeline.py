"""A training corpus out of documents, stage by stage.

Every stage is written as Parquet to the shared folder and read again before the
next one starts. All stages but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm import decontam, langid, packing, secrets, simhash
from spanloom.llm.common import table, written

#: A text that no learnt language codes in fewer bits a byte than this is in none of them.
MOST_BITS = 7.0


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learnt language stay, as they are.

    Null texts, texts without a letter and texts that every language's trees code
    as badly as random bytes go. The trees are learnt from the labelled documents
    of ``sf_dir``. Rows are judged by what they hold, so repeated ids are fine.
    """
    model = langid.fit(langid.training_rows(table(spark, sf_dir, "documents")))
    judged = docs.select(F.struct(*docs.columns).alias("row"), "text")
    found = langid.predict(judged, model, id_col="row").where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("bits_per_byte") <= MOST_BITS))
    return found.select("id.*")


def row_key(docs: DataFrame) -> Column:
    """What tells rows apart and puts them in order: their id (null last) and a hash of all they hold."""
    return F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.xxhash64(*docs.columns).alias("row"))


def keyed_rows(docs: DataFrame) -> DataFrame:
    """``(key, text, row)``: each row whole, so its columns may have any names."""
    return docs.select(row_key(docs).alias("key"), F.col("text"), F.struct(*docs.columns).alias("row"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, one row stays: that of the smallest id.

    Near copies are alike by 0.8 or more in their five-word shingles (the cosine
    that fingerprints estimate), or have fingerprints within two bits. Rows are
    judged by what they hold: different texts under one id each have their own
    group. Rows without an id come after all others in their group; of rows that
    are equal in full one stays.
    """
    keyed = keyed_rows(docs)
    groups = simhash.near_copies(keyed, id_col="key").where("id = component").groupBy(F.col("id").alias("key")).agg(F.count(F.lit(1)).alias("times"))
    kept = keyed.join(groups, "key")
    once = kept.where("times = 1").unionByName(kept.where("times > 1").dropDuplicates(["key"]))
    return once.select("row.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item, edited or not, go; a row without an id is judged like any other."""
    keyed = keyed_rows(docs)
    found = decontam.contaminated(keyed.select(F.col("key").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("key")).distinct()
    return keyed.join(found, "key", "left_anti").select("row.*")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; every document stays."""
    return secrets.redact(docs, secrets.train(secrets.labelled_findings(spark)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes: the last stage, with columns of its own."""
    out = packing.pack_documents(docs)
    return out.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("without_secrets", without_secrets),
    ("packed", packed),
]

#: SQL can express neither context trees nor a forest nor byte-pair encoding; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
