"""Reports in and out: JSON and XML folders, databases, corpora."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def report_name(report_type: Column, report_id: Column) -> Column:
    """``type-id-BASE36``; the last part only for numbers."""
    return F.concat_ws("-", report_type, report_id.cast("string"), F.upper(F.conv(report_id.try_cast("long").cast("string"), 10, 36)))


def corpus_group(name: Column) -> Column:
    """The group of a document: its name up to the first dash."""
    return F.split(name, "-")[0]


def read_json_folder(spark: SparkSession, path: str) -> DataFrame:
    """``(name, content)``: one report a file, named like it."""
    return _whole_files(spark, path, "*.json")


def read_xml_folder(spark: SparkSession, path: str) -> DataFrame:
    return _whole_files(spark, path, "*.xml")


def _whole_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    files = spark.read.option("wholetext", True).option("pathGlobFilter", pattern).text(path)
    return files.select(F.regexp_replace(F.element_at(F.split(F.input_file_name(), "/"), -1), r"\.\w+$", "").alias("name"), F.col("value").alias("content"))


def read_jdbc(spark: SparkSession, url: str, query: str, partition_column: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 8, **options: str) -> DataFrame:
    """A query's rows; with a numeric column and its bounds it is read in parallel."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if partition_column and bounds:
        reader = reader.option("dbtable", f"({query}) q").option("partitionColumn", partition_column).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", partitions)
    else:
        reader = reader.option("query", query)
    return reader.load()


def for_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` in the columns of a target table; those it lacks are empty, nulls stay null."""
    return df.select(*[F.col(c) if c in df.columns else F.lit("").alias(c) for c in columns])


def write_jdbc(df: DataFrame, url: str, table: str, columns: list[str], batch: int = 100, **options: str) -> None:
    for_table(df, columns).write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch).options(**options).mode("append").save()


def filter_types(docs: DataFrame, patterns: list[str], column: str = "doc_type") -> DataFrame:
    """Documents whose type one of the patterns matches in full; no pattern lets all through."""
    return docs.where(F.col(column).rlike(f"^(?:{'|'.join(patterns)})$")) if patterns else docs


def filter_ids(docs: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    return docs.join(ids.select(column).distinct(), column, "left_semi")


def skip_limit(docs: DataFrame, order: str, skip: int = 0, limit: int = 0) -> DataFrame:
    """Without the first ``skip`` documents in order, ``limit`` of them at most (0: all)."""
    rest = docs.orderBy(order).offset(skip)
    return rest.limit(limit) if limit > 0 else rest


def write_corpus(docs: DataFrame, path: str, group: str = "doc_type") -> None:
    docs.write.mode("overwrite").partitionBy(group).parquet(path)


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_json(df: DataFrame, path: str, per_file: int = 2_000_000) -> None:
    df.write.mode("overwrite").option("maxRecordsPerFile", per_file).json(path)


def annotated_json(docs: DataFrame, annotations: DataFrame, keys: tuple[str, ...] = ("doc_id",), default_set: str = "default-annotations") -> DataFrame:
    """``(keys, json)``: a document's annotations under ``<set>_<type>``."""
    row = F.struct("start", "end", "text")
    lists = annotations.groupBy(*keys, "type").agg(F.array_sort(F.collect_list(row)).alias("a"))
    groups = lists.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.concat(F.lit(f"{default_set}_"), "type").alias("k"), F.col("a").alias("v"))))).alias("m"))
    return docs.select(*keys).join(groups, list(keys), "left").select(*keys, F.coalesce(F.to_json("m"), F.lit("{}")).alias("json"))


def diagnosis_lines(found: DataFrame) -> DataFrame:
    """Findings for a file of semicolons: those in a text are spelt out."""
    return found.select(F.col("doc_id").alias("docId"), F.replace("text", F.lit(";"), F.lit("SEP")).alias("annotationText"), "code", "reliability")


def write_diagnosis(found: DataFrame, path: str) -> None:
    diagnosis_lines(found).write.mode("overwrite").option("sep", ";").option("header", True).csv(path)


def write_diagnosis_jdbc(found: DataFrame, url: str, table: str, **options: str) -> None:
    """Findings as rows of a database table."""
    write_jdbc(found.select("doc_id", "code", "reliability", "text"), url, table, ["doc_id", "code", "reliability", "text"], **options)
