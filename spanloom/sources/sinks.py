"""Sinks that a repeated or killed task leaves whole: a file a document, and rows of a database by key."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


def _files(path: str):
    """The store that a path is in, and the path there: a local folder or a URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def file_name(name: str) -> str:
    """A document's name as a file's: what could lead to another folder is spelt out."""
    return re.sub(r"[^\w.() -]|^\.+", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), name) or "%"


@dataclass
class Written(WriterCommitMessage):
    folder: str
    names: list[str]


class FileWriter(DataSourceWriter):
    """Each attempt of a task writes in a folder of its own; what the attempts that count wrote is moved into place at the end.

    A killed attempt, a repeated one or a speculative copy leaves files only in its
    folder, which goes with the job's. Two documents of one name fail the job,
    before anything is in place; with ``overwrite`` files that are there and not
    written again go.
    """

    def __init__(self, path: str, extension: str, overwrite: bool) -> None:
        self.path, self.extension, self.overwrite = path.rstrip("/"), extension, overwrite
        self.scratch = f"{self.path}/_temporary-{uuid.uuid4().hex}"

    def write(self, iterator) -> Written:
        store, scratch = _files(self.scratch)
        folder, names = f"{scratch}/{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex}", []
        store.create_dir(folder)
        for row in iterator:
            if row["name"] is None:
                raise ValueError("a document without a name can't be a file")
            names.append(f"{file_name(row['name'])}.{self.extension}")
            with store.open_output_stream(f"{folder}/{names[-1]}") as out:
                out.write((row["content"] or "").encode())
        return Written(folder, names)

    def commit(self, messages) -> None:
        store, target = _files(self.path)
        done = [m for m in messages if m is not None]
        names = [n for m in done for n in m.names]
        if len(set(names)) < len(names):
            self._clear()
            raise ValueError(f"documents share names: {sorted({n for n in names if names.count(n) > 1})[:5]}")
        if self.overwrite:
            from pyarrow import fs

            for old in store.get_file_info(fs.FileSelector(target, allow_not_found=True)):
                if old.is_file and old.base_name.endswith(f".{self.extension}") and old.base_name not in set(names):
                    store.delete_file(old.path)
        for m in done:
            for n in m.names:
                store.move(f"{m.folder}/{n}", f"{target}/{n}")
        self._clear()

    def abort(self, messages) -> None:
        self._clear()

    def _clear(self) -> None:
        store, scratch = _files(self.scratch)
        store.delete_dir(scratch)


class DocumentFiles(DataSource):
    """``df.write.format("document_files")`` for rows ``(name, content)``: one file a document; option ``extension``, json if not given."""

    @classmethod
    def name(cls) -> str:
        return "document_files"

    def schema(self) -> str:
        return "name string, content string"

    def writer(self, schema, overwrite: bool) -> FileWriter:
        return FileWriter(self.options["path"], self.options.get("extension", "json"), overwrite)


def write_documents(docs: DataFrame, path: str, extension: str = "json", mode: str = "overwrite") -> None:
    """``docs(name, content)`` as a file each, all or none."""
    docs.sparkSession.dataSource.register(DocumentFiles)
    docs.select(F.col("name").cast("string").alias("name"), F.col("content").cast("string").alias("content")).write.format("document_files").mode(mode).option("extension", extension).save(path)


#: Characters that a text key may have.
KEY_LENGTH = 255


def _attempt(rows: pd.Series) -> pd.Series:
    """The number of the attempt that a row is worked out in."""
    return pd.Series([TaskContext.get().taskAttemptId()] * len(rows))


def upsert_jdbc(df: DataFrame, url: str, table: str, key: str, driver: str | None = None, batch: int = 1000, **options: str) -> None:
    """``df`` into a table by ``key``: rows with a known key are replaced, others added, in one transaction.

    Tasks write to a staging table with the number of their attempt; of rows that a
    repeated task put there twice, the last attempt's count. So a killed task, or a
    second call after a failure, leaves no row twice and never half of them. Keys
    are unique in ``df``; null keys raise.
    """
    spark: SparkSession = df.sparkSession
    staging, columns = f"staging_{uuid.uuid4().hex[:16]}", list(df.columns)
    if driver:
        options = {**options, "driver": driver}
    rows = df.withColumn(key, F.coalesce(F.col(key), F.raise_error(F.lit("a row without a key")).cast(df.schema[key].dataType))).withColumn("row_attempt", F.pandas_udf(_attempt, "long")(F.col(key)))
    jvm = spark.sparkContext._jvm
    if driver:
        jvm.java.lang.Class.forName(driver)
    properties = jvm.java.util.Properties()
    for name, value in options.items():
        properties.setProperty(name, value)
    # a string is an unbounded text to most databases, and such can't be compared
    kinds = {"createTableColumnTypes": f"`{key}` VARCHAR({KEY_LENGTH})"} if df.schema[key].dataType.simpleString() == "string" else {}
    try:
        rows.write.format("jdbc").options(**kinds).option("url", url).option("dbtable", staging).option("batchsize", batch).options(**options).mode("overwrite").save()
        connection = jvm.java.sql.DriverManager.getConnection(url, properties)
        try:
            connection.setAutoCommit(False)
            quote = connection.getMetaData().getIdentifierQuoteString().strip()
            q = lambda c: f"{quote}{c}{quote}"
            statement = connection.createStatement()
            names = ", ".join(q(c) for c in columns)
            statement.executeUpdate(f"delete from {table} where {q(key)} in (select {q(key)} from {staging})")
            statement.executeUpdate(f"insert into {table} ({names}) select {names} from {staging} s where s.{q('row_attempt')} = (select max(t.{q('row_attempt')}) from {staging} t where t.{q(key)} = s.{q(key)})")
            statement.executeUpdate(f"drop table {staging}")
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()
    except Exception:
        _drop(jvm, url, properties, staging)
        raise


def _drop(jvm, url: str, properties, staging: str) -> None:
    """Drops the staging table if it is still there."""
    connection = jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        tables = connection.getMetaData().getTables(None, None, "%", None)
        names = []
        while tables.next():
            names.append(tables.getString("TABLE_NAME"))
        if staging.lower() in (n.lower() for n in names):
            connection.createStatement().executeUpdate(f"drop table {staging}")
    finally:
        connection.close()
