"""Tables that are worked out once and kept in the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; one is made here only where none is named and Spark runs on one machine, as in tests."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder and not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors see")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))
    return context.getCheckpointDir()


def settled(df: DataFrame) -> DataFrame:
    """``df`` worked out once and kept in the checkpoint folder, so what follows starts from a table."""
    _folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """As ``settled``, as a Parquet table there: for what is as large as the input, and read by few of its columns."""
    path = f"{_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
