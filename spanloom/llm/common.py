"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows whose crc32(doc_id) mod 3 has this remainder are held out of training.
HELD_OUT = 1


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``.

    It is set here only where the session names none and runs on one machine, as
    in tests; on a cluster without one this raises, as a temporary folder would be
    another on every machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors see")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    It cuts the lineage in a way that survives the loss of executors, and joins
    that follow get plain scans, whose shuffles AQE can split where keys are hot.
    """
    path = new_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables that an operator writes on its way, deleted once what was made of them is written."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, {}

    def put(self, df: DataFrame, tag: str) -> DataFrame:
        """As :func:`written`, remembered by its tag; the table that had the tag before is deleted."""
        path = new_path(self.spark, tag)
        df.write.parquet(path)
        self.drop(tag)
        self.paths[tag] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tags: str) -> None:
        jvm = self.spark.sparkContext._jvm
        for path in [self.paths.pop(tag) for tag in tags if tag in self.paths]:
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


#: Bits of a Bloom filter, whatever the number of keys; a key sets one in either half of its 64 bits.
BLOOM_BITS, SHIFTS = 1 << 27, (0, 32)


def bloom(hashes: DataFrame, column: str) -> np.ndarray:
    """A Bloom filter of a column of 64-bit hashes, of BLOOM_BITS bits: all that the driver gets."""
    places = F.array(*[F.shiftrightunsigned(F.col(column), k).bitwiseAND(F.lit(BLOOM_BITS - 1)) for k in SHIFTS])
    words = hashes.select(F.explode(places).alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits")).toArrow()
    out = np.zeros(BLOOM_BITS // 64, dtype=np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out


def may_hold(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which 64-bit hashes can be in the filter; those that are always are."""
    right = np.ones(len(hashes), dtype=bool)
    for k in SHIFTS:
        at = (hashes.view(np.uint64) >> np.uint64(k)).astype(np.int64) & (BLOOM_BITS - 1)
        right &= filter_[at >> 6] >> (at & 63) & 1 == 1
    return right


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def is_held_out(doc_id: str = "doc_id"):
    """True where crc32(doc_id as text) mod 3 is 1; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == HELD_OUT, F.lit(False))
