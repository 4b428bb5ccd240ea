"""Intermediate results written to the cluster's shared checkpoint folder.

Used where a result is read more than once or a loop must cut its lineage. A
lost executor costs a re-read of files, not a recomputation.

    with stored.run(spark):
        ledger.write.parquet(...)  # what is stored on the way goes when the block ends
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SETTING = "spark.checkpoint.dir"
_RUN = "ledgerwright.run.folder"
_PARTITIONS = "spark.sql.shuffle.partitions"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows that one task is given to sort or to group.
ROWS_A_TASK = 500_000
#: Rows that are joined at once where a step is made slice by slice, and slices at most: each reads the step's input again.
ROWS_A_SLICE = 2_000_000
MOST_SLICES = 6
_local: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder of the running block, else the session's checkpoint folder.

    A local session without the setting gets a temporary folder that goes with the
    process; a cluster has to name one.
    """
    folder = spark.conf.get(_RUN, None) or spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that every executor can reach")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="ledgerwright-"))
        atexit.register(shutil.rmtree, _local[0], True)
    return _local[0]


@contextmanager
def run(spark: SparkSession) -> Iterator[str]:
    """A folder for what is stored in the block; removed when it ends."""
    outer = spark.conf.get(_RUN, None)
    folder = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"
    spark.conf.set(_RUN, folder)
    try:
        yield folder
    finally:
        spark.conf.unset(_RUN) if outer is None else spark.conf.set(_RUN, outer)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession, rows: int) -> int:
    """The session's number of shuffle partitions, or as many as ``rows`` rows need."""
    return max(int(spark.conf.get(_PARTITIONS)), -(-rows // ROWS_A_TASK))


@contextmanager
def sized(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is written in the block shuffles to enough partitions for ``rows`` rows; adaptive execution joins small ones."""
    before = spark.conf.get(_PARTITIONS)
    spark.conf.set(_PARTITIONS, str(partitions(spark, rows)))
    try:
        yield
    finally:
        spark.conf.set(_PARTITIONS, before)


@contextmanager
def _no_shuffle_left(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is written in the block go once it is written: nothing else reads them."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a DataFrame that reads it back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    with _no_shuffle_left(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(rows: int) -> int:
    """In how many slices a step over ``rows`` rows is made, so that its shuffles take a part of the disk at a time."""
    return max(1, min(MOST_SLICES, rows // ROWS_A_SLICE))


def in_slice(keys: list[str], n: int, k: int) -> str:
    """The condition of the rows of slice ``k`` of ``n`` by ``keys``, any of which may be null."""
    return f"pmod(xxhash64({', '.join(keys)}), {n}) = {k}"


class Pieces:
    """Rows that are stored piece by piece, in a folder for each slice by ``keys`` if there are several."""

    def __init__(self, spark: SparkSession, label: str, keys: list[str] | None = None, n: int = 1):
        self.spark, self.n = spark, n
        self.path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
        self._slice = f"pmod(xxhash64({', '.join(keys)}), {n})" if keys else "0L"
        self._schema = None

    def add(self, df: DataFrame) -> None:
        self._schema = df.schema
        sliced = df.selectExpr("*", f"CAST({self._slice} AS INT) AS _slice")
        with _no_shuffle_left(self.spark):
            sliced.write.option("compression", "zstd").partitionBy("_slice").mode("append").parquet(self.path)

    def rows(self, k: int | None = None) -> DataFrame:
        """All rows, or those of a slice."""
        schema = T.StructType([*self._schema.fields, T.StructField("_slice", T.IntegerType())])
        rows = self.spark.read.schema(schema).parquet(self.path)
        return (rows if k is None else rows.where(f"_slice = {k}")).drop("_slice")

    def drop(self, k: int | None = None) -> None:
        """Remove what is stored, or a slice of it, that nothing will read again."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path if k is None else f"{self.path}/_slice={k}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
