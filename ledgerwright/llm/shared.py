"""Stored intermediates on shared storage, table readers, and arrow helpers."""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwright.functions.stored import shared_folder

#: Rows of a file where a stored step's number of rows is known.
_ROWS_A_FILE = 50_000
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Workspace:
    """A folder of one run below the cluster's shared checkpoint folder.

    Intermediates that are read more than once are written here as Parquet, so a
    lost executor costs a re-read. The caller may remove the folder once the
    result is written.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
        self._steps = 0

    def store(self, df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
        """``df`` written and read back. Its shuffle files go once it is written: nothing else reads them.

        With ``rows``, the most it can have, it is written by as many tasks as that needs, to as many files.
        """
        path = self._next(name)
        if rows is not None:
            df = df.coalesce(max(1, -(-rows // _ROWS_A_FILE)))
        self._write(lambda: df.write.parquet(path))
        return self.spark.read.schema(df.schema).parquet(path)

    def store_by(self, df: DataFrame, name: str, *key: str) -> DataFrame:
        """``df`` stored as a table bucketed by ``key``: a join on these columns moves the other side only.

        There are as many buckets as shuffle partitions. The table's files are in this folder.
        """
        path, table_name = self._next(name), f"stored_{uuid.uuid4().hex}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        write = df.write.format("parquet").option("path", path).bucketBy(buckets, *key)
        self._write(lambda: write.saveAsTable(table_name))
        return self.spark.table(table_name)

    @contextmanager
    def inner(self, name: str) -> Iterator[Workspace]:
        """A workspace in this one's folder for the steps of a block; they go when it ends."""
        space = Workspace.__new__(Workspace)
        space.spark, space.path, space._steps = self.spark, self._next(name), 0
        try:
            yield space
        finally:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(space.path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _next(self, name: str) -> str:
        self._steps += 1
        return f"{self.path}/{self._steps:03d}-{name}"

    def _write(self, action) -> None:
        before = self.spark.conf.get(_CLEANUP, "false")
        self.spark.conf.set(_CLEANUP, "true")
        try:
            action()
        finally:
            self.spark.conf.set(_CLEANUP, before)


@contextmanager
def plain_operators(spark: SparkSession) -> Iterator[None]:
    """Plans made in the block run operator by operator, without code generated for whole stages."""
    setting = "spark.sql.codegen.wholeStage"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id) -> F.Column:
    """The remainder that keeps a document out of every training set."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def held_out_py(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


def slices(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of rows whose ``column`` has about ``most_bytes`` or is one row."""
    texts = batch.column(batch.schema.get_field_index(column))
    sizes = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    lengths = np.nan_to_num(np.asarray(pa.compute.binary_length(sizes).to_numpy(zero_copy_only=False), dtype=float))
    start, total = 0, 0.0
    for i, n in enumerate(lengths):
        if i > start and total + n > most_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0.0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


def arrow_map(df: DataFrame, function, schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package importable in the workers of a local session.

    On a cluster the package is installed or shipped with ``--py-files``.
    """
    context = df.sparkSession.sparkContext
    if context.master.startswith("local"):
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        paths = context.environment.get("PYTHONPATH", "").split(os.pathsep)
        if root not in paths:
            context.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        # The worker serves other stages, too; what Arrow has kept of this task's batches would stay with it.
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(released, schema)
