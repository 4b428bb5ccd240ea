"""Changes of a stored table that are seen all at once or not at all.

The table's own folders are never touched. A change writes new folders beside them, below
the id of its run, and then one marker: a version that maps each changed folder to the
run. Readers take each folder from its latest version, so until the marker is there they
see the old rows, and a run that fails leaves nothing that is read. Markers are numbered
and moved into place, which fails if the number is taken. A writer names the folders it
has read; if one of them has a newer version by then, the writer is refused and has to
read again.
"""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwright.schemas import TABLES
from ledgerwright.sources import files

_MARK = "version"
_TAKEN = "FileAlreadyExistsException"


class Conflict(RuntimeError):
    """Another writer changed a folder since it was read."""


@dataclass(frozen=True)
class Snapshot:
    """A table as of one version."""

    version: int
    rows: DataFrame


def _folder(root: str, name: str, what: str) -> str:
    return f"{root.rstrip('/')}/{name}_{what}"


def _types(name: str) -> list[T.StructField]:
    return [TABLES[name].schema[c] for c in files.FOLDERS[name]]


def _hadoop(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def last_version(spark: SparkSession, root: str, name: str) -> int:
    """The number of the latest marker; 0 for a table that was never changed."""
    path, fs = _hadoop(spark, _folder(root, name, "versions"))
    if not fs.exists(path):
        return 0
    found = [s.getPath().getName() for s in fs.listStatus(path)]
    return max([int(f.split("=")[1]) for f in found if f.startswith(f"{_MARK}=")], default=0)


def _markers(spark: SparkSession, root: str, name: str, until: int) -> DataFrame:
    """Changed folders with their run, for the versions up to ``until``."""
    fields = [*_types(name), T.StructField(files.RUN_COLUMN, T.StringType()), T.StructField(_MARK, T.LongType())]
    schema = T.StructType(fields)
    if not until:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(_folder(root, name, "versions")).where(F.col(_MARK) <= until)


def read_version(spark: SparkSession, root: str, name: str, version: int | None = None) -> Snapshot:
    """The table as of a version, the latest one by default."""
    version = last_version(spark, root, name) if version is None else version
    base = files.read_table(spark, root, name)
    if not version:
        return Snapshot(0, base)
    keys = files.FOLDERS[name]
    current = _markers(spark, root, name, version).groupBy(*keys).agg(F.max_by(files.RUN_COLUMN, _MARK).alias(files.RUN_COLUMN))
    schema = T.StructType([*TABLES[name].schema.fields, T.StructField(files.RUN_COLUMN, T.StringType())])
    runs = spark.read.schema(schema).parquet(_folder(root, name, "changes"))
    changed = runs.join(current, [files.RUN_COLUMN, *keys], "left_semi").select(*base.columns)
    return Snapshot(version, base.join(current.select(*keys), keys, "left_anti").select(*base.columns).unionByName(changed))


def publish(
    df: DataFrame, root: str, name: str, now: str, run_id: str, read: DataFrame, snapshot: Snapshot
) -> int:
    """Make ``df`` the rows of the folders it names, as one new version; its number.

    ``read`` has all or some of the folder columns: what the change depends on. A retry
    under the same id replaces what a failed attempt left.
    """
    spark, keys = df.sparkSession, files.FOLDERS[name]
    target = f"{_folder(root, name, 'changes')}/{files.RUN_COLUMN}={run_id}"
    files.write_folders(df, target, name, now)
    # The folder names come from the files just written, one row each.
    written = spark.read.schema(TABLES[name].schema).parquet(target).select(*keys).distinct()
    written = written.withColumn(files.RUN_COLUMN, F.lit(run_id))
    waiting = f"{_folder(root, name, 'changes')}/_marker-{run_id}"
    written.coalesce(1).write.mode("overwrite").parquet(waiting)
    seen = snapshot.version
    while True:
        latest = last_version(spark, root, name)
        if latest > seen:
            newer = _markers(spark, root, name, latest).where(F.col(_MARK) > seen)
            on = [c for c in keys if c in read.columns]
            if not newer.join(read.select(*on).distinct(), on, "left_semi").isEmpty():
                raise Conflict(f"{name}: a folder that run {run_id} has read was changed after version {seen}")
            seen = latest
        if _moved(spark, waiting, f"{_folder(root, name, 'versions')}/{_MARK}={seen + 1}"):
            return seen + 1


def _moved(spark: SparkSession, source: str, target: str) -> bool:
    """Move a folder to a name that nobody has; false if it is taken."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    source, target = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.getFileSystem(conf).getUri(), conf)
    context.mkdir(target.getParent(), None, True)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(source, target, options)
    except Py4JJavaError as error:
        if _TAKEN in str(error.java_exception):
            return False
        raise
    return True
