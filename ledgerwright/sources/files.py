"""Planning tables and SQL text on shared storage.

A table is a folder of Parquet files with a declared schema. New rows of a run
carry its id; a run counts once its marker is written, so a header is never
seen without its lines.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwright.schemas import TABLES, complete

RUN_COLUMN = "RunID"
_RUNS = "committed_runs"
#: Folder columns per table; the other layout keys sort the rows inside a file.
FOLDERS = {"BudgetLineItem": ["BudgetHeaderID", "FiscalPeriodID"]}


def _path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A planning table with its declared columns and types."""
    schema = TABLES[name].schema
    return spark.read.schema(schema).parquet(_path(root, name)).select(*schema.names)


def _laid_out(df: DataFrame, name: str) -> DataFrame:
    """Rows arranged for the table's layout key.

    Range partitioning on the layout key and the primary key keeps the key's
    rows together, while a folder that holds a third of the table is still
    written by many tasks.
    """
    table = TABLES[name]
    keys = [*table.cluster_by, *[k for k in table.primary_key if k not in table.cluster_by]]
    if not table.cluster_by:
        return df
    return df.repartitionByRange(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)


def write_table(df: DataFrame, root: str, name: str, now: str) -> None:
    """Write a whole table to a new folder; columns it lacks get their defaults."""
    rows = _typed(complete(df, TABLES[name], now), name)
    writer = _laid_out(rows, name).write.mode("errorifexists")
    if name in FOLDERS:
        writer = writer.partitionBy(*FOLDERS[name])
    writer.parquet(_path(root, name))


def _typed(df: DataFrame, name: str) -> DataFrame:
    """Declared types; a NULL in a required column is an error, as in the table's DDL."""
    out = []
    for c in TABLES[name].columns:
        value = F.col(c.name).cast(c.type)
        if c.required:
            value = F.coalesce(value, F.raise_error(F.lit(f"NULL in required column {name}.{c.name}")).cast(c.type))
        out.append(value.alias(c.name))
    return df.select(*out)


def replace_folders(df: DataFrame, root: str, name: str, now: str) -> None:
    """Replace only the folders that ``df`` has rows for.

    ``df`` must not read the folders it replaces: store it first.
    """
    rows = _typed(complete(df, TABLES[name], now), name)
    (
        _laid_out(rows, name)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*FOLDERS[name])
        .parquet(_path(root, name))
    )


def write_folders(df: DataFrame, path: str, name: str, now: str) -> None:
    """Rows of a table in its folders below ``path``, in place of what is there."""
    rows = _typed(complete(df, TABLES[name], now), name)
    _laid_out(rows, name).write.mode("overwrite").partitionBy(*FOLDERS[name]).parquet(path)


def append_run(frames: dict[str, DataFrame], root: str, run_id: str, now: str) -> None:
    """Write the rows of one run to its own folders of several tables, then mark the run committed.

    A retry replaces what a failed attempt left under the same id; a committed id is refused.
    """
    spark = next(iter(frames.values())).sparkSession
    if not _committed(spark, root).where(F.col(RUN_COLUMN) == run_id).isEmpty():
        raise ValueError(f"run {run_id} is committed already")
    for name, df in frames.items():
        rows = _typed(complete(df, TABLES[name], now), name)
        rows.write.mode("overwrite").parquet(f"{_path(root, f'{name}_runs')}/{RUN_COLUMN}={run_id}")
    spark.createDataFrame([(run_id,)], f"{RUN_COLUMN} string").coalesce(1).write.mode("append").parquet(
        _path(root, _RUNS)
    )


def _committed(spark: SparkSession, root: str) -> DataFrame:
    """Ids of committed runs; none where no run was ever committed."""
    try:
        return spark.read.schema(f"{RUN_COLUMN} string").parquet(_path(root, _RUNS))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{RUN_COLUMN} string")


def read_runs(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Rows of committed runs of a table."""
    schema = T.StructType([*TABLES[name].schema.fields, T.StructField(RUN_COLUMN, T.StringType())])
    rows = spark.read.schema(schema).parquet(_path(root, f"{name}_runs"))
    return rows.join(_committed(spark, root), RUN_COLUMN, "left_semi").drop(RUN_COLUMN)


_SQL = "*.[sS][qQ][lL]"


def _sql_text(spark: SparkSession, paths: tuple[str, ...], **how) -> DataFrame:
    return spark.read.options(recursiveFileLookup=True, pathGlobFilter=_SQL).text(list(paths), **how)


def read_sql_files(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, text) of every .sql file under the given folders, one row per file."""
    files = _sql_text(spark, paths, wholetext=True)
    return files.select(F.input_file_name().alias("path"), F.make_valid_utf8("value").alias("text"))


def read_sql_chunks(spark: SparkSession, *paths: str, most: int = 8 << 20, lines: int = 20_000) -> DataFrame:
    """(path, block, chunk, text) of every .sql file under the given folders.

    Files of up to ``most`` bytes are one chunk. Larger ones are read by as many tasks as
    Spark has splits for them; a split is a block, and ``lines`` rows in a row a chunk.
    """
    small = _sql_text(spark, paths, wholetext=True).where(f"_metadata.file_size <= {most}")
    small = small.selectExpr("input_file_name() AS path", "0L AS block", "0L AS chunk", "make_valid_utf8(value) AS text")
    # Rows of a split are in one task and in order, so their numbers are too.
    large = _sql_text(spark, paths, lineSep="\n").where(f"_metadata.file_size > {most}")
    large = large.selectExpr(
        "input_file_name() AS path", "_metadata.file_block_start AS block", "monotonically_increasing_id() AS at",
        "make_valid_utf8(value) AS line",
    )
    joined = "concat(array_join(transform(array_sort(collect_list(struct(at, line))), x -> x.line), '\n'), '\n') AS text"
    large = large.groupBy("path", "block", F.expr(f"at div {lines}").alias("chunk")).agg(F.expr(joined))
    return small.unionByName(large)
