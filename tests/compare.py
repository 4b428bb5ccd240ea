"""Run queries and their SQL counterparts side by side.

    python tests/compare.py <sf_dir> [query ...]
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def canonical(value):
    if isinstance(value, float):
        return f"{value:.6f}"
    return str(value)


def multiset(names, tuples):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(canonical(t[i]) for i in order) for t in tuples)


def connect(sf_dir):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def sql_rows(db, text):
    cursor = db.execute(text)
    return multiset([c[0] for c in cursor.description], cursor.fetchall())


def spark_rows(df):
    return multiset(df.columns, [tuple(r) for r in df.collect()])


def difference(spark, db, sf_dir, name, query, text):
    """'ok' and the row count when both sides agree, else what differs."""
    have, want = spark_rows(query(spark, sf_dir)), sql_rows(db, text)
    if have[0] != want[0]:
        return f"columns {sorted(set(have[0]) ^ set(want[0]))}"
    if have[1] != want[1]:
        extra, missing = have[1] - want[1], want[1] - have[1]
        return (
            f"rows {sum(have[1].values())} / {sum(want[1].values())}; {have[0]}\n"
            f"  only in Spark {sum(extra.values())}: {list(extra)[:2]}\n"
            f"  only in SQL   {sum(missing.values())}: {list(missing)[:2]}"
        )
    return f"ok {sum(have[1].values())}"


def session(cpus=8):
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def main(sf_dir, *names):
    import __spark_entry__ as entry

    spark, db = session(), connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in names or queries:
        started = time.time()
        try:
            found = difference(spark, db, sf_dir, name, queries[name], oracles[name])
        except Exception as error:  # report and go on with the next query
            found = f"ERROR {type(error).__name__} {str(error)[:600]}"
        print(f"{name:32s} {time.time() - started:6.1f}s {found}", flush=True)


if __name__ == "__main__":
    main(*sys.argv[1:])
