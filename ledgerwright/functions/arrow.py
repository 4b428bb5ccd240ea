"""Arrow functions over partitions."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def map_batches(df: DataFrame, function, schema: str) -> DataFrame:
    """``df.mapInArrow``; a local session's workers find this package, a cluster has it installed."""
    context = df.sparkSession.sparkContext
    if context.master.startswith("local"):
        paths = context.environment.get("PYTHONPATH", "").split(os.pathsep)
        if _ROOT not in paths:
            context.environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])
    return df.mapInArrow(function, schema)
