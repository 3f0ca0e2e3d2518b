"""What several operators share: tables in the shared folder, checked broadcasts, code on the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession, functions as F

from sourceloom.sources.shared import shared_folder

#: Rows of one or two 64-bit columns that may be broadcast: at most about 64 MB in an executor.
SMALL_ROWS = 2_000_000

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the executors this package through Spark's own file server, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    place = os.path.join(tempfile.mkdtemp(prefix="code-"), "sourceloom.zip")
    with zipfile.ZipFile(place, "w") as pack:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    pack.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(place)
    _shipped.add(context.applicationId)


def store(df: DataFrame, purpose: str) -> DataFrame:
    """Writes ``df`` once under ``spark.checkpoint.dir`` and reads it back: cuts the lineage and survives lost executors."""
    place = shared_folder(df.sparkSession, purpose)
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def apart(docs: DataFrame, *outputs: str):
    """``docs`` with its columns named by place, the place of a column, and what passes through.

    No name of the input then meets a name that an operator uses inside; input columns named like one of ``outputs``
    (case aside) give way to it.
    """
    places = {name.lower(): f"in_{i}" for i, name in reversed(list(enumerate(docs.columns)))}
    taken = {name.lower() for name in outputs}
    through = [F.col(f"in_{i}").alias(name) for i, name in enumerate(docs.columns) if name.lower() not in taken]
    return docs.toDF(*(f"in_{i}" for i in range(len(docs.columns)))), lambda name: places[name.lower()], through


def small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it is counted and within ``rows``; beyond that Spark shuffles both sides."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def only(df: DataFrame, keys: DataFrame, *names: str) -> DataFrame:
    """Rows of ``df`` whose ``names`` occur in ``keys``; the texts move only if the keys are too many to broadcast."""
    return df.join(small(keys.select(*names).distinct()), list(names), "left_semi")


def without(df: DataFrame, keys: DataFrame, *names: str) -> DataFrame:
    """Rows of ``df`` whose ``names`` do not occur in ``keys``."""
    return df.join(small(keys.select(*names).distinct()), list(names), "left_anti")
