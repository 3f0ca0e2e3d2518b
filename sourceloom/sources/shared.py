"""Where jobs put tables that several executors must see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """Fresh folder name under ``spark.checkpoint.dir``; if that is unset, a local one for a local master, else an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Writes ``df`` once and reads it back: for results that several branches of a job use.

    Unlike a cache it survives the loss of executors, and it cuts the lineage.
    """
    place = shared_folder(df.sparkSession, purpose)
    df.write.parquet(place)
    return df.sparkSession.read.parquet(place)


def spread(df: DataFrame) -> DataFrame:
    """Redistributes a scan that has fewer tasks than cores (one large row group), else nothing.

    Only for plain scans of few files; a scan of many files already has its tasks.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
