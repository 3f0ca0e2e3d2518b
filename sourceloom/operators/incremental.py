"""What changed since the last run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def manifest(files: DataFrame, key: str = "path", content: str | Column = "content") -> DataFrame:
    """``(key, digest)`` to store after a run and compare with at the next."""
    return files.select(key, F.sha2(content, 256).alias("digest"))


def changed_files(current: DataFrame, previous: DataFrame, key: str = "path") -> DataFrame:
    """``(key, change)`` with change in new, changed, deleted; unchanged files are left out."""
    joined = current.select(key, F.col("digest").alias("now")).join(
        previous.select(key, F.col("digest").alias("before")), key, "full_outer"
    )
    change = (
        F.when(F.col("before").isNull(), "new").when(F.col("now").isNull(), "deleted")
        .when(F.col("now") != F.col("before"), "changed")
    )
    return joined.select(key, change.alias("change")).where("change IS NOT NULL")


def files_to_process(files: DataFrame, changes: DataFrame, key: str = "path") -> DataFrame:
    return files.join(changes.where("change <> 'deleted'").select(key), key, "left_semi")


def refreshed(collection: DataFrame, changes: DataFrame, fresh: DataFrame, key: str = "file_path") -> DataFrame:
    """Collection without rows of changed or deleted files, plus the fresh rows."""
    touched = changes.select(F.col(changes.columns[0]).alias(key))
    return collection.join(touched, key, "left_anti").unionByName(fresh, allowMissingColumns=True)
