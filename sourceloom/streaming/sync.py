"""Keeps a collection of chunks in step with a corpus whose files come, change and go."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from sourceloom.operators.chunks import extract_functions
from sourceloom.operators.incremental import changed_files, files_to_process, manifest
from sourceloom.operators.snapshots import Snapshots
from sourceloom.sources.shared import stored


def chunks_of(spark: SparkSession, place: str) -> Snapshots:
    return Snapshots(spark, f"{place.rstrip('/')}/chunks", ["file_path"])


# Fixed value: HotSpot never compiles a method of more bytes.
COMPILED_BYTES = 8000


@contextmanager
def compiled(spark: SparkSession):
    """While it lasts, Spark splits generated code that the JVM would only interpret, as that of all languages' patterns."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), COMPILED_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def sync(spark: SparkSession, files: DataFrame, place: str) -> int:
    """Brings the collection under ``place`` to ``files(path, language, text)`` and returns its version.

    The digest of every file is kept beside the chunks.  Files whose digest is new or another are extracted, rows of changed and
    deleted files go, and only data files that hold such rows are written anew; without a change nothing is written.
    The chunks are committed before the digests, so after a stop between the two the next run does the same change again.  Run it
    on a schedule, or per micro-batch of a stream of change notices; a path stands once in ``files``.
    """
    with compiled(spark):
        return _synced(spark, files, place)


def _synced(spark: SparkSession, files: DataFrame, place: str) -> int:
    chunks, digests = chunks_of(spark, place), Snapshots(spark, f"{place.rstrip('/')}/digests", ["path"])
    now = stored(manifest(files, content="text"), "digests")
    if not digests.versions():
        version = chunks.write(extract_functions(files))
        digests.write(now)
        return version
    changes = stored(changed_files(now, digests.read()), "changes")
    if changes.isEmpty():
        return chunks.versions()[-1]
    fresh = extract_functions(files_to_process(files, changes))
    version = chunks.replace(changes.select(F.col("path").alias("file_path")), fresh)
    digests.replace(changes.select("path"), now.join(changes.select("path"), "path", "left_semi"))
    return version
