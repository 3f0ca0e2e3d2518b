"""File-at-a-time ingestion: new files of a directory become chunk rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from sourceloom.functions.paths import SUFFIX_GLOB, language_of
from sourceloom.operators.chunks import extract_functions
from sourceloom.operators.predicates import decoded, is_binary, is_text
from sourceloom.sources.scan import base_path, relative_path, wanted


def file_stream(
    spark: SparkSession, root: str, patterns: Iterable[str] = (), max_files: int | None = None, languages: Sequence[str] | None = None
) -> DataFrame:
    """Stream of ``files(path, language, text)``; each file is seen once.

    Paths are relative to the root and go through the ignore rules and languages as in ``list_corpus``.  Spark's stream listing leaves out names that start with ``_`` or ``.``.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", SUFFIX_GLOB)
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    content = F.col("content")
    path = relative_path(F.col("_metadata.file_path"), base_path(spark, root))
    kept = reader.load(root).withColumn("path", path).where(wanted(F.col("path"), list(patterns), languages))
    return kept.where(~is_binary(content) & is_text(content)).select(
        "path", language_of(F.col("path")).alias("language"), decoded(content).alias("text")
    )


def ingest(files: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Extracts the streamed files not seen before and stops; rerun it to pick up later ones.

    Every micro-batch writes its own ``batch_id`` folder and replaces it when
    retried, so a lost driver or executor leaves no duplicate rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        extract_functions(batch).write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch_id={batch_id}")

    return (
        files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
