"""Points and collections: ids, payloads, writes, upserts and run reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# Id ranges: files fall into this many groups by the leading hex digits of a digest.
ID_GROUPS_HEX = 4

# Payload keys in their order; the chunk name is stored as ``function_name``.
PAYLOAD = ("function_name", "file_path", "start_line", "end_line", "language", "function_type", "code", "arguments",
           "return_type", "docstring", "modifiers", "scope", "imports", "calls", "complexity", "loc", "comment_lines")


def point_ids(chunks: DataFrame, start_id: int = 0, id_col: str = "id") -> DataFrame:
    """Consecutive ids from ``start_id`` in the order (group, path, position).

    The group is a digest prefix of the path, a pure function of the row, so a
    rerun task yields the same ids.  Ranks are taken per group and shifted by
    the total of the groups before, a table of at most 16**4 rows; no window
    ever spans the whole data.
    """
    grouped = chunks.withColumn("id_group", F.substring(F.md5("file_path"), 1, ID_GROUPS_HEX))
    sizes = grouped.groupBy("id_group").agg(F.count("*").alias("size"))
    running = Window.orderBy("id_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("id_group", F.coalesce(F.sum("size").over(running), F.lit(0)).alias("id_offset"))
    order = Window.partitionBy("id_group").orderBy("file_path", "start_line", "start_column")
    ranked = grouped.withColumn("id_rank", F.row_number().over(order))
    # At most 16**4 small rows by construction.
    return ranked.join(F.broadcast(offsets), "id_group").withColumn(
        id_col, F.lit(start_id) + F.col("id_offset") + F.col("id_rank") - 1
    ).drop("id_group", "id_offset", "id_rank")


def payload(chunks: DataFrame) -> Column:
    """Struct of the stored metadata of a chunk."""
    named = {"function_name": F.col("name")}
    return F.struct(*[named.get(key, F.col(key)).alias(key) for key in PAYLOAD])


def with_repository(df: DataFrame, repos: DataFrame | None = None, on: str = "repo", **constants: str) -> DataFrame:
    """Repository metadata on every row: constants for one repository, a join for several."""
    for column, value in constants.items():
        df = df.withColumn(column, F.lit(value))
    return df if repos is None else df.join(repos, on, "left")


def collection_name(root: str, name: str | None = None) -> str:
    """Given name, or the last segment of the corpus root."""
    return name or root.rstrip("/").rsplit("/", 1)[-1]


def write_collection(points: DataFrame, warehouse: str, name: str, partition_by: Sequence[str] = ("language",)) -> str:
    """Replaces the collection as a whole and returns its place."""
    place = f"{warehouse.rstrip('/')}/{name}"
    points.write.mode("overwrite").partitionBy(*partition_by).parquet(place)
    return place


def read_collection(spark: SparkSession, place: str) -> DataFrame:
    return spark.read.parquet(place)


def newest(batch: DataFrame, key: str | Sequence[str] = "id", latest: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest by the ``latest`` columns, then by the others; map columns are not compared."""
    others = [f.name for f in batch.schema.fields if f.name not in latest and f.dataType.typeName() != "map"]
    order = F.struct(*(F.col(f"`{c}`") for c in (*latest, *others)))
    row = F.struct(*(F.col(f"`{c}`") for c in batch.columns))
    return batch.groupBy(*([key] if isinstance(key, str) else key)).agg(F.max_by(row, order).alias("_row")).select("_row.*")


def upsert(existing: DataFrame, batch: DataFrame, key: str = "id", latest: Sequence[str] = ()) -> DataFrame:
    """One row of the batch per key, see ``newest``, and the existing rows whose key it does not hold."""
    return existing.join(batch.select(key), key, "left_anti").unionByName(newest(batch, key, latest), allowMissingColumns=True)


def upsert_collection(spark: SparkSession, place: str, batch: DataFrame, new_place: str, key: str = "id",
                      partition_by: Sequence[str] = ("language",), latest: Sequence[str] = ()) -> str:
    """Writes the merged collection beside the old one, which stays valid if the job dies."""
    merged = upsert(read_collection(spark, place), batch, key, latest)
    merged.write.mode("overwrite").partitionBy(*partition_by).parquet(new_place)
    return new_place


def run_summary(files: DataFrame, chunks: DataFrame) -> DataFrame:
    """Files, functions and lines per language, with a total row (language NULL)."""
    per_file = files.groupBy("language").agg(F.count("*").alias("files"))
    per_chunk = chunks.groupBy("language").agg(F.count("*").alias("functions"), F.sum("loc").alias("loc"))
    # Both sides hold one row per language here.
    joined = per_file.join(per_chunk, "language", "left")
    return joined.rollup("language").agg(
        F.sum("files").alias("files"),
        F.coalesce(F.sum("functions"), F.lit(0)).alias("functions"),
        F.coalesce(F.sum("loc"), F.lit(0)).alias("loc"),
    )


def metric_stats(chunks: DataFrame, by: Sequence[str] = ("language",)) -> DataFrame:
    """Average, maximum and median of the line and branch metrics."""
    aggregates = []
    for metric in ("loc", "comment_lines", "complexity"):
        aggregates += [
            F.avg(metric).alias(f"avg_{metric}"), F.max(metric).alias(f"max_{metric}"),
            F.percentile(metric, F.lit(0.5)).alias(f"median_{metric}"),
        ]
    return chunks.groupBy(*by).agg(F.count("*").alias("functions"), *aggregates)
