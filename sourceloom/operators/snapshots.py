"""Collections in versions: a manifest names the files of a snapshot, and a change rewrites only the files it touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from sourceloom.operators.collection import newest
from sourceloom.sources.scan import filesystem
from sourceloom.sources.shared import stored

MANIFEST = "file string, low string, high string, n_rows bigint, version bigint"


class Snapshots:
    """A collection under ``place``: data files in ``data/<version>``, and per version a manifest of the files that make it up.

    A version counts once its manifest is complete (Spark's ``_SUCCESS`` file), so a job that dies earlier leaves the version before valid, and its
    rerun overwrites what it left.  Files are dealt by ranges of the ``key`` columns and the manifest holds the least and greatest key
    of each (as text), so that a change looks only into files whose range meets its keys.  One writer at a time.
    """

    def __init__(self, spark: SparkSession, place: str, key: Sequence[str] = ("id",)) -> None:
        self.spark, self.place, self.key = spark, place.rstrip("/"), list(key)

    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        fs, path = filesystem(self.spark, f"{self.place}/manifests")
        if not fs.exists(path):
            return []
        found = [s.getPath() for s in fs.listStatus(path)]
        done = [p for p in found if p.getName().isdigit() and fs.exists(p.suffix("/_SUCCESS"))]
        return sorted(int(p.getName()) for p in done)

    def manifest(self, version: int | None = None) -> DataFrame:
        """Files of a version, the last one if none is named."""
        known = self.versions()
        version = version if version is not None else (known[-1] if known else None)
        if version not in known:
            raise ValueError(f"no version {version} under {self.place}")
        return self.spark.read.schema(MANIFEST).parquet(f"{self.place}/manifests/{version:08d}")

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of a version; the file names are the driver's only part in it."""
        return self._files([r.file for r in self.manifest(version).select("file").collect()])

    def write(self, rows: DataFrame, files: int | None = None) -> int:
        """A first or wholly new version in ``files`` files (by default Spark's shuffle partitions)."""
        known = self.versions()
        return self._commit(known[-1] + 1 if known else 1, rows, None, files)

    def replace(self, keys: DataFrame, rows: DataFrame) -> int:
        """A version without the rows whose key columns occur in ``keys``, and with ``rows``; no other file is read whole or rewritten."""
        last = self.versions()[-1]
        manifest = self.manifest(last)
        keys = keys.select(*self.key).distinct()
        range_ = keys.agg(F.min(self._first(keys)).alias("low"), F.max(self._first(keys)).alias("high")).first()
        near = manifest.where((F.col("high") >= range_.low) & (F.col("low") <= range_.high)) if range_.low is not None else manifest.limit(0)
        candidates = [r.file for r in near.select("file").collect()]
        touched: list[str] = []
        if candidates:
            found = self._files(candidates).select(*self.key, F.col("_metadata.file_path").alias("_file")).join(keys, self.key, "left_semi")
            touched = [r._file for r in found.select("_file").distinct().collect()]  # at most one row per file
        names = {self._name(f) for f in touched}
        kept = [f for f in (r.file for r in manifest.select("file").collect()) if self._name(f) not in names]
        if touched:
            rest = self._files([f for f in candidates if self._name(f) in names]).join(keys, self.key, "left_anti")
            rows = rest.unionByName(rows, allowMissingColumns=True)
        return self._commit(last + 1, rows, manifest.where(F.col("file").isin(kept)) if kept else None, max(len(touched), 1))

    def upsert(self, batch: DataFrame, latest: Sequence[str] = ()) -> int:
        """A version with one row of the batch per key (see ``newest``) in place of the rows with such a key."""
        return self.replace(batch, newest(batch, self.key, latest))

    def _files(self, files: list[str]) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.place}/data/{self.versions()[0]:08d}").schema if not files else None
        return self.spark.createDataFrame([], schema) if schema is not None else self.spark.read.option("mergeSchema", "true").parquet(*files)

    @staticmethod
    def _name(file: str) -> str:
        return "/".join(file.split("/")[-2:])

    def _first(self, rows: DataFrame):
        """The first key column as text of one length for whole numbers, so that texts compare as the numbers do."""
        name = self.key[0]
        if rows.schema[name].dataType.typeName() in ("byte", "short", "integer", "long"):
            # Shifted above 0, then padded.
            shifted = F.col(name).cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")
            return F.lpad(shifted.cast("decimal(20,0)").cast("string"), 20, "0")
        return F.col(name).cast("string")

    def _commit(self, version: int, rows: DataFrame, kept: DataFrame | None, files: int | None) -> int:
        place = f"{self.place}/data/{version:08d}"
        rows = stored(rows, "change")  # range partitioning reads its input twice
        dealt = rows.repartitionByRange(files, *self.key) if files else rows.repartitionByRange(*self.key)
        dealt.write.mode("overwrite").parquet(place)
        written = self.spark.read.schema(rows.schema).parquet(place)
        first = self._first(written)
        made = written.groupBy(F.col("_metadata.file_path").alias("file")).agg(
            F.coalesce(F.min(first), F.lit("")).alias("low"), F.coalesce(F.max(first), F.lit("")).alias("high"),
            F.count("*").alias("n_rows")).withColumn("version", F.lit(version).cast("bigint"))
        whole = made if kept is None else kept.unionByName(made)
        whole.coalesce(1).write.mode("overwrite").parquet(f"{self.place}/manifests/{version:08d}")
        return version
