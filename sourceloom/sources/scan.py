"""Corpus sources: a directory tree, or a table that already holds file texts."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence
from itertools import islice
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sourceloom.functions.paths import is_ignored, language_of
from sourceloom.functions.text import normalize_newlines
from sourceloom.operators.predicates import decoded, is_binary, is_text
from sourceloom.sources.shared import stored


def filesystem(spark: SparkSession, place: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def ignore_patterns(spark: SparkSession, root: str, ignore_file: str | None) -> list[str]:
    """Lines of ``<root>/<ignore_file>``; none if there is no name or no such file.

    One small configuration file, usually a dot file, which Spark's own readers skip.
    """
    if ignore_file is None:
        return []
    fs, path = filesystem(spark, f"{root.rstrip('/')}/{ignore_file}")
    if not fs.exists(path):
        return []
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()
    finally:
        stream.close()


def base_path(spark: SparkSession, root: str) -> str:
    """Path of the root without scheme and authority."""
    fs, path = filesystem(spark, root)
    return fs.makeQualified(path).toUri().getPath().rstrip("/")


def relative_path(location: Column, base: str) -> Column:
    """Path below the root from a URI: drops scheme and authority, then decodes."""
    plain = F.regexp_replace(location, r"\A[A-Za-z][\w+.-]*:(?://[^/]*)?", "")
    decoded_path = F.url_decode(F.replace(plain, F.lit("+"), F.lit("%2B")))
    return F.substring(decoded_path, F.lit(len(base) + 2), F.length(decoded_path))


def wanted(relative: Column, patterns: Sequence[str], languages: Sequence[str] | None = None) -> Column:
    """Whether a path below the root has one of the languages (any known one if none is named) and no rule excludes it."""
    language = language_of(relative)
    chosen = language.isNotNull() if languages is None else language.isin(*languages)
    return chosen & ~is_ignored(relative, patterns)


# A worker sends listed names and read files on in batches of so many rows or bytes.
BATCH_ROWS = 10_000
BATCH_BYTES = 4 << 20


def _places():
    """A function from a location as Hadoop writes it, nothing escaped, to its file system and the path there."""
    from pyarrow import fs as arrow_fs

    known = {"": (arrow_fs.LocalFileSystem(), "")}

    def place(uri: str):
        prefix, path = re.match(r"((?:[A-Za-z][\w+.-]*:)?(?://[^/]*)?)(.*)", uri, re.S).groups()
        prefix = "" if prefix in ("file:", "file://") else prefix
        if prefix not in known:
            store, found = arrow_fs.FileSystem.from_uri(prefix + quote(path))
            known[prefix] = store, found[:len(found) - len(path)]
        return known[prefix][0], known[prefix][1] + path

    return place


def _entries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What stands directly in each folder, a batch of names at a time."""
    from pyarrow import fs as arrow_fs

    place = _places()

    def standing(uri: str) -> Iterator[tuple[str, bool]]:
        store, folder = place(uri)
        if isinstance(store, arrow_fs.LocalFileSystem):  # name by name: a folder may hold very many
            with os.scandir(folder) as found:
                for i in found:
                    if i.is_dir() or i.is_file():
                        yield i.name, i.is_dir()
        else:
            for i in store.get_file_info(arrow_fs.FileSelector(folder)):
                if i.type in (arrow_fs.FileType.File, arrow_fs.FileType.Directory):
                    yield i.base_name, i.type == arrow_fs.FileType.Directory

    for frame in frames:
        for uri, below in zip(frame.uri, frame.path):
            names = standing(uri)
            while found := list(islice(names, BATCH_ROWS)):
                yield pd.DataFrame([(f"{uri.rstrip('/')}/{name}", f"{below}/{name}" if below else name, folder) for name, folder in found],
                                   columns=["uri", "path", "folder"])


def list_tree(spark: SparkSession, root: str, patterns: Sequence[str] = (), languages: Sequence[str] | None = None) -> DataFrame:
    """``(uri, path)`` of the wanted files below a folder, names that start with ``_`` or ``.`` included.

    A frontier of folders is a table; each round its folders are dealt over all tasks and listed one level deep, files and folders
    that no rule can want leave at once, and the folders found are the next frontier.  So one deep tree is split at every level, and the
    rounds are as many as the tree is deep.  Each round is stored, so a lost executor repeats one round's listing at most.
    """
    fs, path = filesystem(spark, root)
    schema = "uri string, path string, folder boolean"
    if not fs.exists(path):
        return spark.createDataFrame([], schema).drop("folder")
    frontier = spark.createDataFrame([(fs.makeQualified(path).toString(), "", True)], schema)
    found = None
    while True:
        level = frontier.repartition(spark.sparkContext.defaultParallelism, "uri").select("uri", "path").mapInPandas(_entries, schema)
        # A folder goes only if a rule excludes all below it and no rule takes paths back in.
        pruned = F.lit(False) if any(p.startswith("!") for p in patterns) else is_ignored(F.concat("path", F.lit("/.~any~name~")), [p for p in patterns if "*" not in p])
        level = stored(level.where(F.when(F.col("folder"), ~pruned).otherwise(wanted(F.col("path"), patterns, languages))), "listing")
        files = level.where("NOT folder").drop("folder")
        found = files if found is None else found.unionByName(files)
        frontier = level.where("folder")
        if frontier.isEmpty():
            return found


def _reader(most: int):
    """Reads listed files in the tasks, a batch of bytes at a time; a longer file than ``most`` bytes is an error."""
    def read(batches):
        import pyarrow as pa

        place = _places()
        kind = pa.schema([("path", pa.string()), ("language", pa.string()), ("content", pa.binary()), ("length", pa.int64()),
                          ("modificationTime", pa.timestamp("us", "UTC"))])
        rows, held = [], 0
        for batch in batches:
            for listed in batch.to_pylist():
                store, at = place(listed["uri"])
                info = store.get_file_info(at)
                if (info.size or 0) > most:
                    raise ValueError(f"{listed['uri']} has {info.size} bytes; spark.sql.sources.binaryFile.maxLength is {most}")
                with store.open_input_stream(at) as stream:
                    content = stream.read()
                rows.append({"path": listed["path"], "language": listed["language"], "content": content, "length": len(content),
                             "modificationTime": (info.mtime_ns or 0) // 1_000_000 * 1000})
                held += len(content)
                if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                    yield pa.RecordBatch.from_pylist(rows, kind)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, kind)

    return read


def list_corpus(
    spark: SparkSession, root: str, languages: Sequence[str] | None = None, ignore_file: str | None = None
) -> DataFrame:
    """Files of a tree with raw content.

    Tasks list the tree and read the files, so the driver holds no table of the files, as Spark's own file index
    would.  Rules and languages are tested on the listed paths, so no excluded file is opened.
    """
    patterns = ignore_patterns(spark, root, ignore_file)
    fs, path = filesystem(spark, root)
    if not fs.exists(path):
        spark.read.format("binaryFile").load(root)  # raises Spark's PATH_NOT_FOUND
    # As with Spark's file reader, half-copied folders and empty files stay out, unless a name on the way hides them from it.
    names = F.split("path", "/")
    hidden = F.exists(names, lambda s: s.startswith(".") | (s.startswith("_") & ~s.contains("=")))
    listed = list_tree(spark, root, patterns, languages).where(hidden | ~F.exists(names, lambda s: s.endswith("._COPYING_")))
    listed = listed.withColumn("language", language_of(F.col("path")))
    partitions = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    most = int(spark.conf.get("spark.sql.sources.binaryFile.maxLength", str(2**31 - 1)))
    read = listed.repartition(partitions, "path").mapInArrow(
        _reader(most), "path string, language string, content binary, length bigint, modificationTime timestamp")
    return read.where(hidden | (F.col("length") > 0))


def scan_corpus(
    spark: SparkSession, root: str, languages: Sequence[str] | None = None, ignore_file: str | None = None
) -> DataFrame:
    """``files(path, language, text)`` of a directory; binary and non-UTF-8 files are left out.

    A missing directory raises Spark's PATH_NOT_FOUND.
    """
    listed = list_corpus(spark, root, languages, ignore_file)
    content = F.col("content")
    return listed.where(~is_binary(content) & is_text(content)).select("path", "language", decoded(content).alias("text"))


def files_from_table(table: DataFrame, path_col: str, text_col: str, repo_col: str | None = None) -> DataFrame:
    """``files`` from rows at rest; with a repository column the path becomes ``repo/path``."""
    path = F.col(path_col) if repo_col is None else F.concat_ws("/", repo_col, path_col)
    named = table.select(path.alias("path"), language_of(F.col(path_col)).alias("language"),
                         normalize_newlines(F.col(text_col)).alias("text"))
    return named.where("language IS NOT NULL AND text IS NOT NULL")
