"""A cleaning pipeline over ``documents``; every stage calls one operator of ``sourceloom.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sourceloom.llm.common import store, without
from sourceloom.llm.decontaminate import contained_items
from sourceloom.llm.language_id import identify
from sourceloom.llm.line_dedup import dedup_lines
from sourceloom.llm.ngram_join import ngram_components
from sourceloom.llm.source_mix import mix_sources

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Below this mean share of its words a text's language counts as unknown.
LEAST_SCORE = 0.5


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a certain language; those without letters or with no language for half of their words go."""
    known = identify(docs.select(*COLUMNS))
    return known.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; those of which nothing is left go."""
    kept = dedup_lines(docs.select(*COLUMNS))
    text = F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("text"))
    left = kept.where("n_dropped = 0 OR trim(kept) <> ''").withColumn("text", text)
    return left.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_row``, a number of each row: its id if all ids differ and none is null, else one fixed in a stored table."""
    docs = docs.select(*COLUMNS)
    odd = docs.groupBy("doc_id").count().where("doc_id IS NULL OR count > 1")
    if not odd.limit(1).count():
        return docs.withColumn("_row", F.col("doc_id"))
    return store(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each component, at five words and a likeness of 0.8; null ids are the largest.

    Each row is a document: of rows with equal ids and texts one stays.
    """
    rows = keyed(docs)
    found = store(ngram_components(rows.select("_row", "text"), k=5, percent=80, id_col="_row"), "components")
    members = found.where("doc_id <> component_id").select(F.col("doc_id").alias("_row"), "component_id")
    heads = members.select("component_id").distinct().select(F.col("component_id").alias("_row"), "component_id")
    named = members.unionByName(heads).join(rows.select("_row", "doc_id"), "_row")
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("x"))
    gone = named.select("_row").join(first.select("x._row"), "_row", "left_anti")
    return without(rows, store(gone, "near-copies"), "_row").select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; each row is judged by itself, whatever its id."""
    rows = keyed(docs)
    leaks = contained_items(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="_row")
    return without(rows, store(leaks.select(F.col("doc_id").alias("_row")), "leaks"), "_row").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated towards square-root source weights and shuffled."""
    return mix_sources(docs.select(*COLUMNS))


STAGES = [("language_id", keep_languages), ("line_dedup", drop_lines), ("ngram_join", drop_near_copies),
          ("decontamination", drop_leaks), ("source_mix", mix)]
ORACLE_SQL = None  # language ID is a trained model


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result is stored before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
