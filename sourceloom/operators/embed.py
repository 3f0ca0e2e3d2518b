"""Text → vectors, and retrieval over stored vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from sourceloom.functions import vectors as V

# Fixed value: rows handed to a model at a time.
BATCH_SIZE = 8


def hash_embed(df: DataFrame, text_col: str, dimension: int = V.DIMENSION, max_length: int | None = V.MAX_TOKENS) -> DataFrame:
    """Adds ``embedding``: normalised hashed token counts of the text."""
    words = V.tokens(F.col(text_col), max_length)
    return df.withColumn("embedding", V.l2_normalize(V.hashed_vector(words, dimension)).cast("array<float>"))


def embed_with(
    df: DataFrame, text_col: str, model: Callable[[list[str]], np.ndarray], dimension: int = V.DIMENSION,
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """Adds ``embedding`` from a user model called on small batches of texts.

    The model is called once per batch inside the tasks; a vector of another
    size than ``dimension`` fails the query.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("embedding", T.ArrayType(T.FloatType()))])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame[text_col].fillna("").tolist()
            rows: list[np.ndarray] = []
            for start in range(0, len(texts), batch_size):
                found = np.asarray(model(texts[start:start + batch_size]), dtype="float32")
                if found.ndim != 2 or found.shape[1] != dimension:
                    raise ValueError(f"model returned shape {found.shape}, expected (*, {dimension})")
                rows.extend(found)
            yield frame.assign(embedding=rows)

    return df.mapInPandas(run, schema)


def mean_pool(df: DataFrame, keys: Sequence[str], vector_col: str = "embedding") -> DataFrame:
    """Average vector per key; positions are averaged before the shuffle, so hot keys stay small."""
    exploded = df.select(*keys, F.posexplode(vector_col).alias("pos", "value"))
    means = exploded.groupBy(*keys, "pos").agg(F.avg(F.col("value").cast("double")).alias("mean"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("pos", "mean"))), lambda s: s["mean"])
    return means.groupBy(*keys).agg(ordered.alias(vector_col))


def nearest(points: DataFrame, vector: Sequence[float], k: int, id_col: str = "vec_id",
            where: Column | None = None, vector_col: str = "embedding") -> DataFrame:
    """The ``k`` points most similar to one vector, after an optional payload filter."""
    kept = points if where is None else points.where(where)
    query = F.array(*[F.lit(float(x)) for x in vector])
    scored = kept.withColumn("score", V.cosine(F.col(vector_col), query))
    return scored.orderBy(F.desc_nulls_last("score"), id_col).limit(k)


def nearest_by_payload(points: DataFrame, queries: DataFrame, on: Sequence[str], k: int, id_col: str = "vec_id",
                       vector_col: str = "embedding", query_col: str = "query") -> DataFrame:
    """Top ``k`` points per query among the points that share the payload columns ``on``.

    An equi-join, so Spark broadcasts the queries when they are small and
    otherwise shuffles; the rank filter is applied before the ranking shuffle
    too, so a query with very many points sends only ``k`` per task.
    ``queries`` holds one row per value of ``on``.
    """
    scored = points.join(queries, list(on)).withColumn("score", V.cosine(F.col(vector_col), F.col(query_col)))
    order = Window.partitionBy(*on).orderBy(F.desc_nulls_last("score"), id_col)
    ranked = scored.select(*on, id_col, "score", F.row_number().over(order).alias("rank"))
    return ranked.where(F.col("rank") <= k)


#: Queries that a task searches for together (broadcast: 4096 vectors of 768 numbers are 25 MB), points scored at once, and
#: parts in which the hits of all tasks are first ranked.
QUERY_BLOCK, POINT_BLOCK, SALTS = 4096, 2048, 32
#: Comparisons that a filter may name.
COMPARISONS = {"=": np.equal, "<>": np.not_equal, "<": np.less, "<=": np.less_equal, ">": np.greater, ">=": np.greater_equal}


def nearest_many(points: DataFrame, queries: DataFrame, k: int, filters: Sequence[tuple[str, str, str]] = (), where: Column | None = None,
                 id_col: str = "vec_id", vector_col: str = "embedding", query_id: str = "query_id", query_col: str = "query", digits: int = 9) -> DataFrame:
    """``query_id, rank, id, score``: for every query the ``k`` points of greatest cosine that pass its filter.

    ``where`` filters the points for all queries; ``filters`` holds ``(point column, comparison, query column)`` that must all be true, such as
    ``("year", ">=", "from_year")``; numbers only, and null is never true.  Points are scored block by block against a block
    of queries, and a task keeps ``k`` candidates of each query, which is all that is shuffled: no product of points
    and queries is stored.  Queries beyond ``QUERY_BLOCK`` take further passes.  Scores are rounded to ``digits`` so
    that equal vectors tie; ties go by id.  Null or zero vectors and those of another length than the query have no score and are left out.
    """
    spark = points.sparkSession
    kept = points if where is None else points.where(where)
    columns = list(dict.fromkeys(c for c, _, _ in filters))
    base = kept.select(F.col(id_col).cast("bigint").alias("_id"), F.col(vector_col).cast("array<double>").alias("_vector"),
                       *(F.col(c).cast("double").alias(f"_f{i}") for i, c in enumerate(columns)))
    asked = queries.select(F.col(query_id).cast("bigint").alias("q"), F.col(query_col).cast("array<double>").alias("v"),
                           *(F.col(c).cast("double").alias(f"_q{i}") for i, (_, _, c) in enumerate(filters)))
    rules = [(columns.index(c), COMPARISONS[op]) for c, op, _ in filters]
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    block = F.pmod(F.xxhash64("q"), F.lit(blocks))
    found = None
    for b in range(blocks):
        rows = asked.where(block == b).where("v IS NOT NULL").orderBy("q").collect()  # about QUERY_BLOCK rows
        part = base.mapInPandas(_search(spark.sparkContext.broadcast([tuple(r) for r in rows]), rules, k, digits), "query_id bigint, id bigint, score double")
        found = part if found is None else found.unionByName(part)
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id")))
    salted = found.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    first = salted.withColumn("_rank", rank("query_id", "_salt")).where(F.col("_rank") <= k)
    return first.withColumn("rank", rank("query_id")).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def _search(shared, rules, k: int, digits: int):
    def unit(vectors: list) -> tuple[np.ndarray, np.ndarray]:
        """Vectors of one length each as rows, and where they stood; zero and broken ones are left out."""
        wide = np.array(vectors, dtype=float)
        size = np.linalg.norm(wide, axis=1)
        fine = np.isfinite(size) & (size > 0)
        return wide[fine] / size[fine, None], fine

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked = shared.value
        groups = {}
        for dims in {len(r[1]) for r in asked if len(r[1])}:
            same = [r for r in asked if len(r[1]) == dims and None not in r[1]]
            if same:
                matrix, fine = unit([r[1] for r in same])
                same = [r for r, f in zip(same, fine) if f]
                bounds = np.array([[np.nan if x is None else x for x in r[2:]] for r in same], float).reshape(len(same), len(rules))
                groups[dims] = matrix, [r[0] for r in same], bounds, [(np.zeros(0), np.zeros(0, object))] * len(same)
        for frame in frames:
            for at in range(0, len(frame), POINT_BLOCK):
                piece = frame.iloc[at:at + POINT_BLOCK]
                piece = piece[[v is not None for v in piece["_vector"]]]
                length = np.array([len(v) for v in piece["_vector"]], int)
                for dims, (matrix, _, bounds, best) in groups.items():
                    same = piece[length == dims]
                    if not len(same):
                        continue
                    points, fine = unit(list(same["_vector"]))
                    same = same[fine]
                    score = np.round(points @ matrix.T, digits)
                    for j, (column, compare) in enumerate(rules):
                        value = same[f"_f{column}"].to_numpy(dtype=float)[:, None]
                        ok = compare(value, bounds[None, :, j]) & ~np.isnan(value) & ~np.isnan(bounds[None, :, j])
                        score = np.where(ok, score, -np.inf)
                    ids = np.array([None if pd.isna(i) else int(i) for i in same["_id"]], object)
                    last = np.array([b[0][-1] if len(b[0]) == k else -np.inf for b in best])
                    for q in np.flatnonzero((score >= last).any(0) & (score > -np.inf).any(0)):
                        hit = np.flatnonzero((score[:, q] >= last[q]) & (score[:, q] > -np.inf))
                        s, i = np.append(best[q][0], score[hit, q]), np.append(best[q][1], ids[hit])
                        order = sorted(range(len(s)), key=lambda n: (-s[n], i[n] is None, i[n] or 0))[:k]
                        best[q] = s[order], i[order]
        rows = [(n, i, s) for _, names, _, best in groups.values() for n, (score, ids) in zip(names, best) for s, i in zip(score, ids)]
        made = pd.DataFrame(rows, columns=["query_id", "id", "score"])
        yield made.astype({"query_id": "Int64", "id": "Int64", "score": "float64"})

    return run
