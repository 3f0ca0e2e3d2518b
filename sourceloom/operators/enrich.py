"""Relations between chunks: call edges, neighbours, and per-file context."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# Names that a sketch of the edges tracks, those it may report, and the share of all edges that makes a name hot.
TRACKED, HOT_NAMES, HOT_SHARE = 8192, 256, 1 / 256


def call_edges(chunks: DataFrame) -> DataFrame:
    """``(callee, caller, file_path, start_line)``, one row per distinct call of a chunk."""
    return chunks.select(
        F.explode("calls").alias("callee"), F.col("name").alias("caller"), "file_path", "start_line"
    )


def hot_callees(edges: DataFrame) -> DataFrame:
    """``callee`` names with at least ``HOT_SHARE`` of all edges, at most ``HOT_NAMES``; estimated, found in one pass.

    A heavy-hitter sketch of fixed size combines before the shuffle, so the pass moves no edges.
    """
    found = edges.agg(
        F.count("*").alias("edges"), F.expr(f"approx_top_k(callee, {HOT_NAMES}, {TRACKED})").alias("top"))
    each = found.select("edges", F.explode("top").alias("hot"))
    return each.where(F.col("hot.count") >= F.lit(HOT_SHARE) * F.col("edges")).select(F.col("hot.item").alias("callee"))


def called_by(chunks: DataFrame) -> DataFrame:
    """Edges whose callee is defined in the corpus.

    Kept as rows: a name such as ``get`` may have callers without bound, so no
    list per callee is built, and definitions are reduced to distinct names so a
    name defined often does not multiply its callers.  Edges of hot names stay
    where they are and meet the few defined hot names by broadcast; only the
    others are shuffled by name, each name once.
    """
    edges = call_edges(chunks)
    names = chunks.select(F.col("name").alias("callee")).distinct()
    hot = F.broadcast(hot_callees(edges))
    defined = F.broadcast(names.join(hot, "callee", "left_semi"))
    rest = edges.join(hot, "callee", "left_anti")
    return edges.join(defined, "callee", "left_semi").unionByName(rest.join(names, "callee", "left_semi"))


def caller_counts(edges: DataFrame) -> DataFrame:
    """Number of callers per defined name; partial counts combine before the shuffle."""
    return edges.groupBy("callee").agg(F.count("*").alias("callers"))


def with_neighbours(chunks: DataFrame) -> DataFrame:
    """Adds the code before and after each chunk in its file."""
    order = Window.partitionBy("file_path").orderBy("start_line", "start_column")
    return chunks.select(
        "*", F.lag("code").over(order).alias("previous_code"), F.lead("code").over(order).alias("next_code")
    )


def embedding_text(docstring, code):
    """Comment text and code joined by a newline; a missing comment adds nothing."""
    return F.concat_ws("\n", docstring, code)
