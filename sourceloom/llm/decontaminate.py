"""Benchmark decontamination: size-partitioned MinHash containment search."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from sourceloom.llm.common import only, small, store
from sourceloom.llm.line_dedup import NO_ID

#: Size classes: documents of up to 2**c shingles.
CLASSES = 40


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; an empty array for null or no word."""
    plain = F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " ", -1))


def _windows(word_col: str, k: int, make) -> Column:
    """``make`` of each run of ``k`` words; fewer words are one run."""
    w, n = F.col(word_col), F.size(word_col)
    runs = F.transform(F.sequence(F.lit(0), n - k), lambda i: make([F.get(w, i + j) for j in range(k)]))
    return F.when(n >= k, runs).when(n > 0, F.array(make([F.array_join(w, " ")])))


def _bin(h: Column, bins: Column) -> Column:
    return F.shiftright(F.shiftright(h, 32) * bins, 31)


def _minima(sorted_col: str, bins: Column) -> Column:
    """The smallest hash of each bin of a sorted array: a one-permutation MinHash signature."""
    s = F.col(sorted_col)
    return F.filter(s, lambda h, i: (i == 0) | (_bin(h, bins) != _bin(F.get(s, i - 1), bins)))


def bins_for(size: int, query: int, threshold: float, miss: float) -> int:
    """Bins so that a query of ``query`` shingles, contained at ``threshold`` in ``size`` shingles, is missed with probability ``miss``.

    With ``x`` shingles a bin a shared one is the least of its bin with probability ``(1 - exp(-x)) / x``.
    """
    shared = max(math.ceil(threshold * query), 1)
    least, low, high = 1 - miss ** (1 / shared), 1e-9, 1e9
    for _ in range(100):
        x = math.sqrt(low * high)
        low, high = (x, high) if -math.expm1(-x) / x > least else (low, x)
    return min(max(math.ceil((size + query - shared) / low), 1), (1 << 31) - 1)


def _signed(rows: DataFrame, k: int) -> DataFrame:
    """``hashes``: sorted 63-bit shingle hashes of ``_words``.

    What is built on the arrays must not imply a not-null filter (hence ``explode_outer`` and ``coalesce``): Spark would
    push it below the projections and compute the words anew for each shingle.
    """
    positive = lambda parts: F.xxhash64(*parts).bitwiseAND(F.lit((1 << 63) - 1))
    return rows.withColumn("_raw", _windows("_words", k, positive)).withColumn("hashes", F.sort_array("_raw")).drop("_raw")


def contained_items(docs: DataFrame, items: DataFrame, k: int = 5, threshold: float = 0.8, miss: float = 1e-3,
                    text_col: str = "text", id_col: str = "doc_id", item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """``doc_id, item_id, n_item, n_shared, containment`` where a document holds ``threshold`` of an item's word shingles.

    Documents are partitioned by size.  Each class has its own number of MinHash bins,
    set from the containment threshold turned into the Jaccard likeness of the shortest item
    and the largest document of the class, so that a contained item shares no bin minimum with
    probability at most ``miss``, also in very long documents.  Shared minima are candidates,
    and each is verified on the shingles themselves.

    Null, empty and wordless texts or items match nothing.  An item of fewer than ``k`` words
    is one shingle and matches a document with just these words.  Repeated shingles count once; rows
    with the same id are one document (null ids as well), and repeated item rows one item.  No Python runs.
    """
    ident = F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID))
    item = F.coalesce(F.col(item_id).cast("bigint"), F.lit(NO_ID))
    source = docs.select(ident.alias("_doc"), F.col(text_col).cast("string").alias("_text"))
    tests = items.select(item.alias("_item"), words(F.col(item_text)).alias("_words")).where("size(_words) > 0")
    tests = store(_signed(tests, k).withColumn("hashes", F.array_distinct("hashes")), "items")
    shortest = tests.agg(F.min(F.size("hashes"))).first()[0] or 1
    bins = [bins_for(1 << c, shortest, threshold, miss) for c in range(CLASSES)]

    # An item's hash takes part in the classes whose bits are set: there it is the minimum of its bin.
    mask = tests.select("_item", "hashes", F.explode(F.array(*(F.struct(F.lit(c).alias("c"), F.lit(b).cast("bigint").alias("b"))
                                                               for c, b in enumerate(bins)))).alias("x"))
    mask = mask.withColumn("sig", _minima("hashes", F.col("x.b"))).select("_item", "x.c", F.explode("sig").alias("h"))
    mask = store(mask.groupBy("_item", "h").agg(F.sum(F.expr("shiftleft(bigint(1), c)")).alias("classes")), "item-minima")

    signed = _signed(source.withColumn("_words", words(F.col("_text"))).drop("_text"), k).drop("_words")
    size_class = F.ceil(F.log2(F.size("hashes").cast("double"))).cast("int")
    classed = signed.withColumn("_c", size_class).withColumn("_b", F.element_at(F.array(*(F.lit(b).cast("bigint") for b in bins)), F.col("_c") + 1))
    minima = classed.select("_doc", "_c", F.explode_outer(_minima("hashes", F.col("_b"))).alias("h"))
    met = minima.join(small(mask), "h").where(F.expr("coalesce(shiftright(classes, _c) & 1, 0) = 1"))
    candidates = store(met.select("_doc", "_item").distinct(), "leak-candidates")

    text_of = lambda parts: F.concat_ws(" ", *parts)
    exact = tests.withColumn("s", F.explode_outer(F.array_distinct(_windows("_words", k, text_of)))).select("_item", "s").distinct()
    sizes = exact.groupBy("_item").agg(F.count("*").alias("n_item"))
    near = only(source, candidates, "_doc").withColumn("_words", words(F.col("_text")))
    held = near.select("_doc", F.explode_outer(F.array_distinct(_windows("_words", k, text_of))).alias("s"))
    shared = held.join(small(exact), "s").select("_doc", "_item", "s").distinct().groupBy("_doc", "_item").agg(F.count("*").alias("n_shared"))
    verified = shared.join(candidates, ["_doc", "_item"], "left_semi").join(sizes, "_item")
    return verified.where(F.col("n_shared") >= F.lit(threshold) * F.col("n_item")).select(
        F.nullif("_doc", F.lit(NO_ID)).alias("doc_id"), F.nullif("_item", F.lit(NO_ID)).alias("item_id"), "n_item", "n_shared",
        (F.col("n_shared") / F.col("n_item")).alias("containment"))
