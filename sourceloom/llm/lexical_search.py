"""Ranked lexical search: NRA over impact-sorted posting lists of document shards."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sourceloom.llm.common import ship, store
from sourceloom.llm.kernels import TERMS, Words, raw, steps

#: Documents and postings of a shard, beyond the document that fills it up.
SHARD_DOCS, SHARD_POSTINGS = 16_384, 2_000_000
#: First depth of the sorted reads, and the factor by which each further read is deeper.
DEPTH, DEEPER = 64, 4
#: Terms of items searched for together (broadcast: about 8 MB); more items are searched in several rounds.
ROUND_TERMS = 250_000
#: Parts that an item's hits of all tasks are first ranked in.
SALTS = 32


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct terms of each item, with their repeats."""
    for batch in batches:
        data, offsets = raw(batch.column("_text"))
        words = Words(data, offsets, TERMS)
        order = np.lexsort((words.hash, words.row))
        h, row = words.hash[order], words.row[order]
        head = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1]))) if len(h) else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("item").take(pa.array(row[head])), batch.column("item_id").take(pa.array(row[head])),
                                          pa.array(h[head].view(np.int64)), pa.array(np.diff(np.append(head, len(h))).astype(np.int64))], names=["item", "item_id", "h", "q"])


def _indexed(batches: Iterator[pa.RecordBatch], wanted) -> Iterator[pa.RecordBatch]:
    """Per document its number of terms, and the sought ones among them with their occurrences."""
    keys = wanted.value
    for batch in batches:
        data, offsets = raw(batch.column("_text"))
        for a, b in steps(offsets):
            words = Words(data, offsets[a:b + 1], TERMS)
            at = np.minimum(np.searchsorted(keys, words.hash), len(keys) - 1)
            there = keys[at] == words.hash
            pair, tf = np.unique(words.row[there] * len(keys) + at[there], return_counts=True)
            row, term = pair // len(keys), pair % len(keys)
            edge = pa.array(np.append(0, np.cumsum(np.bincount(row, minlength=b - a))).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(a, b - a), pa.array(words.count.astype(np.int64)),
                 pa.ListArray.from_arrays(edge, pa.array(term.astype(np.int32))), pa.ListArray.from_arrays(edge, pa.array(tf.astype(np.int64)))],
                names=["doc_id", "n", "terms", "tf"])


class _Shard:
    """Posting lists of some documents, each sorted by falling impact."""

    def __init__(self, n: np.ndarray, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray, weights: np.ndarray, total: int, length: int) -> None:
        doc = np.repeat(np.arange(len(n)), sizes)
        m = 100 - 75 + (75 * n * total) // max(length, 1)
        impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
        some = impact > 0
        doc, term, impact = doc[some], term[some], impact[some]
        order = np.lexsort((-impact, term))
        self.docs = len(n)
        self.doc, self.impact = doc[order], impact[order]
        self.begin = np.searchsorted(term[order], np.arange(len(weights) + 1))

    def search(self, terms: np.ndarray, q: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the ``k`` best of at least ``least``, and all that tie with the last.

        The lists are read in parallel, a stretch at a time.  A document's lower bound is what was read of it; its upper bound adds the next unread
        impact of each list that it has not shown up in.  Reading goes on until no document that could still be among the best has
        bounds apart, so membership, ties and scores are settled.
        """
        at, end = self.begin[terms].copy(), self.begin[terms + 1]
        low, seen = np.zeros(self.docs, np.int64), np.zeros((len(terms), self.docs), bool)
        alive, depth = np.arange(self.docs), DEPTH
        while True:
            to = np.minimum(at + depth, end)
            for t in range(len(terms)):
                if at[t] < to[t]:
                    read = self.doc[at[t]:to[t]]
                    low[read] += q[t] * self.impact[at[t]:to[t]]
                    seen[t, read] = True
            at, depth = to, depth * DEEPER
            ahead = np.where(at < end, self.impact[np.minimum(at, len(self.impact) - 1)], 0) * q if len(self.impact) else np.zeros(len(terms), np.int64)
            if len(alive) > k:
                least = max(least, int(np.partition(low[alive], -k)[-k]))
            open_ = np.flatnonzero(ahead)
            high = low[alive] + ahead.sum() - sum((ahead[t] * seen[t, alive] for t in open_), np.zeros(len(alive), np.int64))
            stay = high >= least
            alive, apart = alive[stay], (high - low[alive])[stay].any()
            if not apart:
                return alive, low[alive]


def _searched(batches: Iterator[pa.RecordBatch], spec, k: int) -> Iterator[pa.RecordBatch]:
    """The best documents of each item in this task; what earlier shards gave bounds the later ones from below."""
    items, weights, total, length = spec.value
    best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(items)
    held: list[tuple] = []
    unknown = np.iinfo(np.int64).max  # null ids come last among equals

    def search() -> None:
        ids, n, sizes, term, tf = (np.concatenate(c) for c in zip(*held))
        shard = _Shard(n, sizes, term, tf, weights, total, length)
        for i, (_, terms, q) in enumerate(items):
            known, score = best[i]
            doc, found = shard.search(terms, q, k, max(1, int(score[-1]) if len(score) == k else 1))
            known, score = np.append(known, ids[doc]), np.append(score, found)
            order = np.lexsort((known, -score))[:k]
            best[i] = known[order], score[order]

    docs = postings = 0
    for batch in batches:
        ids = batch.column("doc_id").fill_null(unknown).to_numpy(zero_copy_only=False)
        n = batch.column("n").to_numpy(zero_copy_only=False)
        sizes = batch.column("terms").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        term, tf = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("terms", "tf"))
        held.append((ids, n, sizes, term, tf))
        docs, postings = docs + len(ids), postings + len(term)
        if docs >= SHARD_DOCS or postings >= SHARD_POSTINGS:
            search()
            held, docs, postings = [], 0, 0
    if docs:
        search()
    size = [len(b[0]) for b in best]
    if sum(size):
        doc = np.concatenate([b[0] for b in best])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(items), dtype=np.int32), size)), pa.array([items[i][0] for i, s in enumerate(size) for _ in range(s)], pa.int64()),
             pa.array(doc, mask=doc == unknown), pa.array(np.concatenate([b[1] for b in best]))], names=["item", "item_id", "doc_id", "score"])


def _round(docs: DataFrame, terms: DataFrame, k: int) -> DataFrame:
    """Hits of some items; their terms are few enough to broadcast."""
    spark = docs.sparkSession
    rows = terms.orderBy("item", "h").toArrow()  # about ROUND_TERMS rows
    item, hashes, q = (rows.column(c).to_numpy() for c in ("item", "h", "q"))
    keys = np.unique(hashes.view(np.uint64))
    share = spark.sparkContext.broadcast
    index = store(docs.mapInArrow(partial(_indexed, wanted=share(keys)), "doc_id bigint, n bigint, terms array<int>, tf array<bigint>"), "postings")
    total, length = index.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(len(keys), np.int64)
    for term, df in index.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*")).collect():  # one row per sought term
        weights[term] = math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1)))
    items = []
    for part in np.split(np.arange(len(item)), np.flatnonzero(item[1:] != item[:-1]) + 1):
        at = np.searchsorted(keys, hashes[part].view(np.uint64))
        some = weights[at] > 0
        if some.any():
            items.append((rows.column("item_id")[int(part[0])].as_py(), at[some], q[part][some]))
    spec = share((items, weights, int(total), int(length)))
    hits = index.mapInArrow(partial(_searched, spec=spec, k=k), "item int, item_id bigint, doc_id bigint, score bigint")
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    # A task gives at most k hits of an item; those of many tasks are ranked in two steps.
    hits = hits.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    hits = hits.withColumn("_rank", rank("item", "_salt")).where(F.col("_rank") <= k)
    return hits.withColumn("rank", rank("item")).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, text_col: str = "text", id_col: str = "doc_id", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item by summed integer impacts of its terms.

    Terms are runs of ASCII letters and digits and of non-ASCII characters, A-Z lower-cased, in whole texts.  With N documents that
    have a term, L terms in all, n in a document, a term in df documents and tf times in this one, its impact is w * (10**9 * tf div
    (1000 * tf + 8 * m)), w = floor(1000 * ln((2N + 2) / (2df + 1))), m = 25 + (75 * n * N div L); it counts as often as the item holds it.

    Documents are indexed once, for the items' terms.  A task searches shards of documents by NRA (``_Shard.search``), so nothing
    but its best ``k`` of each item is shuffled.  Equal scores are ranked by ascending id, null ids last; scores of 0 are left out.  Null, empty and
    termless texts or items give no rows.  Repeated documents are ranked each; equal rows of ``items`` count once, and rows of one id with
    different texts are ranked apart.  Terms are told apart by 64 bits of hash.  Very many items are searched in
    rounds of ``ROUND_TERMS`` terms, each with its own pass over the documents.
    """
    spark = docs.sparkSession
    ship(spark)
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("_text"))
    asked = items.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(item_text_col).cast("string").alias("_text")).where("_text IS NOT NULL")
    asked = asked.distinct().withColumn("item", F.xxhash64("item_id", "_text"))
    terms = store(asked.mapInArrow(_terms, "item bigint, item_id bigint, h bigint, q bigint"), "item-terms")
    rounds = -(-terms.count() // ROUND_TERMS)
    found = None
    for i in range(rounds):
        part = _round(base, terms.where(F.pmod("item", F.lit(rounds)) == i), k)
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint") if found is None else found
