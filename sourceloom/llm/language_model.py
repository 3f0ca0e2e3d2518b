"""LM scoring with a hidden Markov model of words."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sourceloom.llm.common import ship, store
from sourceloom.llm.kernels import Words, mixed, raw, steps

#: Latent states, Baum-Welch rounds, and the occurrences that a word is taken to have in all states alike.
STATES, ROUNDS, ALIKE = 4, 3, 3.0
#: Most frequent words with emissions of their own, broadcast (24 MB at most); the others share one emission and
#: differ by their counts, which come by a join.
TABLE_WORDS = 1 << 19
#: Tokens handled together, padding included.
GROUP_TOKENS = 600_000
#: Stands for the end of a text among word hashes.
END = np.uint64(0x7E57E0D)


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 7 == 2, F.lit(False))


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of some rows, each row's end included, and tokens per row."""
    words = Words(data, offsets)
    n = words.count + 1
    out = np.empty(int(n.sum()), np.uint64)
    last = np.cumsum(n) - 1
    out[last] = END
    rest = np.ones(len(out), bool)
    rest[last] = False
    out[rest] = words.hash
    return out, n


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = raw(batch.column("_text"))
        for a, b in steps(offsets):
            h, c = np.unique(_tokens(data, offsets[a:b + 1])[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], names=["h", "c"])


def _encoded(batches: Iterator[pa.RecordBatch], table) -> Iterator[pa.RecordBatch]:
    """Texts as ranks of their tokens among the table's words, with the sums that do not depend on the model.

    Tokens that are not in the table have the rank behind the last one; their hashes are listed in ``rest``.
    """
    keys, counts, ranks = table.value
    for batch in batches:
        data, offsets = raw(batch.column("_text"))
        for a, b in steps(offsets):
            h, n = _tokens(data, offsets[a:b + 1])
            row = np.repeat(np.arange(b - a), n)
            if len(keys):
                distinct, back = np.unique(h, return_inverse=True)
                at = np.minimum(np.searchsorted(keys, distinct), len(keys) - 1)
                there = keys[at] == distinct
                rank, count = np.where(there, ranks[at], len(keys))[back], np.where(there, counts[at], 0)[back]
            else:
                rank, count = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
            known = count > 0
            total = lambda x: np.bincount(row, weights=x, minlength=b - a)
            lists = lambda flags, values: pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(row[flags], minlength=b - a))).astype(np.int32)), pa.array(values))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).slice(a, b - a) for c in ("_row", "doc_id", "held_out")), pa.array(total(known).astype(np.int64)),
                 pa.array(total(np.log10(count + 1.0))), lists(slice(None), rank.astype(np.int32)), lists(~known, h[~known].view(np.int64))],
                names=["_row", "doc_id", "held_out", "known", "logs", "ids", "rest"])


def _sequences(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Some rows at a time: first and last row, ranks of their tokens, tokens per row."""
    ids = batch.column("ids")
    flat, size = ids.flatten().to_numpy(zero_copy_only=False), ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    edge = np.append(0, np.cumsum(size))
    for a, b in steps(edge, GROUP_TOKENS):
        yield a, b, flat[edge[a]:edge[b]], size[a:b]


class _Model:
    def __init__(self, spec: dict) -> None:
        self.start, self.move, self.emit = spec["start"], spec["move"], spec["emit"]
        self.ones = np.ones(len(self.start))

    def groups(self, ranks: np.ndarray, n: np.ndarray):
        """Rows of like lengths together, the longest first: row numbers, lengths, and ranks by step and row, padded behind."""
        order, first = np.argsort(-n, kind="stable"), np.cumsum(n) - n
        at = 0
        while at < len(order):
            size = max(1, GROUP_TOKENS // int(n[order[at]]))
            rows = order[at:at + size]
            length = n[rows]
            inside = np.arange(length[0])[:, None] < length[None, :]
            step, row = np.nonzero(inside)
            padded = np.zeros(inside.shape, np.int64)
            padded[step, row] = ranks[first[rows][row] + step]
            yield rows, length, inside, padded
            at += size

    def forward(self, length: np.ndarray, padded: np.ndarray):
        """Scaled forward variables, their scales, emissions, and how many rows reach each step."""
        b = np.ascontiguousarray(self.emit.T)[padded]
        alpha, scale = np.zeros_like(b), np.ones(padded.shape)
        live = np.searchsorted(-length, -np.arange(len(padded)), "left")
        a = self.start * b[0]
        for t in range(len(padded)):
            m = live[t]
            if t:
                a = alpha[t - 1, :m] @ self.move
                a *= b[t, :m]
            scale[t, :m] = s = a @ self.ones
            np.divide(a, s[:, None], out=alpha[t, :m])
        return alpha, scale, b, live


def _states(k: int) -> list[str]:
    return [f"s{j}" for j in range(k)]


def _expected(batches: Iterator[pa.RecordBatch], spec) -> Iterator[pa.RecordBatch]:
    """Baum-Welch counts of a partition: starts, moves and emissions."""
    model = _Model(spec.value)
    k, w = model.emit.shape
    starts, moves, emits = np.zeros(k), np.zeros((k, k)), np.zeros((k, w))
    for batch in batches:
        for _, _, ranks, n in _sequences(batch):
            for _, length, inside, padded in model.groups(ranks, n):
                alpha, scale, emit, live = model.forward(length, padded)
                beta = np.ones_like(alpha)
                back = np.ascontiguousarray(model.move.T)
                for t in range(len(padded) - 2, -1, -1):
                    m = live[t + 1]
                    right = emit[t + 1, :m] * beta[t + 1, :m]
                    right /= scale[t + 1, :m, None]
                    moves += alpha[t, :m].T @ right
                    np.matmul(right, back, out=beta[t, :m])
                gamma = alpha * beta
                starts += gamma[0].sum(0)
                flat, g = padded[inside], gamma[inside]
                for j in range(k):
                    emits[j] += np.bincount(flat, weights=g[:, j], minlength=w)
    # One row per word with its states side by side; starts and moves have numbers below 0.
    found = np.flatnonzero(emits.any(0))
    numbers = np.concatenate([found, -1 - np.arange(k + 1)])
    values = np.vstack([emits[:, found].T, starts, moves * model.move])
    yield pa.RecordBatch.from_arrays([pa.array(numbers.astype(np.int32)), *(pa.array(values[:, j]) for j in range(k))], names=["word", *_states(k)])


def _scored(batches: Iterator[pa.RecordBatch], spec) -> Iterator[pa.RecordBatch]:
    model = _Model(spec.value)
    keep = ("_row", "doc_id", "held_out", "known", "logs")
    for batch in batches:
        for a, b, ranks, n in _sequences(batch):
            value = np.zeros(b - a)
            for rows, length, _, padded in model.groups(ranks, n):
                value[rows] = np.log10(model.forward(length, padded)[1]).sum(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in keep), pa.array(n), pa.array(value)], names=[*keep, "n_tokens", "value"])


def hmm_scores(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Tokens are runs of bytes other than space and 0x09-0x0D with A-Z lower-cased, and one end per text.  Word counts are
    grouped over all training texts.  Texts are stored once as ranks of their words; training and scoring read these.  States emit each of the
    ``TABLE_WORDS`` most frequent words with a probability of its own, or a rarer one; which rarer one follows its smoothed count,
    an unseen word having the share of one.  Baum-Welch counts of all training texts are summed across partitions in each of
    ``ROUNDS`` rounds, and the scaled forward recursion gives a text's probability, to base 10.

    Null and empty texts are an end only.  Rows with a null id are training texts; repeated rows count and are scored each.
    Without training texts every word has count 0.  A text of any length is one sequence; memory follows the longest text.
    Words are told apart by 64 bits of hash.  Only tables of bounded size reach the driver: ``TABLE_WORDS`` counts and the model.
    """
    spark = docs.sparkSession
    ship(spark)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), text.alias("_text"))
    counts = store(base.where("NOT held_out").select("_text").mapInArrow(_counted, "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c")), "word-counts")
    n_all, n_words = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()

    top = counts.orderBy(F.desc("c"), "h").limit(TABLE_WORDS).toArrow()
    h, c = top.column("h").to_numpy().view(np.uint64), top.column("c").to_numpy()
    own, order = len(c), np.argsort(h)
    rest_mass = float(n_all - c.sum() + (n_words - own) + 1)
    table = spark.sparkContext.broadcast((h[order], c[order], order.astype(np.int32)))
    named = base.withColumn("_row", F.xxhash64("doc_id", "_text"))
    texts = named.mapInArrow(partial(_encoded, table=table), "_row bigint, doc_id bigint, held_out boolean, known bigint, logs double, "
                             "ids array<int>, rest array<bigint>")
    # Texts of like lengths stand together, so that the recursions step through many of them at once.
    texts = store(texts.sortWithinPartitions(F.desc(F.size("ids"))), "ranked-texts")

    # The start: word frequencies, tilted per state by a hash so that the states can part.
    share = np.append(c + 1.0, rest_mass)
    share /= share.sum()
    tilt = mixed(np.arange(STATES * (own + 1), dtype=np.uint64) + np.uint64(1)).reshape(STATES, own + 1) / 2.0 ** 64
    emit = share * (0.1 + 2 * tilt ** 2)
    spec = {"start": np.full(STATES, 1 / STATES), "move": np.full((STATES, STATES), 0.1 / STATES) + np.eye(STATES) * 0.9, "emit": emit / emit.sum(1, keepdims=True)}
    for _ in range(ROUNDS if n_all else 0):
        shared = spark.sparkContext.broadcast(spec)
        names = _states(STATES)
        parts = texts.where("NOT held_out").select("ids").mapInArrow(partial(_expected, spec=shared), ", ".join(["word int", *(f"{s} double" for s in names)]))
        summed = parts.groupBy("word").agg(*(F.sum(s).alias(s) for s in names)).toArrow()  # one row per word of the table
        word, sums = summed.column("word").to_numpy(), np.zeros((STATES, own + 2 + STATES))
        for j, s in enumerate(names):
            sums[j, word] = summed.column(s).to_numpy()  # numbers below 0 count from the end
        start, move, emit = sums[:, -1], sums[:, -2:-2 - STATES:-1].T + 0.1, sums[:, :own + 1]
        # A rare word's states are drawn towards those of all words; its frequency stays.
        held = emit.sum(0)
        mass = emit.sum(1, keepdims=True) + 1e-9
        emit = (emit + ALIKE * mass / mass.sum()) / (held + ALIKE) * share
        spec = {"start": (start + 0.1) / (start + 0.1).sum(), "move": move / move.sum(1, keepdims=True),
                "emit": emit / emit.sum(1, keepdims=True)}
        shared.unpersist()

    scored = texts.select("_row", "doc_id", "held_out", "known", "logs", "ids").mapInArrow(
        partial(_scored, spec=spark.sparkContext.broadcast(spec)),
        "_row bigint, doc_id bigint, held_out boolean, known bigint, logs double, n_tokens bigint, value double")
    rest = texts.where("size(rest) > 0").select("_row", "rest").dropDuplicates(["_row"]).select("_row", F.size("rest").alias("n_rest"), F.explode("rest").alias("h"))
    found = rest.join(counts.hint("merge"), "h", "left").groupBy("_row").agg(
        F.count("c").alias("more"), F.coalesce(F.sum(F.log10(F.col("c") + 1.0)), F.lit(0.0)).alias("more_logs"), F.first("n_rest").alias("n_rest"))
    full = scored.join(found, "_row", "left").fillna({"more": 0, "more_logs": 0.0, "n_rest": 0})
    return full.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.col("more")).alias("n_known"), F.lit(int(n_all)).cast("bigint").alias("train_tokens"),
        (F.col("logs") + F.col("more_logs") - F.col("n_tokens") * F.log10(F.lit(float(n_all + n_words + 1)))).alias("base_score"),
        (F.col("value") + F.col("more_logs") - F.col("n_rest") * F.log10(F.lit(rest_mass))).alias("score"))
