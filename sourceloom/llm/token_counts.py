"""Token counts: byte-pair merging with a heap and a linked list."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import partial
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from sourceloom.llm.common import ship

# Fixed value: how the byte-level vocabulary splits a text before merging.
PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
# Fixed value: bytes that stand for themselves in the vocabulary file; the others follow from code point 256 on.
PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]

#: Words a worker remembers; the memory is cleared when it is full, counts don't depend on it.
REMEMBERED = 1 << 19


def merge_ranks(path: str) -> tuple[list[tuple[str, str]], list[str]]:
    """Merge pairs of a tokenizer file by rank, as one character per byte, and its special strings."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    others = [b for b in range(256) if b not in PLAIN]
    byte = {chr(b): chr(b) for b in PLAIN} | {chr(256 + i): chr(b) for i, b in enumerate(others)}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    merges = [("".join(map(byte.get, a)), "".join(map(byte.get, b))) for a, b in pairs]
    return merges, [t["content"] for t in spec["added_tokens"] if t["special"]]


def merged(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many merges apply: the pair of lowest rank first, the leftmost of equals."""
    n, done = len(symbols), 0
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
    heapify(heap)
    while heap:
        rank, i = heappop(heap)
        left, j = symbols[i], after[i]
        if left is None or j >= n or ranks.get((left, symbols[j])) != rank:
            continue  # one side was merged meanwhile
        symbols[i], symbols[j] = left + symbols[j], None
        after[i] = k = after[j]
        done += 1
        if k < n:
            before[k] = i
            if (r := ranks.get((symbols[i], symbols[k]))) is not None:
                heappush(heap, (r, i))
        if (p := before[i]) >= 0 and (r := ranks.get((symbols[p], symbols[i]))) is not None:
            heappush(heap, (r, p))
    return done


class _Joined(Exception):
    """A blank that doesn't certainly start a new piece."""


class Counter(dict):
    """Tokens of a word with the blank before it, by word; counts whole texts through that memory."""

    def __init__(self, merges: list[tuple[str, str]], special: list[str]) -> None:
        super().__init__()
        self.ranks = {pair: rank for rank, pair in enumerate(merges)}
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.pieces: dict[str, int] = {}

    def _piece(self, piece: str) -> int:
        known = self.pieces.get(piece)
        if known is None:
            symbols = list(piece.encode().decode("latin-1"))
            known = len(symbols) - merged(symbols, self.ranks)
            if len(piece) < 64:
                self.pieces[piece] = known
        return known

    def _plain(self, text: str) -> int:
        return sum(map(self._piece, PIECES.findall(text)))

    def __missing__(self, word: str) -> int:
        # A blank before a letter, digit or ASCII sign always starts a piece: what precedes it can be counted apart.
        if not word or not (word[0].isalnum() or "!" <= word[0] <= "~"):
            raise _Joined
        n = self._plain(" " + word)
        if len(word) < 64:
            self[word] = n
        return n

    def _part(self, text: str) -> int:
        words = text.split(" ")
        try:
            return self._plain(words[0]) + sum(map(self.__getitem__, words[1:]))
        except _Joined:
            return self._plain(text)

    def count(self, text: str) -> int:
        if len(self) > REMEMBERED or len(self.pieces) > REMEMBERED:
            self.clear()
            self.pieces.clear()
        if self.special is None:
            return self._part(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self._part(p) for p in parts if p)


_counters: dict[int, Counter] = {}


def _counted(batches: Iterator[pa.RecordBatch], spec, limit: int) -> Iterator[pa.RecordBatch]:
    counter = _counters.get(spec.value[2])
    if counter is None:
        _counters.clear()
        counter = _counters[spec.value[2]] = Counter(*spec.value[:2])
    for batch in batches:
        texts = batch.column("_text").to_pylist()
        tokens = [counter.count(t) if t else 0 for t in texts]
        names = [n for n in batch.schema.names if n != "_text"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names),
             pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64()), pa.array(tokens, pa.int64()),
             pa.array([t > limit for t in tokens], pa.bool_())],
            names=[*names, "n_bytes", "n_tokens", "over_limit"])


def token_counts(docs: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
                 limit: int = 1024) -> DataFrame:
    """``keep`` columns, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row.

    A text is split into pieces, each piece starts as bytes in a linked list, and a
    heap gives the adjacent pair of lowest rank until no pair has one.  A piece
    counts its bytes minus its merges, so no identifier is ever made.  Special
    strings of the tokenizer inside a text count one token each.

    Null or empty texts count 0.  Repeated rows are counted each; other columns
    are not read.  The merges (one vocabulary file, fixed size) are sent to the
    executors once; the work of a text is linear in it but for the heap's logarithm.
    """
    spark = docs.sparkSession
    ship(spark)
    merges, special = merge_ranks(path)
    spec = spark.sparkContext.broadcast((merges, special, hash((path, len(merges)))))
    source = docs.select(*keep, F.col(text_col).cast("string").alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields if f.name != "_text")
    schema = f"{fields}{', ' if fields else ''}n_bytes bigint, n_tokens bigint, over_limit boolean"
    return source.mapInArrow(partial(_counted, spec=spec, limit=limit), schema)
