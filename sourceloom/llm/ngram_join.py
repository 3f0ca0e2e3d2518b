"""N-gram Jaccard join by vertical partitioning of the global n-gram order."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sourceloom.llm.common import only, ship, store, without
from sourceloom.llm.components import components
from sourceloom.llm.kernels import Words, mixed, raw, shingles, steps

#: Counters of the frequency sketch behind the global order (fixed size, 16 MB as counts, 4 MB as classes), and its blocks.
SLOTS, BLOCKS = 1 << 22, 64
#: Fragments of the global order.
FRAGMENTS = 4
#: Bytes of text whose shingles are made at once.
SET_BYTES = 1 << 20
#: Posting lists up to this length are compared pair by pair, longer ones with hubs until nothing is left to compare.
PLAIN_LIST = 4
#: Bits of a set's parity map: bit ``i`` says whether an odd number of its shingles fell on ``i``.
MAP_WORDS = 8
#: Hubs that a long list gets in the second round, and the factor by which each later round has more.
HUBS, WIDER = 8, 4

_U = np.uint64


def _sets(batch: pa.RecordBatch, k: int):
    """Distinct shingles of some rows at a time: first row, row of each shingle, shingle, counts and set ids per row."""
    data, offsets = raw(batch.column("_text"))
    for a, b in steps(offsets, SET_BYTES):
        h, row = shingles(Words(data, offsets[a:b + 1]), k)
        order = np.lexsort((h, row))
        h, row = h[order], row[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        h, row = h[new], row[new]
        n = np.bincount(row, minlength=b - a)
        ids = np.zeros(b - a, np.uint64)
        if len(h):
            at = np.cumsum(n) - n
            some = n > 0
            ids[some] = mixed(np.add.reduceat(mixed(h), at[some]) ^ mixed(np.add.reduceat(mixed(h ^ _U(0x5DEECE66D)), at[some]) + n[some].astype(np.uint64)))
        yield a, row, h, n, ids


def _slot(h: np.ndarray) -> np.ndarray:
    return ((h >> _U(6)) & _U(SLOTS - 1)).astype(np.int64)


def _maps(h: np.ndarray, n: np.ndarray) -> pa.ListArray:
    """The parity map of each row's set as ``MAP_WORDS`` longs; zeros for an empty set."""
    maps = np.zeros((len(n), MAP_WORDS), np.uint64)
    some = n > 0
    if len(h):
        at, slot = (np.cumsum(n) - n)[some], h >> _U(20)
        word, bit = (slot >> _U(6)) & _U(MAP_WORDS - 1), _U(1) << (slot & _U(63))
        for w in range(MAP_WORDS):
            maps[some, w] = np.bitwise_xor.reduceat(np.where(word == _U(w), bit, _U(0)), at)
    places = np.arange(0, MAP_WORDS * len(n) + 1, MAP_WORDS, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(places), pa.array(maps.reshape(-1).view(np.int64)))


def _scanned(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    names = ["kind", "doc_id", "n", "id", "map", "block", "data"]
    counts = np.zeros(SLOTS, np.int64)
    for batch in batches:
        for a, row, h, n, ids in _sets(batch, k):
            np.add.at(counts, _slot(h), 1)
            rows = len(n)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.zeros(rows, np.int32)), batch.column("doc_id").slice(a, rows), pa.array(n.astype(np.int64)),
                pa.array(ids.view(np.int64), mask=n == 0), _maps(h, n), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], names=names)
    if counts.any():
        parts = counts.reshape(BLOCKS, -1)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.ones(BLOCKS, np.int32)), pa.nulls(BLOCKS, pa.int64()), pa.nulls(BLOCKS, pa.int64()), pa.nulls(BLOCKS, pa.int64()),
            pa.nulls(BLOCKS, pa.list_(pa.int64())), pa.array(np.arange(BLOCKS, dtype=np.int32)), pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary())], names=names)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up sketch blocks as they stream by: memory for the blocks of the task only."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, data in zip(batch.column("block").to_pylist(), batch.column("data").to_pylist()):
            part = np.frombuffer(zlib.decompress(data), np.int64)
            sums[block] = sums[block] + part if block in sums else part
    for block, total in sums.items():
        classes = np.log2(np.maximum(total, 1)).astype(np.uint8)
        mass = np.bincount(classes, weights=total, minlength=32).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([classes.tobytes()], pa.binary()),
                                          pa.array([mass.tolist()], pa.list_(pa.int64()))], names=["block", "classes", "mass"])


def _keys(h: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Place in the global order: frequency class, rare first, then hash."""
    return ((np.minimum(classes[_slot(h)], 31).astype(np.uint64) << _U(58)) | (h >> _U(6))).view(np.int64)


def _ordered(batches, k, classes):
    table = np.frombuffer(classes.value, np.uint8)
    for batch in batches:
        for _, row, h, n, ids in _sets(batch, k):
            key = _keys(h, table)
            order = np.lexsort((key, row))
            yield row, key[order], n, ids


def _prefixes(batches: Iterator[pa.RecordBatch], k: int, percent: int, classes) -> Iterator[pa.RecordBatch]:
    for row, key, n, ids in _ordered(batches, k, classes):
        place = np.arange(len(key)) - np.repeat(np.cumsum(n) - n, n)
        length = n - (percent * n + 99) // 100 + 1
        take = place < length[row]
        yield pa.RecordBatch.from_arrays([pa.array(key[take]), pa.array(ids[row[take]].view(np.int64)), pa.array(n[row[take]].astype(np.int64)),
                                          pa.array(place[take].astype(np.int64))], names=["key", "id", "n", "pos"])


def _segments(batches: Iterator[pa.RecordBatch], k: int, classes, pivots: list[int]) -> Iterator[pa.RecordBatch]:
    for row, key, n, ids in _ordered(batches, k, classes):
        if not len(key):
            continue
        part = np.searchsorted(np.array(pivots, np.int64), key, "right")
        first = np.ones(len(key), bool)
        first[1:] = (row[1:] != row[:-1]) | (part[1:] != part[:-1])
        at = np.flatnonzero(first)
        lists = pa.ListArray.from_arrays(pa.array(np.append(at, len(key)).astype(np.int32)), pa.array(key))
        yield pa.RecordBatch.from_arrays([pa.array(ids[row[at]].view(np.int64)), pa.array(part[at].astype(np.int32)), lists],
                                         names=["id", "fragment", "grams"])


def _pivots(mass: list[int], fragments: int) -> list[int]:
    """Cuts of the global order into parts of about equal numbers of n-grams."""
    total, cuts, below = sum(mass), [], 0
    for c, m in enumerate(mass):
        while m and len(cuts) < fragments - 1 and below + m >= total * (len(cuts) + 1) / fragments:
            share = (total * (len(cuts) + 1) / fragments - below) / m
            cuts.append((c << 58) + int(min(share, 0.999999) * (1 << 58)))
        below += m
    return cuts


class NgramJoin:
    """Links between documents whose sets of word ``k``-shingles are alike by ``percent`` (Jaccard) or more.

    The global order of shingles is frequency class (from a counting sketch of all shingles) and hash.
    Equal sets are joined as one.  Any two linked sets share a shingle in the prefixes of the order, so prefixes give
    the candidates, with bounds on size, position and differing bits of their parity maps; the candidates' overlaps are counted in each
    fragment of the order on its own and summed per pair.

    In a long posting list candidates are its members against a few hubs; members not yet in the
    list's main component are hubs of later rounds, four times as many in each, until every pair of different components
    was compared, so no link between components is lost and no group is expanded into all its pairs.
    """

    def __init__(self, docs: DataFrame, k: int = 4, percent: int = 85, text_col: str = "text", id_col: str = "doc_id") -> None:
        spark = docs.sparkSession
        ship(spark)
        self.k, self.percent = k, percent
        self.docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("_text"))
        scan = store(self.docs.mapInArrow(partial(_scanned, k=k), "kind int, doc_id bigint, n bigint, id bigint, map array<bigint>, block int, data binary"), "ngram-scan")
        self.sets = scan.where("kind = 0").select("doc_id", "n", "id", "map")
        sketch = scan.where("kind = 1").select("block", "data").repartition(BLOCKS, "block")
        parts = sketch.mapInArrow(_summed, "block int, classes binary, mass array<bigint>").collect()  # fixed size
        table, mass = np.zeros((BLOCKS, SLOTS // BLOCKS), np.uint8), [0] * 32
        for p in parts:
            table[p.block] = np.frombuffer(p.classes, np.uint8)
            mass = [x + y for x, y in zip(mass, p.mass)]
        self.classes = spark.sparkContext.broadcast(table.tobytes())
        self.pivots = _pivots(mass, FRAGMENTS)
        # Only repeated or missing ids bring a set's text to its segments more than once.
        self.repeated = self.sets.where("n > 0").groupBy("doc_id").count().where("doc_id IS NULL OR count > 1").limit(1).count() > 0
        self.reps = store(self.sets.where("n > 0").groupBy("id").agg(F.min("doc_id").alias("doc_id"), F.first("map").alias("map")), "ngram-sets")

    def _texts(self) -> DataFrame:
        """One text of each set; documents without id always stay."""
        copies = self.sets.where("n > 0 AND doc_id IS NOT NULL").select("doc_id").join(self.reps, "doc_id", "left_anti")
        return without(self.docs, copies, "doc_id")

    def _near(self, a: str, b: str):
        """Bounds that every linked pair meets at its first common shingle.

        Each bit in which two parity maps differ stands for at least one shingle that only one set has, so
        pairs that differ in more bits than linked sets may differ in shingles are never made.
        """
        p = self.percent
        shared = f"least({a}.n - {a}.pos, {b}.n - {b}.pos)"
        apart = " + ".join(f"bit_count({a}.map[{i}] ^ {b}.map[{i}])" for i in range(MAP_WORDS))
        return (f"100 * least({a}.n, {b}.n) >= {p} * greatest({a}.n, {b}.n) AND "
                f"{100 + p} * {shared} >= {p} * ({a}.n + {b}.n) AND "
                f"{100 + p} * ({apart}) <= {100 - p} * ({a}.n + {b}.n)")

    @staticmethod
    def _pairs(joined: DataFrame, a: str, b: str) -> DataFrame:
        return joined.select(F.least(f"{a}.id", f"{b}.id").alias("a"), F.greatest(f"{a}.id", f"{b}.id").alias("b")).distinct()

    def _linked(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose overlaps, summed over the fragments, reach the threshold."""
        ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
        needed = self.reps.join(ids, "id", "left_semi")
        texts = only(self.docs.where("doc_id IS NOT NULL"), needed.where("doc_id IS NOT NULL"), "doc_id")
        if needed.where("doc_id IS NULL").limit(1).count():
            texts = texts.unionByName(self.docs.where("doc_id IS NULL"))
        parts = texts.mapInArrow(partial(_segments, k=self.k, classes=self.classes, pivots=self.pivots), "id bigint, fragment int, grams array<bigint>")
        parts = store(parts.dropDuplicates(["id", "fragment"]) if self.repeated else parts, "ngram-segments")
        sizes = parts.groupBy("id").agg(F.sum(F.size("grams")).alias("n"))
        # Both joins are dealt by id and fragment, so the second one reuses the segments that the first one moved.
        each = pairs.withColumn("fragment", F.explode(F.sequence(F.lit(0), F.lit(len(self.pivots)))))
        left = each.join(parts.select(F.col("id").alias("a"), "fragment", F.col("grams").alias("ga")).hint("merge"), ["a", "fragment"])
        both = left.join(parts.select(F.col("id").alias("b"), "fragment", F.col("grams").alias("gb")).hint("merge"), ["b", "fragment"])
        counted = both.select("a", "b", F.size(F.array_intersect("ga", "gb")).alias("o")).groupBy("a", "b").agg(F.sum("o").alias("o"))
        sized = counted.join(sizes.select(F.col("id").alias("a"), F.col("n").alias("na")), "a").join(sizes.select(F.col("id").alias("b"), F.col("n").alias("nb")), "b")
        return sized.where(f"100 * o >= {self.percent} * (na + nb - o)").select(F.col("a").alias("u"), F.col("b").alias("v"))

    def labels(self) -> DataFrame:
        """``id, label`` of every set that is linked with another one."""
        rows = self._texts().mapInArrow(partial(_prefixes, k=self.k, percent=self.percent, classes=self.classes), "key bigint, id bigint, n bigint, pos bigint")
        postings = store(rows, "ngram-prefixes")
        # Near copies share most of their keys, so most of their lists have the same members.  Of such lists the first key in the
        # global order stands earliest in each member: its bounds let through every pair that the others would.
        # Most keys stand in one set: all postings move once, to leave those out.
        members = lambda seed: F.bit_xor(F.xxhash64("id", F.lit(seed)))
        counted = postings.repartition("key").withColumn("m", F.count("*").over(Window.partitionBy("key"))).where("m > 1")
        postings = store(counted, "ngram-shared")
        shared = postings.groupBy("key", "m").agg(members(1).alias("s1"), members(2).alias("s2"))
        shared = shared.groupBy("m", "s1", "s2").agg(F.min("key").alias("key")).select("key")
        lists = postings.join(shared.hint("merge"), "key")
        lists = store(lists.join(self.reps.select("id", "map").hint("merge"), "id"), "ngram-lists")
        short, long = lists.where(f"m <= {PLAIN_LIST}"), lists.where(f"m > {PLAIN_LIST}")
        plain = self._pairs(short.alias("x").join(short.alias("y"), F.expr(f"x.key = y.key AND x.id < y.id AND {self._near('x', 'y')}")), "x", "y")
        # In the first round a list's hub is its member of least hash, and a document meets the least hub of all its lists.
        own = long.groupBy("key").agg(F.min(F.struct(F.xxhash64("id").alias("h"), "id", "n", "pos", "map")).alias("x")).select("key", "x.*")
        met = long.alias("x").join(own.alias("y"), F.expr(f"x.key = y.key AND x.id <> y.id AND {self._near('x', 'y')}"))
        met = met.groupBy(F.col("x.id").alias("id")).agg(F.min(F.struct("y.h", F.col("y.id").alias("hub"))).alias("y"))
        first = met.select(F.least("id", "y.hub").alias("a"), F.greatest("id", "y.hub").alias("b")).distinct()
        tested = store(plain.unionByName(first).distinct(), "ngram-pairs")
        links = store(self._linked(tested), "ngram-links")
        done, wide = long.select("id").limit(0), HUBS
        found = components(links)
        while True:
            placed = long.join(found, "id", "left").withColumn("label", F.coalesce("label", "id"))
            main = placed.groupBy("key", "label").agg(F.count("*").alias("c")).groupBy("key").agg(
                F.max_by("label", "c").alias("main"), F.count("*").alias("labels")).where("labels > 1").select("key", "main")
            # Lists of one label have nothing left to compare, now or later.
            placed = store(placed.join(main, "key"), "ngram-open")
            long = placed.drop("label", "main")
            open_ = placed.where("label <> main").join(done, "id", "left_anti")
            salted = open_.groupBy("key", F.pmod(F.xxhash64("id", F.lit("hub")), F.lit(wide)).alias("s")).agg(F.min("id").alias("id"))
            hubs = store(salted.select("id").distinct(), "hubs")
            if not hubs.limit(1).count():
                return found
            fresh = store(self._against(placed, hubs).join(tested, ["a", "b"], "left_anti"), "ngram-pairs")
            new = store(self._linked(fresh), "ngram-links")
            tested, done = store(tested.unionByName(fresh), "ngram-tested"), store(done.unionByName(hubs), "hubs-done")
            wide *= WIDER
            if new.limit(1).count():
                found = components(found.select(F.col("id").alias("u"), F.col("label").alias("v")).unionByName(new))

    def _against(self, placed: DataFrame, hubs: DataFrame) -> DataFrame:
        """Pairs of a hub and a member of one of its lists that no link has joined so far."""
        placed = placed.drop("main")
        hub = placed.join(hubs, "id", "left_semi")
        return self._pairs(placed.alias("x").join(hub.alias("y"), F.expr(f"x.key = y.key AND x.label <> y.label AND {self._near('x', 'y')}")), "x", "y")


def ngram_components(docs: DataFrame, k: int = 4, percent: int = 85, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (least id reachable by links) of every row.

    Words are runs of bytes other than space and 0x09-0x0D with A-Z lower-cased; a text with fewer than
    ``k`` words is one shingle.  Null, empty and wordless texts have 0 shingles, are linked with
    nothing and are their own component.  Repeated rows and equal sets are linked; null ids take part in
    links but never name a component unless all of it is null.  Different texts need different ids.
    Shingles are compared by 58 bits of hash within a pair, sets by 64 bits.
    """
    join = NgramJoin(docs, k, percent, text_col, id_col)
    labels = store(join.labels(), "ngram-labels")
    placed = join.sets.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    least = placed.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    full = placed.join(least, "label", "left")
    return full.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
