"""Line dedup: levelled sorted runs of line hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sourceloom.llm.common import apart, small, store

# What is stripped at both ends of a line, and the letters that are lower-cased.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Stands for a null document id inside the jobs: smaller than any id.
NO_ID = -(1 << 63)
KEY = ["k1", "k2"]


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _hashes(line: Column, min_chars: int) -> Column:
    """Two independent 64-bit hashes of the key; null for short keys."""
    key = line_key(line)
    pair = F.struct(F.xxhash64(key).alias("k1"), F.xxhash64(F.lit("line"), key).alias("k2"))
    return F.when(F.char_length(key) >= min_chars, pair)


class LineRuns:
    """Line keys seen so far, as runs sorted by key; ``fanout`` runs of a level are compacted into one of the next.

    Batches come with falling document ids, so a key's keeper is the largest id of
    the first batch that has it: the anti-join against the runs tells those keys
    apart, and later batches add only counts.
    """

    def __init__(self, fanout: int = 3) -> None:
        self.fanout, self.levels = fanout, []

    def _all(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        rows = runs[0]
        for run in runs[1:]:
            rows = rows.unionByName(run)
        return rows.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))

    def add(self, batch: DataFrame) -> None:
        """``batch``: one ``(k1, k2, doc)`` row per document and key."""
        run = batch.groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.max("doc").alias("keeper"))
        if seen := self._all():
            run = store(run, "line-batch")
            known = seen[0].select(*KEY)
            for other in seen[1:]:
                known = known.unionByName(other.select(*KEY))
            fresh = run.join(known, KEY, "left_anti")
            counts = run.join(known.distinct(), KEY, "left_semi").withColumn("keeper", F.lit(None).cast("bigint"))
            run = fresh.unionByName(counts)
        self._put(0, run)

    def _put(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(store(run.repartition(*KEY).sortWithinPartitions(*KEY), f"line-run-{level}"))
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._put(level + 1, self._merged(full))

    def keys(self) -> DataFrame | None:
        runs = self._all()
        return self._merged(runs) if runs else None


def dedup_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_chars: int = 40, min_docs: int = 5,
                batches: int = 4, fanout: int = 3) -> DataFrame:
    """``docs`` with ``kept`` (text without repeated lines), ``n_lines`` and ``n_dropped``.

    A line's key is the line stripped of blanks and with A-Z lower-cased.  Keys of at
    least ``min_chars`` code points in at least ``min_docs`` documents lose their lines
    except in the largest document id that holds them; other lines stay, joined by newlines.

    Null and empty texts are one empty line.  Rows are documents; rows with the same id
    keep or lose a key together.  Null ids count as smaller than any id.  Keys are compared by 128 bits
    of hash.  A line common to a third of all rows is counted before it is shuffled, and
    no group of documents is ever gathered; only a document's own dropped keys are.  Input columns named like
    the three new ones give way to them.
    """
    docs, at, through = apart(docs, "kept", "n_lines", "n_dropped")
    text_col, id_col = at(text_col), at(id_col)
    base = docs.withColumn("_id", F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)))
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    own = F.array_distinct(F.filter(F.transform(lines, lambda l: _hashes(l, min_chars)), lambda p: p.isNotNull()))
    rows = base.select(F.col("_id").alias("doc"), F.explode_outer(own).alias("p")).where("p IS NOT NULL").select("doc", "p.k1", "p.k2")
    cuts = docs.select(F.col(id_col).cast("double").alias("d")).approxQuantile("d", [i / batches for i in range(1, batches)], 0.01) or []
    cuts = sorted(set(cuts))
    number = F.lit(len(cuts))
    for cut in cuts:
        number = number - (F.col("doc") >= F.lit(cut)).cast("int")
    place = store(rows.withColumn("batch", number), "line-keys")
    runs = LineRuns(fanout)
    for i in range(len(cuts) + 1):
        runs.add(place.where(F.col("batch") == i).drop("batch"))
    common = runs.keys().where(F.col("n_docs") >= min_docs).select(*KEY, "keeper")
    common = store(common, "line-common")
    drops = (place.join(small(common), KEY).where("doc <> keeper")
             .groupBy(F.col("doc").alias("_id")).agg(F.collect_set(F.struct(*KEY)).alias("_drops")))
    marked = base.join(small(store(drops, "line-drops"), 200_000), "_id", "left").withColumn("_lines", lines)
    kept = F.when(F.col("_drops").isNull(), F.col("_lines")).otherwise(
        F.filter("_lines", lambda l: ~F.coalesce(F.array_contains(F.col("_drops"), _hashes(l, min_chars)), F.lit(False))))
    marked = marked.withColumn("_kept", kept)
    return marked.select(*through, F.array_join("_kept", "\n").alias("kept"),
                         F.size("_lines").cast("bigint").alias("n_lines"),
                         (F.size("_lines") - F.size("_kept")).cast("bigint").alias("n_dropped"))
