"""Suffix-array dedup: a depth-limited radix sort finds every repeated window of bytes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sourceloom.llm.common import only, ship, store, without
from sourceloom.llm.kernels import inverse_powers, mixed, powers, raw, sliding_minimum

#: Bytes of an anchor: a window's least hashed run of so many bytes, the leftmost of equals.
ANCHOR = 80
#: Window starts handled at once within a long text; what lies across the border is read by both sides.
PIECE = 1 << 22
#: Bytes of a digit of the radix sort; a digit is compared by its 64-bit hash.
DIGIT = 50
#: Anchors with more distinct surroundings than this are sorted by all tasks together.
ONE_TASK = 4096
#: Suffixes that a task sorts at once, beyond the anchor that fills it up.
SORTED = 100_000

_U = np.uint64
_PLACE = _U((1 << 31) - 1)


def _spans(text: np.ndarray, window: int):
    """Runs of windows with the same anchor: hash of the anchor, hash of all bytes of the run, first window, windows."""
    n, scale, back = len(text), powers(len(text)), inverse_powers(len(text))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + _U(1)) * scale, out=total[1:])
    h = mixed((total[ANCHOR:] - total[:-ANCHOR]) * back[:n - ANCHOR + 1])
    least = sliding_minimum((h & ~_PLACE) | np.arange(len(h), dtype=np.uint64), window - ANCHOR + 1) & _PLACE
    first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    count = np.diff(np.append(first, len(least)))
    end = first + count - 1 + window
    whole = mixed((total[end] - total[first]) * back[first] ^ mixed(count.astype(np.uint64)))
    return h[least[first].astype(np.int64)], whole, first, count


def _anchored(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    names = ["anchor", "span", "doc", "start", "windows"]
    for batch in batches:
        data, offsets = raw(batch.column("_text"))
        docs = batch.column("_doc").to_numpy(zero_copy_only=False)
        found: list[tuple] = []
        held = 0
        for i, doc in enumerate(docs):
            begin, end = int(offsets[i]), int(offsets[i + 1])
            for at in range(begin, end - window + 1, PIECE):
                anchor, span, first, count = _spans(data[at:min(at + PIECE + window - 1, end)], window)
                found.append((anchor, span, np.full(len(first), doc), first + (at - begin), count))
                held += len(first)
            if found and (held > 50_000 or i == len(docs) - 1):
                columns = [np.concatenate(c) for c in zip(*found)]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.uint64).view(np.int64)) for c in columns[:2]]
                                                 + [pa.array(c.astype(np.int64)) for c in columns[2:]], names=names)
                found, held = [], 0
        if found:
            columns = [np.concatenate(c) for c in zip(*found)]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.uint64).view(np.int64)) for c in columns[:2]]
                                             + [pa.array(c.astype(np.int64)) for c in columns[2:]], names=names)


def _passes(bodies: list[bytes], anchors: np.ndarray, copies: np.ndarray, windows: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Body and place of each suffix whose first ``window`` bytes occur twice: most-significant-digit passes over groups."""
    sizes = np.array([len(b) for b in bodies], np.int64)
    text = np.frombuffer(b"".join(bodies), np.uint8)
    back, total = inverse_powers(len(text) + 1), np.zeros(len(text) + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + _U(1)) * powers(len(text)), out=total[1:])
    body = np.repeat(np.arange(len(bodies)), windows)
    place = np.arange(len(body)) - np.repeat(np.cumsum(windows) - windows, windows)
    at, group = (np.cumsum(sizes) - sizes)[body] + place, np.unique(anchors, return_inverse=True)[1][body]
    for depth in range(0, window, DIGIT):
        low, high = at + depth, at + min(depth + DIGIT, window)
        digit = mixed((total[high] - total[low]) * back[low])
        order = np.lexsort((digit, group))
        group, digit, body, place, at = group[order], digit[order], body[order], place[order], at[order]
        if not len(group):
            break
        new = np.append(True, (group[1:] != group[:-1]) | (digit[1:] != digit[:-1]))
        head = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        many = (np.add.reduceat(copies[body], head) > 1)[group]
        group, body, place, at = group[many], body[many], place[many], at[many]
    return body, place


def _radix(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Sorts the suffixes of whole anchors; the rows come sorted by anchor."""
    rows: list[tuple] = []
    held = 0

    def out() -> pa.RecordBatch:
        anchor, span, copies, windows, bodies = zip(*rows)
        anchor, span = np.array(anchor, np.int64), np.array(span, np.int64)
        body, place = _passes(list(bodies), anchor, np.array(copies, np.int64), np.array(windows, np.int64), window)
        order = np.lexsort((place, body))
        body, place = body[order], place[order]
        head = np.flatnonzero(np.append(True, (body[1:] != body[:-1]) | (place[1:] != place[:-1] + 1))) if len(body) else body
        last = np.append(head[1:], len(body)) - 1 if len(body) else body  # neighbouring windows leave as one range
        return pa.RecordBatch.from_arrays([pa.array(anchor[body[head]]), pa.array(span[body[head]]), pa.array(place[head].astype(np.int64)),
                                           pa.array(place[last].astype(np.int64))], names=["anchor", "span", "i", "j"])

    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in ("anchor", "span", "copies", "windows", "body"))):
            if held > SORTED and row[0] != rows[-1][0]:
                yield out()
                rows, held = [], 0
            rows.append(row)
            held += row[3]
    if rows:
        yield out()


def _cut(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Takes the byte ranges of ``_cuts`` out of each text."""
    for batch in batches:
        data, offsets = raw(batch.column("_text"))
        lists = batch.column("_cuts")
        bounds = lists.offsets.to_numpy()
        starts, ends = (lists.values.field(n).to_numpy(zero_copy_only=False) for n in ("start", "end"))
        kept, removed, spans = [], [], []
        for i in range(batch.num_rows):
            text, mine = data[int(offsets[i]):int(offsets[i + 1])], slice(int(bounds[i]), int(bounds[i + 1]))
            edge = np.zeros(len(text) + 1, np.int32)
            np.add.at(edge, starts[mine], 1)
            np.add.at(edge, ends[mine], -1)
            gone = np.cumsum(edge[:-1]) > 0
            kept.append(text[~gone].tobytes())
            removed.append(int(gone.sum()))
            spans.append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), pa.array(np.diff(offsets).tolist(), pa.int64()), pa.array(removed, pa.int64()),
             pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], names=[*names, "n_bytes", "n_removed", "n_spans", "kept"])


def _shared_radix(held: DataFrame, window: int) -> DataFrame:
    """The same passes by all tasks together, with a group per digits so far."""
    suffixes = held.select("anchor", "span", "copies", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("windows") - 1)).alias("i"), "body")
    group, key = F.col("anchor"), []
    for depth in range(0, window, DIGIT):
        group = F.xxhash64(group, F.expr(f"substring(body, int(i + 1 + {depth}), {min(DIGIT, window - depth)})"))
        key.append(group)
    rows = suffixes.select("anchor", "span", "copies", "i", *(g.alias(f"g{p}") for p, g in enumerate(key)))
    for p in range(len(key)):  # a suffix is carried as its number, not its bytes
        many = rows.groupBy(f"g{p}").agg(F.sum("copies").alias("size")).where("size > 1").select(f"g{p}")
        rows = store(rows.join(many, f"g{p}", "left_semi").drop(f"g{p}"), f"digit-{p}")
    return rows.select("anchor", "span", "i", F.col("i").alias("j"))


def repeated_windows(texts: DataFrame, window: int = 200) -> DataFrame:
    """``doc, start, end``: byte ranges whose every window of ``window`` bytes starts at least twice in ``texts(_doc, _text)``.

    A window's anchor depends on its bytes alone, so equal windows have equal anchors, and an
    anchor seen once drops all its windows before any sort.  Windows of an anchor whose surroundings are all
    the same are equal groups already.  Of the others each distinct surrounding is
    taken once, with its number of copies, and its window suffixes are sorted by
    most-significant-digit passes: groups that hold one suffix leave after each
    pass, and those left after ``window`` bytes are exactly the repeated windows.
    """
    spans = store(texts.mapInArrow(partial(_anchored, window=window), "anchor bigint, span bigint, doc bigint, start bigint, windows bigint"), "anchors")
    anchors = spans.groupBy("anchor").agg(F.count("*").alias("n"), F.min("span").alias("low"), F.max("span").alias("high"))
    again = store(anchors.where("n > 1").select("anchor", F.expr("low <> high").alias("differ")), "anchors-again")
    spans = store(spans.join(again.hint("merge"), "anchor"), "spans-again")
    last = F.col("start") + F.col("windows") - 1 + window
    same = spans.where("NOT differ").select("doc", "start", last.alias("end"))

    mixed_ = spans.where("differ")
    classes = store(mixed_.groupBy("anchor", "span").agg(F.count("*").alias("copies"), F.min(F.struct("doc", "start", "windows")).alias("x"))
                    .select("anchor", "span", "copies", "x.*"), "span-classes")
    body = F.expr(f"substring(cast(_text AS binary), int(start + 1), int(windows - 1 + {window}))")
    held = only(texts.withColumnRenamed("_doc", "doc"), classes, "doc").join(classes, "doc")
    held = store(held.select("anchor", "span", "copies", "windows", body.alias("body")), "span-bodies")
    crowds = store(held.groupBy("anchor").agg(F.count("*").alias("n")).where(f"n > {ONE_TASK}").select("anchor"), "crowded-anchors")
    ordered = without(held, crowds, "anchor").repartition("anchor").sortWithinPartitions("anchor")
    rows = ordered.mapInArrow(partial(_radix, window=window), "anchor bigint, span bigint, i bigint, j bigint")
    if crowds.limit(1).count():
        rows = rows.unionByName(_shared_radix(only(held, crowds, "anchor"), window))
    # A span has at most ``window - ANCHOR + 1`` windows, so its ranges are few.
    hits = rows.groupBy("anchor", "span").agg(F.collect_set(F.struct("i", "j")).alias("hits"))
    partly = mixed_.join(hits, ["anchor", "span"]).select("doc", "start", F.explode("hits").alias("hit"))
    return same.unionByName(partly.select("doc", F.expr("start + hit.i").alias("start"), F.expr(f"start + hit.j + {window}").alias("end")))


def remove_repeats(docs: DataFrame, window: int = 200, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans`` and ``kept`` (binary) of every row.

    Removes each byte covered by a string of ``window`` bytes that also starts anywhere else in the table, the same text
    included; strings overlap, never cross texts, and are judged on the input.

    Null texts are empty; texts shorter than ``window`` stay whole.  Repeated rows count as occurrences each and so lose
    all their windows.  A null id stands for its text; different texts need different ids.  A very long text is anchored
    in pieces that overlap, so no window is missed.  A string that a third of all rows hold is counted before it
    is shuffled and sorted once for all its equal surroundings.
    """
    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("_text"))
    base = base.withColumn("_doc", F.coalesce("doc_id", F.xxhash64("_text")))
    ranges = repeated_windows(base.select("_doc", "_text"), window)
    cuts = ranges.groupBy(F.col("doc").alias("_doc")).agg(F.collect_set(F.struct("start", "end")).alias("_cuts"))  # of one text
    cuts = store(cuts, "cuts")
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    touched = only(base, cuts, "_doc").join(cuts, "_doc").select("doc_id", "_text", "_cuts")
    cut = touched.mapInArrow(partial(_cut, names=["doc_id"]), schema)
    zero = F.lit(0).cast("bigint")
    whole = without(base, cuts, "_doc").select("doc_id", F.octet_length("_text").cast("bigint").alias("n_bytes"), zero.alias("n_removed"),
                                               zero.alias("n_spans"), F.encode("_text", "UTF-8").alias("kept"))
    return cut.unionByName(whole)
