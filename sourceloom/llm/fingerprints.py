"""Document fingerprints by winnowing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Characters of a k-gram and k-grams of a window: any run of K + W - 1 shared characters shares a fingerprint.
K, W = 16, 32
#: Low bits of a selected value hold its place counted down, so that the rightmost of equal hashes is the least.
PLACE_BITS = 24
#: Groups of neighbouring documents: about so many documents each, and how many groups at most.
GROUP_DOCS, GROUPS = 1000, 1 << 16
_PLACES = (1 << PLACE_BITS) - 1


def _minima(df: DataFrame, text: str, out: str, offset: Column) -> DataFrame:
    """Adds ``out``: for each place of ``text`` the least (hash, counted-down place) of the window that starts there, cut at the end.

    A text below ``K`` characters is one k-gram, an empty one none.  The expression walks by code points.
    """
    start = F.lit(_PLACES) - offset.cast("bigint")
    top = F.lit(((1 << 63) - 1) ^ _PLACES)
    value = lambda gram, i: F.xxhash64(gram).bitwiseAND(top).bitwiseOR((start - i).bitwiseAND(F.lit(_PLACES)))
    grams = F.when(F.char_length(text) >= K, F.regexp_extract_all(text, F.lit(rf"(?s)(?=(.{{{K}}}))."), F.lit(1))).when(
        F.char_length(text) > 0, F.array(text)).otherwise(F.array().cast("array<string>"))
    df = df.withColumn(out, F.transform(grams, value))
    for step in (1, 2, 4, 8, 16):  # least of 2, 4, 8, 16 and of W values
        ahead = F.slice(out, F.lit(1 + step), F.greatest(F.size(out) - step, F.lit(0)))
        df = df.withColumn(out, F.zip_with(F.col(out), ahead, lambda x, y: F.least(x, y)))
    return df


def winnowed(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: selected values of ``text`` in order of place; see ``places`` and ``hashes_of``."""
    df = _minima(df, text, "_m", F.lit(0))
    windows = F.greatest(F.size("_m") - (W - 1), F.lit(1))
    return df.withColumn(out, F.array_distinct(F.slice("_m", F.lit(1), windows)))


def hashes_of(selected: Column) -> Column:
    return F.transform(selected, lambda s: F.shiftright(s, PLACE_BITS))


def places(selected: Column) -> Column:
    """Places, from 0, modulo 2**24."""
    return F.transform(selected, lambda s: F.lit(_PLACES) - s.bitwiseAND(F.lit(_PLACES)))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two hash arrays; two empty ones are alike."""
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def _grouped(docs: DataFrame, id_col: str) -> DataFrame:
    """``docs`` in groups of neighbouring ids (``_g``); the first document of a group also ends the group before (``_guest``).

    Group borders are quantiles of the ids, at most ``GROUPS`` numbers.
    """
    ids = docs.select(F.col(id_col).alias("d")).where("d IS NOT NULL")
    n = min(max(-(-docs.count() // GROUP_DOCS), 1), GROUPS)
    cuts = ids.agg(F.percentile_approx("d", F.lit([i / n for i in range(1, n)] or [0.5]), F.lit(max(20 * n, 1000)))).first()[0] or []
    cuts = sorted(set(cuts)) if n > 1 else []
    side = max(int(len(cuts) ** 0.5), 1)
    rows = [cuts[i:i + side] for i in range(0, len(cuts), side)]

    def place(d: Column) -> Column:
        """How many borders are not above ``d``, looked up in two steps."""
        if not cuts:
            return F.lit(0)
        row = F.size(F.filter(F.lit([r[0] for r in rows]), lambda c: c <= d))
        inner = F.size(F.filter(F.element_at(F.array(*(F.lit(r) for r in rows)), F.greatest(row, F.lit(1))), lambda c: c <= d))
        return F.when(d.isNull() | (row == 0), F.lit(0)).otherwise((row - 1) * side + inner)

    firsts = ids.groupBy(place(F.col("d")).alias("g")).agg(F.min("d").alias("d")).orderBy("g").collect()  # one row per group
    nulls = docs.where(F.col(id_col).isNull()).limit(1).count() > 0
    known = [f.d for f in firsts]
    before = [firsts[i - 1].g if i else (0 if nulls else firsts[-1].g) for i in range(len(firsts))]
    grouped = docs.withColumn("_g", place(F.col(id_col)))
    if not known:
        return grouped.withColumn("_guest", F.lit(False))
    spots = {f.g: (d, b) for f, d, b in zip(firsts, known, before)}
    heads = F.lit([spots[g][0] if g in spots else None for g in range(len(cuts) + 1)]) if len(spots) == len(cuts) + 1 else \
        F.array(*(F.lit(spots[g][0]) if g in spots else F.lit(None).cast("bigint") for g in range(len(cuts) + 1)))
    backs = F.array(*(F.lit(spots[g][1] if g in spots else -1) for g in range(len(cuts) + 1)))
    target = F.when(F.col(id_col) == F.element_at(heads, F.col("_g") + 1), F.element_at(backs, F.col("_g") + 1))
    own = F.struct(F.col("_g").alias("g"), F.lit(False).alias("guest"))
    guest = F.when(target.isNotNull(), F.struct(target.alias("g"), F.lit(True).alias("guest")))
    twice = grouped.withColumn("_x", F.explode(F.filter(F.array(own, guest), lambda x: x.isNotNull())))
    return twice.withColumn("_g", F.col("_x.g")).withColumn("_guest", F.col("_x.guest")).drop("_x")


def fingerprint_edits(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id``, ``n_chars``, ``text``, ``edited``, the selected values of both (``own``, ``edit``) and of the next document (``following``).

    The edited text is the document with its last quarter of code points (rounded down) replaced by the first as many of the
    next document, ascending ids; after the last comes the first.

    Hashes are of 16-character grams; in each window of 32 the least is selected, the rightmost of equals, with its place, so texts
    that share 47 characters share a fingerprint.  Texts below 16 characters are one gram.  The edited text keeps the selections
    of the windows before the edit; only those that reach into it are made anew.

    Null texts are empty and have no selection.  Null ids come first; rows with the same id are ordered by the hashes of
    their texts, and the only row of a table is its own next.  Texts move once, in groups of about 1000 neighbouring ids.  No Python runs.
    """
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    groups = _grouped(base, "doc_id").repartition("_g")
    made = winnowed(groups, "text", "own")
    made = made.withColumn("_late", F.col("_guest").cast("int"))
    order = Window.partitionBy("_g").orderBy(F.col("_late"), F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    ahead = F.lead(F.struct("text", "own")).over(order)
    made = made.withColumn("_next", ahead).where("NOT _guest")
    n, part = F.char_length("text"), F.floor(F.char_length("text") / 4)
    made = made.withColumn("_head", F.left("text", (n - part).cast("int"))).withColumn("_add", F.coalesce(F.left(F.col("_next.text"), part.cast("int")), F.left("text", part.cast("int"))))
    made = made.withColumn("following", F.coalesce(F.col("_next.own"), F.col("own"))).drop("_next")
    reach = K + W - 2
    long = F.char_length("_head") > reach
    keep = F.when(long, F.char_length("_head") - reach).otherwise(0)
    made = made.withColumn("_keep", keep).withColumn("edited", F.concat("_head", "_add"))
    made = made.withColumn("_tail", F.when(long, F.concat(F.right("_head", F.lit(reach)), F.col("_add"))).otherwise(F.col("edited")))
    made = made.withColumn("_first", F.slice("_m", F.lit(1), F.greatest(F.col("_keep"), F.lit(1)))).withColumn("_first", F.when(F.col("_keep") > 0, F.array_distinct("_first")).otherwise(F.array().cast("array<bigint>"))).drop("_m")
    made = _minima(made, "_tail", "_m", F.col("_keep"))
    windows = F.greatest(F.size("_m") - (W - 1), F.when(F.col("_keep") > 0, F.lit(0)).otherwise(F.lit(1)))
    made = made.withColumn("edit", F.array_distinct(F.concat("_first", F.slice("_m", F.lit(1), windows))))
    return made.select("doc_id", F.char_length("text").cast("bigint").alias("n_chars"), "text", "edited", "own", "edit", "following")
