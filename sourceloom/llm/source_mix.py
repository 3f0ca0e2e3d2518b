"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sourceloom.llm.common import apart, small

#: Sources that may be broadcast with their distribution tables (some hundred bytes each).
BROADCAST_SOURCES = 20_000


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) of 52 bits of an MD5 digest: the same in every run and engine."""
    digest = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13)
    return F.conv(digest, 16, 10).cast("double") / F.lit(2.0 ** 52)


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5, text_col: str = "text",
                 source_col: str = "source") -> DataFrame:
    """``_source``, ``rate``: target repetitions of each source so that shares of characters meet the weights.

    Without ``weights`` a source's weight is its size to ``power``.  Sources are counted
    before the shuffle, so one that holds a third of all rows costs no more than others.
    """
    size = F.coalesce(F.char_length(text_col).cast("double"), F.lit(0.0))
    sizes = docs.groupBy(F.col(source_col).alias("_source")).agg(F.sum(size).alias("size"))
    if weights is None:
        weight = F.pow("size", F.lit(power))
    else:
        named = F.create_map(*(F.lit(x) for pair in weights.items() for x in pair)) if weights else F.lit(None).cast("map<string,double>")
        weight = F.coalesce(F.element_at(named, F.col("_source")), F.lit(0.0))
    weighed = sizes.withColumn("weight", F.when(F.col("size") > 0, weight).otherwise(0.0))
    whole = weighed.agg(F.sum("size").alias("all_size"), F.sum("weight").alias("all_weight"))
    # One row of totals, joined on a constant: no product of two tables.
    joined = weighed.withColumn("_one", F.lit(1)).join(F.broadcast(whole.withColumn("_one", F.lit(1))), "_one")
    rate = F.when(F.col("weight") > 0, F.col("weight") / F.col("all_weight") * F.col("all_size") / F.col("size")).otherwise(0.0)
    return joined.select("_source", rate.alias("rate"))


def poisson_steps(rate: Column) -> Column:
    """Cumulative Poisson probabilities from 0 on, until what is left is below the resolution of ``uniform``."""
    last = F.ceil(rate + 14 * F.sqrt(rate) + 30).cast("int")
    start = F.struct((-rate).alias("log"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("steps"))

    def step(state: Column, k: Column) -> Column:
        log = state["log"] + F.log(rate) - F.log(k.cast("double"))
        total = state["sum"] + F.exp(log)
        return F.struct(log.alias("log"), total.alias("sum"), F.concat(state["steps"], F.array(total)).alias("steps"))

    return F.when(rate <= 0, F.array(F.lit(1.0))).otherwise(F.aggregate(F.sequence(F.lit(1), last), start, step)["steps"])


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5, seed: str = "mix",
                text_col: str = "text", id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """``docs`` repeated by Poisson counts and shuffled, with ``rate``, ``copies``, ``copy`` (1 to ``copies``), ``shuffle_key``.

    A document's count inverts the Poisson distribution with its source's rate at a
    number hashed from the seed and its id, so any run gives the same rows.  Rows are
    dealt by the digest ``shuffle_key`` and sorted by it inside partitions.

    Null sources form a source of their own.  Rows of one id share a draw; rows without id draw by their text, so
    those of equal texts (null and empty are equal) share one.  Sources without text or weight get rate 0 and leave.
    Empty texts of other sources are repeated like any.  Input columns named like the four new ones give way to them.
    No Python runs.
    """
    inner, at, through = apart(docs, "rate", "copies", "copy", "shuffle_key")
    text_col, source_col = at(text_col), at(source_col)
    ident = F.coalesce(F.col(at(id_col)).cast("string"), F.concat(F.lit("null|"), F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")))))
    rates = source_rates(inner, weights, power, text_col, source_col).select("_source", "rate", poisson_steps(F.col("rate")).alias("_steps"))
    rated = inner.join(small(rates, BROADCAST_SOURCES), F.col(source_col).eqNullSafe(F.col("_source"))).drop("_source")
    drawn = rated.withColumn("_u", uniform(F.lit(seed), ident))
    counted = drawn.withColumn("copies", F.size(F.filter("_steps", lambda c: c <= F.col("_u"))).cast("bigint")).drop("_steps", "_u")
    copies = counted.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    keyed = copies.withColumn("shuffle_key", F.md5(F.concat_ws("|", F.lit(seed), F.lit("order"), ident, F.col("copy").cast("string"))))
    dealt = keyed.select(*through, "rate", "copies", "copy", "shuffle_key")
    return dealt.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
