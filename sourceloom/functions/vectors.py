"""Column functions on vectors and on the tokens they come from."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sourceloom.functions.text import bound

# Model context and dimension.
MAX_TOKENS = 8192
DIMENSION = 768


def tokens(text: Column, max_length: int | None = MAX_TOKENS) -> Column:
    """Lower-cased word tokens, cut to the context length of the model."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    return found if max_length is None else F.slice(found, 1, max_length)


def bucket(token: Column, dimension: int) -> Column:
    """Position of a token in the feature vector: leading 32 bits of its MD5."""
    return F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint") % dimension


def hashed_vector(words: Column, dimension: int = DIMENSION) -> Column:
    """Dense token counts by bucket, computed inside the row: nothing is shuffled.

    Equal buckets stand together after sorting, so a count is the length of a run.  Each run gives its count after the
    zeros since the run before; the parts are joined once, in work linear in tokens and dimension.
    """
    zeros = lambda n: F.array_repeat(F.lit(0).cast("float"), n)

    def dense(buckets: Column, starts: Column) -> Column:
        at = lambda j: F.get(buckets, F.get(starts, j))

        def part(start: Column, j: Column) -> Column:
            behind = F.coalesce(at(j - 1) + 1, F.lit(0))
            following = F.coalesce(F.get(starts, j + 1), F.size(buckets))
            return F.concat(zeros(F.get(buckets, start) - behind), F.array((following - start).cast("float")))

        tail = zeros(F.lit(dimension - 1) - F.coalesce(at(F.size(starts) - 1), F.lit(-1)))
        return F.concat(F.flatten(F.transform(starts, part)), tail)

    def counted(buckets: Column) -> Column:
        places = F.transform(buckets, lambda x, i: F.when((i == 0) | (x != F.get(buckets, i - 1)), i))
        return bound(F.filter(places, lambda i: i.isNotNull()), lambda starts: dense(buckets, starts))

    return bound(F.sort_array(F.transform(words, lambda w: bucket(w, dimension).cast("int"))), counted)


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def l2_normalize(vector: Column) -> Column:
    """Unit length in double precision; a zero vector stays as it is."""
    divide = lambda v, length: F.transform(
        v, lambda x: F.when(length > 0, x.cast("double") / length).otherwise(x.cast("double")))
    return bound(vector, lambda v: bound(norm(v), lambda length: divide(v, length)))


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def cosine(left: Column, right: Column) -> Column:
    """Cosine similarity; NULL if either vector is zero."""
    length = norm(left) * norm(right)
    return F.when(length > 0, dot(left, right) / length)


def checked(vector: Column, dimension: int) -> Column:
    """The vector itself, or a failing query if its size is not ``dimension``."""
    message = F.format_string("vector of size %d, expected %d", F.size(vector), F.lit(dimension))
    return F.when(F.size(vector) == dimension, vector).otherwise(F.raise_error(message).cast("array<float>"))
