"""Row filters of the corpus, and the report of what they reject."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sourceloom.functions.paths import is_ignored, language_of
from sourceloom.functions.text import normalize_newlines
from sourceloom.operators.blocks import syntax_health

# Fixed value: how many leading bytes are probed for a NUL byte.
BINARY_PROBE = 8192


def is_binary(content: Column) -> Column:
    """NUL among the first bytes; unreadable (NULL) content counts as binary."""
    return F.coalesce(F.contains(F.substring(content, 1, BINARY_PROBE), F.lit(b"\x00")), F.lit(True))


def is_text(content: Column) -> Column:
    return F.is_valid_utf8(content)


def decoded(content: Column) -> Column:
    """UTF-8 text with universal newlines; NULL if the bytes are not UTF-8."""
    return normalize_newlines(F.try_validate_utf8(content.cast("string")))


def with_language(files: DataFrame, path: str = "path") -> DataFrame:
    return files.withColumn("language", language_of(F.col(path)))


def scan_filter(
    files: DataFrame, patterns: Iterable[str] = (), languages: Sequence[str] | None = None, path: str = "path"
) -> DataFrame:
    """Ignore rules, then language by suffix, then the allow-list; no byte is read for these."""
    kept = with_language(files.where(~is_ignored(F.col(path), patterns)), path).where("language IS NOT NULL")
    return kept if languages is None else kept.where(F.col("language").isin(*languages))


def reject_reason(
    path: Column, content: Column, patterns: Iterable[str] = (), languages: Sequence[str] | None = None
) -> Column:
    """First filter, in scan order, that a file fails; NULL if it passes all of them."""
    language = language_of(path)
    reason = (
        F.when(is_ignored(path, patterns), "ignored").when(is_binary(content), "binary")
        .when(language.isNull(), "unsupported")
    )
    if languages is not None:
        reason = reason.when(~language.isin(*languages), "language not selected")
    return reason.when(~is_text(content), "not utf-8")


def skipped(
    files: DataFrame, patterns: Iterable[str] = (), languages: Sequence[str] | None = None
) -> DataFrame:
    """``files(path, content)`` → ``(path, stage, reason)`` for everything that yields no rows."""
    marked = files.select(
        "path", "content", reject_reason(F.col("path"), F.col("content"), patterns, languages).alias("reason")
    )
    filtered = marked.where("reason IS NOT NULL").select("path", F.lit("scan").alias("stage"), "reason")
    readable = marked.where("reason IS NULL").select(
        "path", language_of(F.col("path")).alias("language"), decoded(F.col("content")).alias("text")
    )
    broken = syntax_health(readable).where("reason IS NOT NULL")
    return filtered.unionByName(broken.select("path", F.lit("parse").alias("stage"), "reason"))
