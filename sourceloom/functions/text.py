"""Column functions on text: line metrics, branching complexity, comment cleaners."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sourceloom.functions.patterns import WORD

# The blanks a line is stripped of, and the words that count as branches.
BLANK = r"[\t\x0B\f\r\x1C-\x1F \x85\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
BRANCH_WORDS = ("if", "for", "while", "elif", "else", "case", "switch", "catch")

_COMMENT_LINE = rf"(?dm)^{BLANK}*+(?:#|//|/?\*)"
_FILLED_LINE = rf"(?dm)^{BLANK}*+[^\n]"
# The plain character is tested first: it rules out most places.
_BRANCH = rf"(?=[{''.join(sorted({word[0] for word in BRANCH_WORDS}))}])(?<!{WORD})(?:{'|'.join(BRANCH_WORDS)})(?!{WORD})"
_TERNARY = rf"\?(?<={WORD}\?)(?={WORD})"


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def comment_lines(text: Column) -> Column:
    """Lines whose first visible characters look like a comment."""
    return _count(text, _COMMENT_LINE)


def loc(text: Column) -> Column:
    """Non-blank lines that are not comment lines."""
    return _count(text, _FILLED_LINE) - _count(text, _COMMENT_LINE)


def complexity(text: Column) -> Column:
    """One plus the branch words and tight ``a?b`` ternaries of the raw text."""
    return F.lit(1) + _count(text, _BRANCH) + _count(text, _TERNARY)


def normalize_newlines(text: Column) -> Column:
    return F.regexp_replace(text, r"\r\n?", "\n")


def trim_blank(text: Column) -> Column:
    """Strip every kind of blank, not only spaces."""
    any_blank = BLANK[:-1] + r"\n]"
    return F.regexp_replace(text, rf"\A{any_blank}++|{any_blank}++\z", "")


# A line start: blanks, one leading star, blanks.
_MARGIN = rf"{BLANK}*+(?:\*{BLANK}*+)?"


def clean_block_comment(comment: Column) -> Column:
    """Text of a ``/** … */`` comment on one line; NULL for other comments or no text."""
    inner = F.substring(comment, F.lit(4), F.greatest(F.length(comment) - 5, F.lit(0)))
    headless = F.regexp_replace(inner, rf"\A{_MARGIN}(?:\n{_MARGIN})*+", "")
    joined = trim_blank(F.regexp_replace(headless, rf"{BLANK}*+(?:\n{_MARGIN})++", " "))
    return F.when(comment.startswith("/**"), F.nullif(joined, F.lit("")))


def clean_line_comment(comment: Column, *markers: str) -> Column:
    """Text after the first matching marker such as ``///``; NULL without one."""
    result = F.lit(None).cast("string")
    for marker in reversed(markers):
        rest = F.substring(comment, F.lit(len(marker) + 1), F.length(comment))
        result = F.when(comment.startswith(marker), trim_blank(rest)).otherwise(result)
    return result


def strip_quotes(literal: Column) -> Column:
    """Drop quote characters at both ends, then blanks."""
    return trim_blank(F.regexp_replace(literal, r"""\A["']++|["']++\z""", ""))
