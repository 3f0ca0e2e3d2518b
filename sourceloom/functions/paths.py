"""Column functions on paths: language by suffix, gitignore-style exclusion."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# File suffixes per language.
EXTENSIONS = {
    "python": ("py",),
    "rust": ("rs",),
    "go": ("go",),
    "java": ("java",),
    "c": ("c", "h"),
    "cpp": ("cpp", "cc", "cxx", "hpp", "hh", "hxx"),
}

# ``{[pP][yY],…}``: lets the file listing itself skip other suffixes in any case.
SUFFIX_GLOB = "*.{" + ",".join(
    "".join(f"[{c}{c.upper()}]" for c in suffix) for suffixes in EXTENSIONS.values() for suffix in suffixes
) + "}"


def language_of(path: Column) -> Column:
    """Language by lower-cased last suffix; NULL for any other file.

    A leading dot makes a hidden name, not a suffix.
    """
    suffix = F.lower(F.regexp_extract(path, r"[^/.][^/]*\.([^./]+)\z", 1))
    result = F.lit(None).cast("string")
    for language, suffixes in EXTENSIONS.items():
        result = F.when(suffix.isin(*suffixes), language).otherwise(result)
    return result


def ignore_regex(pattern: str) -> tuple[str, bool] | None:
    """Regex of one ignore line and whether it excludes; None for blanks and notes."""
    line = pattern.rstrip("\r\n")
    if not line.endswith("\\ "):
        line = line.rstrip()
    if not line or line.startswith("#"):
        return None
    excludes = not line.startswith("!")
    body = line if excludes else line[1:]
    folder_only = body.endswith("/")
    parts = body.strip("/").split("/")
    if parts == [""]:
        return None
    rooted = body.startswith("/") or len(parts) > 1
    regex = "" if rooted else "(?:.+/)?"
    for i, part in enumerate(parts):
        final = i == len(parts) - 1
        if part == "**":
            regex += ".+" if final else "(?:.+/)?"
        else:
            regex += _segment(part) + ("" if final else "/")
    if parts[-1] != "**":
        regex += "/.*" if folder_only else "(?:/.*)?"
    return rf"(?s)\A{regex}\z", excludes


def _segment(glob: str) -> str:
    """Regex of one path segment: ``*``, ``?``, ``[...]`` and backslash escapes."""
    if glob == "*":
        return "[^/]+"
    token = re.compile(r"\\(.)|(\*+)|(\?)|\[([!^]?)(\]?[^\]]*)\]|(.)", re.S)

    def one(m: re.Match) -> str:
        escaped, stars, mark, negated, members, char = m.groups()
        if stars:
            return "[^/]*"
        if mark:
            return "[^/]"
        if members is not None:
            body = re.sub(r"[\\\[\]^&]", lambda c: "\\" + c.group(), members)
            return f"[{'^/' if negated else ''}{body}]"
        return re.sub(r"[^\w/ -]", lambda c: "\\" + c.group(), escaped or char)

    return token.sub(one, glob)


def is_ignored(path: Column, patterns: Iterable[str]) -> Column:
    """Last matching pattern decides; ``!`` patterns take a path back in."""
    rules = [rule for rule in map(ignore_regex, patterns) if rule]
    if not rules:
        return F.lit(False)
    result = None
    for regex, excludes in reversed(rules):
        hit = path.rlike(regex)
        result = F.when(hit, F.lit(excludes)) if result is None else result.when(hit, F.lit(excludes))
    return result.otherwise(F.lit(False))
