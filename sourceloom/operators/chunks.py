"""Function rows: block positions joined back to the file text, then projected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sourceloom.functions import headers as H
from sourceloom.functions import patterns as P
from sourceloom.functions import relations as R
from sourceloom.functions import text as X
from sourceloom.operators.blocks import broken_regions, by_path, located, paired, pieces, scoped
from sourceloom.schema import CHUNKS


def _languages(languages) -> tuple[str, ...]:
    unknown = set(languages or ()) - set(P.LANGUAGES)
    if unknown:
        raise ValueError(f"unknown languages: {sorted(unknown)}")
    return tuple(languages or P.LANGUAGES)


def block_table(files: DataFrame, keep_broken: bool = False, languages=None) -> DataFrame:
    """Located functions and class-like holders, without their text."""
    langs = _languages(languages)
    return scoped(paired(located(pieces(by_path(files, langs), langs)), keep_broken, langs), langs)


def _cut(lines: Column, span: Column) -> Column:
    """Source text of a span; the lines are bound once per file, not once per span."""
    kept = F.slice(lines, span["start"]["line"] + 1, span["end"]["line"] - span["start"]["line"] + 1)
    joined = F.array_join(kept, "\n")
    last = F.element_at(lines, (span["end"]["line"] + 1).cast("int"))
    size = F.length(joined) - span["start"]["column"] - F.length(last) + span["end"]["column"]
    return F.substring(joined, (span["start"]["column"] + 1).cast("int"), size.cast("int"))


def _byte_column(lines: Column, point: Column) -> Column:
    line = F.element_at(lines, (point["line"] + 1).cast("int"))
    return F.octet_length(F.left(line, point["column"].cast("int")))


def attach_text(blocks: DataFrame, files: DataFrame, with_imports: bool = True, langs=P.LANGUAGES) -> DataFrame:
    """Adds ``code`` and byte columns by a co-partitioned join on path.

    The grouped side holds the few spans of a file, the other side is the same
    exchange the pieces came from, so the join moves no further data.
    """
    columns = [c for c in blocks.columns if c not in ("path", "language")]
    spans = blocks.groupBy("path").agg(F.collect_list(F.struct(*columns)).alias("spans"))
    placed = by_path(files, langs)
    joined = placed.join(spans.hint("shuffle_hash"), "path")

    def enrich(lines: Column) -> Column:
        return F.transform("spans", lambda s: F.struct(
            s.alias("span"), _cut(lines, s).alias("code"),
            _byte_column(lines, s["start"]).alias("start_column"),
            _byte_column(lines, s["end"]).alias("end_column"),
        ))

    # The test keeps ``language`` in this branch whatever columns are wanted: pruned
    # of it, the branch could not share the exchange of the other one.
    texts = F.when(F.col("language").isNotNull(), X.bound(F.split("text", "\n"), enrich))
    empty = F.array().cast("array<string>")
    imports = H.by_language(F.col("language"), lambda l: R.imports(F.col("text"), l), langs) if with_imports else empty
    return joined.select(
        "path", "language", imports.alias("imports"), F.explode(texts).alias("item")
    ).select("path", "language", "imports", "item.code", "item.start_column", "item.end_column", "item.span.*")


def _docstring(lang: str) -> Column:
    if lang == "python":
        return R.python_docstring(F.col("code"))
    pattern, group = P.last_comment(lang)
    comment = F.nullif(F.regexp_extract("lead", pattern, group), F.lit(""))
    if lang == "rust":
        return X.clean_line_comment(comment, "///", "//!")
    if lang == "go":
        return X.clean_line_comment(comment, "//")
    return X.clean_block_comment(comment)


def _scope(lang: str) -> tuple[Column, Column]:
    inside = F.col("classes") > 0
    if lang == "go":
        method = F.col("clean").rlike(r"\Afunc ?\(")
        return F.when(method, "method").otherwise("global"), F.when(method, "method").otherwise("function")
    if lang == "c":
        return F.lit("global"), F.lit("function")
    if lang == "java":
        scope = F.when(F.col("constructor") | inside, "class").otherwise("global")
        return scope, F.when(F.col("constructor"), "constructor").otherwise("method")
    scope = F.when(inside, "impl" if lang == "rust" else "class").otherwise("global")
    method = F.when(inside, F.when(F.col("constructor"), "constructor").otherwise("method"))
    return scope, method.otherwise("function")


EXTRAS = ("attributes", "types_used")


def described(located_blocks: DataFrame, columns, langs=P.LANGUAGES) -> DataFrame:
    """The wanted chunk attributes; expressions of other columns are not even built."""
    language, clean, code = F.col("language"), F.col("clean"), F.col("code")
    entries, names = F.col("entries"), F.col("names")
    pick = lambda build: H.by_language(language, build, langs)
    function = F.col("kind") == "f"
    empty = F.array().cast("array<string>")
    listed = lambda build: F.when(function, pick(build)).otherwise(empty)
    holder_scope = F.when(F.col("holder.title").isNull() | (F.col("classes") <= 1), "global").otherwise("class")
    projections = {
        "name": lambda: F.col("name"),
        "code": lambda: code,
        "file_path": lambda: F.col("path"),
        "start_line": lambda: (F.col("start.line") + 1).cast("int"),
        "end_line": lambda: (F.col("end.line") + 1).cast("int"),
        "start_column": lambda: F.col("start_column"),
        "end_column": lambda: F.col("end_column"),
        "language": lambda: language,
        "function_type": lambda: F.when(function, pick(lambda l: _scope(l)[1])).otherwise("class"),
        "arguments": lambda: listed(lambda l: H.arguments(names, clean, l)),
        "return_type": lambda: F.col("result_type"),
        "docstring": lambda: pick(_docstring),
        "comments": lambda: pick(lambda l: R.comments(code, l)),
        "modifiers": lambda: listed(lambda l: H.modifiers(clean, l)),
        "scope": lambda: F.when(function, pick(lambda l: _scope(l)[0])).otherwise(holder_scope),
        "imports": lambda: F.col("imports"),
        "calls": lambda: listed(lambda l: R.calls(code, l)),
        "complexity": lambda: X.complexity(code),
        "loc": lambda: X.loc(code),
        "comment_lines": lambda: X.comment_lines(code),
        "attributes": lambda: pick(lambda l: R.attributes(F.col("lead"), F.col("skeleton"), l)),
        "types_used": lambda: listed(lambda l: R.types_used(entries, names, F.col("result_type"), l)),
    }
    # Shared parts are columns of their own, so they are computed once.
    parsed = located_blocks
    if {"arguments", "types_used"} & set(columns):
        split = pick(lambda l: H.split_parameters(H.parameters(clean, l), l))
        parsed = parsed.withColumn("entries", F.when(function, split))
        parsed = parsed.withColumn("names", F.when(function, pick(lambda l: H.entry_names(entries, l))))
    if {"return_type", "types_used"} & set(columns):
        parsed = parsed.withColumn("result_type", F.when(function, pick(lambda l: H.return_type(clean, l))))
    return parsed.select(*[projections[c]().alias(c) for c in columns])


def extract_functions(
    files: DataFrame, on_error: str = "drop", include_classes: bool = False, languages=None, columns=None
) -> DataFrame:
    """``files(path, language, text)`` → one row per function, nested ones included.

    ``path`` must identify a file; prefix it with the repository for several
    repositories.  Files that fail the syntax check yield no row unless
    ``on_error="keep"``.  ``languages`` and ``columns`` narrow the plan itself.
    """
    if on_error not in ("drop", "keep"):
        raise ValueError("on_error must be 'drop' or 'keep'")
    langs = _languages(languages)
    columns = tuple(columns or (*CHUNKS.fieldNames(), *EXTRAS))
    blocks = block_table(files, on_error == "keep", langs)
    blocks = blocks.where((F.col("kind") == "f") | is_class_like()) if include_classes else blocks.where("kind = 'f'")
    return described(attach_text(blocks, files, "imports" in columns, langs), columns, langs)


def marked_functions(files: DataFrame, languages=None, columns=None) -> DataFrame:
    """Functions of all files, those of broken ones too, with ``incomplete`` and ``reason``.

    A function of a broken file is incomplete if it ends after the sound text of the file
    (``blocks.broken_regions``); those closed before the first error are not marked and have no reason.
    ``columns`` must hold ``file_path`` and ``end_line``.
    """
    found = extract_functions(files, on_error="keep", languages=languages, columns=columns)
    regions = broken_regions(files, _languages(languages)).withColumnRenamed("path", "file_path")
    joined = found.join(regions, "file_path", "left")
    incomplete = F.coalesce(F.col("end_line") > F.col("from_line"), F.lit(False))
    return joined.select(*found.columns, incomplete.alias("incomplete"), F.when(incomplete, F.col("reason")).alias("reason"))


def is_class_like() -> Column:
    """Classes, interfaces, enums, records, structs and impl blocks that bear a name."""
    return (F.col("kind") == "c") | ((F.col("kind") == "k") & (F.col("language") == "java") & (F.col("name") != ""))


def class_edges(files: DataFrame, languages=None) -> DataFrame:
    """``(file_path, class_name, base)`` for every declared base or implemented trait."""
    langs = _languages(languages)
    blocks = block_table(files, languages=langs).where(is_class_like())
    bases = H.by_language(F.col("language"), lambda l: R.bases(F.col("clean"), l), langs)
    return blocks.select(
        F.col("path").alias("file_path"), "language", F.col("name").alias("class_name"),
        F.explode(bases).alias("base"),
    )
