"""Files → pieces → paired blocks, as one shuffle and a few windows.

A file is cut inside its row into statement-sized pieces, so only about one row
per statement is exploded and no token ever crosses the network: the files are
hash-partitioned by path *before* the explosion, and every later window and
aggregate is clustered by path, which that partitioning already satisfies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sourceloom.functions import headers as H
from sourceloom.functions import patterns as P
from sourceloom.functions import text as X


def by_path(files: DataFrame, langs=P.LANGUAGES) -> DataFrame:
    """The one exchange of the extraction; both its branches reuse it.

    The count is explicit because the stages behind it cost CPU per byte:
    compressed source text looks small to adaptive coalescing, which would
    squeeze the work into a few tasks.
    """
    partitions = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Both branches must ask for the same rows, or Spark could not reuse the exchange.
    kept = files.where(F.col("language").isin(*langs) & F.col("path").isNotNull() & F.col("text").isNotNull())
    return kept.select("path", "language", "text").repartition(partitions, "path")


def _chars(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _after_newline(text: Column) -> Column:
    return F.length(F.substring_index(text, "\n", -1))


def pieces(placed: DataFrame, langs=P.LANGUAGES) -> DataFrame:
    """One row per piece plus an empty one that marks the end of the file."""
    language = F.col("language")
    cut = H.by_language(
        language, lambda lang: F.regexp_extract_all("text", F.lit(P.piece_lexer(lang)), F.lit(0)), langs
    )
    exploded = placed.select(
        "path", "language", F.posexplode(F.array_append(cut, F.lit(""))).alias("n", "piece")
    )
    residue = H.by_language(
        language, lambda lang: F.regexp_replace("piece", P.bracket_residue(lang), ""), langs
    )
    marked = exploded.withColumn("residue", residue)
    python = language == "python"
    last = F.right("piece", F.lit(1))
    term = F.when(
        ~python & last.isin("{", "}", ";") & (F.right("residue", F.lit(1)) == last), last
    ).otherwise("")
    pairs = F.translate(F.col("residue"), "{};\"'`/#", "")
    marked = marked.withColumn("term", term).withColumn(
        "pairs", F.when(python, F.translate(F.col("residue"), "\"'#", "")).otherwise(pairs)
    )
    # Shallow balanced groups go; what stays is mostly open towards other pieces.
    unmatched = F.regexp_replace(F.regexp_replace("pairs", P.balanced("()[]{}", 3), ""), P.balanced("()[]{}", 3), "")
    return marked.select(
        "path", "language", "n", "piece", "term",
        F.length("piece").alias("len"),
        _chars(F.col("piece"), "\n").alias("nl"),
        F.col("residue").rlike(r"[\"'`/#]").alias("stray"),
        F.when(F.col("pairs") == "", "").otherwise(unmatched).alias("rest"),
        (F.when(F.col("term") == "{", 1).when(F.col("term") == "}", -1).otherwise(0)).alias("brace"),
    )


def located(cut: DataFrame) -> DataFrame:
    """Adds line, column, nesting and open-bracket counts to every piece."""
    rest = F.col("rest")
    opened = _chars(rest, "(") + _chars(rest, "[") + _chars(rest, "{")
    closing = _chars(rest, ")") + _chars(rest, "]") + _chars(rest, "}")
    # How far the piece closes brackets opened before it: the lowest prefix sum.
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("low"))
    step = lambda state, char: X.bound(
        state["now"] + F.when(char.isin(")", "]", "}"), -1).otherwise(1),
        lambda now: F.struct(now.alias("now"), F.least(state["low"], now).alias("low")))
    walked = F.aggregate(F.regexp_extract_all(rest, F.lit("."), F.lit(0)), start, step, lambda state: -state["low"])
    closed = F.when(rest == "", 0).otherwise(walked)
    weigh = lambda o, c: _chars(rest, o) - _chars(rest, c)
    order = Window.partitionBy("path").orderBy("n")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    summed = (
        cut.withColumn("closed", closed).withColumn("net", opened - closing)
        .withColumn("round", weigh("(", ")")).withColumn("square", weigh("[", "]"))
        .withColumn("tail", F.when(F.col("nl") > 0, _after_newline(F.col("piece"))))
        .select(
            "*",
            F.sum("len").over(upto).alias("char_end"),
            F.sum("nl").over(upto).alias("line_end"),
            F.sum("brace").over(upto).alias("depth_end"),
            F.sum("net").over(upto).alias("open_end"),
            F.sum("round").over(upto).alias("round_end"),
            F.sum("square").over(upto).alias("square_end"),
        )
    )
    line_start = F.when(F.col("nl") > 0, F.col("char_end") - F.col("tail"))
    with_lines = summed.select(
        "*",
        F.coalesce(F.max(line_start).over(upto), F.lit(0)).alias("line_at_end"),
        F.coalesce(F.max(line_start).over(before), F.lit(0)).alias("line_at_start"),
    )
    is_end = (F.col("len") == 0)
    unbalanced = (
        (F.col("depth_end") < 0) | (F.col("round_end") < 0) | (F.col("square_end") < 0)
        | (F.col("open_end") - F.col("net") - F.col("closed") < 0)
        | (is_end & ((F.col("depth_end") != 0) | (F.col("round_end") != 0)
                     | (F.col("square_end") != 0) | (F.col("open_end") != 0)))
    )
    return with_lines.select(
        "path", "language", "n", "piece", "term", "nl", "net", "depth_end", "open_end", is_end.alias("is_end"),
        (F.col("line_end") - F.col("nl")).alias("line"),
        (F.col("char_end") - F.col("len") - F.col("line_at_start")).alias("column"),
        F.col("line_end"),
        (F.col("char_end") - F.col("line_at_end")).alias("column_end"),
        (F.col("depth_end") - F.col("brace")).alias("depth"),
        (F.col("open_end") - F.col("net")).alias("open"),
        F.col("stray").alias("stray"),
        unbalanced.alias("unbalanced"),
    )


def syntax_health(files: DataFrame) -> DataFrame:
    """Per file: NULL reason if healthy, else why the whole file is rejected."""
    rows = located(pieces(by_path(files)))
    return rows.groupBy("path", "language").agg(
        F.when(F.max("stray"), "unterminated literal or comment")
        .when(F.max("unbalanced"), "unbalanced brackets").alias("reason")
    )


def broken_regions(files: DataFrame, langs=P.LANGUAGES) -> DataFrame:
    """``path, reason, from_line`` of each file that fails the check: where sound text ends, from 0.

    Sound text ends with the last piece before the first error after which nothing is open, so all that
    was closed by then is intact.  What comes later is not looked at again.
    """
    rows = located(pieces(by_path(files, langs), langs))
    bad = F.col("stray") | F.col("unbalanced")
    first = F.min(F.when(bad, F.col("n"))).over(Window.partitionBy("path"))
    rows = rows.withColumn("first_bad", first).where("first_bad IS NOT NULL")
    sound = (F.col("n") < F.col("first_bad")) & (F.col("depth_end") == 0) & (F.col("open_end") == 0)
    # A piece that ends in the middle of a line leaves that line to the sound text.
    edge = F.struct("n", (F.col("line_end") + F.when(F.col("column_end") > 0, 1).otherwise(0)).alias("line"))
    reason = F.when(F.max("stray"), "unterminated literal or comment").otherwise("unbalanced brackets")
    return rows.groupBy("path").agg(
        reason.alias("reason"), F.coalesce(F.max(F.when(sound, edge))["line"], F.lit(0)).alias("from_line"))


def _candidates(rows: DataFrame, langs=P.LANGUAGES) -> DataFrame:
    """Keeps pieces that open, close or declare something; drops all other text."""
    language, term, piece = F.col("language"), F.col("term"), F.col("piece")
    python = language == "python"
    logical = python & (F.col("open") == 0)
    # Only these need their header read: openers, Python lines, bodiless members.
    bodiless = (term == ";") & (
        ((language == "java") & piece.rlike(r"\)[^()=]*;\z"))
        | ((language == "cpp") & piece.rlike(r"=\s*(?:default|delete)\s*;\z"))
    )
    python_header = logical & piece.rlike(r"(?m)^[ \t\f]*+(?:async[ \t]+def|def|class)\b")
    opener = term == "{"
    # Pieces of brace languages that neither open, close nor declare bear no event, and no other row looks at them.
    kept = rows.withColumn("bodiless", bodiless).where(python | term.isin("{", "}") | F.col("bodiless"))
    led = kept.withColumn("is_line", logical & ~F.col("is_end")).withColumn(
        "lead",
        F.when(opener | F.col("bodiless") | logical,
               H.by_language(language, lambda l: F.regexp_extract("piece", P.lead(l), 0), langs)),
    )
    core = F.substring("piece", F.length("lead") + 1, F.length("piece"))
    likely = H.by_language(
        language, lambda l: F.lit(False) if l == "python" else H.opens_candidate(piece, core, l), langs
    )
    led = led.withColumn("header", F.col("bodiless") | python_header | (opener & likely))
    stripped = H.by_language(
        language, lambda l: F.regexp_replace(core, P.strip_comments(l), "$1$1$2$2 "), langs
    )
    # The terminator is dropped, and for C++ a bodiless ``= default``.
    skeleton = F.trim(F.regexp_replace(
        F.regexp_replace(stripped, r"(?:=\s*(?:default|delete)\s*)?[{};]\s*\z", ""), r"\s\s++|[^\S ]", " "))
    if "python" in langs:
        skeleton = F.when(python, F.trim(F.regexp_replace(stripped, r"\s\s++|[^\S ]", " "))).otherwise(skeleton)
    with_skeleton = led.withColumn("skeleton", F.when(F.col("header"), skeleton))
    clean = H.by_language(language, lambda l: H.plain(F.col("skeleton"), l), langs)
    cleaned = with_skeleton.withColumn("clean", F.when(F.col("header"), clean))
    kind = H.by_language(language, lambda l: H.kind(F.col("clean"), l, term), langs)
    return cleaned.withColumn("kind", F.when(F.col("header"), kind))


def paired(rows: DataFrame, keep_broken: bool = False, langs=P.LANGUAGES) -> DataFrame:
    """Block rows (functions, classes and other holders) with start and end positions."""
    python = F.col("language") == "python"
    order = Window.partitionBy("path").orderBy("n")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    if not keep_broken:
        # The windows share one clustering, so this flag costs no exchange.
        rows = rows.withColumn(
            "broken", F.max(F.col("stray") | F.col("unbalanced")).over(Window.partitionBy("path"))
        ).where(~F.col("broken")).drop("broken")
        file_end = F.lit(None).cast("struct<line:bigint,column:bigint,n:int>")
    else:
        # A surplus closing brace ends nothing: depth starts anew at 0, so the functions after it are found.
        low = lambda window: F.least(F.lit(0), F.coalesce(F.min("depth_end").over(window), F.lit(0)))
        upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = rows.withColumns({"depth": F.col("depth") - low(before), "depth_end": F.col("depth_end") - low(upto)})
        # Where a block is never closed, the file's end stands in.
        file_end = F.max(F.struct(F.col("line_end").alias("line"), F.col("column_end").alias("column"), "n")).over(
            Window.partitionBy("path"))
    rows = rows.withColumn("file_end", file_end)
    found = _candidates(rows, langs)
    text = F.regexp_replace(F.col("piece"), r"\s++\z", "")
    lead = F.col("lead")
    indent_text = F.regexp_extract(F.col("lead"), r"[ \t\f]*\z", 0)
    core_empty = F.length("lead") == F.length("piece")
    found = found.withColumn(
        "indent",
        F.when(F.col("is_line"), F.when(core_empty, 0).otherwise(
            F.length(F.replace(indent_text, F.lit("\t"), F.lit(" " * 8))))),
    ).withColumn(
        "stop",
        F.when(python & ~F.col("is_end"), F.struct(
            (F.col("line") + _chars(text, "\n")).alias("line"),
            F.when(text.contains("\n"), _after_newline(text))
            .otherwise(F.col("column") + F.length(text)).cast("long").alias("column"),
        )),
    )
    previous = F.last(
        F.when(F.col("is_line"), F.struct("indent", F.col("kind").isNotNull().alias("opens"))), ignorenulls=True
    ).over(before)
    lined = found.select(
        "*", previous.alias("previous"), F.lag("stop").over(order).alias("previous_stop"),
    )
    # A Python line ends every open block indented at least as deep; EOF ends all.
    reach = F.coalesce(F.col("indent"), F.lit(0))
    ends_python = python & (F.col("is_line") | F.col("is_end")) & (
        (reach < F.col("previous.indent")) | (F.col("previous.opens") & (reach <= F.col("previous.indent")))
    )
    start = F.struct(
        (F.col("line") + _chars(lead, "\n")).alias("line"),
        F.when(lead.contains("\n"), _after_newline(lead))
        .otherwise(F.col("column") + F.length(lead)).cast("long").alias("column"),
    )
    own_stop = F.struct(F.col("line_end").alias("line"), F.col("column_end").alias("column"))
    closing_notes = F.when(F.col("lead").contains("#"), F.col("lead"))
    level_of = F.when(python, F.col("indent")).otherwise(F.col("depth_end")).cast("long")
    event = lambda level, opens, stop, notes: F.struct(
        level.cast("long").alias("level"), F.lit(opens).alias("opens"), stop.alias("stop"), notes.alias("notes")
    )
    no_text = F.lit(None).cast("string")
    nothing = F.array().cast("array<struct<level:bigint,opens:boolean,stop:struct<line:bigint,column:bigint>,notes:string>>")
    is_block = (F.col("term") == "{") | F.col("bodiless") | (python & F.col("kind").isNotNull())
    events = F.concat(
        F.when(ends_python, F.transform(
            F.sequence(reach, F.col("previous.indent")),
            lambda i: event(i, False, F.col("previous_stop"), closing_notes))).otherwise(nothing),
        F.when(F.col("term") == "}", F.array(event(F.col("depth"), False, own_stop, no_text))).otherwise(nothing),
        F.when(is_block, F.array(event(
            F.when(F.col("bodiless"), F.lit(-1)).otherwise(level_of), True, own_stop, no_text))).otherwise(nothing),
    )
    # The indentation of a Python body decides which trailing comments belong to it.
    body_indent = F.lead(F.when(F.col("is_line"), F.col("indent"))).over(order)
    wanted = F.col("kind").isNotNull()
    # Blocks that are neither functions nor holders only pair up; their text is dropped here.
    light = lined.select(
        "path", "language", "n", "depth", "kind", "bodiless", "file_end", F.col("open_end").alias("open_here"),
        F.when(python & wanted, body_indent).alias("body_indent"), F.when(wanted, start).alias("start"),
        *[F.when(wanted, F.col(c)).alias(f"{c}_") for c in ("lead", "skeleton", "clean")],
        events.alias("events"),
    )
    flat = light.where(F.size("events") > 0).select(
        *[c for c in light.columns if c != "events"], F.explode("events").alias("event")
    ).select("*", "event.*").drop("event").withColumnsRenamed({f"{c}_": c for c in ("lead", "skeleton", "clean")})
    # Opens and ends of one level alternate, so the next event of the level is the end.
    same_level = Window.partitionBy("path", "level").orderBy("n", F.col("opens"))
    mate = F.lead(F.struct("n", "stop", "notes", "open_here", "opens")).over(same_level)
    joined = flat.withColumn("mate", mate).where("opens")
    if not keep_broken:
        crossed = F.col("mate").isNotNull() & ~F.col("bodiless") & ~python & (
            (F.col("mate.open_here") != F.col("open_here")) | F.col("mate.opens")
        )
        joined = joined.withColumn(
            "crossed", F.max(crossed).over(Window.partitionBy("path"))
        ).where(~F.col("crossed"))
    notes = F.call_function(
        "regexp_extract", F.col("mate.notes"),
        F.concat(F.lit(r"\A(?:[ \t]*+\n|[ \t]{"), F.col("body_indent"), F.lit(r",}+#[^\n]*+(?:\n|\z))*+")), F.lit(0),
    )
    notes = F.regexp_replace(notes, r"\s++\z", "")
    extended = F.struct(
        (F.col("mate.stop.line") + _chars(notes, "\n") + 1).alias("line"),
        _after_newline(notes).cast("long").alias("column"),
    )
    end = (
        F.when(F.col("bodiless"), F.col("stop"))
        .when(F.col("body_indent").isNotNull() & F.coalesce(notes != "", F.lit(False)), extended)
        .otherwise(F.coalesce(F.col("mate.stop"), F.struct("file_end.line", "file_end.column")))
    )
    n_end = F.when(F.col("bodiless"), F.col("n")).otherwise(F.coalesce("mate.n", "file_end.n"))
    return joined.where(wanted).select(
        "path", "language", "n", n_end.alias("n_end"),
        "depth", "level", "kind", "bodiless", "lead", "skeleton", "clean", "start", end.alias("end"),
    )


def scoped(blocks: DataFrame, langs=P.LANGUAGES) -> DataFrame:
    """Adds the nearest class-like holder and whether any ancestor gives class scope."""
    holder = F.col("kind") != "f"
    events = blocks.withColumn("event", F.explode(F.when(
        holder,
        F.array(
            F.struct(F.col("n").alias("at"), F.lit(1).alias("step")),
            F.struct(F.col("n_end").alias("at"), F.lit(-1).alias("step")),
        ),
    ).otherwise(F.array(F.struct(F.col("n").alias("at"), F.lit(0).alias("step"))))))
    language = F.col("language")
    title = F.when(holder, H.by_language(language, lambda l: H.holder_name(F.col("clean"), l), langs))
    word = F.when(holder, H.by_language(language, lambda l: H.holder_word(F.col("clean"), l), langs))
    step = F.col("event.step")
    order = Window.partitionBy("path").orderBy("event.at", F.when(step < 0, 0).otherwise(1))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = events.select(
        "*",
        F.sum(step).over(upto).alias("holders"),
        F.sum(F.when(F.col("kind") == "c", step).otherwise(0)).over(upto).alias("classes"),
    )
    near = Window.partitionBy("path", "holders").orderBy("event.at", F.when(step < 0, 0).otherwise(1))
    nearest = F.last(
        F.when(step > 0, F.struct(title.alias("title"), word.alias("word"), F.col("kind"), "level")), ignorenulls=True
    ).over(near.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = counted.select("*", nearest.alias("holder")).where(step >= 0)
    name = H.by_language(language, lambda l: H.name(F.col("clean"), l), langs)
    typed = found.withColumn("name", F.when(F.col("kind") == "f", name).otherwise(title))
    at_top = (F.col("depth") == 0) | F.coalesce(F.col("holder.level") == F.col("depth"), F.lit(False))
    declared = F.regexp_replace(F.regexp_extract("clean", H.FUNCTION["java"], 1), P.ANGLES, "")
    typeless = ~declared.rlike(r"(?:\A|\s)(?!(?:public|private|protected)\b)[\p{L}_$]")
    constructor = typeless & (F.col("holder.title") == F.col("name"))
    valid = (
        F.when(F.col("kind") != "f", True)
        .when(language == "go", F.col("depth") == 0)
        .when((language == "java") & F.col("bodiless"),
              (F.col("holder.level") == F.col("depth")) & (F.col("holder.word") != "@interface") & ~typeless)
        .when(language == "java", ~typeless | constructor)
        .when(language.isin("c", "cpp"), at_top)
        .otherwise(True)
    )
    return typed.withColumn("constructor", F.when(language == "java", constructor).when(
        language == "cpp", (F.col("holder.kind") == "c") & (F.col("holder.title") == F.col("name"))
    ).otherwise(False)).where(valid).drop("event", "holders")
