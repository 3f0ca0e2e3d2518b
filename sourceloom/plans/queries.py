"""Every operator as a query over the given tables, each with its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sourceloom.functions import paths, text as X, vectors as V
from sourceloom.operators import collection as C, embed as E, enrich, incremental as D, predicates as P
from sourceloom.operators.blocks import syntax_health
from sourceloom.operators.chunks import class_edges, extract_functions, marked_functions
from sourceloom.plans import corpus as R
from sourceloom.operators.snapshots import Snapshots
from sourceloom.sources.scan import files_from_table, scan_corpus
from sourceloom.sources.shared import shared_folder, spread, stored
from sourceloom.streaming.ingest import ingest
from sourceloom.streaming.sync import chunks_of, sync

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with long texts, over all cores even if it is one row group."""
    return spread(table(spark, sf_dir, name))


def corpus_files(spark: SparkSession, sf_dir: str, languages=None) -> DataFrame:
    """Rendered corpus after the path filters, as text with plain newlines."""
    raw = R.raw_corpus(spark, sf_dir)
    return P.scan_filter(raw, R.IGNORE_RULES, languages).select(
        "path", "language", X.normalize_newlines(F.col("text")).alias("text")
    )


def flat(df: DataFrame) -> DataFrame:
    """Scalar columns only: 64-bit integers, arrays joined."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.IntegerType):
            column = column.cast("bigint")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, "|" if field.name in ("comments", "attributes") else ",")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def chunk_columns(spark, sf_dir, columns, languages=None, **options) -> DataFrame:
    files = corpus_files(spark, sf_dir, languages)
    return flat(extract_functions(files, languages=languages, columns=columns, **options))


def expected(*columns: str, languages=R.LANGUAGES) -> str:
    fields = {"file_path": "path", "start_line": "start", "end_line": "end"}
    return R.facts_sql({c: fields.get(c, c) for c in columns}, languages)


# Parts whose files reach extraction, and the broken ones.
KEPT = f"{R.VARIANT} <> 4"
LANGUAGE_SQL = "CASE p_partkey % 6 " + " ".join(f"WHEN {i} THEN '{l}'" for i, l in enumerate(R.LANGUAGES)) + " END"
BLANK_RE2 = (r"[\t\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")


# ---- sources and predicates -------------------------------------------------

@query("scan_filtered", f"""
SELECT {R.path_sql()} AS path, {LANGUAGE_SQL} AS language FROM part
WHERE {KEPT} AND p_partkey % 6 IN (0, 3, 5)""")
def scan_filtered(spark, sf_dir):
    kept = P.scan_filter(R.raw_corpus(spark, sf_dir), R.IGNORE_RULES, ["python", "java", "cpp"])
    return kept.select("path", "language")


@query("language_detect", f"SELECT {R.path_sql()} AS path, {LANGUAGE_SQL} AS language FROM part")
def language_detect(spark, sf_dir):
    return P.with_language(R.raw_corpus(spark, sf_dir)).select("path", "language")


PAGE_RULES = ("fr/", "/en/*", "!/en/*5", "# no rule", "/de/[1-4]?")
PAGE_PATH = r"^[a-z]+://[^/]+/([^?#]*)"


@query("ignore_pages", f"""
SELECT page_id, CASE WHEN regexp_matches(p, '^de/[1-4][^/](/.*)?$') THEN true
  WHEN regexp_matches(p, '^en/[^/]*5(/.*)?$') THEN false
  WHEN regexp_matches(p, '^en/[^/]+(/.*)?$') THEN true
  ELSE regexp_matches(p, '(^|/)fr/') END AS ignored
FROM (SELECT page_id, regexp_extract(url, '{PAGE_PATH}', 1) AS p FROM pages)""")
def ignore_pages(spark, sf_dir):
    path = F.regexp_extract("url", PAGE_PATH, 1)
    return table(spark, sf_dir, "pages").select("page_id", paths.is_ignored(path, PAGE_RULES).alias("ignored"))


@query("page_language", r"""
SELECT page_id, CASE lower(regexp_extract(split_part(split_part(url, '?', 1), '#', 1), '\.([^./]+)$', 1))
  WHEN 'py' THEN 'python' WHEN 'rs' THEN 'rust' WHEN 'go' THEN 'go' WHEN 'java' THEN 'java' WHEN 'c' THEN 'c'
  WHEN 'h' THEN 'c' WHEN 'cpp' THEN 'cpp' WHEN 'cc' THEN 'cpp' WHEN 'cxx' THEN 'cpp' WHEN 'hpp' THEN 'cpp'
  WHEN 'hh' THEN 'cpp' WHEN 'hxx' THEN 'cpp' END AS language FROM pages""")
def page_language(spark, sf_dir):
    path = F.regexp_replace("url", r"[?#].*\z", "")
    return table(spark, sf_dir, "pages").select("page_id", paths.language_of(path).alias("language"))


@query("binary_filter", f"SELECT {R.path_sql()} AS path FROM part WHERE p_partkey % 7 <> 3")
def binary_filter(spark, sf_dir):
    return R.raw_corpus(spark, sf_dir).where(~P.is_binary(F.col("content"))).select("path")


@query("utf8_filter", f"SELECT {R.path_sql()} AS path FROM part WHERE p_partkey % 11 <> 5 OR p_partkey % 7 = 3")
def utf8_filter(spark, sf_dir):
    return R.raw_corpus(spark, sf_dir).where(P.is_text(F.col("content"))).select("path")


@query("newline_norm", f"""
SELECT path, md5(t) AS digest, cast(length(t) as bigint) AS chars FROM (
  SELECT {R.path_sql()} AS path, replace({R.raw_text_sql()}, concat(chr(13), chr(10)), chr(10)) AS t FROM part
  WHERE p_partkey % 11 <> 5 AND p_partkey % 7 <> 3)""")
def newline_norm(spark, sf_dir):
    raw = R.raw_corpus(spark, sf_dir)
    kept = raw.where(P.is_text(F.col("content")) & ~P.is_binary(F.col("content")))
    decoded = kept.select("path", P.decoded(F.col("content")).alias("t"))
    return decoded.select("path", F.md5("t").alias("digest"), F.length("t").cast("bigint").alias("chars"))


@query("files_from_table", f"""
SELECT concat('repo_', cast(p_size % 25 as string), '/', {R.path_sql()}) AS path, {LANGUAGE_SQL} AS language,
  md5(replace({R.raw_text_sql()}, concat(chr(13), chr(10)), chr(10))) AS digest FROM part""")
def table_files(spark, sf_dir):
    rendered = R.dealt(table(spark, sf_dir, "part")).select(
        F.expr("concat('repo_', cast(p_size % 25 as string))").alias("repo"),
        F.expr(R.path_sql()).alias("place"), F.expr(R.raw_text_joined_sql()).alias("body"))
    return files_from_table(rendered, "place", "body", "repo").select("path", "language", F.md5("text").alias("digest"))


def _placed(frames):
    """Writes ``(uri, content)`` rows as files."""
    from pyarrow import fs as arrow_fs

    for frame in frames:
        for uri, content in zip(frame.uri, frame.content):
            store, place = arrow_fs.FileSystem.from_uri(uri)
            store.create_dir(place.rpartition("/")[0])
            with store.open_output_stream(place) as out:
                out.write(content)
        yield frame[["uri"]]


# Every tenth file lies in a folder that Spark's own listing skips.
TREE_PATH = f"CASE WHEN p_partkey % 10 = 1 AND {R.VARIANT} NOT IN (4, 5) THEN concat('src/_in/', {R.path_sql()}) ELSE {R.path_sql()} END"


@query("scan_directory", f"""
SELECT {TREE_PATH} AS path, {LANGUAGE_SQL} AS language, md5(replace({R.raw_text_sql()}, concat(chr(13), chr(10)), chr(10))) AS digest
FROM part WHERE {KEPT} AND p_partkey % 6 IN (0, 3, 5)""")
def scan_directory(spark, sf_dir):
    """The corpus written as a tree of files, then scanned with ignore rules, hidden folders included."""
    root = shared_folder(spark, "tree")
    rendered = R.dealt(table(spark, sf_dir, "part")).select(F.expr(TREE_PATH).alias("path"), F.encode(F.expr(R.raw_text_joined_sql()), "UTF-8").alias("content"))
    rules = spark.createDataFrame([(".rules", "\n".join(R.IGNORE_RULES).encode())], "path string, content binary")
    uri = F.concat(F.lit(root if ":" in root.split("/")[0] else f"file:{root}"), F.lit("/"), "path").alias("uri")
    rendered.unionByName(rules).select(uri, "content").mapInPandas(_placed, "uri string").count()
    return scan_corpus(spark, root, ["python", "java", "cpp"], ".rules").select("path", "language", F.md5("text").alias("digest"))


@query("syntax_gate", f"""
SELECT {R.path_sql()} AS path, CASE WHEN {R.VARIANT} = 3 THEN 'unbalanced brackets' END AS reason
FROM part WHERE {KEPT}""")
def syntax_gate(spark, sf_dir):
    return syntax_health(corpus_files(spark, sf_dir)).select("path", "reason")


@query("skip_report", f"""
SELECT path, CASE WHEN reason = 'unbalanced brackets' THEN 'parse' ELSE 'scan' END AS stage, reason FROM (
  SELECT {R.path_sql()} AS path, CASE WHEN {R.VARIANT} = 4 THEN 'ignored' WHEN p_partkey % 7 = 3 THEN 'binary'
    WHEN p_partkey % 6 = 1 THEN 'language not selected' WHEN p_partkey % 11 = 5 THEN 'not utf-8'
    WHEN {R.VARIANT} = 3 THEN 'unbalanced brackets' END AS reason FROM part) WHERE reason IS NOT NULL""")
def skip_report(spark, sf_dir):
    languages = [lang for lang in R.LANGUAGES if lang != "rust"]
    return P.skipped(R.raw_corpus(spark, sf_dir), R.IGNORE_RULES, languages)


# ---- metrics and text helpers -----------------------------------------------

def _lines_sql(source: str, key: str) -> str:
    return f"""
SELECT {key}, cast(len(list_filter(lines, lambda x: x <> '' AND NOT regexp_matches(x, '^(#|//|/?[*])'))) as bigint) AS loc,
  cast(len(list_filter(lines, lambda x: regexp_matches(x, '^(#|//|/?[*])'))) as bigint) AS comment_lines
FROM (SELECT {key}, list_transform(string_split(text, chr(10)),
  lambda l: regexp_replace(l, '^{BLANK_RE2}+|{BLANK_RE2}+$', '', 'g')) AS lines FROM {source})"""


def _branches_sql(source: str, key: str) -> str:
    words = ", ".join(f"'{w}'" for w in X.BRANCH_WORDS)
    return f"""
SELECT {key}, cast(1 + len(list_filter(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+'), lambda w: w IN ({words})))
  + len(regexp_extract_all(regexp_replace(text, '[?]([\\p{{L}}\\p{{N}}_])', chr(1) || '\\1', 'g'), '[\\p{{L}}\\p{{N}}_]' || chr(1))) as bigint) AS complexity
FROM {source}"""


@query("line_metrics", _lines_sql("documents", "doc_id"))
def line_metrics(spark, sf_dir):
    return flat(texts(spark, sf_dir, "documents").select(
        "doc_id", X.loc(F.col("text")).alias("loc"), X.comment_lines(F.col("text")).alias("comment_lines")))


@query("line_metrics_turns", _lines_sql("conversations", "conv_id, turn"))
def line_metrics_turns(spark, sf_dir):
    return flat(texts(spark, sf_dir, "conversations").select(
        "conv_id", "turn", X.loc(F.col("text")).alias("loc"), X.comment_lines(F.col("text")).alias("comment_lines")))


@query("complexity", _branches_sql("documents", "doc_id"))
def complexity(spark, sf_dir):
    return flat(texts(spark, sf_dir, "documents").select("doc_id", X.complexity(F.col("text")).alias("complexity")))


@query("complexity_turns", _branches_sql("conversations", "conv_id, turn"))
def complexity_turns(spark, sf_dir):
    return flat(texts(spark, sf_dir, "conversations").select(
        "conv_id", "turn", X.complexity(F.col("text")).alias("complexity")))


@query("doc_clean_block", f"""
SELECT doc_id, nullif(array_to_string(list_filter(list_transform(string_split(text, chr(10)),
  lambda l: regexp_replace(l, '^{BLANK_RE2}+|{BLANK_RE2}+$', '', 'g')), lambda x: x <> ''), ' '), '') AS doc FROM documents""")
def doc_clean_block(spark, sf_dir):
    starred = F.concat(F.lit("/**\n * "), F.replace("text", F.lit("\n"), F.lit("\n * ")), F.lit("\n */"))
    return texts(spark, sf_dir, "documents").select("doc_id", X.clean_block_comment(starred).alias("doc"))


@query("doc_clean_line", """
SELECT p_partkey, CASE WHEN p_partkey % 4 = 3 THEN NULL WHEN p_partkey % 4 = 2 THEN concat('/ ', p_name) ELSE p_name END AS doc
FROM part""")
def doc_clean_line(spark, sf_dir):
    marker = F.expr("element_at(array('///', '//!', '////', '//'), cast(p_partkey % 4 as int) + 1)")
    comment = F.concat(marker, F.lit(" "), "p_name", F.lit(" \t"))
    return table(spark, sf_dir, "part").select("p_partkey", X.clean_line_comment(comment, "///", "//!").alias("doc"))


@query("strip_quotes", "SELECT p_partkey, p_name AS doc FROM part")
def strip_quotes(spark, sf_dir):
    quote = F.expr("element_at(array('\"\"\"', \"'''\", '\"', \"'\"), cast(p_partkey % 4 as int) + 1)")
    literal = F.concat(quote, F.lit("\n  "), "p_name", F.lit(" \n\t"), quote)
    return table(spark, sf_dir, "part").select("p_partkey", X.strip_quotes(literal).alias("doc"))


# ---- extraction, per language -----------------------------------------------

FUNCTION_COLUMNS = ("file_path", "name", "start_line", "end_line", "start_column", "end_column", "language",
                    "arguments", "loc", "comment_lines", "complexity")
VIEWS = {
    "functions": FUNCTION_COLUMNS,
    "docs": ("file_path", "name", "start_line", "docstring"),
    "scope": ("file_path", "name", "start_line", "scope", "function_type"),
    "modifiers": ("file_path", "name", "start_line", "modifiers"),
}


def _register_language(view: str, columns: tuple[str, ...], lang: str) -> None:
    @query(f"{view}_{lang}", expected(*columns, languages=(lang,)))
    def run(spark, sf_dir):
        return chunk_columns(spark, sf_dir, columns, [lang])


for _view, _columns in VIEWS.items():
    for _lang in R.LANGUAGES:
        _register_language(_view, _columns, _lang)


@query("functions_all", expected(*FUNCTION_COLUMNS, "docstring", "scope", "function_type", "modifiers"))
def functions_all(spark, sf_dir):
    return chunk_columns(spark, sf_dir, (*FUNCTION_COLUMNS, "docstring", "scope", "function_type", "modifiers"))


# Spans of the facts as text of the rendered file.  One fact follows a two-byte
# character on its line, so its character columns are one less than its byte columns.
CODE_SQL = f"""
SELECT file_path, name, start_line, start_column, substr(joined, c1 + 1, length(joined) - c1 - (length(lines[end_line]) - c2)) AS code
FROM (SELECT *, array_to_string(lines[start_line:end_line], chr(10)) AS joined,
    start_column - cast(name = 'run' as int) AS c1, end_column - cast(name = 'run' as int) AS c2
  FROM (SELECT f.*, string_split(replace(t.body, concat(chr(13), chr(10)), chr(10)), chr(10)) AS lines
    FROM ({expected("file_path", "name", "start_line", "end_line", "start_column", "end_column")}) f
    JOIN (SELECT {R.path_sql()} AS path, {R.raw_text_sql()} AS body FROM part) t ON t.path = f.file_path))"""


@query("chunk_code", f"SELECT file_path, name, start_line, md5(code) AS digest, cast(length(code) as bigint) AS chars FROM ({CODE_SQL})")
def chunk_code(spark, sf_dir):
    chunks = chunk_columns(spark, sf_dir, ("file_path", "name", "start_line", "code"))
    return chunks.select("file_path", "name", "start_line", F.md5("code").alias("digest"),
                         F.length("code").cast("bigint").alias("chars"))


# ---- enrichment -------------------------------------------------------------

def _register_column(key: str, column: str) -> None:
    columns = ("file_path", "name", "start_line", column)

    @query(key, expected(*columns))
    def run(spark, sf_dir):
        return chunk_columns(spark, sf_dir, columns)


for _key, _column in {"return_types": "return_type", "imports": "imports", "chunk_comments": "comments", "calls": "calls",
                      "types_used": "types_used", "attributes": "attributes"}.items():
    _register_column(_key, _column)


def _edges_sql() -> str:
    parts = []
    for i, lang in enumerate(R.LANGUAGES):
        for owner, base in R.EDGES[lang]:
            parts.append(f"SELECT {R.path_sql()} AS file_path, {R.text_sql(owner)} AS class_name, {R.text_sql(base)} AS base "
                         f"FROM part WHERE p_partkey % 6 = {i} AND {R.VARIANT} NOT IN (3, 4)")
    return " UNION ALL ".join(parts)


@query("class_edges", _edges_sql())
def class_edge_rows(spark, sf_dir):
    return class_edges(corpus_files(spark, sf_dir)).select("file_path", "class_name", "base")


CALLED_SQL = f"""
WITH chunks AS ({expected("file_path", "name", "start_line", "calls")}),
edges AS (SELECT unnest(string_split(calls, ',')) AS callee, name AS caller, file_path, start_line FROM chunks WHERE calls <> '')
SELECT callee, caller, file_path, start_line FROM edges WHERE callee IN (SELECT name FROM chunks)"""


def _call_chunks(spark, sf_dir):
    return stored(extract_functions(corpus_files(spark, sf_dir), columns=("file_path", "name", "start_line", "calls")), "chunks")


@query("called_by", CALLED_SQL)
def called_by(spark, sf_dir):
    return flat(enrich.called_by(_call_chunks(spark, sf_dir)))


@query("caller_counts", f"SELECT callee, count(*) AS callers FROM ({CALLED_SQL}) GROUP BY callee")
def caller_counts(spark, sf_dir):
    return enrich.caller_counts(enrich.called_by(_call_chunks(spark, sf_dir)))


CLASSES = {"python": ["Part«k»"], "rust": ["Part«k»"], "java": ["Part«k»", "Sized«k»"], "cpp": ["Part«k»"]}
CLASS_SQL = " UNION ALL ".join(
    f"SELECT {R.path_sql()} AS file_path, {R.text_sql(name)} AS name, 'class' AS function_type FROM part "
    f"WHERE p_partkey % 6 = {R.LANGUAGES.index(lang)} AND {R.VARIANT} NOT IN (3, 4)"
    for lang, names in CLASSES.items() for name in names)


@query("class_chunks", f"{expected('file_path', 'name', 'function_type')} UNION ALL {CLASS_SQL}")
def class_chunks(spark, sf_dir):
    return chunk_columns(spark, sf_dir, ("file_path", "name", "function_type"), include_classes=True)


def _keep_sql() -> str:
    fields = {"file_path": "path", "name": "name", "start_line": "start", "end_line": "end"}
    return R.facts_sql(fields).replace(f"{R.VARIANT} NOT IN (3, 4)", f"{R.VARIANT} <> 4")


@query("keep_incomplete", _keep_sql())
def keep_incomplete(spark, sf_dir):
    return chunk_columns(spark, sf_dir, ("file_path", "name", "start_line", "end_line"), on_error="keep")


@query("marked_functions", f"SELECT *, false AS incomplete FROM ({_keep_sql()})")
def marked_function_rows(spark, sf_dir):
    """Broken files of the corpus break after their last function, so each function is sound."""
    found = marked_functions(corpus_files(spark, sf_dir), columns=("file_path", "name", "start_line", "end_line"))
    return flat(found.drop("reason"))


@query("neighbour_context", f"""
SELECT file_path, name, start_line, md5(lag(code) OVER w) AS previous_digest, md5(lead(code) OVER w) AS next_digest
FROM ({CODE_SQL}) WINDOW w AS (PARTITION BY file_path ORDER BY start_line, start_column)""")
def neighbour_context(spark, sf_dir):
    chunks = extract_functions(corpus_files(spark, sf_dir), columns=("file_path", "name", "start_line", "start_column", "code"))
    found = enrich.with_neighbours(chunks)
    return flat(found.select("file_path", "name", "start_line", F.md5("previous_code").alias("previous_digest"),
                             F.md5("next_code").alias("next_digest")))


# ---- vectors ----------------------------------------------------------------

@query("embed_text", """
SELECT doc_id, md5(concat_ws(chr(10), nullif(source, 'src0'), text)) AS digest FROM documents""")
def embed_text(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents")
    return docs.select("doc_id", F.md5(enrich.embedding_text(F.nullif("source", F.lit("src0")), F.col("text"))).alias("digest"))


TOKENS_SQL = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"


@query("truncate_tokens", f"""
SELECT doc_id, cast(len(kept) as bigint) AS n_tokens, md5(array_to_string(kept, ' ')) AS digest
FROM (SELECT doc_id, {TOKENS_SQL}[1:256] AS kept FROM documents)""")
def truncate_tokens(spark, sf_dir):
    kept = texts(spark, sf_dir, "documents").select("doc_id", V.tokens(F.col("text"), 256).alias("kept"))
    return kept.select("doc_id", F.size("kept").cast("bigint").alias("n_tokens"),
                       F.md5(F.array_join("kept", " ")).alias("digest"))


@query("hash_embed", f"""
WITH tok AS (SELECT doc_id, unnest({TOKENS_SQL}[1:8192]) AS w FROM documents),
counts AS (SELECT doc_id, cast(('0x' || substr(md5(w), 1, 8)) as bigint) % 64 AS bucket, count(*) AS n FROM tok GROUP BY ALL),
norms AS (SELECT doc_id, sqrt(sum(n * n)) AS norm FROM counts GROUP BY doc_id)
SELECT doc_id, bucket, round(cast(cast(n / norm as float) as double), 5) AS value FROM counts JOIN norms USING (doc_id)""")
def hash_embed(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents").select("doc_id", "text")
    embedded = E.hash_embed(docs, "text", dimension=64)
    spread = embedded.select("doc_id", F.posexplode("embedding").alias("bucket", "value"))
    return spread.where("value > 0").select(
        "doc_id", F.col("bucket").cast("bigint").alias("bucket"), F.round(F.col("value").cast("double"), 5).alias("value"))


@query("mean_pool", """
SELECT label, pos, round(avg(v), 6) AS value FROM (
  SELECT label, unnest(range(len(embedding))) AS pos, cast(unnest(embedding) as double) AS v FROM embeddings)
GROUP BY label, pos""")
def mean_pool(spark, sf_dir):
    pooled = E.mean_pool(table(spark, sf_dir, "embeddings"), ["label"])
    return pooled.select("label", F.posexplode("embedding").alias("pos", "v")).select(
        "label", F.col("pos").cast("bigint").alias("pos"), F.round("v", 6).alias("value"))


@query("l2_normalize", """
SELECT vec_id, pos, round(v / norm, 6) AS value FROM (
  SELECT vec_id, unnest(range(len(embedding))) AS pos, cast(unnest(embedding) as double) AS v,
    sqrt(list_sum(list_transform(embedding, lambda x: cast(x as double) * cast(x as double)))) AS norm FROM embeddings)""")
def l2_normalize(spark, sf_dir):
    unit = table(spark, sf_dir, "embeddings").select("vec_id", V.l2_normalize(F.col("embedding")).alias("u"))
    return unit.select("vec_id", F.posexplode("u").alias("pos", "v")).select(
        "vec_id", F.col("pos").cast("bigint").alias("pos"), F.round("v", 6).alias("value"))


@query("dim_check", "SELECT vec_id, cast(len(embedding) as bigint) AS dimension FROM embeddings")
def dim_check(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.size(V.checked(F.col("embedding"), 64)).cast("bigint").alias("dimension"))


@query("cosine_topk_filtered", """
WITH flat AS (SELECT label, unnest(range(len(embedding))) AS pos, cast(unnest(embedding) as double) AS v FROM embeddings),
means AS (SELECT label, pos, avg(v) AS m FROM flat GROUP BY label, pos),
queries AS (SELECT label, list(m ORDER BY pos) AS q FROM means GROUP BY label),
scored AS (SELECT e.label, vec_id, list_cosine_similarity(cast(embedding as double[]), q) AS s
  FROM embeddings e JOIN queries USING (label)),
ranked AS (SELECT label, vec_id, s, row_number() OVER (PARTITION BY label ORDER BY s DESC, vec_id) AS rank FROM scored)
SELECT label, vec_id, round(s, 6) AS score, rank FROM ranked WHERE rank <= 10""")
def cosine_topk_filtered(spark, sf_dir):
    points = table(spark, sf_dir, "embeddings")
    centroids = E.mean_pool(points, ["label"]).withColumnRenamed("embedding", "query")
    top = E.nearest_by_payload(points, centroids, ["label"], 10)
    return top.select("label", "vec_id", F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank"))


AXIS = [1.0 if i % 2 else -0.5 for i in range(64)]


@query("nearest_points", f"""
SELECT vec_id, round(list_cosine_similarity(cast(embedding as double[]), {AXIS}::double[]), 6) AS score
FROM embeddings WHERE label <> 3 ORDER BY list_cosine_similarity(cast(embedding as double[]), {AXIS}::double[]) DESC, vec_id LIMIT 20""")
def nearest_points(spark, sf_dir):
    top = E.nearest(table(spark, sf_dir, "embeddings"), AXIS, 20, where=F.col("label") != 3)
    return top.select("vec_id", F.round("score", 6).alias("score"))


@query("nearest_many", """
WITH flat AS (SELECT vec_id % 100 AS g, label, unnest(range(len(embedding))) AS pos, cast(unnest(embedding) as double) AS v FROM embeddings),
q AS (SELECT g, list(m ORDER BY pos) AS q FROM (SELECT g, pos, avg(v) AS m FROM flat GROUP BY g, pos) GROUP BY g),
s AS (SELECT g, vec_id, round(list_cosine_similarity(cast(embedding as double[]), q), 9) AS s
  FROM embeddings JOIN q ON label >= g % 7 AND label < g % 7 + 4 WHERE vec_id % 100 <> 13),
r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY s DESC, vec_id) AS rank FROM s)
SELECT g AS query_id, rank::BIGINT AS rank, vec_id AS id, round(s, 6) AS score FROM r WHERE rank <= 10""")
def nearest_many(spark, sf_dir):
    """A hundred queries, each with a range of labels of its own."""
    points = table(spark, sf_dir, "embeddings")
    asked = E.mean_pool(points.withColumn("query_id", F.col("vec_id") % 100), ["query_id"]).withColumnRenamed("embedding", "query")
    asked = asked.withColumn("low", F.col("query_id") % 7).withColumn("below", F.col("query_id") % 7 + 4)
    top = E.nearest_many(points, asked, 10, [("label", ">=", "low"), ("label", "<", "below")], where=F.col("vec_id") % 100 != 13)
    return top.select("query_id", F.col("rank").cast("bigint").alias("rank"), "id", F.round("score", 6).alias("score"))


# ---- points and collections -------------------------------------------------

ID_COLUMNS = ("file_path", "name", "start_line", "start_column")
IDS_SQL = f"""
SELECT file_path, name, start_line, 999 + row_number() OVER (
  ORDER BY substr(md5(file_path), 1, 4), file_path, start_line, start_column) AS id FROM ({expected(*ID_COLUMNS)})"""


@query("point_ids", IDS_SQL)
def point_ids(spark, sf_dir):
    chunks = stored(extract_functions(corpus_files(spark, sf_dir), columns=ID_COLUMNS), "chunks")
    return flat(C.point_ids(chunks, 1000).select("file_path", "name", "start_line", "id"))


PAYLOAD_COLUMNS = ("file_path", "name", "start_line", "end_line", "language", "function_type", "arguments", "return_type",
                   "docstring", "modifiers", "scope", "imports", "calls", "complexity", "loc", "comment_lines")


@query("payload", f"""
SELECT p.* EXCLUDE (name), p.name AS function_name, md5(c.code) AS code FROM ({expected(*PAYLOAD_COLUMNS, "start_column")}) p
JOIN ({CODE_SQL}) c USING (file_path, start_line, start_column)""".replace("p.* EXCLUDE (name)", "p.* EXCLUDE (name, start_column)"))
def payload(spark, sf_dir):
    chunks = extract_functions(corpus_files(spark, sf_dir))
    return flat(chunks.select(C.payload(chunks).alias("p")).select("p.*").withColumn("code", F.md5("code")))


def _part_rows(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").cast("bigint").alias("size"))


@query("upsert", """
SELECT p_partkey AS id, p_name AS name, cast(p_size as bigint) AS size FROM part WHERE p_size > 10
UNION ALL SELECT p_partkey, upper(p_name), cast(0 as bigint) FROM part WHERE p_size <= 10
UNION ALL SELECT -p_partkey - 1, p_name, cast(p_size as bigint) FROM part WHERE p_size > 40""")
def upsert(spark, sf_dir):
    rows = _part_rows(spark, sf_dir)
    updates = rows.where("size <= 10").select("id", F.upper("name").alias("name"), F.lit(0).cast("bigint").alias("size"))
    inserts = rows.where("size > 40").select((-F.col("id") - 1).alias("id"), "name", "size")
    return C.upsert(rows, updates.unionByName(inserts))


@query("upsert_snapshot", """
SELECT p_partkey AS id, p_name AS name, cast(p_size as bigint) AS size, p_partkey % 3 = 0 AND p_partkey <= 40 AS fresh
FROM part WHERE p_partkey NOT BETWEEN 41 AND 60
UNION ALL SELECT p_partkey + 10000000, upper(p_name), cast(0 as bigint), true FROM part WHERE p_size = 7""")
def upsert_snapshot(spark, sf_dir):
    """A collection in versions: an upsert of few keys, new keys, and a deletion; the fresh rows are told by their mark."""
    kept = Snapshots(spark, shared_folder(spark, "snapshots"))
    rows = _part_rows(spark, sf_dir).withColumn("fresh", F.lit(False))
    kept.write(rows, files=16)
    changed = rows.where("id % 3 = 0 AND id <= 40").withColumn("fresh", F.lit(True))
    new = rows.where("size = 7").select((F.col("id") + 10_000_000).alias("id"), F.upper("name").alias("name"), F.lit(0).cast("bigint").alias("size"),
                                        F.lit(True).alias("fresh"))
    kept.upsert(changed.unionByName(changed).unionByName(new))
    kept.replace(rows.where("id BETWEEN 41 AND 60"), rows.limit(0))
    return flat(kept.read().select("id", "name", "size", "fresh"))


@query("collection_roundtrip", f"""
SELECT file_path, name, start_line, language FROM ({expected("file_path", "name", "start_line", "language")})""")
def collection_roundtrip(spark, sf_dir):
    chunks = extract_functions(corpus_files(spark, sf_dir), columns=("file_path", "name", "start_line", "language"))
    place = C.write_collection(chunks, shared_folder(spark, "collections"), C.collection_name("/data/parts"))
    return flat(C.read_collection(spark, place)).select("file_path", "name", "start_line", "language")


@query("collection_name", f"SELECT {R.path_sql()} AS file_path, 'parts' AS collection FROM part WHERE {KEPT}")
def collection_names(spark, sf_dir):
    return corpus_files(spark, sf_dir).select(
        F.col("path").alias("file_path"), F.lit(C.collection_name("/data/parts/")).alias("collection"))


def _repo_chunks(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.expr(R.path_sql()).alias("path"), (F.col("p_size") % 25).alias("repo_key"))
    chunks = extract_functions(corpus_files(spark, sf_dir), columns=("file_path", "name", "start_line", "language"))
    return chunks.join(part, chunks.file_path == part.path).drop("path")


def _repo_facts(*columns: str) -> str:
    return R.facts_sql({**{c: {"file_path": "path", "start_line": "start"}.get(c, c) for c in columns}, "repo_key": "=p_size % 25"})


@query("multi_repo", f"""
SELECT n_name AS repo, language, count(*) AS functions FROM ({_repo_facts("language")}) JOIN nation ON n_nationkey = repo_key
GROUP BY n_name, language""")
def multi_repo(spark, sf_dir):
    repos = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("repo_key"), F.col("n_name").alias("repo"))
    points = C.with_repository(_repo_chunks(spark, sf_dir), repos, "repo_key")
    place = C.write_collection(points, shared_folder(spark, "repos"), "points", ("repo", "language"))
    return C.read_collection(spark, place).groupBy("repo", "language").agg(F.count("*").alias("functions"))


@query("repo_metadata", f"""
SELECT file_path, name, start_line, n_name AS repo_name, '1.0' AS version, md5(n_name) AS commit_hash
FROM ({_repo_facts("file_path", "name", "start_line")}) JOIN nation ON n_nationkey = repo_key""")
def repo_metadata(spark, sf_dir):
    repos = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("repo_key"), F.col("n_name").alias("repo_name"), F.md5("n_name").alias("commit_hash"))
    rows = C.with_repository(_repo_chunks(spark, sf_dir), repos, "repo_key", version="1.0")
    return flat(rows.select("file_path", "name", "start_line", "repo_name", "version", "commit_hash"))


# ---- reports and incremental runs -------------------------------------------

@query("run_summary", f"""
WITH f AS (SELECT {LANGUAGE_SQL} AS language, count(*) AS files FROM part WHERE {KEPT} GROUP BY 1),
c AS (SELECT language, count(*) AS functions, sum(loc) AS loc FROM ({expected("language", "loc")}) GROUP BY 1)
SELECT language, cast(sum(files) as bigint) AS files, cast(sum(functions) as bigint) AS functions, cast(sum(loc) as bigint) AS loc
FROM f JOIN c USING (language) GROUP BY ROLLUP (language)""")
def run_summary(spark, sf_dir):
    files = corpus_files(spark, sf_dir)
    return C.run_summary(files, extract_functions(files, columns=("language", "loc")))


@query("metric_stats", f"""
SELECT language, count(*) AS functions,
  round(avg(loc), 6) AS avg_loc, max(loc) AS max_loc, quantile_cont(loc, 0.5) AS median_loc,
  round(avg(comment_lines), 6) AS avg_comment_lines, max(comment_lines) AS max_comment_lines,
  quantile_cont(comment_lines, 0.5) AS median_comment_lines,
  round(avg(complexity), 6) AS avg_complexity, max(complexity) AS max_complexity, quantile_cont(complexity, 0.5) AS median_complexity
FROM ({expected("language", "loc", "comment_lines", "complexity")}) GROUP BY language""")
def metric_stats(spark, sf_dir):
    chunks = extract_functions(corpus_files(spark, sf_dir), columns=("language", "loc", "comment_lines", "complexity"))
    stats = C.metric_stats(chunks)
    rounded = [F.round(c, 6).alias(c) if c.startswith("avg_") else F.col(c) for c in stats.columns]
    return flat(stats.select(*rounded))


def _changes(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("path"), "text", "lang", "source")
    current = D.manifest(docs, content="text")
    rewritten = F.when(F.col("lang") == "en", F.upper("text")).otherwise(F.col("text"))
    known = D.manifest(docs.where("source <> 'src0'").select("path", rewritten.alias("text")), content="text")
    gone = D.manifest(docs.where("lang = 'de'").select(F.concat(F.lit("old/"), "path").alias("path"), "text"), content="text")
    return D.changed_files(current, known.unionByName(gone))


@query("changed_files", """
SELECT 'doc/' || doc_id AS path, CASE WHEN source = 'src0' THEN 'new' ELSE 'changed' END AS change FROM documents
WHERE source = 'src0' OR (lang = 'en' AND upper(text) <> text)
UNION ALL SELECT 'old/doc/' || doc_id, 'deleted' FROM documents WHERE lang = 'de'""")
def changed_files(spark, sf_dir):
    return _changes(spark, sf_dir)


@query("stream_ingest", f"SELECT file_path, name, start_line, end_line FROM ({expected('file_path', 'name', 'start_line', 'end_line')})")
def stream_ingest(spark, sf_dir):
    schema = table(spark, sf_dir, "part").schema
    parts = spark.readStream.schema(schema).option("pathGlobFilter", "part.parquet").parquet(sf_dir)
    rendered = R.dealt(parts).select(F.expr(R.path_sql()).alias("path"), F.expr(R.raw_text_joined_sql()).alias("text"))
    files = P.scan_filter(rendered, R.IGNORE_RULES).select("path", "language", X.normalize_newlines(F.col("text")).alias("text"))
    sink = shared_folder(spark, "stream")
    ingest(files, f"{sink}/chunks", f"{sink}/checkpoint").awaitTermination()
    return flat(spark.read.parquet(f"{sink}/chunks").select("file_path", "name", "start_line", "end_line"))


@query("corpus_sync", f"SELECT file_path, name, start_line, end_line FROM ({expected('file_path', 'name', 'start_line', 'end_line')})")
def corpus_sync(spark, sf_dir):
    """A collection kept in step: of its first files some are rewritten, some go, and others come."""
    files = stored(corpus_files(spark, sf_dir), "corpus")  # else rendered anew by each of six branches
    lot = F.pmod(F.crc32("path"), F.lit(7))
    early = files.where(lot != 0).withColumn("text", F.when(lot == 1, F.concat(F.lit("\n"), "text")).otherwise(F.col("text")))
    gone = files.where(lot == 2).withColumn("path", F.concat(F.lit("old/"), "path"))
    place = shared_folder(spark, "sync")
    sync(spark, early.unionByName(gone), place)
    sync(spark, files, place)
    return flat(chunks_of(spark, place).read().select("file_path", "name", "start_line", "end_line"))


@query("chunk_report", f"""
SELECT language, count(*) AS functions, cast(sum(loc) as bigint) AS loc, cast(sum(comment_lines) as bigint) AS comment_lines,
  cast(sum(complexity) as bigint) AS complexity, cast(sum(end_line - start_line + 1) as bigint) AS lines
FROM ({expected("language", "loc", "comment_lines", "complexity", "start_line", "end_line")}) GROUP BY language""")
def chunk_report(spark, sf_dir):
    """Flagship: scan, cut, pair, scope, measure and summarise the whole corpus."""
    chunks = extract_functions(corpus_files(spark, sf_dir),
                               columns=("language", "loc", "comment_lines", "complexity", "start_line", "end_line"))
    return chunks.groupBy("language").agg(
        F.count("*").alias("functions"), F.sum("loc").alias("loc"), F.sum("comment_lines").alias("comment_lines"),
        F.sum("complexity").alias("complexity"), F.sum(F.expr("end_line - start_line + 1")).cast("bigint").alias("lines"))
