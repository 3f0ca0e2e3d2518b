"""The operators over their whole tables, each with its oracle SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sourceloom.llm.decontaminate import contained_items
from sourceloom.llm.fingerprints import fingerprint_edits, hashes_of, likeness
from sourceloom.llm.language_id import identify
from sourceloom.llm.language_model import hmm_scores
from sourceloom.llm.lexical_search import ranked_search
from sourceloom.llm.licenses import license_scan
from sourceloom.llm.line_dedup import dedup_lines
from sourceloom.llm.ngram_join import ngram_components
from sourceloom.llm.quality import quality_scores
from sourceloom.llm.repeats import remove_repeats
from sourceloom.llm.source_mix import mix_sources
from sourceloom.llm.token_counts import token_counts
from sourceloom.llm.whitening import whiten

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


def _words_sql(text: str) -> str:
    plain = rf"trim(regexp_replace(lower(coalesce({text}, '')), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
    return f"CASE WHEN {plain} = '' THEN [] ELSE string_split({plain}, ' ') END"


def _shingles_sql(table_name: str, key: str, k: int = 5) -> str:
    run = " || ' ' || ".join(f"w[i + {j}]" for j in range(k))
    return f"""(
  SELECT DISTINCT {key}, unnest(CASE WHEN len(w) >= {k} THEN list_transform(range(1, len(w) - {k - 2}), lambda i: {run})
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM (SELECT {key}, {_words_sql('text')} AS w FROM {table_name}))"""


@query("op2_decontaminate", f"""
WITH i AS {_shingles_sql('benchmark', 'item_id')}, d AS {_shingles_sql('documents', 'doc_id')},
n AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY item_id)
SELECT doc_id, item_id, any_value(n_item) AS n_item, count(*) AS n_shared, count(*) / any_value(n_item) AS containment
FROM d JOIN i USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id HAVING count(*) >= 0.8 * any_value(n_item)""")
def op2_decontaminate(spark, sf_dir):
    """Documents that hold a benchmark item, with the shares of its shingles."""
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_mix_sources", """
WITH s AS (SELECT source, sum(length(coalesce(text, '')))::DOUBLE AS size FROM documents GROUP BY source),
w AS (SELECT *, CASE WHEN size > 0 THEN sqrt(size) ELSE 0 END AS weight FROM s),
r AS (SELECT source, CASE WHEN weight > 0 THEN weight / sum(weight) OVER () * sum(size) OVER () / size ELSE 0 END AS rate FROM w),
steps AS (SELECT source, list(total ORDER BY k) AS steps FROM (
  SELECT source, k, sum(CASE WHEN k = 0 THEN exp(-rate) ELSE exp(k * ln(rate) - rate - lgamma(k + 1)) END)
    OVER (PARTITION BY source ORDER BY k) AS total
  FROM (SELECT source, rate, unnest(range(0, 32 + ceil(rate + 14 * sqrt(rate))::BIGINT)) AS k FROM r WHERE rate > 0)) GROUP BY source),
c AS (SELECT d.*, rate, len(list_filter(steps, lambda x: x <= ('0x' || substr(md5('mix|' || coalesce(d.doc_id::VARCHAR, 'null|' || md5(coalesce(d.text, '')))), 1, 13))::BIGINT / 4503599627370496.0)) AS copies
  FROM documents d JOIN r ON d.source IS NOT DISTINCT FROM r.source JOIN steps t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, unnest(range(1, copies + 1)) AS copy FROM c)
SELECT doc_id, text, lang, source, n_chars, round(rate, 9) AS rate, copies, copy,
  md5('mix|order|' || coalesce(doc_id::VARCHAR, 'null|' || md5(coalesce(text, ''))) || '|' || copy) AS shuffle_key FROM e""")
def op5_mix_sources(spark, sf_dir):
    """The corpus repeated towards square-root source weights, shuffled."""
    return mix_sources(table(spark, sf_dir, "documents")).withColumn("rate", F.round("rate", 9))


@query("op7_token_counts")
def op7_token_counts(spark, sf_dir):
    """Tokens of every text under a byte-level vocabulary."""
    import public_tokenizers  # only this query needs it

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


_STRIP = r"'^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$'"


@query("op10_line_dedup", f"""
WITH l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)),
k AS (SELECT *, translate(regexp_replace(line, {_STRIP}, '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, c.key IS NOT NULL AND doc_id <> keeper AS dropped FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256 FROM m GROUP BY doc_id""")
def op10_line_dedup(spark, sf_dir):
    """Every document without the long lines that five documents share."""
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_suffix_dedup")
def op3_suffix_dedup(spark, sf_dir):
    """Every document without the bytes of repeated 200-byte strings."""
    kept = remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op8_fingerprints")
def op8_fingerprints(spark, sf_dir):
    """Winnowed fingerprints of every document and its edited text, and how near they are."""
    made = fingerprint_edits(table(spark, sf_dir, "documents"))
    made = made.select("doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"),
                       *(hashes_of(F.col(c)).alias(c) for c in ("own", "edit", "following")))
    text = lambda c: F.array_join(F.transform(F.col(c), lambda h: F.lower(F.hex(h))), " ")
    return made.select("doc_id", "n_chars", "edited_sha256", text("own").alias("fingerprint"), text("edit").alias("edited_fingerprint"),
                       likeness(F.col("own"), F.col("edit")).alias("near_edited"), likeness(F.col("own"), F.col("following")).alias("near_next"))


@query("op9_ngram_join")
def op9_ngram_join(spark, sf_dir):
    """Components of documents whose 4-word shingle sets are alike by 85 percent."""
    return ngram_components(table(spark, sf_dir, "documents"))


@query("op6_language_id")
def op6_language_id(spark, sf_dir):
    """Predicted language of every whole text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs).select("doc_id", "held_out", "lang_pred", "score")


@query("op1_license_scan")
def op1_license_scan(spark, sf_dir):
    """License notices in every whole text, by alignment coverage."""
    return license_scan(table(spark, sf_dir, "documents"))


@query("op4_hmm_scores")
def op4_hmm_scores(spark, sf_dir):
    """Log probability of every whole text under a hidden Markov model of the training texts."""
    return hmm_scores(table(spark, sf_dir, "documents"))


@query("op11_whitening")
def op11_whitening(spark, sf_dir):
    """Every usable vector on the eight leading components, whitened."""
    return whiten(table(spark, sf_dir, "embeddings"))


@query("op12_quality")
def op12_quality(spark, sf_dir):
    """Quality of every whole text, learnt from the labels."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _search_terms_sql(table_name: str, key: str) -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""(SELECT row_number() OVER () AS r, {key}, regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM {table_name})"""


@query("op13_lexical_search", f"""
WITH d AS MATERIALIZED {_search_terms_sql('documents', 'doc_id')},
n AS (SELECT r, doc_id, len(ts)::BIGINT AS n FROM d WHERE len(ts) > 0),
g AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM n),
p AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS t FROM d) GROUP BY r, t),
f AS (SELECT t, count(*)::BIGINT AS df FROM p GROUP BY t),
i AS (SELECT item_id, any_value(ts) AS ts, min(r) AS r FROM {_search_terms_sql('benchmark', 'item_id')} GROUP BY item_id, ts),
q AS (SELECT r AS i, item_id, t, count(*)::BIGINT AS q FROM (SELECT r, item_id, unnest(ts) AS t FROM i) GROUP BY ALL),
w AS (SELECT i, item_id, t, q * floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w FROM q JOIN f USING (t), g),
s AS (SELECT i, item_id, r, any_value(doc_id) AS doc_id,
  sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms))))::BIGINT AS score
  FROM w JOIN p USING (t) JOIN n USING (r), g GROUP BY i, item_id, r),
o AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM o WHERE rank <= 10""")
def op13_lexical_search(spark, sf_dir):
    """The ten best documents for every benchmark item."""
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
