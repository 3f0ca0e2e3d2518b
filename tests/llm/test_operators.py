"""Each operator against brute force or its oracle, and on nulls, empty texts, repeated rows, empty tables and clashing names."""

import collections
import hashlib
import math
import re
import zlib

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from sourceloom.llm import licenses
from sourceloom.llm.components import components
from sourceloom.llm.decontaminate import contained_items
from sourceloom.llm.fingerprints import fingerprint_edits, hashes_of, places, winnowed
from sourceloom.llm.language_id import identify
from sourceloom.llm.language_model import hmm_scores
from sourceloom.llm.licenses import license_scan
from sourceloom.llm.line_dedup import LineRuns, dedup_lines
from sourceloom.llm.ngram_join import ngram_components
from sourceloom.llm.queries import ORACLES, QUERIES
from sourceloom.llm.repeats import remove_repeats
from sourceloom.llm.source_mix import mix_sources
from sourceloom.llm.token_counts import token_counts

BLOCK = "the quick brown fox jumps over the lazy dog and runs far away from here to there in the night "
ODD = [(1, None, None, None), (2, "", "en", "a"), (3, " \t\n", "en", None), (None, "one two", None, "a"), (4, "ümlaut ß 日本語 \U0001F600 x", "de", "b"),
       (5, BLOCK * 8, "en", "a"), (5, BLOCK * 8, "en", "a"), (6, "word " * 30_000, "en", "b"), (7, "....", "fr", "b")]


def frame(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    # Columns of names that operators use for their own.
    return docs.withColumn("n_chars", F.length("text").cast("bigint")).withColumn("key", F.lit(1)).withColumn("id", F.lit(2)).withColumn("h", F.lit(3))


@pytest.fixture(scope="module")
def texts(data):
    return dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{data}/documents.parquet'").fetchall())


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def rows_of(frame):
    plain = lambda x: round(x, 9) if isinstance(x, float) else (x.item() if hasattr(x, "item") else x)
    frame = frame[sorted(frame.columns)].astype(object).where(lambda f: f.notna(), None)
    return sorted(tuple(repr(plain(x)) for x in row) for row in frame.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, data, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    got = QUERIES[name](spark, data).toPandas()
    assert len(got) and rows_of(got) == rows_of(con.sql(ORACLES[name]).df())


def test_repeats_brute_force(spark, data, texts):
    count = collections.Counter(b[i:i + 200] for b in map(str.encode, texts.values()) for i in range(len(b) - 199))
    for r in QUERIES["op3_suffix_dedup"](spark, data).collect():
        b = texts[r.doc_id].encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if count[b[i:i + 200]] > 1:
                gone[i:i + 200] = b"\1" * 200
        kept = hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), kept)


def test_ngram_join_brute_force(spark, data, texts):
    sets = {i: {tuple(w[j:j + 4]) for j in range(max(len(w) - 3, 1))} if (w := words(t)) else set() for i, t in texts.items()}
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op9_ngram_join"](spark, data).collect()}
    assert got == {i: (len(sets[i]), find(i)) for i in ids}


def test_ngram_join_long_lists_keep_chains(spark):
    """A chain whose neighbours are linked but whose ends are not, in lists long enough for hubs."""
    base = [f"w{i}" for i in range(400)]
    docs = [(n, " ".join(base[12 * n:12 * n + 200]), "en", "a") for n in range(14)]
    got = {r.component_id for r in ngram_components(frame(spark, docs)).collect()}
    assert got == {0}


def test_ngram_join_moves_postings_and_segments_once(spark, tmp_path, monkeypatch):
    """All postings are dealt once, and segments once for both sides of a pair; repeated rows and null ids count once."""
    import re

    from sourceloom.llm import ngram_join as N

    plans = {}

    def kept(df, purpose, store=N.store):
        plans.setdefault(purpose, df._jdf.queryExecution().executedPlan().toString())
        return store(df, purpose)

    monkeypatch.setattr(N, "store", kept)
    words = [f"w{i}" for i in range(300)]
    docs = [(10 * n, " ".join(words[30 * n + i] for i in range(60)), "en", "a") for n in range(8)]
    docs += [(d + 1, t + " end", l, s) for d, t, l, s in docs]
    got = {r.doc_id: r.component_id for r in ngram_components(frame(spark, docs)).collect()}
    assert got == {d: d - d % 10 for d, *_ in docs}
    assert not re.search(r"keys=\[id#\w+, fragment#", plans["ngram-segments"]) and "Window" in plans["ngram-shared"]
    dealt = re.findall(r"Exchange hashpartitioning\((\w+)#\w+, (\w+)#", plans["ngram-links"])
    assert {("a", "fragment"), ("b", "fragment")} <= set(dealt)
    odd = docs + docs[:2] + [(None, docs[0][1] + " close", "en", "a")] * 2
    rows = [(r.doc_id, r.component_id) for r in ngram_components(frame(spark, odd)).collect()]
    assert sorted(rows, key=str) == sorted([(d, d - d % 10) for d, *_ in docs + docs[:2]] + [(None, 0)] * 2, key=str)


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(40, 30), (31, 40)], "u bigint, v bigint")
    got = {r.id: r.label for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(21)}, 30: 30, 31: 30, 40: 30}


def test_token_counts_match_library(spark, data, texts):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    more = ["a  b\n\n c\t d", "<|endoftext|>x<|endoftext|>", "it's we'll  \n", " x 　y", "a" * 5000, "日本語 \U0001F600", " ", "\x1c \x1d", ""]
    docs = [(i, t, None, None) for i, t in enumerate([*texts.values(), *more])]
    for r in token_counts(frame(spark, docs), path, keep=("doc_id", "text")).collect():
        assert r.n_tokens == len(library.encode(r.text, add_special_tokens=False).ids), r.text[:50]


def test_hmm_base_and_probability(spark, data, texts):
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    count = collections.Counter(w for i, t in texts.items() if not out[i] for w in [*words(t), None])
    n, v = sum(count.values()), len(count)
    rows = QUERIES["op4_hmm_scores"](spark, data).collect()
    for r in rows:
        tokens = [*words(texts[r.doc_id]), None]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[r.doc_id], len(tokens), sum(count[w] > 0 for w in tokens), n)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens), rel_tol=1e-9)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_id_held_out(spark, data):
    label = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{data}/documents.parquet'").fetchall())
    rows = [r for r in QUERIES["op6_language_id"](spark, data).collect() if r.held_out]
    assert rows and sum(r.lang_pred == label[r.doc_id] for r in rows) >= 0.95 * len(rows)


def test_winnowing(spark, texts):
    ids = sorted(texts)
    edits = {a: texts[a][:len(texts[a]) - len(texts[a]) // 4] + texts[b][:len(texts[a]) // 4] for a, b in zip(ids, ids[1:] + ids[:1])}
    docs = frame(spark, [(i, t, None, None) for i, t in texts.items()])
    direct = winnowed(spark.createDataFrame(list(edits.items()), "doc_id bigint, text string"), "text", "own")
    want = {r.doc_id: r.own for r in direct.select("doc_id", "own").collect()}
    for r in fingerprint_edits(docs).select("doc_id", "edited", "edit", "own", places(F.col("own")).alias("at"), hashes_of(F.col("own")).alias("h")).collect():
        assert r.edited == edits[r.doc_id] and r.edit == want[r.doc_id]
        if len(texts[r.doc_id]) >= 47:  # every window of 32 grams has a selection
            assert r.at[0] < 32 and all(0 < b - a <= 32 for a, b in zip(r.at, r.at[1:])) and r.at[-1] >= len(texts[r.doc_id]) - 47


def test_patience_alignment():
    a, b = "x the mit license y the end".split(), "the mit free license the end".split()
    pairs = licenses.align(a, b)
    assert all(a[i] == b[j] for i, j in pairs) and [b[j] for _, j in pairs] == ["the", "mit", "license", "the", "end"]


def test_licenses_in_long_texts(spark):
    notice = licenses.TEMPLATES["GPL-3.0 notice"]
    docs = [(1, "word the under " * 5000 + notice + " of version work" * 5000, None, None), (2, "this is licensed work of the public", None, None),
            (3, f"{notice} {notice}", None, None)]
    got = {(r.doc_id, r.license): r for r in license_scan(frame(spark, docs)).collect()}
    assert set(got) == {(1, "GPL-3.0 notice"), (3, "GPL-3.0 notice")}
    assert got[1, "GPL-3.0 notice"].first_word == 15000 and got[3, "GPL-3.0 notice"].n_places == 2


def test_licenses_with_a_word_edited_out(spark):
    """Each template word replaced in turn, in a text that holds the lost word once elsewhere and the others twice more."""
    docs, want = [], {}
    for name, text in licenses.TEMPLATES.items():
        ws = licenses.words_of(text)
        for i, w in enumerate(ws):
            if len(ws) - 1 < 0.85 * len(ws):
                continue
            edited = ws[:i] + ["edited"] + ws[i + 1:]
            others = [f" {x} " + "far " * 3 * len(ws) for x in 2 * sorted(set(ws) - {w})]
            before = licenses.words_of(w + " far" * 3 * len(ws) + "".join(others))
            docs.append((len(docs), " ".join(before + edited + ["far"] * 100), None, None))
            pairs = licenses.align(edited, ws)
            want[len(docs) - 1, name] = (len(pairs), len(before) + pairs[0][0], len(before) + pairs[-1][0])
    got = {(r.doc_id, r.license): (r.n_matched, r.first_word, r.last_word) for r in license_scan(frame(spark, docs)).collect()}
    assert len(want) > 100 and {k: got.get(k) for k in want} == want


def test_line_runs_compact(spark):
    runs = LineRuns(fanout=2)
    for doc in range(5, 0, -1):
        runs.add(spark.createDataFrame([(7, 7, doc), (doc, 0, doc)], "k1 bigint, k2 bigint, doc bigint"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert {(r.k1, r.n_docs, r.keeper) for r in runs.keys().collect()} == {(7, 5, 5), *((d, 1, d) for d in range(1, 6))}


ODD_RUNS = {
    "op1": lambda d: license_scan(d), "op2": lambda d: contained_items(d, d.select(F.col("doc_id").alias("item_id"), "text")),
    "op3": lambda d: remove_repeats(d), "op4": lambda d: hmm_scores(d), "op5": lambda d: mix_sources(d), "op6": lambda d: identify(d),
    "op7": lambda d: token_counts(d, public_tokenizers.path("byte_bpe_50k.json")), "op8": lambda d: fingerprint_edits(d),
    "op9": lambda d: ngram_components(d), "op10": lambda d: dedup_lines(d),
}


@pytest.mark.parametrize("name", list(ODD_RUNS))
def test_odd_rows_and_empty_tables(spark, name):
    got = ODD_RUNS[name](frame(spark, ODD)).collect()
    if name not in ("op1", "op2", "op5"):
        assert len(got) == len(ODD)
    assert ODD_RUNS[name](frame(spark, ODD).limit(0)).count() == 0


CLASHING = ["rate", "Rate", "copies", "copy", "shuffle_key", "_steps", "_source", "_u", "held_out", "lang_pred", "score", "_text", "kept", "n_lines",
            "n_dropped", "_drops", "_id", "_lines", "_kept", "in_0", "in_1"]


@pytest.mark.parametrize("name, new", [("op5", ["rate", "copies", "copy", "shuffle_key"]), ("op6", ["held_out", "lang_pred", "score"]),
                                       ("op10", ["kept", "n_lines", "n_dropped"])])
def test_clashing_names(spark, name, new):
    """Columns of any name pass through; those named like an output give way to it, and values are those without them."""
    plain = frame(spark, ODD)
    rows = spark.createDataFrame([(*r, *(f"{c}!" for c in CLASHING)) for r in ODD],
                                 "doc_id bigint, text string, lang string, source string, " + ", ".join(f"`c{i}` string" for i in range(len(CLASHING))))
    got = ODD_RUNS[name](rows.toDF("doc_id", "text", "lang", "source", *CLASHING))
    through = [c for c in CLASHING if c.lower() not in new]
    assert got.columns == ["doc_id", "text", "lang", "source", *through, *new]
    values = [tuple(r) for r in got.collect()]
    n = 4 + len(through)
    assert values and all(v[4:n] == tuple(f"{c}!" for c in through) for v in values)
    want = ODD_RUNS[name](plain).select("doc_id", "text", *new).collect()
    assert sorted(repr((*v[:2], *v[n:])) for v in values) == sorted(repr(tuple(r)) for r in want)


def test_rows_without_id_draw_each(spark):
    docs = [(None, f"text number {i} of {i % 2}", None, "ab"[i % 2]) for i in range(400)] + [(1, "a long text " * 2000, None, "c")]
    kept = [r for r in mix_sources(frame(spark, docs)).collect() if r.doc_id is None]
    assert len({r.text for r in kept}) > 300 and len({r.copies for r in kept}) > 3


@pytest.mark.parametrize("n", [5, 6, 8])
def test_short_items_in_long_documents(spark, n):
    items = [(i, " ".join(f"i{i}x{j}" for j in range(n))) for i in range(300)]
    texts = [(i, " ".join([f"a{i}y{j}" for j in range(700)] + [t] + [f"b{i}y{j}" for j in range(700)]), None, None) for i, t in items]
    found = contained_items(frame(spark, texts), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert all(r.doc_id == r.item_id for r in found) and len(found) >= 299


def test_language_fit_reads_beyond_heads(spark):
    head = "same words stand here at the head of all " * 70
    bodies = {"x": "lorem ipsum dolor amet sit vel magna " * 100, "y": "quick brown foxes jump high over dogs " * 100}
    docs = [(i, head + bodies["xy"[i % 2]], "xy"[i % 2], None) for i in range(200)]
    rows = identify(frame(spark, docs)).collect()
    assert sum(r.lang_pred == r.lang for r in rows) > 0.9 * len(rows)


def test_pipeline_rows_without_own_id(spark, data):
    """Copies and leaks are decided by row: null and repeated ids neither save nor doom another row."""
    import corpus_pipeline

    item = duckdb.sql(f"SELECT text FROM '{data}/benchmark.parquet' ORDER BY item_id LIMIT 1").fetchall()[0][0]
    rows = [(None, BLOCK * 4, "en", "a"), (None, BLOCK * 4, "en", "a"), (9, BLOCK * 4, "en", "a"), (3, "a clean text of its own words", "en", "a"),
            (3, "a clean text of its own words", "en", "a"), (3, "quite another one under the same number", "en", "a"), (None, f"before {item} after", "en", "a"),
            (3, f"some words {item} more words", "en", "b"), (None, None, None, None)]
    docs = frame(spark, rows).select(*corpus_pipeline.COLUMNS)
    kept = corpus_pipeline.drop_near_copies(spark, docs, data)
    texts = collections.Counter((r.doc_id, r.text) for r in kept.collect())
    assert texts[9, BLOCK * 4] == 1 and texts[None, BLOCK * 4] == 0
    assert texts[3, rows[3][1]] == 1 and texts[3, rows[5][1]] == 1 and texts[None, None] == 1
    clean = corpus_pipeline.drop_leaks(spark, docs, data).collect()
    assert len(clean) == 7 and not any(item in (r.text or "") for r in clean)


def test_pipeline_keeps_clean_documents(spark, data):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, data)
    assert out.count() > 100 and set(corpus_pipeline.COLUMNS) <= set(out.columns)


def test_language_id_reads_long_batches_in_turns(monkeypatch):
    """A batch becomes Python strings a bounded number of bytes at a time, with the same predictions."""
    import numpy as np
    import pyarrow as pa

    from sourceloom.llm import language_id as L

    texts = [None if i % 10 == 3 else "" if i % 10 == 4 else "the cat sat " * (i % 7) if i % 2 else "le chat noir " * (i % 5) for i in range(200)]
    spec = L.fit(texts[:100], ["en" if i % 2 else "fr" for i in range(100)]) | {"id": "turns"}
    batch = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array(texts, pa.string())], names=["doc_id", "_text"])
    model = type("Model", (), {"value": spec})
    whole = [b.to_pydict() for b in L._labelled(iter([batch]), model, ["doc_id"])]
    monkeypatch.setattr(L, "TURN_BYTES", 300)
    turns = list(L._turns(np.array([len(t or "") for t in texts])))
    assert [a for a, _ in turns[1:]] == [b for _, b in turns[:-1]] and (turns[0][0], turns[-1][1]) == (0, 200) and len(turns) > 10
    assert all(sum(len(t or "") for t in texts[a:b]) <= 300 or b == a + 1 for a, b in turns)
    again = [b.to_pydict() for b in L._labelled(iter([batch]), model, ["doc_id"])]
    assert [r["lang_pred"] for r in again] == [r["lang_pred"] for r in whole]
    assert all(abs(x - y) < 1e-6 for r, s in zip(again, whole) for x, y in zip(r["score"], s["score"]))


def test_language_id_frees_its_words_with_the_model_and_moves_texts_once(spark):
    """A reused worker holds no scores of a model that is gone, and a text column goes to the workers once."""
    import gc
    import weakref

    import pyarrow as pa

    from sourceloom.llm import language_id as L

    spec = L.fit(["the cat sat", "le chat noir"], ["en", "fr"])
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["the cat"])], names=["doc_id", "text"])
    model = type("Model", (), {})()
    model.value = spec
    assert [b.to_pydict()["lang_pred"] for b in L._labelled(iter([batch]), model, ["doc_id"], "text")] == [["en"]]
    held = weakref.ref(spec["lexicon"])
    del spec, model
    gc.collect()
    assert held() is None
    docs = spark.createDataFrame([(1, "the cat", "en"), (2, "le chat", "fr")], "doc_id bigint, text string, lang string")
    plan = L.identify(docs)._jdf.queryExecution().analyzed().toString()
    assert "MapInArrow" in plan and "_text" not in plan
