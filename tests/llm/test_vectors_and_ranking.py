"""Whitening, quality classifier and lexical search: brute force, accuracy, and values on odd rows."""

import collections
import math
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sourceloom.llm import lexical_search, quality
from sourceloom.llm.lexical_search import _Shard, ranked_search
from sourceloom.llm.quality import Network, quality_scores
from sourceloom.llm.queries import QUERIES
from sourceloom.llm.whitening import leading_components, polar_factor, whiten

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def vectors(spark, rows):
    made = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    return made.withColumn("n", F.lit("x")).withColumn("component", F.lit("y")).withColumn("whitened", F.lit(1)).withColumn("_vector", F.lit(2))


def test_whitening_brute_force(spark, data):
    given = duckdb.sql(f"SELECT vec_id, embedding FROM '{data}/embeddings.parquet' ORDER BY vec_id").fetchall()
    x = np.floor(np.array([e for _, e in given]) * 1024) + 100_000
    n, y = len(x), x - x.mean(0)
    v, f = np.linalg.eigh(y.T @ y / n)
    want = y @ f[:, ::-1][:, :8] / np.sqrt(v[::-1][:8])
    rows = QUERIES["op11_whitening"](spark, data).orderBy("vec_id", "component").collect()
    got = np.array([r.whitened for r in rows]).reshape(-1, 8)
    assert [r.vec_id for r in rows] == [i for i, _ in given for _ in range(8)] and {r.n for r in rows} == {n}
    for j in range(8):
        assert min(np.abs(got[:, j] - s * want[:, j]).max() for s in (1, -1)) < 1e-9
        assert math.isclose(rows[j].explained, v[::-1][j] / v.sum(), rel_tol=1e-10)
    exact = ((n * x - x.sum(0)).astype(np.int64) ** 2).sum(1)
    assert [r.deviation for r in rows[::8]] == exact.tolist()
    assert max(r.identity_error for r in rows) < 1e-10


@pytest.mark.parametrize("values", [[5, 4, 3, 2, 1], [3, 3, 3, 1, 1, 0, 0], [1, 0, 0, 0], [2, 2, 2], [1, 1e-3, 1e-6, 1e-9, 1e-12], list(range(60, 0, -1)),
                                    [1 + 1e-10 * i for i in range(12)]])
def test_spectral_divide_and_conquer(values):
    q = np.linalg.qr(np.random.default_rng(1).normal(size=(len(values), len(values))))[0]
    a = (q * np.array(values, float)) @ q.T
    found, basis = leading_components((a + a.T) / 2, 4)
    assert np.allclose(found, sorted(values, reverse=True)[:4], rtol=0, atol=1e-13 * len(values) * max(values))
    assert np.linalg.norm(a @ basis - basis * found) < 1e-12 * np.linalg.norm(a) and np.allclose(basis.T @ basis, np.eye(basis.shape[1]), atol=1e-12)


def test_polar_factor():
    a = np.diag([4.0, 1e-9, -3.0, 0.0])
    assert np.allclose(polar_factor(a), np.diag([1, 1, -1, 0]), atol=1e-12)


def test_whitening_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(1, None), (2, []), (3, [1.0, None]), (4, [1.0, nan]), (5, [inf, 0.0]), (6, [1.0, 2.0, 3.0]), (7, [1e30, 0.0])]
    good = [(10, [0.0, 0.0]), (11, [1.0, 0.0]), (11, [1.0, 0.0]), (None, [0.0, -0.5]), (12, [0.25, 0.125])]
    rows = whiten(vectors(spark, odd + good)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in rows) == sorted((i or 0, c) for i, _ in good for c in (1, 2)) and {r.n for r in rows} == {5}
    x = np.array([v for _, v in good]) * 1024
    assert {r.vec_id: r.deviation for r in rows}[12] == round(((5 * x[4] - x.sum(0)) ** 2).sum())
    w = np.array([[r.whitened for r in rows if r.component == c] for c in (1, 2)])
    assert np.allclose(w @ w.T / 5, np.eye(2), atol=1e-9)
    # Equal vectors have no direction; one direction has one component; nothing gives nothing.
    assert whiten(vectors(spark, [(1, [1.0, 2.0])] * 4)).count() == 0
    assert {r.component for r in whiten(vectors(spark, [(i, [float(i), 2.0 * i]) for i in range(5)])).collect()} == {1}
    assert whiten(vectors(spark, odd[:5])).count() == 0 and whiten(vectors(spark, odd).limit(0)).count() == 0


def test_deviation_beyond_64_bits_is_null(spark):
    rows = whiten(vectors(spark, [(i, [float(i % 2) * 2.0 ** 37, float(i)]) for i in range(40)])).collect()
    assert {r.deviation for r in rows} == {None} and {r.n for r in rows} == {40}


def test_quality_held_out(spark, data):
    label = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{data}/../sf0.01/labels.parquet'").fetchall())
    rows = QUERIES["op12_quality"](spark, f"{data}/../sf0.01").collect()
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in label]
    assert sum(r.predicted == label[r.doc_id] for r in held) >= 0.95 * len(held)
    assert sum(r.predicted for r in held if label[r.doc_id]) >= 0.97 * sum(label[r.doc_id] for r in held)
    # Calibrated: the mean score is the share of label 1.
    assert abs(sum(r.score - label[r.doc_id] for r in held) / len(held)) < 0.05


def test_word_vectors_are_neighbours_sums(spark):
    """Without shared slots the sketch holds the plain sums over all texts, however they are dealt."""
    texts = ["a b c d", "b a !! c", "d", "", None, "a a"]
    frame = spark.createDataFrame([(t,) for t in texts], "_text string").repartition(3)
    got = quality.word_vectors(frame)
    index, slot = {}, {}
    for w in ("a", "b", "c", "d", "!!"):
        words = quality.Words(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)]), quality._CLASSES, fold=False)
        index[w] = np.zeros(quality.DIMS)
        for j in range(quality.MARKS):
            place, mark = quality._marks(words.hash, j)
            index[w][place[0]] += mark[0]
        at, sign = quality._slots(words.hash)
        slot[w] = int(at[0]), int(sign[0])
    assert len({s for s, _ in slot.values()}) == len(slot)
    want, count = collections.defaultdict(lambda: np.zeros(quality.DIMS)), collections.Counter()
    for t in texts:
        ws = (t or "").split()
        for i, w in enumerate(ws):
            count[w] += 1
            for k in range(max(0, i - quality.REACH), min(len(ws), i + quality.REACH + 1)):
                if k != i:
                    want[w] += index[ws[k]]
    for w, (at, sign) in slot.items():
        full = want[w] / max(np.linalg.norm(want[w]), 1)
        assert np.allclose(sign * got[at, :quality.DIMS], full, atol=1e-6) and math.isclose(got[at, quality.DIMS], math.log1p(count[w]), rel_tol=1e-6)
    assert np.count_nonzero(got[:, quality.DIMS]) == len(slot)


def test_temperature_calibrates():
    draw = np.random.default_rng(3)
    z = draw.normal(0, 2, 20_000)
    y = (draw.random(20_000) < 1 / (1 + np.exp(-z))).astype(int)
    assert abs(quality._temperature(3 * z, y) - 3) < 0.2
    assert Network(np.zeros((3, 4)), np.ones(3)).score(np.zeros((2, 4))).tolist() == [0.8, 0.8]


def test_quality_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " \n"), (None, "one two"), (4, "ümlaut 日本語 \U0001F600"), (5, "good words here"), (5, "good words here"), (6, "x " * 200_000),
            *((i, "good words here and there " * (i % 5 + 1) if i % 2 else "!! ## $$ " * (i % 7 + 1)) for i in range(20, 120))]
    labels = [(i, i % 2, 9) for i in range(20, 120)] + [(1, None, 0), (None, 1, 0), (5, 1, 0), (5, 0, 0), (6, 7, 0), (999, 0, 0)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("quality", F.lit("no")).withColumn("score", F.lit(0)).withColumn("_draw", F.lit(1))
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, text int")
    rows = quality_scores(frame, known).collect()
    assert collections.Counter(r.doc_id for r in rows) == collections.Counter(i for i, _ in docs) and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[1].score == by[2].score == by[3].score and not by[None].held_out
    assert all(by[i].predicted == i % 2 for i in range(20, 120))
    assert quality_scores(frame.limit(0), known).count() == 0
    alone = quality_scores(frame, known.where("quality = 1")).collect()
    assert len({r.score for r in alone}) == 1 and 0.9 < alone[0].score < 1
    assert {r.score for r in quality_scores(frame, known.limit(0)).collect()} == {0.5}


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def ranked(docs, items, k=10):
    bags = [(i, collections.Counter(terms(t))) for i, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    total, length = sum(n > 0 for n in sizes), sum(sizes)
    df = collections.Counter(t for _, b in bags for t in b)
    out = []
    for item, text in dict.fromkeys(items):
        scores = []
        for (doc, bag), n in zip(bags, sizes):
            s = sum(q * math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10 ** 9 * bag[t] // (1000 * bag[t] + 8 * (25 + 75 * n * total // length)))
                    for t, q in collections.Counter(terms(text)).items() if bag[t])
            if s > 0:
                scores.append((-s, doc is None, doc or 0, doc))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def search(spark, docs, items, parts=3, **options):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("item_id", F.lit(1)).withColumn("n", F.lit(2)).withColumn("terms", F.lit(3)).repartition(parts)
    i = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(1)).withColumn("h", F.lit(2))
    return sorted((tuple(r) for r in ranked_search(d, i, **options).collect()), key=repr)


def test_search_ties_and_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " .,"), (None, "alpha beta"), (4, "Alpha BETA"), (5, "alpha beta"), (5, "alpha beta"), (6, "gamma ümlaut 日本語"), (7, "alpha " * 50_000),
            *((i, "tie word") for i in range(100, 140)), *((i, f"only{i} tie") for i in range(200, 220))]
    items = [(1, "alpha beta beta"), (1, "alpha beta beta"), (1, "tie"), (2, None), (3, ""), (4, "ümlaut 日本語 nowhere"), (None, "word gamma"), (5, "absent")]
    assert search(spark, docs, items) == ranked(docs, items)
    assert search(spark, docs, items, k=3) == ranked(docs, items, 3)
    assert search(spark, docs[:1], items) == [] and search(spark, docs, items[3:5]) == []


def test_search_over_many_small_shards(spark, data, monkeypatch):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{data}/documents.parquet'").fetchall()
    items = duckdb.sql(f"SELECT item_id, text FROM '{data}/benchmark.parquet'").fetchall()
    monkeypatch.setattr(lexical_search, "ROUND_TERMS", 200)  # several rounds of items
    assert search(spark, docs, items, parts=5) == ranked(docs, items)


def test_nra_stops_early_and_settles_ties():
    """Random lists, small shards: the same documents as a full sum; documents that cannot win leave with open bounds."""
    draw = np.random.default_rng(5)
    for trial in range(40):
        size = int(draw.integers(1, 400))
        n, weights = draw.integers(1, 30, size), np.array([0, 900, 3000, 7, 2500])
        sizes = draw.integers(0, 6, size)
        term = np.concatenate([draw.permutation(5)[:s] for s in sizes] or [np.zeros(0, int)]).astype(np.int64)
        tf = draw.integers(1, 4, len(term))
        shard = _Shard(n, sizes, term, tf, weights, size, int(n.sum()))
        full = np.zeros(size, np.int64)
        wanted, q = np.array([1, 2, 4]), np.array([1, 2, 1])
        m = 25 + 75 * n * size // n.sum()
        doc = np.repeat(np.arange(size), sizes)
        for t, times in zip(wanted, q):
            at = term == t
            full[doc[at]] += times * weights[t] * (10 ** 9 * tf[at] // (1000 * tf[at] + 8 * m[doc[at]]))
        got, score = shard.search(wanted, q, 10, 1)
        last = max(1, np.sort(full)[-10] if size >= 10 else 1)
        assert sorted(got.tolist()) == np.flatnonzero(full >= last).tolist() and (score == full[got]).all()
