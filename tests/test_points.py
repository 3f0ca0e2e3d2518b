"""Vectors, ids, collections, call edges and incremental refresh."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sourceloom.functions import text as X, vectors as V
from sourceloom.operators import collection as C, embed as E, enrich, incremental as D


def chunk_rows(spark, n=500):
    # One file holds a third of all chunks.
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("f"), F.col("id") % 40)).alias("file_path"),
        F.concat(F.lit("n"), F.col("id")).alias("name"), F.col("id").alias("start_line"), F.lit(0).alias("start_column"),
        F.when(F.col("id") % 2 == 0, "python").otherwise("go").alias("language"))


def test_point_ids_are_consecutive_and_stable(spark):
    chunks = chunk_rows(spark)
    first = {(r.file_path, r.start_line): r.id for r in C.point_ids(chunks, 7).collect()}
    again = {(r.file_path, r.start_line): r.id for r in C.point_ids(chunks.repartition(5), 7).collect()}
    assert sorted(first.values()) == list(range(7, 507)) and first == again


def test_hash_embedding(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, "")], "id int, text string")
    rows = {r.id: r.embedding for r in E.hash_embed(df, "text", 16).collect()}
    assert len(rows[1]) == len(rows[2]) == 16 and sum(rows[2]) == 0
    assert math.isclose(sum(x * x for x in rows[1]), 1, rel_tol=1e-6)


def test_hash_embedding_counts_against_brute_force(spark):
    texts = ["", "x", "a a a b", " ".join(f"w{i * i % 97}" for i in range(900)), " ".join(f"v{i}" for i in range(3000))]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for dimension in (1, 2, 16, 768):
        got = {r.id: list(r.v) for r in df.select("id", V.hashed_vector(V.tokens(F.col("text")), dimension).alias("v")).collect()}
        for i, text in enumerate(texts):
            want = [0.0] * dimension
            for w in text.split():
                want[int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % dimension] += 1
            assert got[i] == want


def test_truncation_keeps_the_first_tokens(spark):
    df = spark.createDataFrame([("A b, c_d É1",)], "t string")
    assert df.select(V.tokens(F.col("t"), 3).alias("w")).first().w == ["a", "b", "c_d"]
    assert df.select(V.tokens(F.col("t"), None).alias("w")).first().w[-1] == "é1"


def test_user_model_hook(spark):
    df = spark.createDataFrame([(i, "x" * i) for i in range(20)], "id int, text string")

    def model(texts):
        assert len(texts) <= 8
        return np.array([[len(t), 1.0] for t in texts])

    rows = {r.id: list(r.embedding) for r in E.embed_with(df, "text", model, 2).collect()}
    assert rows == {i: [float(i), 1.0] for i in range(20)}
    with pytest.raises(Exception, match="expected"):
        E.embed_with(df, "text", model, 3).count()


def test_dimension_check_fails_the_query(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "v array<float>")
    with pytest.raises(Exception, match="expected 3"):
        df.select(V.checked(F.col("v"), 3).alias("v")).collect()


def test_cosine_and_zero_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<float>, z array<float>")
    row = df.select(V.cosine(F.col("a"), F.col("a")).alias("one"), V.cosine(F.col("a"), F.col("z")).alias("none"),
                    V.l2_normalize(F.col("a")).alias("unit"), V.l2_normalize(F.col("z")).alias("zero")).first()
    assert row.one == 1.0 and row.none is None and row.unit == [0.6, 0.8] and row.zero == [0.0, 0.0]


def test_topk_limits_before_the_ranking_shuffle(spark):
    points = spark.range(300).select(F.col("id").alias("vec_id"), F.when(F.col("id") < 200, "hot").otherwise("cold").alias("k"),
                                     F.array(F.lit(1.0), F.col("id").cast("double")).alias("embedding"))
    queries = spark.createDataFrame([("hot", [1.0, 0.0]), ("cold", [0.0, 1.0])], "k string, query array<double>")
    top = E.nearest_by_payload(points, queries, ["k"], 3)
    assert [r.vec_id for r in top.where("k = 'hot'").orderBy("rank").collect()] == [0, 1, 2]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_call_edges_against_brute_force(spark):
    data = [("f1", i, f"n{i % 7}", [f"n{j}" for j in range(i % 9)] + ["hot"]) for i in range(60)] + [("g", 1, "hot", [])] * 1
    chunks = spark.createDataFrame(data, "file_path string, start_line int, name string, calls array<string>")
    defined = {d[2] for d in data}
    want = sorted((c, d[2], d[0], d[1]) for d in data for c in d[3] if c in defined)
    assert sorted(map(tuple, enrich.called_by(chunks).collect())) == want
    counts = {r.callee: r.callers for r in enrich.caller_counts(enrich.called_by(chunks)).collect()}
    assert counts["hot"] == 60


def test_a_hot_callee_is_found_and_never_shuffled_by_name(spark):
    """One callee holds a third of the edges, another hot one has no definition."""
    rows = [(f"f{i}", 1, f"n{i}", ["hot", "gone", f"n{(i * 7) % 1000}"]) for i in range(1000)] + [("g", 1, "hot", None)]
    chunks = spark.createDataFrame(rows, "file_path string, start_line int, name string, calls array<string>")
    edges = enrich.call_edges(chunks)
    assert {"hot", "gone"} == {r.callee for r in enrich.hot_callees(edges).collect()}
    got = enrich.called_by(chunks)
    assert {r.callee: r.callers for r in enrich.caller_counts(got).collect()} == {"hot": 1000} | {f"n{i}": 1 for i in range(1000)}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in plan and "pmod(" not in plan
    empty = chunks.where("false")
    assert enrich.called_by(empty).count() == 0


def test_collection_upsert_and_refresh(spark, tmp_path):
    base = chunk_rows(spark, 30).withColumn("id", F.col("start_line"))
    place = C.write_collection(base, str(tmp_path), "c")
    place = C.write_collection(base.where("id < 20"), str(tmp_path), "c")
    assert C.read_collection(spark, place).count() == 20
    batch = base.where("id >= 10").withColumn("name", F.lit("new"))
    merged = C.upsert_collection(spark, place, batch, str(tmp_path / "c2"))
    rows = {r.id: r.name for r in C.read_collection(spark, merged).collect()}
    assert len(rows) == 30 and rows[9] == "n9" and rows[10] == "new"
    changes = spark.createDataFrame([("hot", "deleted")], "path string, change string")
    left = D.refreshed(C.read_collection(spark, merged), changes, batch.where("file_path = 'hot'"))
    assert left.where("file_path = 'hot'").count() == 6
    assert C.collection_name("/a/b/") == "b" and C.collection_name("/a/b", "x") == "x"


def test_changed_files(spark):
    now = D.manifest(spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "path string, content string"))
    before = D.manifest(spark.createDataFrame([("a", "1"), ("b", "x"), ("d", "4")], "path string, content string"))
    changes = D.changed_files(now, before)
    assert {tuple(r) for r in changes.collect()} == {("b", "changed"), ("c", "new"), ("d", "deleted")}
    assert {r.path for r in D.files_to_process(now, changes).collect()} == {"b", "c"}


@pytest.mark.parametrize("code, loc, notes, branches", [
    ("a\n\n# b\n  // c\n/* d\n * e\nf", 2, 4, 1), ("if a else b", 1, 0, 3), ("x?y:z", 1, 0, 2), ("a ? b : c", 1, 0, 1),
    ("else if (x) {}\nswitch case catch elif for while", 2, 0, 9), ("iffy elsewhere _if if_ éif", 1, 0, 1), ("", 0, 0, 1),
    ("  \n #x\r\n\x0b", 0, 1, 1), ("*p = 1;", 0, 1, 1), ("a?b?c", 1, 0, 3),
])
def test_metrics(spark, code, loc, notes, branches):
    t = F.col("t")
    row = spark.createDataFrame([(code,)], "t string").select(X.loc(t), X.comment_lines(t), X.complexity(t)).first()
    assert tuple(row) == (loc, notes, branches)


@pytest.mark.parametrize("comment, text", [
    ("/** one */", "one"), ("/**\n * a\n *\n * b\n */", "a b"), ("/***/", None), ("/* no */", None), ("/** * * x\n** y */", "* x * y"),
    ("/**/", None), ("/**\n\tplain\n*/", "plain"),
])
def test_block_comment_cleaner(spark, comment, text):
    df = spark.createDataFrame([(comment,)], "c string")
    assert df.select(X.clean_block_comment(F.col("c")).alias("x")).first().x == text


def test_upsert_keeps_one_row_per_key(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id int, name string, version int")
    batch = spark.createDataFrame([(1, "z", 2), (1, "c", 3), (1, "c", 3), (3, "d", 2)], old.schema)
    got = C.upsert(old, batch, latest=["version"]).collect()
    assert sorted(map(tuple, got)) == [(1, "c", 3), (2, "b", 1), (3, "d", 2)]
