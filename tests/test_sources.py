"""Directory scans, ignore rules, and the file predicates."""

import re

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sourceloom.functions.paths import SUFFIX_GLOB, ignore_regex, is_ignored, language_of
from sourceloom.operators import predicates as P
from sourceloom.operators.blocks import by_path
from sourceloom.plans import corpus
from sourceloom.plans.queries import QUERIES, corpus_files
from sourceloom.sources.scan import scan_corpus
from sourceloom.streaming.ingest import file_stream, ingest


@pytest.fixture
def tree(tmp_path):
    files = {
        "src/main.py": b"def f(): pass\r\nx = 1\r", "src/LIB.RS": b"fn g() {}\n", "src/a b+c%20.java": b"class A { void h() {} }\n",
        "src/note.txt": b"text", "src/data.c": b"int x;\x00", "src/latin.go": b"package \xe9\n", "build/gen.py": b"def no(): pass\n",
        "src/test_x.py": b"def t(): pass\n", "src/keep/test_y.py": b"def y(): pass\n", ".rules": b"# note\n\nbuild/\ntest_*.py\n!src/keep/\n",
        ".py": b"def hidden(): pass\n", "src/pkg/__init__.py": b"def made(): pass\n", "src/_in/x.go": b"package p\n",
        "build/__init__.py": b"x = 1\n",
    }
    for name, content in files.items():
        place = tmp_path / name
        place.parent.mkdir(parents=True, exist_ok=True)
        place.write_bytes(content)
    return str(tmp_path)


def test_scan_directory(spark, tree):
    rows = {r.path: r for r in scan_corpus(spark, tree, ignore_file=".rules").collect()}
    assert set(rows) == {"src/main.py", "src/LIB.RS", "src/a b+c%20.java", "src/keep/test_y.py", "src/pkg/__init__.py",
                         "src/_in/x.go"}
    assert rows["src/main.py"].text == "def f(): pass\nx = 1\n"
    assert rows["src/LIB.RS"].language == "rust"


def test_scan_without_rules_and_with_languages(spark, tree):
    every = {r.path for r in scan_corpus(spark, tree).collect()}
    assert {"build/gen.py", "src/test_x.py"} <= every and "src/data.c" not in every and "src/latin.go" not in every
    assert {r.path for r in scan_corpus(spark, tree + "/", ["rust"], "absent").collect()} == {"src/LIB.RS"}


def test_partition_like_names_are_listed_once(spark, tmp_path):
    for name in ("_v=1/a.py", "_in/b.py", ".c/_v=2/d.py"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("def f(): pass\n")
    assert sorted(r.path for r in scan_corpus(spark, str(tmp_path)).collect()) == [".c/_v=2/d.py", "_in/b.py", "_v=1/a.py"]


def test_missing_directory_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        scan_corpus(spark, str(tmp_path / "none"))


def test_ignored_files_are_not_read(spark, tree):
    # A length limit makes any read of an excluded file fail.
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 1)
    try:
        assert scan_corpus(spark, tree, ["cpp"]).count() == 0
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


@pytest.mark.parametrize("pattern, path, hit", [
    ("*.pyc", "a/b.pyc", True), ("*.pyc", "a/b.py", False), ("build/", "build/x", True), ("build/", "a/build/x", True),
    ("build/", "build", False), ("/top.py", "top.py", True), ("/top.py", "a/top.py", False), ("a/b", "a/b/c", True),
    ("a/b", "x/a/b", False), ("a/**/b", "a/b", True), ("a/**/b", "a/x/y/b", True), ("**/b", "x/b", True), ("a/**", "a/x", True),
    ("a/**", "a", False), ("?.c", "x.c", True), ("?.c", "xy.c", False), ("[ab].c", "a.c", True), ("[!ab].c", "a.c", False),
    ("[!ab].c", "z.c", True), (r"\#x", "#x", True), (r"\!x", "!x", True), ("a.b", "axb", False), ("docs", "docs/x/y", True),
])
def test_ignore_patterns(pattern, path, hit):
    regex, excludes = ignore_regex(pattern)
    assert excludes and bool(re.search(regex.replace(r"\z", r"\Z"), path)) is hit


def test_last_rule_wins_and_notes_are_skipped(spark):
    df = spark.createDataFrame([("a.log",), ("keep.log",), ("b.txt",)], "p string")
    rules = ["# x", "  ", "*.log", "!keep.log"]
    assert {r.p: r.i for r in df.select("p", is_ignored(F.col("p"), rules).alias("i")).collect()} == {
        "a.log": True, "keep.log": False, "b.txt": False}
    assert df.where(is_ignored(F.col("p"), [])).count() == 0


def test_languages_by_suffix(spark):
    wanted = {"a.py": "python", "A.PY": "python", "x/b.Rs": "rust", "c.go": "go", "d.java": "java", "e.c": "c", "e.h": "c",
              "f.cpp": "cpp", "f.cc": "cpp", "f.cxx": "cpp", "f.hpp": "cpp", "f.hh": "cpp", "f.hxx": "cpp", "g.txt": None,
              "py": None, ".py": None, "x.py/readme": None, "a.py.bak": None}
    df = spark.createDataFrame([(k,) for k in wanted], "p string")
    assert {r.p: r.l for r in df.select("p", language_of(F.col("p")).alias("l")).collect()} == wanted
    assert "[pP][yY]" in SUFFIX_GLOB


def test_binary_probe_and_encoding(spark):
    rows = [("a", b"x" * 8191 + b"\x00"), ("b", b"x" * 8192 + b"\x00"), ("c", b"\xff"), ("d", None), ("e", "é\r\n".encode())]
    df = spark.createDataFrame(rows, "k string, content binary")
    found = {r.k: (r.binary, r.text) for r in df.select(
        "k", P.is_binary(F.col("content")).alias("binary"), P.decoded(F.col("content")).alias("text")).collect()}
    assert [found[k][0] for k in "abcde"] == [True, False, False, True, False]
    assert found["c"][1] is None and found["e"][1] == "é\n"


def test_stream_sees_each_file_once(spark, tree, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    run = lambda: ingest(file_stream(spark, tree, max_files=2), out + "/chunks", out + "/state").awaitTermination()
    run()
    first = spark.read.parquet(out + "/chunks").count()
    run()
    assert first == 6 and spark.read.parquet(out + "/chunks").count() == first
    with open(tree + "/src/late.go", "w") as f:
        f.write("package p\nfunc late() {}\n")
    run()
    assert spark.read.parquet(out + "/chunks").count() == first + 1


def test_stream_follows_the_rules_of_the_scan(spark, tmp_path):
    for name in ("build/root/top.py", "build/root/a/top.py", "build/root/a/b+c%20.py", "build/root/x.go", "build/root/build/y.py"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("def f(): pass\n")
    root, out = str(tmp_path / "build/root"), str(tmp_path / "out")
    rules = ["/top.py", "build/"]
    (tmp_path / "build/root/.rules").write_text("\n".join(rules))
    ingest(file_stream(spark, root, rules, languages=["python"]), out + "/chunks", out + "/state").awaitTermination()
    streamed = {r.file_path for r in spark.read.parquet(out + "/chunks").collect()}
    assert streamed == {r.path for r in scan_corpus(spark, root, ["python"], ".rules").collect()} == {"a/top.py", "a/b+c%20.py"}


def test_texts_are_rendered_by_many_tasks(spark, tmp_path):
    """A part table of one row group becomes texts, paths and filters in all tasks, with the same rows."""
    parts = spark.range(600).selectExpr("id AS p_partkey", "concat('red ', id) AS p_name", "cast(id % 50 AS int) AS p_size")
    parts.unionByName(parts.where("p_partkey < 2")).coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    for rendered in (corpus.raw_corpus(spark, str(tmp_path)), QUERIES["files_from_table"](spark, str(tmp_path))):
        rows = rendered.groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in rows) == 602
        assert len(rows) == 8 and max(r["count"] for r in rows) < 100


def test_texts_are_rendered_after_the_deal(spark, tmp_path):
    """Filters on rendered paths and texts stay above the exchange that deals the parts over all tasks."""
    names = (None, "", "almond rose", "x«s»y z", "«k» «w»", "ä'\\")
    rows = [(key, name, size) for key in [None, *range(-2, 40)] for name, size in zip(names, (3, None, 0, 7, 5, -2))]
    part = spark.createDataFrame(rows, "p_partkey bigint, p_name string, p_size int")
    part.write.parquet(str(tmp_path / "part.parquet"))
    texts = part.select(F.expr(corpus.raw_text_sql()).alias("old"), F.expr(corpus.raw_text_joined_sql()).alias("new"))
    assert texts.where("NOT old <=> new").count() == 0
    filtered = by_path(corpus_files(spark, str(tmp_path)))
    plan = filtered._jdf.queryExecution().executedPlan().toString()
    deal = plan.index("RoundRobinPartitioning")
    assert "Filter (" in plan[:deal] and "Filter (" not in plan[deal:] and "RLIKE" not in plan[deal:]
