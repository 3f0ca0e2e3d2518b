"""Properties of lexing and extraction that hold for any text."""

import random

import pytest
from pyspark.sql import functions as F

from sourceloom.functions import patterns as P
from sourceloom.operators.blocks import by_path, pieces, syntax_health
from sourceloom.operators.chunks import extract_functions
from sourceloom.plans import queries as Q

FILES = "path string, language string, text string"
ALPHABET = ["{", "}", "(", ")", "[", "]", ";", ":", "\n", "\n    ", " ", "\"", "'", "`", "/", "/*", "*/", "//", "#", "\\", "<", ">",
            "=", ",", "é", "fn ", "def f", "func ", "int f", "class A", "impl ", "x", "1", "r#\"", "\"#", "R\"(", "\"\"\"", "'a", "->", "@"]


@pytest.fixture(scope="module")
def noise(spark):
    rng = random.Random(7)
    rows = []
    for i in range(240):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 120)))
        rows.append((f"f{i}", P.LANGUAGES[i % 6], text))
    return spark.createDataFrame(rows, FILES)


def test_pieces_are_lossless(spark, noise, data):
    for files in (noise, Q.corpus_files(spark, data)):
        ordered = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "piece"))), lambda s: s["piece"]), "")
        again = pieces(by_path(files)).groupBy("path").agg(ordered.alias("again"))
        assert files.join(again, "path").where("text <> again").count() == 0
        assert again.count() == files.count()


def test_noise_never_fails(noise):
    for mode in ("drop", "keep"):
        rows = extract_functions(noise, on_error=mode).collect()
        assert all(r.end_line >= r.start_line for r in rows)


def test_chunks_are_slices_of_their_file(spark, data):
    files = Q.corpus_files(spark, data)
    chunks = extract_functions(files, columns=("file_path", "code", "start_line", "end_line", "loc", "comment_lines"))
    joined = chunks.join(files, chunks.file_path == files.path)
    assert joined.where(~F.contains("text", "code")).count() == 0
    assert joined.where("end_line - start_line + 1 <> size(split(code, '\n'))").count() == 0
    assert joined.where("loc + comment_lines > end_line - start_line + 1").count() == 0


def test_result_does_not_depend_on_partitioning(spark, data):
    files = Q.corpus_files(spark, data)
    digest = lambda df: df.select(F.bit_xor(F.xxhash64("file_path", "name", "start_line", "code")).alias("h")).first().h
    columns = ("file_path", "name", "start_line", "code")
    assert digest(extract_functions(files, columns=columns)) == digest(extract_functions(files.repartition(3), columns=columns))


@pytest.mark.parametrize("language", P.LANGUAGES)
def test_extreme_texts_do_not_overflow(spark, language):
    texts = ["(" * 20000, "(" * 20000 + ")" * 20000, "x = " + '"' + "a" * 500000 + '"', "// " + "y" * 500000, "a " * 200000,
             "/*" * 20000, "'" * 20001, "[" * 300 + "{" * 300, "\\" * 100001, "f(" + "x, " * 100000 + ")"]
    files = spark.createDataFrame([(f"p{i}", language, t) for i, t in enumerate(texts)], FILES)
    assert syntax_health(files).count() == len(texts)
    extract_functions(files, languages=[language]).count()


def test_a_large_file_is_linear(spark, extract):
    text = "class A {\n" + "".join(f"  int f{i}(int a) {{ if (a > {i}) {{ return a; }} return {i}; }}\n" for i in range(20000)) + "}\n"
    rows = extract("java", text, columns=("name", "start_line", "start_column", "scope", "complexity"))
    assert len(rows) == 20000 and {r["complexity"] for r in rows} == {2}
    assert rows[-1]["start_line"] == 20001
