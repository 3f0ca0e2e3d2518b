"""Snapshots that rewrite only touched files, collections kept in step with a corpus, distributed listing, and batched search."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sourceloom.operators import embed as E
from sourceloom.operators.snapshots import Snapshots
from sourceloom.operators.blocks import _candidates, by_path, located, pieces
from sourceloom.operators.chunks import extract_functions
from sourceloom.plans import queries
from sourceloom.sources import scan
from sourceloom.sources.scan import list_tree, scan_corpus
from sourceloom.streaming import sync as sync_module
from sourceloom.streaming.sync import chunks_of, sync


def rows(spark, ids, name="a"):
    return spark.createDataFrame([(i, f"{name}{i}") for i in ids], "id bigint, name string")


def content(frame):
    return sorted(map(tuple, frame.collect()))


def test_upsert_rewrites_only_touched_files(spark, tmp_path):
    kept = Snapshots(spark, str(tmp_path))
    assert kept.versions() == [] and kept.write(rows(spark, range(-50, 50)), files=10) == 1
    before = {r.file for r in kept.manifest().collect()}
    assert len(before) == 10
    assert kept.upsert(rows(spark, [-3, -2, 5000], "b").union(rows(spark, [-2], "b"))) == 2
    after = {r.file: r for r in kept.manifest().collect()}
    assert len(before & set(after)) >= 8 and all(after[f].version == 1 for f in before & set(after))
    want = sorted([(i, f"a{i}") for i in range(-50, 50) if i not in (-3, -2)] + [(-3, "b-3"), (-2, "b-2"), (5000, "b5000")])
    assert content(kept.read()) == want and sum(r.n_rows for r in after.values()) == len(want)
    assert content(kept.read(1)) == [(i, f"a{i}") for i in range(-50, 50)]  # the older version stays
    # Keys outside every file add a file and touch none; a deletion adds nothing.
    kept.upsert(rows(spark, [10 ** 15], "c"))
    assert set(after) <= {r.file for r in kept.manifest().collect()}
    kept.replace(rows(spark, range(-50, 10 ** 4 // 2 + 1)), rows(spark, []))
    assert content(kept.read()) == [(10 ** 15, f"c{10 ** 15}")]
    kept.replace(rows(spark, [10 ** 15]), rows(spark, []))
    assert content(kept.read()) == [] and kept.versions() == [1, 2, 3, 4, 5]


def test_a_stopped_write_leaves_the_version_before(spark, tmp_path):
    kept = Snapshots(spark, str(tmp_path))
    kept.write(rows(spark, range(20)), files=4)
    stop = F.udf(lambda n: 1 // 0 if n == "x19" else n)
    broken = rows(spark, range(10, 20), "x").withColumn("name", stop("name"))
    with pytest.raises(Exception, match="ZeroDivision"):
        kept.upsert(broken)
    assert kept.versions() == [1] and kept.read().count() == 20
    os.makedirs(tmp_path / "manifests" / "00000002")  # a manifest without its end
    rows(spark, [1]).write.parquet(str(tmp_path / "data" / "00000002"))
    assert kept.versions() == [1]
    assert kept.upsert(rows(spark, range(10, 20), "x")) == 2
    assert content(kept.read()) == [(i, f"{'x' if i >= 10 else 'a'}{i}") for i in range(20)]
    with pytest.raises(ValueError, match="no version"):
        kept.read(7)


def test_collection_follows_a_directory(spark, tmp_path):
    root, place = tmp_path / "root", str(tmp_path / "out")
    files = {"a.py": "def a(): pass\n", "pkg/__init__.py": "def made(): pass\n", "b.go": "package p\nfunc b() {}\n", "_in/c.py": "def c(): pass\n"}
    for name, text in files.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(text)
    run = lambda: sync(spark, scan_corpus(spark, str(root)), place)
    names = lambda: sorted((r.file_path, r.name) for r in chunks_of(spark, place).read().select("file_path", "name").collect())
    assert run() == 1 and names() == [("_in/c.py", "c"), ("a.py", "a"), ("b.go", "b"), ("pkg/__init__.py", "made")]
    assert run() == 1  # nothing changed, nothing written
    (root / "pkg/__init__.py").write_text("def made(): pass\ndef more(): pass\n")
    (root / "a.py").unlink()
    (root / "d.py").write_text("def d(): pass\n")
    assert run() == 2
    assert names() == [("_in/c.py", "c"), ("b.go", "b"), ("d.py", "d"), ("pkg/__init__.py", "made"), ("pkg/__init__.py", "more")]


def test_listing_splits_a_deep_tree_and_prunes(spark, tmp_path):
    names = ["src/a/b/c/d.py", "src/a/b/_x/e.py", "src/a/f.txt", "build/deep/g.py", "src/.h/i.go", "build/j.rs"]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x")
    listed = lambda *p, **o: sorted(r.path for r in list_tree(spark, str(tmp_path), *p, **o).collect())
    assert listed() == sorted(n for n in names if not n.endswith("txt"))
    assert listed(["build/"]) == ["src/.h/i.go", "src/a/b/_x/e.py", "src/a/b/c/d.py"]
    assert listed(["build/", "!build/j.rs"]) == ["build/j.rs", "src/.h/i.go", "src/a/b/_x/e.py", "src/a/b/c/d.py"]
    assert listed((), languages=["go"]) == ["src/.h/i.go"]
    assert list_tree(spark, str(tmp_path / "none")).count() == 0


def test_many_queries_against_brute_force(spark, monkeypatch):
    draw = np.random.default_rng(2)
    points = [(i, draw.integers(-3, 4, 5).astype(float).tolist(), float(i % 9) if i % 11 else None) for i in range(300)]
    points += [(300, None, 1.0), (301, [0.0] * 5, 1.0), (302, [1.0, 2.0], 1.0), (None, points[7][1], 7.0)]
    asked = [(q, draw.normal(size=5).tolist(), float(q % 9), float(q % 9 + 3)) for q in range(40)] + [(90, None, 0.0, 9.0), (91, [0.0] * 5, 0.0, 9.0), (92, [1.0] * 5, None, 9.0)]
    p = spark.createDataFrame(points, "vec_id bigint, embedding array<double>, year double").repartition(5)
    q = spark.createDataFrame(asked, "query_id bigint, query array<double>, low double, high double")
    monkeypatch.setattr(E, "QUERY_BLOCK", 16)
    got = {}
    for r in E.nearest_many(p, q, 4, [("year", ">=", "low"), ("year", "<=", "high")], where=F.col("year") < 8).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.id, r.score))
    for name, v, low, high in asked:
        want = []
        for i, x, year in points:
            if v and x and any(v) and any(x) and len(x) == len(v) and None not in (low, year) and low <= year <= high and year < 8:
                want.append((-round(float(np.dot(v, x) / np.linalg.norm(v) / np.linalg.norm(x)), 9), i is None, i or 0, i))
        want = [(n + 1, w[3], -w[0]) for n, w in enumerate(sorted(want)[:4])]
        assert [(a, b) for a, b, _ in sorted(got.get(name, []))] == [(a, b) for a, b, _ in want], name
        assert np.allclose([s for *_, s in sorted(got.get(name, []))], [s for *_, s in want])
    assert E.nearest_many(p.limit(0), q, 3).count() == 0 and E.nearest_many(p, q.limit(0), 3).count() == 0


def test_a_tree_is_scanned_without_an_index_of_its_files_on_the_driver(spark, tmp_path, monkeypatch):
    """Tasks list and read the files in bounded batches; names with blanks and percent signs are plain names."""
    names = {"my dir/a.py": b"a", "p%20q/b c.py": b"b\xff", "c+d/e#f.go": b"\x00", "_metadata.py": b"m", "_h/g.py": b"", "i/j.py": b"", "k.py/l.py": b"l" * 30}
    for name, content in names.items():
        (tmp_path / "ro ot" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "ro ot" / name).write_bytes(content)
    listed = scan.list_corpus(spark, str(tmp_path / "ro ot"))
    # Outside hidden folders an empty file is left out as Spark's reader leaves it out.
    want = {n: c for n, c in names.items() if n != "i/j.py"}
    assert sorted((r.path, bytes(r.content), r.length) for r in listed.collect()) == sorted((n, c, len(c)) for n, c in want.items())
    sources = listed._jdf.queryExecution().optimizedPlan().toString()
    assert "binaryFile" not in sources and not any("ro ot" in f for f in listed.inputFiles())
    monkeypatch.setattr(scan, "BATCH_ROWS", 2)
    top = pd.DataFrame([(f"file:{tmp_path}/ro ot", "")], columns=["uri", "path"])
    frames = list(scan._entries(iter([top])))
    assert [len(f) for f in frames] == [2, 2, 2, 1] and set(pd.concat(frames).path) == {n.split("/")[0] for n in names}
    (tmp_path / "ro ot" / ".rules").write_text("k.py/\n")
    kept = scan_corpus(spark, f"file://{tmp_path}/ro ot/", ["python"], ".rules")
    assert sorted((r.path, r.text) for r in kept.collect()) == [("_h/g.py", ""), ("_metadata.py", "m"), ("my dir/a.py", "a")]
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 20)
    try:
        with pytest.raises(Exception, match="maxLength"):
            scan_corpus(spark, str(tmp_path / "ro ot"), ["python"]).count()
        assert scan_corpus(spark, str(tmp_path / "ro ot"), ["go"]).count() == 0
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_only_pieces_with_events_have_their_headers_read(spark):
    """Statements of brace languages leave before the patterns of headers; Python's lines stay, since they end blocks."""
    java = "class A {\n  int x = 1;\n  void g() { x++; x--; }\n  abstract int k(int a);\n}\n"
    files = spark.createDataFrame([("a", "java", java), ("b", "python", "x = 1\ndef f():\n    y()\n")], "path string, language string, text string")
    kept = _candidates(located(pieces(by_path(files)))).select("path", "term", "bodiless", "piece").collect()
    assert sorted(r.piece.strip() for r in kept if r.path == "a") == ["abstract int k(int a);", "class A {", "void g() {", "}", "}"], kept
    assert sum(r.path == "b" for r in kept) == 4
    assert sorted((r.file_path, r.name) for r in extract_functions(files).collect()) == [("a", "g"), ("a", "k"), ("b", "f")]


def test_sync_lets_the_jvm_compile_the_extraction(spark, tmp_path, monkeypatch):
    """Generated methods stay under the size that HotSpot compiles, and the session's own limit comes back, after an error too."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before, seen = spark.conf.get(name), []
    files = spark.createDataFrame([("a.py", "python", "def f(): pass\n")], "path string, language string, text string")

    def watched(*args, **options):
        seen.append(int(spark.conf.get(name)))
        return extract_functions(*args, **options)

    monkeypatch.setattr(sync_module, "extract_functions", watched)
    assert sync(spark, files, str(tmp_path / "out")) == 1
    assert seen == [8000] and spark.conf.get(name) == before
    with pytest.raises(Exception, match="nothing"):
        sync(spark, files.select("path", "language", F.raise_error(F.lit("nothing")).cast("string").alias("text")), str(tmp_path / "other"))
    assert spark.conf.get(name) == before


def test_the_corpus_of_a_sync_is_rendered_once(spark, tmp_path, monkeypatch):
    """Both runs of the query read the same stored corpus."""
    rows = [(key, f"w{key % 3} x", key % 5) for key in range(90)]
    spark.createDataFrame(rows, "p_partkey bigint, p_name string, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    given = []
    monkeypatch.setattr(queries, "sync", lambda session, files, place: (given.append(files), sync(session, files, place)))
    found = queries.QUERIES["corpus_sync"](spark, str(tmp_path))
    assert len(given) == 2 and all("part.parquet" not in f for files in given for f in files.inputFiles())
    whole = extract_functions(queries.corpus_files(spark, str(tmp_path)), columns=("file_path", "name", "start_line", "end_line"))
    assert content(found) == content(whole) != []
