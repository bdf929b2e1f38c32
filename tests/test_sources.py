"""File sources: whole-text files, numbered lines, unreadable paths."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from textoverlap.config import Params
from textoverlap.operators import report
from textoverlap.plans import jobs
from textoverlap.sources import read_lines, read_numbered_lines, read_paths, read_text_files, unreadable_paths


def test_text_folder_round_trip(spark):
    d = tempfile.mkdtemp(prefix="to-src-")
    for name, text in [("a.txt", "The cat sat. A dog ran."), ("b.txt", "the cat sat! Other."),
                       ("c.txt", "Nothing alike here.")]:
        with open(os.path.join(d, name), "w") as f:
            f.write(text)
    os.mkdir(os.path.join(d, "subdir"))
    docs = read_text_files(spark, d)
    assert docs.count() == 3
    scores = jobs.compare_corpus(docs).collect()
    pair = [r for r in scores if r.doc1.endswith("a.txt") and r.doc2.endswith("b.txt")]
    assert len(pair) == 1 and pair[0].edit_similarity == 0.25
    with open(os.path.join(d, "a b+c%.txt"), "w") as f:
        f.write("Named oddly.")
    docs = read_text_files(spark, d)
    asked = [os.path.join(d, n) for n in ("a.txt", "a b+c%.txt", "zz.txt")]
    missing = unreadable_paths(spark, asked, docs)
    assert [r.doc_id for r in missing.collect()] == asked[2:]


def test_numbered_lines(spark):
    d = tempfile.mkdtemp(prefix="to-lines-")
    p = os.path.join(d, "Input.txt")
    with open(p, "w") as f:
        f.write("1. This is a sentence.\n2. Another One\nNo number\n10. Tenth line.\n")
    rows = {r.line_no: r.text for r in read_numbered_lines(spark, p).collect()}
    assert rows == {1: "this is a sentence.", 2: "another one", None: "no number", 10: "tenth line."}


def test_missing_document_skips_its_pair(spark):
    docs = spark.createDataFrame([(1, "One. Two."), (2, "")], "doc_id long, text string")
    assert jobs.compare_two(docs, 1, 99).count() == 0
    assert [r.overall_similarity for r in jobs.compare_two(docs, 1, 2).collect()] == [0.0]


def test_lines_are_numbered_across_splits(spark, tmp_path):
    """Files of many splits (a few hundred bytes each) are numbered as by one reader, empty lines and a missing newline included."""
    rnd = random.Random(2)
    want = {}
    for name, n in (("a.txt", 400), ("b.txt", 3), ("empty.txt", 0), ("c.txt", 90)):
        lines = ["".join(rnd.choice("abc é") for _ in range(rnd.randrange(40))) for _ in range(n)]
        (tmp_path / name).write_text("\n".join(lines))
        if lines and not lines[-1]:
            lines.pop()
        want |= {(name, i): x for i, x in enumerate(lines, 1)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
    spark.conf.set("spark.sql.files.openCostInBytes", "10b")
    try:
        splits = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
        got = {(r.file.rsplit("/", 1)[-1], r.position): r.text for r in read_lines(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert splits > 10 and got == want


def test_line_listing_of_files(spark, tmp_path):
    (tmp_path / "one.txt").write_text("1. The cat sat on the mat.\n2. the cat sat on a mat.\n3. Other words entirely\nThe cat sat on the mat.")
    (tmp_path / "two.txt").write_text("1. The cat sat on the mat.")
    rows = jobs.line_listing(spark, str(tmp_path)).collect()
    assert {r.file.rsplit("/", 1)[-1] for r in rows} == {"one.txt"}
    edit = {(r.line_a, r.line_b): r.line for r in rows if r.kind == 1}
    assert edit == {(1, 2): "Edit Distance between sentence 1 and 2 is 3.", (1, 4): "Edit Distance between sentence 1 and 4 is 0.",
                    (2, 4): "Edit Distance between sentence 2 and 4 is 3."}
    assert "Cosine Similarity between Sentence 1 and 4 is 1.000000." in {r.line for r in rows if r.kind == 2}


def test_path_list_with_unreadable_files(spark, tmp_path):
    """An empty and a missing file, a folder, a missing folder and a link to nowhere are told, and their pairs skipped."""
    for name, text in [("a.txt", "The cat sat. A dog ran."), ("b c+%.txt", "the cat sat! Other."), ("empty.txt", ""), ("other.txt", "The cat sat.")]:
        (tmp_path / name).write_text(text)
    (tmp_path / "folder").mkdir()
    (tmp_path / "nowhere.txt").symlink_to(tmp_path / "gone")
    asked = [str(tmp_path / n) for n in ("a.txt", "b c+%.txt", "empty.txt", "missing.txt", "folder", "nowhere.txt", "none/x.txt")] + [f"file://{tmp_path}/a.txt", None]
    for paths in (asked, spark.createDataFrame([(p,) for p in asked], "doc_id string")):
        got = {r.doc_id: (r.text, r.status) for r in read_paths(spark, paths).collect()}
        assert got == {asked[0]: ("The cat sat. A dog ran.", "ok"), asked[1]: ("the cat sat! Other.", "ok"), 
                       **{p: (None, "no text") for p in asked[2:7]}, asked[7]: ("The cat sat. A dog ran.", "ok")}
    rows = jobs.compare_paths(spark, asked[:7]).collect()
    assert [(r.doc1, r.doc2, r.edit_similarity) for r in rows] == [(asked[0], asked[1], 0.25)]
    assert read_paths(spark, [str(tmp_path / "none" / "y.txt")]).first().status == "no text"


def test_listings_follow_each_other(spark, tmp_path):
    """Ordered parts, one after the other; a part that was not committed is not read."""
    folder = f"file://{tmp_path}/report"
    assert report.read_listing(spark, folder).count() == 0
    rows = [(i * 7 % 100, i) for i in range(100)]
    lines = spark.createDataFrame(rows, "a int, b int").repartition(5).withColumn("line", F.concat_ws(" ", "a", "b"))
    assert report.append_listing(lines, folder, ["a", "b"]) == 1
    (tmp_path / "report" / "listing-000002").mkdir()
    (tmp_path / "report" / "listing-000002" / "part-00000").write_text("half a part\n")
    assert report.append_listing(lines.limit(3), folder, ["b"]) == 3
    scores = spark.createDataFrame([("b", "c", 0.5, 0.5, 0.5, True), ("a", "b", 0.0, 0.0, 0.0, False)],
                                   "doc1 string, doc2 string, lsh_similarity double, edit_similarity double, overall_similarity double, flagged boolean")
    assert report.append_report(scores, folder) == 4
    got = [(r.part, r.text) for r in report.read_listing(spark, folder).orderBy("part", "position").collect()]
    assert [t for p, t in got if p == 1] == [f"{a} {b}" for a, b in sorted(rows)]
    assert len([t for p, t in got if p == 3]) == 3 and {p for p, _ in got} == {1, 3, 4}
    blocks = "\n".join(t for p, t in got if p == 4)
    assert blocks.index("Document 1: a") < blocks.index("Document 1: b") and blocks.count("Plagiarism Detection Report") == 2


def test_shingle_size_is_bounded():
    with pytest.raises(ValueError):
        Params(k=8)
