import os

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from snapsync.functions.names import object_path
from snapsync.sources import tree


@pytest.fixture
def root(tmp_path):
    for name in (
        "C/N.sql", "C/N.body.sql", "C/N.locals.sql", "C/N.package body.sql", "C/a.b.trg.sql",
        "TESTS/N.sql", ".git/HEAD", "C/.hidden.sql", "C/sub/deep.sql", "top.sql",
    ):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(f"text of {name}\n", encoding="utf8")
    return str(tmp_path)


def test_listing_takes_files_two_levels_deep(spark, root):
    assert tuples(tree.list_tree(spark, root)) == [
        (".git", "HEAD"), ("C", "N.body.sql"), ("C", "N.locals.sql"), ("C", "N.package body.sql"), ("C", "N.sql"),
        ("C", "a.b.trg.sql"), ("TESTS", "N.sql"),
    ]


def test_both_classifiers_on_files(spark, root):
    files = tree.list_tree(spark, root)
    assert tuples(tree.objects_in_folder(files), "type", "class_id", "short_name") == [
        ("METHOD", "C", "N"), ("PACKAGE", "C", "N"), ("TRIGGER", "C", "a"), ("VIEW", "C", "N"),
    ]
    assert tuples(tree.tree_schema(files)) == [
        ("METHOD", "C", "N"), ("UNKNOWN", "C", "N"), ("UNKNOWN", "C", "a"), ("VIEW", "C", "N"),
    ]
    assert tree.tree_elements(files).count() == 5
    assert tuples(tree.folder_name_sets(files)) == [("C", "N"), ("C", "a")]


def test_whole_texts(spark, root):
    texts = {(r.folder, r.file): r.text for r in tree.read_tree(spark, root).collect()}
    assert texts["C", "N.package body.sql"] == "text of C/N.package body.sql\n"


def test_single_byte_encodings(spark, tmp_path):
    text = "Текст «Ж» № 5\nline"
    (tmp_path / "C").mkdir()
    (tmp_path / "C" / "n.tst").write_bytes(text.encode("cp1251"))
    assert tree.read_tree(spark, str(tmp_path), "cp1251").first().text == text


def test_paths_stay_in_a_mounted_root(spark, tmp_path):
    rows = spark.createDataFrame([("C/../../out.sql", "x")], "path string, text string")
    with pytest.raises(Exception, match="leads out of the tree"):
        tree.write_tree(rows, str(tmp_path / "root"))
    assert not (tmp_path / "out.sql").exists()
    with pytest.raises(ValueError, match="s3a"):
        tree.write_tree(rows, "s3a://bucket/tree")
    inside = spark.createDataFrame([("C/a.sql", "x")], "path string, text string")
    tree.write_tree(inside, f"file://{tmp_path}/root")
    assert (tmp_path / "root" / "C" / "a.sql").read_text() == "x"


def test_written_tree_reads_back(spark, tmp_path):
    rows = spark.createDataFrame(
        [("C", "A", "body", "x\r\ny"), ("C", "A", None, "v"), ("D", "B", "trg", "Ж"), ("D", "E", "", "")],
        "class_id string, short_name string, extention string, text string",
    )
    path = object_path(F.col("class_id"), F.col("short_name"), F.col("extention"))
    rows = rows.withColumn("path", path)
    root = str(tmp_path)
    for _ in range(2):
        tree.write_tree(rows, root)
    assert tuples(tree.read_tree(spark, root)) == [
        ("C", "A.body.sql", "x\r\ny"), ("C", "A.sql", "v"), ("D", "B.trg.sql", "Ж"),
    ]
    tree.write_tree(rows.withColumn("text", F.lit(None).cast("string")), root)
    assert [f for _, _, files in os.walk(root) for f in files if not f.startswith(".")] == []
