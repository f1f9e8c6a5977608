import os
import time

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from snapsync.sources import committed


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "path string, text string").repartition(3)


def texts(spark, root, at=None):
    return tuples(committed.read_committed(spark, root, at))


def names(root):
    return sorted(os.path.join(d, f) for d, _, files in os.walk(root) for f in files)


def test_writes_add_replace_and_remove(spark, tmp_path):
    root = str(tmp_path / "tree")
    assert committed.last_commit(root) == 0 and texts(spark, root) == []
    committed.write_committed(rows(spark, ("C/a.sql", "Ж\r\n"), ("C/b.sql", "2"), ("D/c.sql", "3")), root)
    committed.write_committed(rows(spark, ("C/a.sql", "new"), ("C/b.sql", None), ("D/d.sql", "")), root)
    assert texts(spark, root) == [("C", "a.sql", "new"), ("D", "c.sql", "3")]
    assert texts(spark, root, at=1) == [("C", "a.sql", "Ж\r\n"), ("C", "b.sql", "2"), ("D", "c.sql", "3")]
    committed.write_committed(rows(spark, ("E/e.sql", "only")), root, overwrite=True)
    assert texts(spark, root) == [("E", "e.sql", "only")]
    state = committed.tree_files(spark, root).first()
    assert (state.path, state.size, state.commit) == ("E/e.sql", 4, 3)
    committed.write_committed(rows(spark).limit(0), root, overwrite=True)
    assert texts(spark, root) == [] and committed.last_commit(root) == 4


def test_an_aborted_write_leaves_the_old_tree(spark, tmp_path):
    root = str(tmp_path / "tree")
    committed.write_committed(rows(spark, ("C/a.sql", "1"), ("C/b.sql", "2")), root)
    before, files = texts(spark, root), names(root)
    late = F.when(F.col("path") == "C/z.sql", F.raise_error(F.lit("lost"))).otherwise(F.col("text"))
    failing = rows(spark, *[(f"C/n{i}.sql", "x") for i in range(50)], ("C/a.sql", "9"), ("C/z.sql", "z"))
    with pytest.raises(Exception):
        committed.write_committed(failing.withColumn("text", late.cast("string")), root, overwrite=True)
    assert texts(spark, root) == before and committed.last_commit(root) == 1
    # Tasks that were stopped after the abort may have left files.
    committed.sweep(root)
    time.sleep(1)
    committed.sweep(root, keep_hours=0)
    assert names(root) == files and texts(spark, root) == before


@pytest.mark.parametrize("path", ["../x.sql", "C/../x", "x.sql", "C/.x", "/C/x", "C/d/x", "_C/x"])
def test_odd_paths_are_refused(spark, tmp_path, path):
    root = str(tmp_path / "tree")
    with pytest.raises(Exception):
        committed.write_committed(rows(spark, (path, "x")), root)
    assert committed.last_commit(root) == 0


def test_compare_and_set(spark, tmp_path):
    root = str(tmp_path / "tree")
    committed.write_committed(rows(spark, ("C/a.sql", "1")), root, after=0)
    with pytest.raises(Exception):
        committed.write_committed(rows(spark, ("C/a.sql", "lost")), root, after=0)
    assert texts(spark, root) == [("C", "a.sql", "1")]
    committed.write_committed(rows(spark, ("C/a.sql", "2")), root, after=1)
    assert texts(spark, root) == [("C", "a.sql", "2")]


def test_a_record_is_created_once(tmp_path):
    system, root = committed._place(str(tmp_path))
    assert committed._create(system, root, 1, b"{}")
    assert not committed._create(system, root, 1, b"[]")
    assert os.listdir(tmp_path / "commits") == ["0000000001.json"]


def test_repeated_paths_of_one_write(spark, tmp_path):
    root = str(tmp_path / "tree")
    twice = [("C/a.sql", "1"), ("C/a.sql", "2"), ("C/a.sql", "1"), ("C/a.sql", None)]
    for shuffled in (twice, twice[::-1]):
        committed.write_committed(rows(spark, *shuffled), root)
        assert len(texts(spark, root)) == 1
    assert texts(spark, root, at=1) == texts(spark, root, at=2)
