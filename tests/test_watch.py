import os

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from snapsync.sources import tree, watch


def put(root, when, **texts):
    for name, text in texts.items():
        path = root / "C" / f"{name}.sql"
        path.parent.mkdir(parents=True, exist_ok=True)
        if text is None:
            path.unlink()
            continue
        path.write_text(text, encoding="utf8", newline="")
        os.utime(path, (when, when))


def found(df):
    return tuples(df, "file", "change", "text")


def state(spark, root):
    return {(r.folder, r.file): r.text for r in tree.read_tree(spark, str(root)).collect()}


def batch_diff(old, new):
    rows = [(k[1], "added" if k not in old else "changed", new[k]) for k in new if old.get(k) != new[k]]
    return sorted(rows + [(k[1], "deleted", None) for k in old if k not in new], key=repr)


DROPS = [
    {"a": "1", "b": "Ж\r\n", "c": "3"},
    {"a": "1", "b": "new", "c": None, "d": "4"},  # a is written anew with the same text
    {"b": "back", "c": "again", "d": None, "e": "5"},
]


def test_three_drops_equal_the_batch_diff_and_the_stream(spark, tmp_path):
    root, w = tmp_path / "tree", watch.TreeWatch(str(tmp_path / "tree"), str(tmp_path / "state"))
    root.mkdir()
    assert w.look(spark).count() == 0
    before, seen = {}, []
    for i, drop in enumerate(DROPS):
        put(root, 1_700_000_000 + 60 * i, **drop)
        now = state(spark, root)
        rows = found(w.look(spark))
        assert rows == batch_diff(before, now)
        before, seen = now, seen + rows
        assert tuples(w.known(spark), "folder", "file") == sorted(now)
    assert w.look(spark).count() == 0
    query = (
        w.stream(spark).writeStream.format("memory").queryName("watched")
        .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert found(spark.table("watched")) == sorted(seen, key=repr)
    assert found(w.changes(spark, 3)) == [("b.sql", "changed", "new"), ("c.sql", "deleted", None), ("d.sql", "added", "4")]


def test_a_tree_without_files_and_no_tree(spark, tmp_path):
    root, w = tmp_path / "tree", watch.TreeWatch(str(tmp_path / "tree"), str(tmp_path / "state"))
    put(root, 1_700_000_000, a="1")
    w.look(spark)
    put(root, 0, a=None)
    assert found(w.look(spark)) == [("a.sql", "deleted", None)]
    put(root, 1_700_000_000, a="1")
    w.look(spark)
    root.rename(tmp_path / "elsewhere")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        w.look(spark)
    assert w.last(spark) == 3


def test_an_older_file_and_one_of_the_same_size(spark, tmp_path):
    root, w = tmp_path / "tree", watch.TreeWatch(str(tmp_path / "tree"), str(tmp_path / "state"))
    put(root, 1_700_000_000, a="11", b="22")
    w.look(spark)
    put(root, 1_600_000_000, b="33", c="")
    assert found(w.look(spark)) == [("b.sql", "changed", "33")]
    put(root, 1_700_000_060, b="")
    assert found(w.look(spark)) == [("b.sql", "deleted", None)]


def test_only_candidates_are_opened(spark, tmp_path):
    root, w = tmp_path / "tree", watch.TreeWatch(str(tmp_path / "tree"), str(tmp_path / "state"))
    put(root, 1_700_000_000, a="1", b="2")
    w.look(spark)
    put(root, 1_700_000_060, b="3")
    os.chmod(root / "C" / "a.sql", 0)
    plan = w._read(spark, watch.listed_changes(w.known(spark), listing(spark, root)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(modificationTime" in text
    assert found(w.look(spark)) == [("b.sql", "changed", "3")]


def listing(spark, root):
    return tree._files(spark, str(root)).select(
        "folder", "file", F.col("modificationTime").alias("modified"), F.col("length").alias("size")
    )


def test_a_second_look_at_the_same_time_is_refused(spark, tmp_path, monkeypatch):
    root, w = tmp_path / "tree", watch.TreeWatch(str(tmp_path / "tree"), str(tmp_path / "state"))
    put(root, 1_700_000_000, a="1")
    real = watch.move_if_absent

    def slower(spark, source, target):
        monkeypatch.setattr(watch, "move_if_absent", real)
        w.look(spark)
        return real(spark, source, target)

    monkeypatch.setattr(watch, "move_if_absent", slower)
    with pytest.raises(watch.Conflict):
        w.look(spark)
    assert w.last(spark) == 1 and found(w.changes(spark, 1)) == [("a.sql", "added", "1")]
    assert os.listdir(tmp_path / "state" / "attempts") == []
