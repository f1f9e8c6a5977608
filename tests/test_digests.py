"""Digest trees, and pulls that read only the classes that they tell apart."""

import random
from dataclasses import replace

import pytest
from catalog_data import tables
from conftest import tuples
from pyspark.sql import functions as F

from snapsync.operators.sizing import written
from snapsync.plans import digests, pull
from snapsync.plans.pull import SNAPSHOT, pull_all, snapshot_of_files
from snapsync.sources import catalog
from snapsync.sources.catalog import catalog_objects

COLUMNS = "source_db string, class_id string, type string, short_name string, v string"


def plain_rows(n, seed):
    chosen = random.Random(seed)
    pick = lambda *values: chosen.choice(values)
    return [
        (pick("a", "b", None), pick("C", "D", None), pick("VIEW", "METHOD"), f"N{chosen.randrange(6)}", pick("x", "", None))
        for _ in range(n)
    ]


def tree(spark, rows):
    return digests.digest_tree(spark.createDataFrame(rows, COLUMNS), "v")


def test_levels_add_up(spark):
    rows = plain_rows(200, 1)
    found = tree(spark, rows).collect()
    for level, keys in digests.LEVELS.items():
        own = [r for r in found if r.level == level]
        groups = {tuple(r[digests.KEY.index(k)] for k in keys) for r in rows}
        assert {tuple(r[k] for k in keys) for r in own} == groups and len(own) == len(groups)
        assert [sum(r[c] for r in own) for c in digests.DIGEST] == [
            sum(r[c] for r in found if r.level == "object") for c in digests.DIGEST
        ]
    shuffled = tree(spark, random.Random(2).sample(rows, len(rows)))
    assert tuples(shuffled) == sorted(map(tuple, found), key=repr)


def test_rows_are_moved_once(spark):
    rows = plain_rows(200, 4)
    plan = tree(spark, rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    for lowest in digests.LEVELS:
        part = digests.digest_tree(spark.createDataFrame(rows, COLUMNS), "v", lowest=lowest)
        levels = list(digests.LEVELS)[: list(digests.LEVELS).index(lowest) + 1]
        assert tuples(part) == tuples(tree(spark, rows).where(F.col("level").isin(levels)))


@pytest.mark.parametrize("level", ["source", "class", "object"])
def test_differing_keys(spark, level):
    rows = plain_rows(60, 3)
    other = rows[4:] + [("c", "C", "VIEW", "N1", "x")] + rows[10:11]
    keys = digests.LEVELS[level]

    def groups(found):
        held = {}
        for r in found:
            held.setdefault(tuple(r[digests.KEY.index(k)] for k in keys), []).append(repr(r))
        return {k: sorted(v) for k, v in held.items()}

    one, two = groups(rows), groups(other)
    want = sorted((k for k in one.keys() | two.keys() if one.get(k) != two.get(k)), key=repr)
    assert tuples(digests.differing(tree(spark, rows), tree(spark, other), level)) == want
    assert digests.differing(tree(spark, rows), tree(spark, rows), level).isEmpty()
    assert digests.differing(tree(spark, rows), tree(spark, []), "source").count() == 3


def files_of(spark, objects):
    """A tree in which every object of the catalogue has a file, and some that are no objects."""
    suffix = {"METHOD": ".body.sql", "VIEW": ".sql", "TRIGGER": ".trg.sql"}
    rows = [
        (o.source_db, o.class_id, o.short_name + suffix[o.type], "old text")
        for o in objects.collect() if o.type in suffix and o.class_id
    ]
    rows += [(r[0], r[1], "GONE.sql", "x") for r in rows[:2]] + [(r[0], r[1], "ODD.txt", "x") for r in rows[:1]]
    return snapshot_of_files(spark.createDataFrame(rows, "source_db string, folder string, file string, text string"))


def second(t, name="z"):
    """The same tables, once more as another source."""

    def both(df):
        return df.unionByName(df.withColumn("source_db", F.lit(name)))

    parts = {k: both(v) for k, v in vars(t).items() if k not in ("line_ties",) and v is not None}
    return replace(t, **parts)


def test_equals_the_full_pull(spark):
    t = second(tables(spark))
    pulled = pull_all(t, files_of(spark, catalog_objects(t)))
    pulled = spark.createDataFrame(pulled.collect(), pulled.schema)
    kept = digests.pull_digests(t, pulled)
    same = digests.changed_classes(digests.pull_digests(t, pulled), kept)
    assert same.isEmpty()
    assert tuples(digests.pull_changed_classes(t, pulled, kept), *SNAPSHOT) == tuples(pulled, *SNAPSHOT)
    # a file edited, one added that is no object, an object moved in the source
    key = (F.col("source_db") == "z") & (F.col("type") == "VIEW")
    edited = pulled.withColumn("text", F.when(key, F.lit("by hand")).otherwise(F.col("text")))
    stray = pulled.limit(1).withColumns({"type": F.lit("UNKNOWN"), "path": F.lit("C/ODD.txt")})
    edited = edited.unionByName(stray)
    later = replace(t, methods=t.methods.withColumn("modified", F.col("modified") + F.make_dt_interval(days=F.lit(1))))
    for tables_now, files in ((t, edited), (later, edited)):
        found = digests.pull_changed_classes(tables_now, files, kept)
        assert tuples(found, *SNAPSHOT) == tuples(pull_all(tables_now, files), *SNAPSHOT)
    # without kept digests everything is pulled
    found = digests.pull_changed_classes(t, edited, kept.limit(0))
    assert tuples(found, *SNAPSHOT) == tuples(pull_all(t, edited), *SNAPSHOT)


def test_other_sources_are_not_read(spark, tmp_path):
    """Lines of a source without changed classes are neither listed nor scanned."""
    t = tables(spark)
    stored = {}
    for name in ("a", "z"):
        t.lines.withColumn("source_db", F.lit(name)).write.parquet(str(tmp_path / name))
        read = spark.read.schema(t.lines.schema).parquet(str(tmp_path / name))
        stored[name] = read.withColumn("source_db", F.lit(name))
    both = replace(second(t), lines=stored["a"].unionByName(stored["z"]))
    classes = both.methods.where("source_db = 'z'").select("source_db", "class_id").distinct()
    cut = digests.of_classes(both, classes)
    plan = cut.lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1
    kept = cut.lines.select("source_db").distinct().collect()
    assert [r.source_db for r in kept] == ["z"]
    assert both.lines.select("source_db").distinct().count() == 2


def kept_steps(monkeypatch, *modules):
    """What the modules write from now on: (name, DataFrame before it is written)."""
    steps = []

    def noted(df, name):
        steps.append((name, df))
        return written(df, name)

    for module in modules:
        monkeypatch.setattr(module, "written", noted)
    return steps


def test_tree_is_read_once(spark, tmp_path, monkeypatch):
    """Not once for each kind of the catalogue; null is no key on either side."""
    t = tables(spark)
    nameless = t.methods.limit(1).withColumns({"class_id": F.lit(None).cast("string")})
    t = replace(t, methods=t.methods.unionByName(nameless))
    files = files_of(spark, catalog_objects(t))
    stray = files.where("type = 'METHOD'").limit(1).withColumn("class_id", F.lit(None).cast("string"))
    files.unionByName(stray).write.parquet(str(tmp_path / "tree"))
    stored = spark.read.parquet(str(tmp_path / "tree"))
    steps = kept_steps(monkeypatch, pull)
    found = pull_all(t, stored)
    (keys,) = [df for name, df in steps if name == "keys"]
    assert keys._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1
    joined = pull.predicates.by_keys(catalog_objects(t), stored).select(*pull.OBJECT_KEY).distinct()
    assert tuples(keys) == tuples(joined) != []
    assert found.where("class_id is null").isEmpty()


def test_objects_are_not_compared(spark, monkeypatch):
    """The digests of a new pull end at the classes, and are taken once."""
    t = second(tables(spark))
    pulled = pull_all(t, files_of(spark, catalog_objects(t)))
    kept = digests.pull_digests(t, pulled)
    steps = kept_steps(monkeypatch, digests)
    digests.pull_changed_classes(t, pulled, kept)
    (now,) = [df for name, df in steps if name == "digests"]
    assert {r.level for r in now.select("level").distinct().collect()} == {"source", "class"}


def test_texts_of_many_methods(spark, monkeypatch):
    t = second(tables(spark))
    files = files_of(spark, catalog_objects(t))
    want = tuples(pull_all(t, files))
    monkeypatch.setattr(catalog, "FEW_METHODS", 0)
    found = pull_all(t, files)
    assert tuples(found) == want
    assert "ShuffledHashJoin" in found._jdf.queryExecution().executedPlan().toString()
