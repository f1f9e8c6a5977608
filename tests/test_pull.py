from catalog_data import NOW, elements, tables
from conftest import at, tuples
from pyspark.sql import functions as F

from snapsync.plans import pull
from snapsync.sources import tree

FILES = [
    ("C", "IN.body.sql", "stored"),
    ("C", "IN.script.sql", "stored"),
    ("C", "V_IN.sql", "stored"),
    ("C", "GONE.sql", "stored"),
    ("C", "NOTE.txt", "stored"),
    ("TBL", "T_IN.trg.sql", "stored"),
    ("PACKAGES", "PKG.bdy", "stored"),
    ("PACKAGES", "PKG2.spc", "stored"),
    ("TESTS", "IN.body.sql", "stored"),
]
AFTER_PULL = [
    ("C/IN.body.sql", "body 1\n"),
    ("C/IN.globals.sql", "g1\ng2\n"),
    ("C/IN.locals.sql", " \n"),
    ("C/V_IN.sql", "where group"),
    ("PACKAGES/PKG.bdy", "stored"),
    ("TBL/T_IN.trg.sql", "CREATE OR REPLACE TRIGGER T_IN after begin"),
]


def snapshot(spark):
    rows = [("a", *f) for f in FILES]
    files = spark.createDataFrame(rows, "source_db string, folder string, file string, text string")
    return pull.snapshot_of_files(files)


def test_full_pull(spark):
    t = tables(spark)
    once = pull.pull(t, snapshot(spark), package_name="PKG")
    assert tuples(once, "path", "text") == AFTER_PULL
    twice = pull.pull_all(t, once, "PKG")
    assert tuples(twice, "path", "text") == AFTER_PULL


def test_pull_of_a_time(spark):
    t, stored = tables(spark), snapshot(spark)
    interval = F.make_dt_interval(days=F.lit(10))
    last = pull.pull(t, stored, as_of=F.lit(NOW), interval=interval)
    got = dict(tuples(last, "path", "text"))
    assert got["C/IN.body.sql"] == "body 1\n" and "C/IN.script.sql" not in got
    assert got["C/FUTURE.body.sql"] == "body 3\n" and got["C/GONE.sql"] == "stored"
    since = pull.pull(t, stored, as_of=F.lit(NOW), last=F.lit(at("2024-06-26")))
    assert "C/FUTURE.body.sql" not in dict(tuples(since, "path", "text"))


def test_pull_of_a_list(spark):
    listed = spark.createDataFrame([("C", "OLD")], "class_id string, short_name string")
    got = dict(tuples(pull.pull(tables(spark), snapshot(spark), listed=listed), "path", "text"))
    assert got["C/OLD.body.sql"] == "body 2\n" and got["C/IN.body.sql"] == "stored"


def test_export_leaves_packages_out(spark):
    keys = elements(spark, ("PACKAGE", "PACKAGES", "PKG"), ("METHOD", "C", "IN"))
    got = pull.export_parts(tables(spark), keys)
    assert got.count() == 5 and got.where("text is null").count() == 2


def test_parts_to_rows_and_back(spark):
    long = spark.createDataFrame(
        [("C", "A", "body", "x"), ("C", "A", "locals", "y"), ("C", "B", "script", "z")],
        "class_id string, short_name string, part string, text string",
    )
    assert tuples(tree.parts_long(tree.parts_wide(long))) == tuples(long)


def test_publish_rows(spark):
    parts = spark.createDataFrame(
        [
            ("a", "METHOD", "c", "m", "body", "x"),
            ("a", "METHOD", "c", "other", "body", "y"),
            ("a", "VIEW", "c", "m", None, "v"),
        ],
        "source_db string, type string, class_id string, short_name string, part string, text string",
    )
    listed = spark.createDataFrame([("c.m,x.y",)], "list string")
    assert tuples(pull.publish_rows(parts, listed, "list")) == [
        ("a", "C", "M", "x", None, None, None, None)
    ]


def test_refresh_of_class_folders(spark):
    rows = [("a", "C", "IN.any", ""), ("a", "C", "V_IN.sql", "")]
    files = spark.createDataFrame(rows, "source_db string, folder string, file string, text string")
    got = pull.refresh_classes(tables(spark), files)
    assert tuples(got, "extention", "text") == [
        ("body", "body 1\r\n"), ("globals", "g1\r\ng2\r\n"), ("locals", "\r\n"),
    ]
