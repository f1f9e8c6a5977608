from catalog_data import NOW, allowed, bounds, elements, tables
from conftest import at, tuples
from pyspark.sql import functions as F

from snapsync.operators import predicates
from snapsync.plans import changes
from snapsync.sources import catalog


def names(df):
    return sorted({r.short_name for r in df.collect()})


def test_catalog_of_three_and_four_kinds(spark):
    t = tables(spark)
    three = catalog.catalog_objects(t)
    assert three.count() == 9 + 3 + 3
    four = catalog.catalog_objects(t, "PKG").exceptAll(three)
    assert tuples(four, "type", "class_id", "short_name") == [("PACKAGE", "PACKAGES", "PKG")]
    lost = three.where("short_name = 'T_LOST'").first()
    assert lost.class_id is None and lost.modified == at("2024-06-26 10:00:00")


def test_method_window_floor_and_users(spark):
    rows = catalog.method_rows(tables(spark), bounds(spark), allowed(spark))
    # closed at both ends; touched through the diary; null times, users and strangers are out
    assert names(rows) == ["IN", "ON_LAST", "ON_NOW", "TOUCHED"]
    assert rows.count() == 4 * 5
    got = {r.extention: r.text for r in rows.where("short_name = 'IN'").collect()}
    assert got == {"body": "body 1\n", "validate": "", "globals": "g1\ng2\n", "locals": " \n", "script": ""}


def test_blank_parts_are_dropped(spark):
    rows = changes.changes_of_kind(tables(spark), "METHOD", bounds(spark), allowed(spark))
    assert tuples(rows.where("short_name = 'IN'"), "extention") == [("body",), ("globals",)]


def test_view_rows(spark):
    rows = catalog.view_rows(tables(spark), bounds(spark), allowed(spark))
    assert tuples(rows, "short_name", "action_date", "user_modified", "condition") == [
        ("V_IN", at("2024-06-27"), "ann", "where")
    ]
    text = changes.normalized_rows(rows, "VIEW").first().text
    assert text == "where group"


def test_trigger_rows_know_no_user(spark):
    rows = changes.changes_of_kind(tables(spark), "TRIGGER", bounds(spark), allowed(spark))
    assert tuples(rows, "class_id", "short_name", "user_modified", "text") == [
        ("TBL", "T_IN", None, "CREATE OR REPLACE TRIGGER T_IN after begin")
    ]


def test_window_or_folder_differs_per_kind(spark):
    t, b, users = tables(spark), bounds(spark), allowed(spark)
    tree = elements(
        spark,
        ("METHOD", "C", "old"),
        ("VIEW", "C", "V_OLD"),
        ("VIEW", "C", "v_floor"),
        ("TRIGGER", "TBL", "T_OLD"),
    )

    def found(kind, strict=False):
        return names(changes.window_or_folder(t, kind, b, users, tree, strict=strict))

    assert found("METHOD") == ["IN", "OLD", "ON_LAST", "ON_NOW", "TOUCHED"]
    # the floor holds for views of the folder, too
    assert found("VIEW") == ["V_FLOOR", "V_IN"]
    assert found("TRIGGER") == ["T_IN"]
    assert found("VIEW", strict=True) == ["V_FLOOR", "V_IN", "V_OLD"]
    assert found("TRIGGER", strict=True) == ["T_IN", "T_OLD"]


def test_empty_tree_leaves_the_window(spark):
    t, b, users = tables(spark), bounds(spark), allowed(spark)
    both = changes.changes_or_folder(t, b, users, elements(spark, ("VIEW", "X", "X")).limit(0))
    columns = ["type", "class_id", "short_name", "extention", "text"]
    assert tuples(both, *columns) == tuples(changes.changes_all(t, b, users), *columns)


def test_consecutive_windows_give_the_long_one(spark):
    t, users = tables(spark), allowed(spark)
    middle = at("2024-06-28")
    columns = ["type", "short_name", "extention", "text"]
    whole = tuples(changes.changes_all(t, bounds(spark), users), *columns)
    first = tuples(changes.changes_all(t, bounds(spark, now=middle), users), *columns)
    second = tuples(changes.changes_all(t, bounds(spark, last=middle), users), *columns)
    assert set(first) | set(second) == set(whole)


def test_lookback_is_strict_and_open(spark):
    objects = catalog.catalog_objects(tables(spark))
    days = F.make_dt_interval(days=F.lit(5))
    found = objects.where(predicates.in_lookback(F.col("modified"), F.lit(NOW), days))
    assert {"FUTURE", "ON_NOW"} <= set(names(found))
    assert "ON_LAST" not in names(found)


def test_last_modification_and_users(spark):
    t = tables(spark)
    assert catalog.max_modified(t).first().modified == at("2024-07-02")
    now = F.lit(NOW)
    assert [r[0] for r in catalog.recent_users(t, now).collect()] == [None, "ANN", "Ann", "ann", "bob"]


def test_source_lines_are_in_order(spark):
    rows = catalog.source_lines(tables(spark)).collect()
    order = [(r.class_id, r.short_name, r.type, r.line) for r in rows]
    assert order == sorted(order)


def test_key_selections(spark):
    objects = catalog.catalog_objects(tables(spark))
    listed = spark.createDataFrame([("C.IN,C.V_IN",), ("C.OLD.x",)], "list string")
    assert names(predicates.by_list(objects, listed, "list")) == ["IN", "OLD", "V_IN"]
    keys = elements(spark, ("METHOD", "C", "IN"), ("VIEW", "C", "IN"))
    assert names(predicates.by_keys(objects, keys)) == ["IN"]
    assert predicates.by_keys(objects, keys.limit(0)).isEmpty()
    assert names(predicates.by_folder(objects, elements(spark, ("METHOD", "C", "in")))) == ["IN"]
    assert names(predicates.any_null(objects)) == ["NO_TIME", "T_LOST"]
