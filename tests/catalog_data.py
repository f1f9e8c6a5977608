"""A small source: two methods, two views, two triggers."""

from conftest import at

from snapsync.sources.catalog import Tables

NOW = at("2024-06-30 12:00:00")
LAST = at("2024-06-25 12:00:00")


def tables(spark, methods=None):
    frame = spark.createDataFrame
    time = "timestamp_ntz"
    return Tables(
        methods=frame(
            methods
            or [
                ("a", 1, "C", "IN", at("2024-06-26"), "Ann", "P"),
                ("a", 2, "C", "OLD", at("2024-01-01"), "ann", "P"),
                ("a", 3, "C", "FUTURE", at("2024-07-02"), "ann", "P"),
                ("a", 4, "C", "ALIEN", at("2024-06-26"), "bob", "P"),
                ("a", 5, "C", "NOBODY", at("2024-06-26"), None, "P"),
                ("a", 6, "C", "TOUCHED", at("2024-06-10"), "ANN", "P"),
                ("a", 7, "C", "ON_LAST", LAST, "ann", "P"),
                ("a", 8, "C", "ON_NOW", NOW, "ann", "P"),
                ("a", 9, "C", "NO_TIME", None, "ann", "P"),
            ],
            f"source_db string, id long, class_id string, short_name string, modified {time}, "
            "user_modified string, package_name string",
        ),
        lines=frame(
            [("a", i, "EXECUTE", 1, f"body {i}") for i in range(1, 10)]
            + [("a", 1, "PUBLIC", 2, "g2"), ("a", 1, "PUBLIC", 1, "g1"), ("a", 1, "PRIVATE", 1, " ")],
            "source_db string, id long, type string, line int, text string",
        ),
        method_diary=frame(
            [("a", 6, at("2024-06-29")), ("a", 6, at("2024-06-11")), ("a", 1, at("2024-06-01"))],
            f"source_db string, id long, time {time}",
        ),
        criteria=frame(
            [
                ("a", 1, "C", "V_IN", at("2024-06-26"), "where", None, " group"),
                ("a", 2, "C", "V_OLD", at("2024-01-01"), "old", None, None),
                ("a", 3, "C", "V_FLOOR", at("2024-06-01"), "floor", None, None),
            ],
            f"source_db string, id long, class_id string, short_name string, modified {time}, "
            "condition string, order_by string, group_by string",
        ),
        criteria_diary=frame(
            [
                ("a", 1, at("2024-06-26"), 1, "INSERTED", "D.ann"),
                ("a", 1, at("2024-06-27"), 2, "OPENED", "D.bob"),
                ("a", 2, at("2024-06-27"), 3, "UPDATED", "D.ann"),
            ],
            f"source_db string, id long, time {time}, seq long, action string, user_id string",
        ),
        triggers=frame(
            [("a", "T_IN", "Z#TBL", "T_IN after ", "begin"), ("a", "T_OLD", "Z#TBL", "T_OLD ", None)],
            "source_db string, trigger_name string, table_name string, description string, "
            "trigger_body string",
        ),
        user_objects=frame(
            [
                ("a", "T_IN", "TRIGGER", "2024-06-26:10:00:00"),
                ("a", "T_OLD", "TRIGGER", "2024-01-01 10:00:00"),
                ("a", "T_LOST", "TRIGGER", "2024-06-26:10:00:00"),
                ("a", "PROC", "PROCEDURE", "2024-06-26:10:00:00"),
            ],
            "source_db string, object_name string, object_type string, timestamp string",
        ),
        all_objects=frame(
            [("a", "PKG", "Package", at("2024-06-26")), ("a", "PKG2", "PACKAGE", at("2024-06-26"))],
            f"source_db string, object_name string, object_type string, last_ddl_time {time}",
        ),
    )


def bounds(spark, last=LAST, now=NOW):
    return spark.createDataFrame(
        [("a", last, now)], "source_db string, last timestamp_ntz, as_of timestamp_ntz"
    )


def allowed(spark):
    return spark.createDataFrame([("aNN",), (None,)], "user_name string")


def elements(spark, *keys):
    rows = [("a", *key) for key in keys]
    return spark.createDataFrame(
        rows, "source_db string, type string, class_id string, short_name string"
    )
