from datetime import datetime

import pytest
from pyspark.sql import functions as F

from snapsync.functions import names, text, times

C = None


@pytest.fixture(autouse=True)
def named_column(spark):
    """The column under test; columns need a session."""
    global C
    C = F.col("c")


def test_nonblank_agrees_with_strip(column):
    texts = ["", " ", "\t\r\n\x0b\x0c", "\xa0 　", "\x1c\x1d\x85", "a", " a\n", "​", None]
    assert column(texts, text.nonblank(C)) == [
        t is not None and t.strip() != "" for t in texts
    ]


def test_nonempty_keeps_blanks(column):
    assert column(["", " ", None, "x"], text.nonempty(C)) == [False, True, False, True]


def test_normalized_text(column):
    texts = ["a \t\nb\n", "no end  ", "\n\n", "a\r\nb", " " * 20000 + "x", None, "  \n"]
    want = ["a\r\nb\r\n", "no end  ", "\r\n\r\n", "a\r\nb", " " * 20000 + "x", None, "\r\n"]
    assert column(texts, text.normalized_text(C)) == want


def test_line_slice(column):
    texts = ["head\n2\na\nb\nc", "head\n9\na\nb", "head\n0\na", "head\nx\na", "head", "h\n 1 \na\nb"]
    assert column(texts, text.line_slice(C)) == ["a\nb", "a\nb", "", None, None, "a"]


def test_strip_domain(column):
    assert column(["DOM.U", "A.B.U", "U", None], text.strip_domain(C)) == ["U", "U", "U", None]


def test_view_and_trigger_text(spark):
    df = spark.createDataFrame([("a", None, "c"), (None, None, None)], "x string, y string, z string")
    got = df.select(
        text.view_text(F.col("x"), F.col("y"), F.col("z")), text.trigger_text(F.col("x"), F.col("z"))
    ).collect()
    assert [tuple(r) for r in got] == [
        ("ac", "CREATE OR REPLACE TRIGGER ac"),
        ("", "CREATE OR REPLACE TRIGGER "),
    ]


def test_class_rules(column):
    tables = ["Z#A", "Z#A#B", "NOHASH", None]
    assert column(tables, names.class_after_prefix(C)) == ["A", "A#B", "HASH", None]
    assert column(tables, names.class_after_hash(C)) == ["A", "A#B", "NOHASH", None]
    assert column(tables, names.class_between_hashes(C)) == ["A", "A", None, None]


FILES = [
    "N.sql", "N.body.sql", "N.BODY.sql", "N.x.sql", "N", "a.b.trg.sql", "N.trg.sql",
    "N.package body.sql", ".hidden.sql", "N.bdy", "N.spc", "N.", "N.sql.",
]


def test_classifier_by_pieces(column):
    assert column(FILES, names.kind_by_pieces(C)) == [
        "VIEW", "METHOD", "METHOD", None, "VIEW", "TRIGGER", "TRIGGER", "PACKAGE", None,
        "VIEW", "VIEW", "VIEW", None,
    ]


def test_classifier_by_suffix(column):
    assert column(FILES, names.kind_by_suffix(C)) == [
        "VIEW", "METHOD", "UNKNOWN", "UNKNOWN", "UNKNOWN", "UNKNOWN", "TRIGGER", "UNKNOWN",
        "VIEW", "PACKAGE", "PACKAGE", "UNKNOWN", "UNKNOWN",
    ]


def test_object_name_is_the_text_before_the_first_dot(column):
    assert column(["a.b.trg.sql", "N", ".x"], names.object_name(C)) == ["a", "N", ""]


def test_file_names(column):
    name = F.lit("N")
    assert column(["body", "", None, "x."], names.file_name(name, C)) == [
        "N.body.sql", "N.sql", "N.sql", "N.x.sql",
    ]
    assert column(["trg"], names.object_path(F.lit("C"), name, C)) == ["C/N.trg.sql"]


def test_labels(column):
    label = names.object_label(C, F.lit("CLS"), F.lit("NAME"))
    assert column(["METHOD", "VIEW"], label) == ["Method ::[CLS].[NAME]", "View ::[CLS].[NAME]"]
    assert column(["u/p@db", "u/p@x@db", "db"], names.source_label(C)) == ["db", "db", None]


def test_part_extension(column):
    kinds = ["EXECUTE", "VALIDATE", "PUBLIC", "PRIVATE", "VBSCRIPT", "OTHER"]
    assert column(kinds, names.part_extension(C)) == [
        "body", "validate", "globals", "locals", "script", None,
    ]


def test_object_times_in_both_spellings(column):
    t = datetime(2024, 2, 3, 4, 5, 6)
    texts = ["2024-02-03:04:05:06", "2024-02-03 04:05:06", "", "soon", None]
    assert column(texts, times.parse_object_time(C)) == [t, t, None, None, None]
    assert column(["03/02/2024 04:05:06", ""], times.parse_marker(C)) == [t, None]


def test_durations(column):
    origin = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    seconds = F.timestamp_diff("SECOND", origin, origin + times.parse_duration(C))
    texts = ["36h", "3d", "15m", "7s", "3w", "h", "", None]
    assert column(texts, seconds) == [36 * 3600, 3 * 86400, 900, 7, None, None, None, None]


def test_author_time_and_epochs(column):
    t = F.col("c").cast("timestamp_ntz")
    stamps = ["2024-03-01 01:02:03"]
    assert column(stamps, times.author_time(t, F.lit(0), -3)) == ["29.02.2024T22:02:03"]
    assert column(stamps, times.author_time(t, F.lit(2), -3)) == ["02.03.2024T22:02:03"]
    db = F.lit("day")
    assert column(stamps, times.epoch_name(db, t)) == ["day_2024.03.01_01.02"]
    assert column(stamps, times.epoch_name(db, t, "day_first")) == ["day_01.03.2024_01.02"]
    assert column(stamps, times.epoch_name(db, t, "compact")) == ["day_20240301_0102"]


def test_clock_shift_counts_whole_days(column):
    local = F.lit("2024-03-02 00:10:00").cast("timestamp_ntz")
    stamps = ["2024-03-01 23:50:00", "2024-03-02 05:00:00", "2024-03-05 00:00:00"]
    assert column(stamps, times.clock_shift(local, C.cast("timestamp_ntz"))) == [1, 0, -3]
