import pytest
from conftest import tuples

from snapsync.operators.assembly import assemble_text, list_names, nested_lines

LINES = [
    (1, "body", 1, "a"),
    (1, "body", 2, None),
    (1, "body", 7, "c"),
    (1, "locals", 1, ""),
    (2, "body", 3, "  "),
    (2, "body", 1, "x\ny"),
]


@pytest.fixture
def lines(spark):
    return spark.createDataFrame(LINES, "id int, part string, line int, text string")


@pytest.mark.parametrize("block", [1, 2, 3, 4096])
def test_each_line_ends_and_null_lines_are_empty(lines, block):
    got = assemble_text(lines, ["id", "part"], lines_per_block=block)
    assert tuples(got, "id", "part", "text") == [
        (1, "body", "a\n\nc\n"),
        (1, "locals", "\n"),
        (2, "body", "x\ny\n  \n"),
    ]


def test_a_long_text_is_joined_from_blocks(spark):
    lines = spark.range(5000).selectExpr("1 as id", "cast(id as int) as line", "string(id) as text")
    short = spark.createDataFrame([(2, 1, "z")], "id int, line int, text string")
    got = assemble_text(lines.union(short), ["id"], lines_per_block=100)
    want = "".join(f"{i}\n" for i in range(5000))
    assert tuples(got, "id", "text") == [(1, want), (2, "z\n")]


def test_nested_lines_keep_nulls_in_order(lines):
    got = {(r.id, r.part): [tuple(x) for x in r.lines] for r in nested_lines(lines, ["id", "part"]).collect()}
    assert got[1, "body"] == [(1, "a"), (2, None), (7, "c")]


@pytest.mark.parametrize("how", ["window", "ranges"])
def test_names_go_on_in_further_rows(spark, how):
    rows = [("c", f"N{i:02}") for i in range(7)] * 2 + [("d", None), ("e", "X")]
    df = spark.createDataFrame(rows, "class string, name string")
    got = list_names(df, ["class"], "name", per_row=3, how=how)
    assert tuples(got, "class", "part_no", "names") == [
        ("c", 0, "N00, N01, N02"),
        ("c", 1, "N03, N04, N05"),
        ("c", 2, "N06"),
        ("e", 0, "X"),
    ]
