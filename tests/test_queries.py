"""Registered queries beside their SQL; SNAPSYNC_ALL=1 runs them all."""

import os

import pytest

import __spark_entry__ as entry_points
from check import compare, connect

SF = "/root/testdata/sf0.001"
SAMPLE = (
    "assemble_text author_islands author_islands_ranges catalog_objects4 changed_vs_baseline "
    "diff_indicator effective_changes_ranges epoch_base normalized_text poll_changesets tree_schema"
).split()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize(
    "name", list(entry_points.QUERIES) if os.environ.get("SNAPSYNC_ALL") else SAMPLE
)
def test_query_equals_its_sql(spark, name):
    status, _, _, detail = compare(spark, connect(SF), SF, name)
    assert status in ("same", "rows only"), detail


def test_every_query_has_its_sql():
    assert set(entry_points.oracle_sql()) >= set(entry_points.QUERIES)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
