import pytest
from conftest import tuples
from pyspark.sql import types as T

from snapsync.plans import publish
from snapsync.plans.publish import Ledger, ParquetSink

COLUMNS = "source_db string, class_id string, short_name string, body string, globals string"


def rows(spark, *values):
    return spark.createDataFrame([("a", "C", *v) for v in values], COLUMNS).repartition(3)


@pytest.fixture
def parts(tmp_path):
    ledger = Ledger(str(tmp_path / "ledger"), T.StructType.fromDDL(COLUMNS))
    return ledger, ParquetSink(str(tmp_path / "staging"), ledger.schema)


def staged(spark, sink):
    return tuples(sink.rows(spark), "publish_no", "short_name", "body", "globals")


def test_a_repeated_publish_appends_nothing(spark, parts):
    ledger, sink = parts
    first = rows(spark, ("M", "1", None), ("N", None, "1"), (None, "x", None), ("M", "1", None))
    assert ledger.publish(first, sink) == 1
    want = [(1, "M", "1", None), (1, "N", None, "1"), (1, None, "x", None)]
    assert staged(spark, sink) == want
    assert ledger.publish(first, sink) is None and staged(spark, sink) == want
    # A text that moves from one part to the other differs; one that comes back is sent again.
    assert ledger.publish(rows(spark, ("M", None, "1"), ("N", None, "1")), sink) == 2
    assert ledger.publish(rows(spark, ("M", "1", None)), sink) == 3
    assert staged(spark, sink) == sorted([*want, (2, "M", None, "1"), (3, "M", "1", None)], key=repr)
    assert ledger.publish(first.limit(0), sink) is None and ledger.batches(spark) == [1, 2, 3]
    assert sink.rows(spark).select("publish_id").distinct().count() == 5


class Breaking(ParquetSink):
    """Fails after half of the rows."""

    def append(self, rows):
        super().append(rows.orderBy("short_name").limit(2))
        raise RuntimeError("connection lost")


def test_a_batch_that_was_sent_in_part(spark, parts):
    ledger, sink = parts
    some = rows(spark, *[(f"M{i}", str(i), None) for i in range(5)])
    with pytest.raises(RuntimeError):
        ledger.publish(some, Breaking(sink.folder, sink.schema))
    assert len(staged(spark, sink)) == 2
    with pytest.raises(publish.Unfinished):
        ledger.publish(rows(spark, ("M0", "new", None)), sink)
    assert ledger.resume(spark, sink) == [1] and ledger.resume(spark, sink) == []
    assert staged(spark, sink) == [(1, f"M{i}", str(i), None) for i in range(5)]
    assert ledger.publish(rows(spark, ("M0", "new", None), ("M1", "1", None)), sink) == 2
    assert staged(spark, sink)[-1] == (2, "M0", "new", None) and len(staged(spark, sink)) == 6


def test_a_batch_that_was_sent_and_not_marked(spark, parts, monkeypatch):
    ledger, sink = parts
    real = publish.move_if_absent
    monkeypatch.setattr(publish, "move_if_absent", lambda s, a, b: "/sent/" not in b and real(s, a, b))
    ledger.publish(rows(spark, ("M", "1", None)), sink)
    monkeypatch.setattr(publish, "move_if_absent", real)
    assert ledger.resume(spark, sink) == [1] and len(staged(spark, sink)) == 1


def test_of_two_publishes_one_is_claimed(spark, parts, monkeypatch):
    ledger, sink = parts
    real = publish.move_if_absent

    def slower(*args):
        monkeypatch.setattr(publish, "move_if_absent", real)
        ledger.publish(rows(spark, ("M", "other", None)), sink)
        return real(*args)

    monkeypatch.setattr(publish, "move_if_absent", slower)
    with pytest.raises(publish.Conflict):
        ledger.publish(rows(spark, ("M", "1", None)), sink)
    assert staged(spark, sink) == [(1, "M", "other", None)]
