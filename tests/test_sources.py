from catalog_data import NOW, allowed, elements, tables
from conftest import tuples
from pyspark.sql import functions as F

from snapsync.plans import poll, pull
from snapsync.plans.store import Store
from snapsync.sources.databases import TABLES, read_sources


def reader(spark, marked=True):
    """A source that answers from small tables, without the column that names it."""
    t = tables(spark)

    def read(name):
        if name == "now":
            return spark.createDataFrame([(NOW, NOW)], "as_of timestamp_ntz, local_time timestamp_ntz")
        if name == "marker":
            return spark.createDataFrame([(1,)] if marked else [], "mark int")
        return getattr(t, name).drop("source_db")

    return read


def test_sources_to_a_poll(spark, tmp_path):
    names = [n for n in TABLES if getattr(tables(spark), n) is not None]
    sources = {"a": reader(spark), "b": reader(spark, marked=False)}
    t, now, restored = read_sources(sources, names=names)
    assert tuples(restored) == [("b",)]
    assert {r.source_db for r in t.methods.select("source_db").distinct().collect()} == {"a", "b"}
    store = Store(str(tmp_path / "store")).create(spark)
    poll.run_poll(t, now, allowed(spark), elements(spark, ("METHOD", "C", "OLD")), store, restored)
    counts = {r.source_db: r["count"] for r in store.versions(spark).groupBy("source_db").count().collect()}
    assert set(counts) == {"a", "b"}
    epochs = {r.source_db: r.epoch for r in store.last_control(spark).collect()}
    assert epochs == {"a": "a_2024.06.30_12.00", "b": "b_2024.06.30_12.00"}


def test_publish_a_tree(spark):
    files = spark.createDataFrame(
        [("a", "C", "N.body.sql", "x"), ("a", "C", "N.locals.sql", "y"), ("a", "C", "M.body.sql", "z")],
        "source_db string, folder string, file string, text string",
    )
    listed = spark.createDataFrame([("C.N",)], "list string")
    got = []
    pull.publish_tree(files, listed, "list", got.append)
    rows = got[0].select("class_id", "short_name", "body", F.col("locals"), "globals")
    assert tuples(rows) == [("C", "N", "x", "y", None)]
