import os

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark, tmp_path_factory):
    """A function that makes a table of documents from texts or (doc_id, text) pairs."""
    from snapsync.llm.common import importable

    importable(spark)
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))

    def make(texts, files=3):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(d, t, "en", "s", len(t or "")) for d, t in pairs]
        return spark.createDataFrame(rows, SCHEMA).repartition(files, F.col("doc_id"))

    return make


@pytest.fixture(scope="session")
def given():
    """The folder of the small given tables."""
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    return folder
