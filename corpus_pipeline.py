"""A corpus from raw documents to packed sequences, stage by stage.

Each stage gets what the one before it kept, written as Parquet and read again.
"""

import public_tokenizers

from snapsync.llm import contamination, lines, neardup, packing, quality
from snapsync.llm.common import importable, table, written

# Stages learn, compare and pack; SQL can't express the rows of run(): tests use plain versions.
ORACLE_SQL = None


def classify(spark, docs, sf_dir):
    """Documents that the compression classifier takes for good ones."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def dedup_lines(spark, docs, sf_dir):
    """Without repeated runs of lines beyond their first copy; emptied documents go."""
    importable(spark)
    return lines.drop_repeated_lines(docs)


def dedup_documents(spark, docs, sf_dir):
    """One document of each group of near duplicates, the one with the smallest id."""
    importable(spark)
    return neardup.drop_near_duplicates(docs)


def decontaminate(spark, docs, sf_dir):
    """Documents that hold no window of a benchmark item."""
    return contamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark, docs, sf_dir):
    """Pieces of documents in sequences of at most 2048 tokens."""
    importable(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", classify),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("decontamination", decontaminate),
    ("packing", pack),
]


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs)
    return docs
