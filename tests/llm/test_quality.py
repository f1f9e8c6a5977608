import random

import numpy as np
import zstandard

from snapsync.llm import quality


def test_held_out_accuracy(spark, documents, given):
    folder = given.replace("sf0.001", "sf0.1")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.fit(docs, labels.where("doc_id % 2 = 0"))
    rows = quality.score(docs, model).withColumnRenamed("id", "doc_id")
    held = rows.join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    for label in (0, 1):
        right = [(r.score >= 0.5) == (label == 1) for r in held if r.quality == label]
        assert np.mean(right) > 0.9
    assert rows.count() == docs.count() and all(0 <= r.score <= 1 for r in held)


def test_odd_rows(spark, documents):
    docs = documents([None, "", "abc", "abc", (None, "abc"), (9, "x" * 300_000)])
    labels = spark.createDataFrame([(2, 1), (3, 0), (None, 1), (2, 0)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    scores = quality.score(docs, model).collect()
    assert len(scores) == 6 and all(0 <= r.score <= 1 for r in scores)
    for empty in (labels.limit(0), labels.where("quality = 1")):
        model = quality.fit(docs, empty)
        assert all(0 <= r.score <= 1 for r in quality.score(docs, model).collect())
    assert quality.score(documents([]), model).count() == 0


def plain_features(raw, good, bad):
    """Sizes by compressing each block with a compressor of its own."""
    if not raw:
        return [0.0] * quality.FEATURES

    def size(view, dictionary):
        total = 0
        for at in range(0, len(view), 4096):
            known = dictionary and zstandard.ZstdCompressionDict(dictionary, zstandard.DICT_TYPE_RAWCONTENT)
            one = zstandard.ZstdCompressor(
                level=1, dict_data=known, write_content_size=False, write_dict_id=False
            )
            total += max(1, len(one.compress(view[at : at + 4096])) - 9)
        return total

    out = [np.log(len(raw))]
    for shape in (bytes, quality.shape_of):
        view = shape(raw)
        sizes = [size(view, shape(good)), size(view, shape(bad)), size(view, None)]
        out += [(sizes[0] - sizes[1]) / len(view), min(sizes[:2]) / len(view), sizes[2] / len(view)]
    return out


def test_scores_equal_a_plain_version(spark, documents, given):
    docs = spark.read.parquet(f"{given}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{given}/labels.parquet"))
    found = {r.id: r.score for r in quality.score(docs, model).collect()}
    for row in docs.orderBy("doc_id").collect():
        x = plain_features((row.text or "").encode(), model.good, model.bad)
        z = np.clip((np.array(x) - model.middle) / model.scale, -3, 3)
        terms = [1.0, *z] + [z[i] * z[j] for i in range(len(z)) for j in range(i, len(z))]
        want = 1 / (1 + np.exp(-np.clip(np.dot(terms, model.weights), -30, 30)))
        assert abs(found[row.doc_id] - want) < 1e-9


def test_the_whole_of_each_sampled_text_reaches_the_dictionary():
    rng = random.Random(5)
    blocks = [bytes(rng.choices(range(256), k=4096)) for _ in range(1250 * 4)]
    raw = quality.dictionary_of(blocks, 110_000)
    held = [i for i, b in enumerate(blocks) if b[2016:2080] in raw]
    assert len(raw) <= 110_000 and len(held) > 500
    # Evenly over all: no stretch of the blocks is left out.
    assert max(np.diff([0, *held, len(blocks)])) < 20


def test_long_labelled_texts_calibrate_as_a_whole(spark, documents):
    """Long texts that differ after their first 100,000 bytes only."""
    good, bad = "the quick brown fox jumps over it. ", "zq#9!x "
    rows = [(i, "same head " * 10_000 + (good if i % 2 else bad) * 8_000 + str(i)) for i in range(40)]
    docs = documents(rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    scores = {r.id: r.score for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    assert all((scores[i] >= 0.5) == (i % 2 == 1) for i in range(30, 40))


def test_repeated_ids_do_not_enlarge_the_sample(spark, documents):
    docs = documents([(1, "good text here")] * 300 + [(2, "BAD!!"), (3, "good text there"), (4, "BAD!?")])
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0)], "doc_id long, quality int")
    assert quality.texts_of(docs, [(1, 1), (2, 0)], "doc_id", "text").count() == 2
    assert quality.score(docs, quality.fit(docs, labels)).count() == 303
