"""The pipeline's stages beside plain versions of themselves, each on its own input."""

import corpus_pipeline
from .test_contamination import plain as plain_hits
from .test_lines import plain as plain_lines
from .test_neardup import kmers, lcs
from .test_packing import check as check_packed

from snapsync.llm import quality


def plain_groups(texts):
    seqs = [kmers(t) for t in texts]
    sets = [set(s) for s in seqs]
    name = list(range(len(texts)))

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    for i, a in enumerate(seqs):
        for j, b in enumerate(seqs[:i]):
            if a != b:
                need = 0.8 * (len(a) + len(b)) / 1.8
                if not a or not b or min(len(a), len(b)) < need or len(sets[i] & sets[j]) < 0.5 * need:
                    continue
                n = lcs(a, b)
                if n < 0.8 * (len(a) + len(b) - n) - 1e-9:
                    continue
            x, y = sorted((root(i), root(j)))
            name[y] = x
    return [root(i) for i in range(len(texts))]


def words(text):
    return bool((text or "").strip(" \t\r\x0b\x0c\n"))


def rows_of(df):
    return sorted(df.collect(), key=lambda r: r.doc_id)


def test_each_stage_on_its_own_input(spark, documents, given):
    labels = spark.read.parquet(f"{given}/labels.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{given}/benchmark.parquet").collect()]
    docs = documents([]).unionByName(spark.read.parquet(f"{given}/documents.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    columns = docs.columns

    good = stages["quality"](spark, docs, given)
    model = quality.fit(docs, labels)
    want = {r.id for r in quality.score(docs, model).where("score >= 0.5").collect()}
    before = rows_of(good)
    assert good.columns == columns and {r.doc_id for r in before} == want

    lined = stages["line_dedup"](spark, documents([tuple(r[:2]) for r in before]), given)
    after = rows_of(lined)
    left = plain_lines([r.text for r in before], 50)
    assert lined.columns == columns
    assert [(r.doc_id, r.text) for r in after] == [
        (b.doc_id, t) for b, (t, _, gone) in zip(before, left) if not gone or words(t)
    ]
    assert all(r.n_chars == len(r.text) for r in after)

    shorter = [r for r in after if len(r.text) < 2500]
    alone = stages["near_dedup"](spark, documents([tuple(r[:2]) for r in shorter]), given)
    groups = plain_groups([r.text for r in shorter])
    kept = rows_of(alone)
    assert [r.doc_id for r in kept] == [r.doc_id for i, r in enumerate(shorter) if groups[i] == i]

    few = kept[:60]
    clean = stages["decontamination"](spark, documents([tuple(r[:2]) for r in few]), given)
    assert [r.doc_id for r in rows_of(clean)] == [
        r.doc_id for r in few if plain_hits(r.text, items)[1] == 0
    ]
    packed = stages["packing"](spark, clean, given).collect()
    check_packed(packed, {r.doc_id: r.text for r in rows_of(clean)})


def test_run_and_odd_rows(spark, documents, given):
    rows = [(None, None), (1, ""), (2, "a b c"), (2, "a b c"), (None, "d e f g h i"), (3, "x" * 100_000)]
    docs = documents(rows).withColumnRenamed("lang", "row").withColumnRenamed("source", "a b.c")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, given)
        assert found.columns == docs.columns and len(found.collect()) <= len(rows)
        assert stage(spark, docs.limit(0), given).count() == 0
    assert corpus_pipeline.run(spark, given).count() > 0
