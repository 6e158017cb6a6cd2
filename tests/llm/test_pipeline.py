import corpus_pipeline
from rulegrove.llm import pieces, pii, quality

DATA = "/root/testdata/sf0.01"


def test_stages_on_all_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    items = [r.text.lower() for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    before, last = docs, None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = corpus_pipeline.written(stage(spark, before, DATA))
        old = {r.doc_id: r.text for r in before.collect()}
        if k < 4:
            assert tuple(after.columns) == tuple(docs.columns)
            new = {r.doc_id: r.text for r in after.collect()}
            assert set(new) <= set(old)
        if k == 0:
            assert all(quality.encode([(new[d] or "").encode()])[0].shape[1] == quality.FEATURES for d in list(new)[:3])
            wrong = sum((d in new) != bool(labels[d]) for d in old if d in labels)
            assert wrong < 0.05 * len(labels)
        elif k == 1:
            assert len(set(new.values())) == len(new) and set(new.values()) <= set(old.values())
            assert {min(d for d in old if old[d] == t) for t in set(old.values())} >= set(new)
        elif k == 2:
            dirty = {d for d, t in old.items() if any(x in t.lower() for x in items)}
            assert dirty and not dirty & set(new) and len(new) > 0.98 * (len(old) - len(dirty))
        elif k == 3:
            assert set(new) == set(old)
            for d, t in old.items():
                spans = pii.base_spans(t)
                assert (new[d] == t) == (not spans)
                assert not any(s[1] == 0 for s in pii.base_spans(new[d]))
        else:
            back = pieces.decode(after).collect()
            assert {r.doc_id for r in back} == set(old) and all(r.text == old[r.doc_id] for r in back)
        before, last = after, after
    assert last.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None
