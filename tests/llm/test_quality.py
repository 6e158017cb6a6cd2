import zlib

import numpy as np

from rulegrove.llm import quality

DATA = "/root/testdata/sf0.1"


def test_gradients_are_right():
    rng = np.random.default_rng(0)
    x, doc, y = rng.normal(size=(12, 6)), np.repeat(np.arange(4), 3), np.array([0.0, 1, 1, 0])
    model = quality.GatedAttention(6, 5, 4)

    def loss():
        out = model.forward(x, doc, 4)[5]
        return -np.mean(y * np.log(out) + (1 - y) * np.log(1 - out))

    for k, g in model.gradients(x, doc, y).items():
        at = tuple(0 for _ in model.p[k].shape)
        old = model.p[k][at]
        model.p[k][at] = old + 1e-6
        up = loss()
        model.p[k][at] = old - 1e-6
        down = loss()
        model.p[k][at] = old
        assert abs((up - down) / 2e-6 - g[at]) < 1e-6, k


def test_passages_cover_whole_texts():
    texts = [b"", b"a b c", b"x" * (quality.PASSAGE * 3 + 1), b"ab " * 1000]
    x, doc = quality.encode(texts)
    assert np.bincount(doc).tolist() == [1, 1, 4, 6]
    assert not x[0].any()
    for i, t in enumerate(texts):  # a batch encodes as its rows alone
        assert np.allclose(quality.encode([t])[0], x[doc == i])


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    out = quality.op1_quality(spark, DATA)
    rows = out.join(labels, "doc_id").filter("held_out").select("predicted", "quality", "doc_id").collect()
    assert len(rows) > 500 and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    good = [r.predicted == 1 for r in rows if r.quality == 1]
    bad = [r.predicted == 0 for r in rows if r.quality == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) > 0.9
    assert out.count() == docs.count()


def test_edges(spark):
    rows = [(1, "some text", 5.0), (1, "some text", 6.0), (2, None, 1.0), (None, "", 2.0), (4, "w " * 100_000, 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.train(df, none)
    got = quality.quality_scores(df, model).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r.score)
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got) and by[1][0] == by[1][1] and by[2] == by[None]
    assert quality.quality_scores(df.limit(0), model).collect() == []
