import random

from rulegrove.llm import similar


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similarity(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def corpus():
    """Texts with an appended tail, a replaced block and scattered edits, on both sides of 0.8; shared vocabulary only."""
    rng, rows = random.Random(4), []
    for i in range(60):
        words = [f"w{rng.randrange(400)}" for _ in range(200)]
        rows.append((i * 10 + 5, " ".join(words)))
        rows.append((i * 10 + 1, " ".join(words + [f"t{rng.randrange(400)}" for _ in range(20 + i)])))
        at, size = rng.randrange(100), 5 + i // 2
        rows.append((i * 10 + 2, " ".join(words[:at] + [f"b{rng.randrange(400)}" for _ in range(size)] + words[at + size :])))
        rows.append((i * 10 + 3, " ".join(rng.sample(words, len(words)))))  # same words, no shingles
    rows += [(9000, None), (None, ""), (9001, " "), (9002, "a b"), (9003, "A  b"), (None, "a b"), (9004, "a b c")]
    return rows


def test_groups_are_those_of_exact_similarity(spark):
    rows = corpus()
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if similarity(rows[i][1], rows[j][1]) >= 0.8:
                parent[root(i)] = root(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        best[root(i)] = min(best.get(root(i), (True, 0)), (d is None, d or 0))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(r.doc_id for r in similar.drop_similar(df).collect())
    assert 150 < len(best) < 220 and got == sorted(d for _, d in best.values())
    assert similar.drop_similar(df.limit(0)).collect() == []


def test_members_of_one_key_in_different_groups_are_all_compared():
    import numpy as np
    import pyarrow as pa

    comp = {7: 7, 10: 7, 8: 8, 9: 9, 11: 11}
    far = {11}  # its sketch is far from the others'
    keys = {x: [1, 2, *[100 * x + i for i in range(2, similar.BANDS)]] for x in comp}
    keys[9][0] = 3  # shares the second key alone

    def row(key, i, j, block, node):
        bits = (np.zeros(similar.BITS // 8, np.uint8) + (255 if node in far else 0)).tobytes()
        return key, i, j, block, keys[node].index(key), comp[node], node, bits, keys[node]

    rows = [row(1, 0, 0, 0, x) for x in (7, 8, 11)] + [row(1, 0, 1, b, x) for b, x in ((0, 7), (0, 8), (0, 11), (1, 10))] + [row(1, 1, 1, 1, 10)]
    rows += [row(2, 0, 0, 0, x) for x in (7, 10, 8, 9, 11)]
    types = [pa.int64()] * 7 + [pa.binary(), pa.list_(pa.int64())]
    batches = [pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows[a:b]), types)], names=similar.CROSSED) for a, b in ((0, 2), (2, 9), (9, 13))]
    got = sorted((r["a"], r["b"]) for b in similar._crossed(iter(batches)) for r in b.to_pylist())
    assert got == [(7, 8), (7, 9), (8, 9), (8, 10), (9, 10)]


def test_sketches_estimate_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 1000, np.uint64)
    for share in (0.6, 0.8, 0.95):
        k = round(1000 * 2 * share / (1 + share))  # of 1000 in both
        b = np.r_[a[:k], rng.integers(0, 1 << 63, 1000 - k, np.uint64)]
        x, y = similar.sketches([a, b])
        assert abs(np.bitwise_count(x ^ y).sum() / similar.BITS - (1 - share) / 2) < 0.045


def shuffled_bytes(spark):
    found = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(found.apply(i).totalShuffleWrite() for i in range(found.size()))


def test_texts_that_look_like_no_other_are_not_moved(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, " ".join(f"{rng.getrandbits(60):x}" for _ in range(1500))) for i in range(300)]
    rows += [(1000 + i, rows[i][1] + " tail") for i in range(3)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    name = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        before = shuffled_bytes(spark)
        assert sorted(r.doc_id for r in similar.drop_similar(docs).select("doc_id").collect()) == list(range(300))
        similar.drop_similar(docs).write.parquet(f"{tmp_path}/out")
        assert (shuffled_bytes(spark) - before) / 2 < 0.5 * sum(len(t) for _, t in rows)
    finally:
        spark.conf.set(name, was)


def test_flagged_rows_are_all_keys_and_few_others(spark):
    from rulegrove.llm.common import flagged

    df = spark.range(-20_000, 20_000).withColumnRenamed("id", "n")
    keys = df.filter("n % 7 = 3").unionByName(spark.createDataFrame([(10**18,)], "n long"))
    told = flagged(df, "n", keys, "hit")
    assert told.columns == ["n", "hit"] and told.count() == 40_000
    got = {r.n for r in told.filter("hit").collect()}
    want = {r.n for r in keys.collect()} - {10**18}
    assert want <= got and len(got) < len(want) + 60
    assert flagged(df, "n", keys.limit(0), "hit").filter("hit").count() == 0
