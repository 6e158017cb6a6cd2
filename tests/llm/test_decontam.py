import random

import numpy as np

from rulegrove.llm import decontam

DATA = "/root/testdata/sf0.1"


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_bit_parallel_lcs():
    rng = random.Random(4)
    for _ in range(300):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 30))] for _ in range(2))
        assert decontam.common(decontam.masks_of(a), len(a), b) == lcs(a, b)


def test_word_hashes():
    texts = ["", "One two, ONE-two é!", "x" * 10, "é two"]
    h, owner = decontam.words_of([t.lower().encode() for t in texts])
    assert owner.tolist() == [1] * 5 + [2] + [3] * 2
    assert h[0] == h[2] and h[1] == h[3] == h[7] and h[4] == h[6] and len(set(h.tolist())) == 4
    long = " ".join(f"w{i}" for i in range(700_000)).encode()
    assert len(decontam.words_of([b"a", long, b"b"])[0]) == 700_002


def planted(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").filter("doc_id < 3000").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    rng = random.Random(8)
    holds = {(d, i) for d, t in docs for i, x in items if x.lower() in t.lower()}
    clean = [d for d, t in docs if not any(x.lower() in t.lower() for _, x in items) and len(t) > 300]
    text = dict(docs)
    para = set()
    for n, d in enumerate(rng.sample(clean, 60)):  # one word in six replaced, set in the middle of a document
        i, x = items[n]
        words = x.split()
        if len(words) < 18:
            continue
        for k in range(3, len(words) - 1, 6):
            words[k] = "zzz" + str(k)
        text[d] = text[d][:150] + " " + " ".join(words) + " " + text[d][150:]
        para.add((d, i))
    return list(text.items()), items, holds, para


def test_planted_items_are_found_and_clean_documents_are_not(spark):
    rows, items, holds, para = planted(spark)
    df = spark.createDataFrame([(d, t, 1) for d, t in rows] + [(None, items[0][1], 1), (-1, None, 1), (-2, "", 1)], "doc_id long, text string, matches int").repartition(4)
    bench = spark.createDataFrame([*items, (990, items[0][1]), (991, None), (992, "")], "item_id long, text string")
    out = decontam.matched(df, bench).select("doc_id", "matches").collect()
    got = {(r.doc_id, m.item_id) for r in out for m in r.matches}
    assert holds <= got
    assert {(None, items[0][0]), (None, 990)} <= got
    assert len(para - got) <= 0.05 * len(para)
    touched = {d for d, _ in holds | para} | {None}
    assert {d for d, _ in got} <= touched
    kept = {r.doc_id for r in decontam.decontaminate(df, bench).collect()}
    assert kept == {d for d, _ in rows} - {d for d, _ in got} | {-1, -2}


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "x y")], "item_id long, text string")
    assert decontam.matched(docs.limit(0), bench).collect() == []
    assert decontam.matched(docs, bench.limit(0)).first().matches == []
    assert decontam.decontaminate(docs, bench).count() == 1
    assert np.isfinite(decontam.latent_space(docs)[0]).all()


def test_clashing_names_rounds_and_shared_words(spark, monkeypatch):
    shared = "alpha beta gamma delta epsilon zeta eta theta"
    items = [(i, f"{shared} item{i} " + " ".join(f"w{i}x{j}" for j in range(12))) for i in range(30)]
    rows = [(i, f"before {t} after " * 2, "kept", "kept", "kept") for i, t in items[:10]] + [(99, shared * 3, "kept", "kept", "kept"), (100, None, "kept", "kept", "kept")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _bytes_of_text string, _row string, _matches string")
    bench = spark.createDataFrame(items, "item_id long, text string")

    def found():
        out = decontam.matched(df, bench).collect()
        assert all((r["_bytes_of_text"], r["_row"], r["_matches"]) == ("kept",) * 3 for r in out)
        return sorted((r.doc_id, sorted(m.item_id for m in r.matches)) for r in out)

    want = [(i, [i]) for i in range(10)] + [(99, []), (100, [])]
    assert found() == want
    monkeypatch.setattr(decontam, "ITEMS", 7)  # several rounds
    assert found() == want
    assert sorted(r.doc_id for r in decontam.decontaminate(df, bench).collect()) == [99, 100]


def test_words_of_many_items_are_placed_in_parts(monkeypatch):
    rng = np.random.default_rng(3)
    items = [([i], " ".join(f"v{x}" for x in rng.integers(0, 30, 20))) for i in range(40)]
    space, df = rng.normal(size=(decontam.TERMS, 8)).astype(np.float32), np.ones(decontam.TERMS)
    bench = decontam.Benchmark(items, space, df)
    h, owner = decontam.words_of([" ".join(f"v{x}" for x in rng.integers(0, 40, 300)).encode() for _ in range(20)])
    whole = bench.holders(h, owner)
    monkeypatch.setattr(decontam, "PLACES", 100)
    parts = bench.holders(h, owner)
    assert len(whole[0]) and all((a == b).all() for a, b in zip(whole, parts))
