import numpy as np
import xxhash

from rulegrove.llm import simhash


def brute_fp(text):
    words = [w for w in (text or "").encode().translate(simhash.LOWER).split()]
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows):
    fps = [brute_fp(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4:
                parent[root(i)] = root(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        r = root(i)
        if d is not None:
            best[r] = min(best.get(r, d), d)
    return sorted((str(d), f"{fps[i]:016x}", best.get(root(i))) for i, (d, _) in enumerate(rows))


def test_components_match_brute_force(spark):
    rng = np.random.default_rng(5)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        words = list(rng.choice(vocab, 150))
        rows.append((i * 10, " ".join(words)))
        for j in range(int(rng.integers(0, 4))):
            changed = list(words)
            changed[int(rng.integers(0, 150))] = "new" + str(j)
            rows.append((i * 10 + j + 1, " ".join(changed)))
    rows += [(9001, ""), (9000, None), (9002, " \t\n"), (9003, "one two"), (None, "one  TWO"), (9004, rows[0][1]), (9004, rows[0][1])]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, fp string")
    for dense in (128, 2):  # the second sends groups through the full-width form
        got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in simhash.simhash_components(df, dense_over=dense).collect())
        assert got == brute_components(rows)


def test_runs_across_batches_and_dense_runs():
    import pyarrow as pa

    keys = np.repeat(np.arange(5), [3, 400, 1, 2, 300]).astype(np.int64)
    fps = np.arange(len(keys)).astype(np.int64) << 5
    fps[1] = fps[0] + 1
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[i : i + 50]), pa.array(fps[i : i + 50])], names=["variant", "fp"]) for i in range(0, len(keys), 50)]
    out = [r for b in simhash._verify_runs(iter(batches), 128) for r in zip(*[c.to_pylist() for c in b.columns])]
    dense = {a for a, b in out if b is None}
    assert dense == set(fps[3:403].tolist()) | set(fps[406:].tolist())
    assert {int(fps[0]), int(fps[1])} in [set(x) for x in out]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_components(df).collect() == []


def jaccard(a, b):
    grams = []
    for t in (a, b):
        w = t.encode().translate(simhash.LOWER).split()
        grams.append({b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    return len(grams[0] & grams[1]) / len(grams[0] | grams[1])


def test_wide_groups_match_brute_force(spark):
    rng = np.random.default_rng(6)
    vocab = [f"v{i}" for i in range(5000)]
    rows, copies = [], []
    for i in range(80):
        words = list(rng.choice(vocab, 300))
        rows.append((i * 10 + 5, " ".join(words)))
        for j in range(i % 4):
            changed = list(words)
            for k in range(0, 300, 60):
                changed[k + j] = f"edit{i}_{j}_{k}"
            rows.append((i * 10 + j, " ".join(changed)))
            copies.append((len(rows) - 1, len(rows) - 2 - j))
    rows += [(9000, None), (None, ""), (9001, " ")]
    df = spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, component int").repartition(3)
    fps = simhash.wide_fingerprints_of([(t or "").encode() for _, t in rows])
    n = len(rows)
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    pieces = [[int(w) >> s & 0xFFFFFFFF for w in f for s in (0, 32)] for f in fps]
    for i in range(n):
        for j in range(i):
            near = any(bin(a ^ b).count("1") <= 2 for a, b in zip(pieces[i], pieces[j]))
            if near and sum(bin(int(a) ^ int(b)).count("1") for a, b in zip(fps[i], fps[j])) <= simhash.WIDE_RADIUS:
                parent[root(i)] = root(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        best[root(i)] = min(best.get(root(i), (True, 0)), (d is None, d or 0))
    got = sorted(r.doc_id for r in simhash.drop_near_duplicates(df).collect())
    assert got == sorted(d for _, d in best.values())
    assert all(jaccard(rows[a][1], rows[b][1]) >= 0.8 for a, b in copies)
    assert np.mean([root(a) == root(b) for a, b in copies]) > 0.95


def test_spanning_forest():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 4, 200).astype(np.uint64) << np.uint64(20)
    x ^= np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64)
    parent = simhash.spanning(x, 2)
    assert (parent == simhash._wide_forest(x, np.zeros(200, np.uint64), 2)).all()
    for i, p in enumerate(parent):
        assert p == i or bin(int(x[i] ^ x[p])).count("1") <= 2
    edges = [(i, j) for i in range(200) for j in range(i) if bin(int(x[i] ^ x[j])).count("1") <= 2]

    def roots(pairs):
        up = list(range(200))

        def root(i):
            while up[i] != i:
                i = up[i]
            return i

        for a, b in pairs:
            up[root(a)] = root(b)
        return len({root(i) for i in range(200)})

    assert roots(edges) == roots([(i, int(p)) for i, p in enumerate(parent)])


def test_clashing_names_are_kept(spark):
    text = " ".join(f"word{i}" for i in range(60))
    df = spark.createDataFrame([(2, text, "x", "y"), (1, text, "x", "y"), (None, "", "x", "y")], "doc_id long, text string, _row string, component string")
    assert sorted((str(r.doc_id), r["_row"], r.component) for r in simhash.drop_near_duplicates(df).collect()) == [("1", "x", "y"), ("None", "x", "y")]
