import hashlib
import random

import numpy as np
import pyarrow as pa

from rulegrove.llm import suffix

L = suffix.LEAST


def brute(rows):
    """rows: (key, text). Per row (n_bytes, n_removed, n_spans, sha)."""
    first = {}
    texts = [(suffix.LAST_KEY if k is None else k, (t or "").encode()) for k, t in rows]
    for k, t in texts:
        for i in range(len(t) - L + 1):
            s = t[i : i + L]
            first[s] = min(first.get(s, k), k)
    out = []
    for k, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - L + 1):
            if first[t[i : i + L]] < k:
                gone[i : i + L] = b"\1" * L
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_array_and_prefixes():
    rng = random.Random(2)
    for n in (0, 1, 2, 7, 300, 3000):
        for abc in (b"a", b"ab", bytes(range(256))):
            text = bytes(rng.choice(abc) for _ in range(n))
            text = text[: n // 2] + text[: n - n // 2]
            data = np.frombuffer(text, np.uint8)
            sa = suffix.suffix_array(data)
            assert sorted(sa.tolist()) == list(range(n))
            prefixes = [text[i : i + L] for i in sa]
            assert prefixes == sorted(prefixes)
            lcp = suffix.common_prefixes(data, sa)
            for i in range(1, n):
                a, b = text[sa[i - 1] : sa[i - 1] + L], text[sa[i] : sa[i] + L]
                same = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
                assert lcp[i] == same


def corpus(seed=3):
    rng = random.Random(seed)
    words = [f"{chr(97 + i % 26)}{i}é" for i in range(300)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = [prose(rng.randrange(8, 60)) for _ in range(8)]
    rows = [(i * 3, " ".join(x for _ in range(rng.randrange(1, 4)) for x in (prose(rng.randrange(0, 40)), rng.choice(shared)))) for i in range(50)]
    rows += [(1000 + i, rows[i][1]) for i in range(10)]  # exact copies
    rows += [(2000, "ab " * 400), (2001, "ab " * 300), (2002, "zab " * 100), (5, "a" * 49), (6, "a" * 50), (4, "a" * 51), (7, "a" * 500)]
    rows += [(3000, None), (3001, ""), (None, shared[0] * 2), (None, shared[0] * 2), (9, "q" + shared[1]), (9, shared[1] + "q"), (9, shared[1] + "q")]
    rng.shuffle(rows)
    return rows


def test_matches_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, kept string").repartition(3)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.drop_repeats(df).collect())
    assert got == sorted((str(k), *x) for (k, _), x in zip(rows, brute(rows)))
    assert suffix.drop_repeats(df.limit(0)).collect() == []


def test_merging_of_shards_by_binary_search():
    """Shards of a few hundred bytes: most pieces fill several, long contexts are cut."""
    rows = corpus(9)
    keys = np.array([suffix.LAST_KEY if k is None else k for k, _ in rows], np.int64)
    texts = [(t or "").encode() for _, t in rows]
    want = brute(rows)
    for shard in (120, 400, 5000):
        blobs = []
        for a in (0, 20, 45):
            b = {0: 20, 20: 45, 45: len(rows)}[a]
            filer = suffix._Filer(2)
            filer.add(np.arange(a, b), keys[a:b], texts[a:b])
            blobs += list(filer.flush())
        lost = {}
        for bucket in (0, 1):
            for r, s, e in zip(*suffix.covered([x for k, x in blobs if k == bucket], shard)):
                lost.setdefault(int(r), []).append((int(s), int(e)))
        for i, t in enumerate(texts):
            gone = bytearray(len(t))
            for s, e in lost.get(i, ()):
                gone[s:e] = b"\1" * (e - s)
            kept = bytes(c for c, g in zip(t, gone) if not g)
            assert hashlib.sha256(kept).hexdigest() == want[i][3]


def test_pieces_that_a_flush_parts_are_told(monkeypatch):
    """Each text is flushed on its own, in the middle of the one source: what two of them share is filed."""
    monkeypatch.setattr(suffix, "FLUSH_BYTES", 1)
    monkeypatch.setattr(suffix, "TEXT_PER_STEP", 1)
    rows = corpus(5)
    keys = np.array([suffix.LAST_KEY if k is None else k for k, _ in rows], np.int64)
    texts = [(t or "").encode() for _, t in rows]
    n = len(rows)
    batch = pa.record_batch([pa.array([0] * n, pa.int64()), pa.array(range(n), pa.int64()), pa.array(keys), pa.array(texts, pa.binary())], names=["source", "row", "key", "_text"])
    announced = pa.Table.from_batches(suffix._announce(1)(iter([batch])))
    assert announced.num_rows > 20
    told = suffix._shared(None, announced).rename_columns(["source", "pieces"])
    both = pa.concat_tables([told, pa.Table.from_batches([batch])], promote_options="default").select(["source", "row", "key", "_text", "pieces"])
    filed = [b.as_py() for x in suffix._file(1)(iter(both.combine_chunks().to_batches())) for b in x.column("blob")]
    lost = {}
    for r, s, e in zip(*suffix.covered(filed)):
        lost.setdefault(int(r), []).append((int(s), int(e)))
    for i, (t, want) in enumerate(zip(texts, brute(rows))):
        gone = bytearray(len(t))
        for s, e in lost.get(i, ()):
            gone[s:e] = b"\1" * (e - s)
        assert hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest() == want[3]
