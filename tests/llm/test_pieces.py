import math
import tracemalloc
from collections import Counter

import numpy as np
import sentencepiece

from rulegrove.llm import pieces

TEXTS = ["", "Hello world", "a", "  two  blanks \n\n tab\tend  ", "é😀 ▁x ￿", "x" * 200, "the the the", "\n", " ", "naïve 三 你好", "▁"]


def all_paths(voc, word):
    """Every segmentation of a word: piece codes -> log weight."""
    ids = {}
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    for i in range(sp.get_piece_size()):
        if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)):
            ids[sp.id_to_piece(i)] = i
    s = word.replace(" ", "▁")

    def walk(at):
        if at == len(s):
            yield (), 0.0
            return
        for n in range(1, min(16, len(s) - at) + 1):
            i = ids.get(s[at : at + n])
            if i is not None:
                for rest, w in walk(at + n):
                    yield (i, *rest), w + float(voc.logp[i])

    return dict(walk(0))


def test_round_trip_and_distinct():
    enc = pieces.Encoder(pieces.MODEL, 4)
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    for got, t in zip(enc.encode(list(range(len(TEXTS))), TEXTS), TEXTS):
        assert all(enc.decode(ids.tolist()) == t for ids, *_ in got)
        assert len({tuple(ids.tolist()) for ids, *_ in got}) == len(got)
        values = [v for _, _, v, _ in got]
        assert values == sorted(values, reverse=True)
        if t and "▁" not in t:
            assert sp.decode(got[0][0].tolist()) == t


def test_samples_do_not_depend_on_the_batch():
    enc = pieces.Encoder(pieces.MODEL, 3)
    whole = enc.encode(list("abcdefghijk"), TEXTS)
    for key, t, want in zip("abcdefghijk", TEXTS, whole):
        alone = enc.encode([key], [t])[0]
        assert [x[0].tolist() for x in alone] == [x[0].tolist() for x in want]
        assert np.allclose([x[1:] for x in alone], [x[1:] for x in want])


def test_distribution_matches_enumeration():
    enc = pieces.Encoder(pieces.MODEL, 2)
    weights = all_paths(enc.voc, " the")
    total = math.log(sum(math.exp(w) for w in weights.values()))
    p = {x: math.exp(w - total) for x, w in weights.items()}
    n = 4000
    got = enc.encode(list(range(n)), ["the"] * n)
    first = Counter(tuple(g[0][0].tolist()) for g in got)
    second = Counter(tuple(g[1][0].tolist()) for g in got)
    assert set(first) | set(second) <= set(p)
    for x, q in p.items():
        assert abs(first[x] / n - q) < 4 * math.sqrt(q / n) + 0.005
        drawn = sum(p[y] * q / (1 - p[y]) for y in p if y != x)  # second draw without replacement
        assert abs(second[x] / n - drawn) < 4 * math.sqrt(drawn / n) + 0.005
    for g in got[:50]:
        for ids, logp, _, inclusion in g:
            assert abs(logp - math.log(p[tuple(ids.tolist())])) < 1e-9 and inclusion <= 0


def test_all_segmentations_are_found_when_few():
    enc = pieces.Encoder(pieces.MODEL, 50)
    weights = all_paths(enc.voc, " ab")
    got = enc.encode(["k"], ["ab"])[0]
    total = math.log(sum(math.exp(w) for w in weights.values()))
    found = {tuple(g[0].tolist()) for g in got}
    assert found == set(weights) and len(got) == len(weights)
    assert all(abs(g[1] - (weights[tuple(g[0].tolist())] - total)) < 1e-9 for g in got)
    assert all(g[3] == 0 for g in got)


def test_scalar_numbers_are_those_of_arrays():
    from itertools import islice

    for seed in (0, 5, (1 << 64) - 1):
        assert list(islice(pieces.scalar_uniforms(seed, 1, 0xFFFFFFFD), 20)) == pieces.uniforms(np.uint64(seed), 1, 0xFFFFFFFD, np.arange(20)).tolist()


def test_what_is_left_of_a_near_certain_word_is_summed():
    enc = pieces.Encoder(pieces.MODEL, 2)
    lat = pieces.Lattices(enc.voc, [" the"])
    weights = all_paths(enc.voc, " the")
    total = math.log(sum(math.exp(w) for w in weights.values()))
    for path, w in weights.items():
        trie = lat.others(0, [tuple(enc._length(c) for c in path)])
        rest = sum(math.exp(x - total) for other, x in weights.items() if other != path)
        assert abs(trie[0][2] - rest) < 1e-9 * rest
    both = [tuple(enc._length(c) for c in p) for p in weights]
    assert lat.others(0, both)[0][2] == 0


def test_inclusion_scores_estimate_sums():
    """Sum over samples of 1 / inclusion is an unbiased count of segmentations."""
    enc = pieces.Encoder(pieces.MODEL, 3)
    weights = all_paths(enc.voc, " ab")
    total = math.log(sum(math.exp(w) for w in weights.values()))
    n = 3000
    got = enc.encode(list(range(n)), ["ab"] * n)
    mass = np.mean([sum(math.exp(x[1] - x[3]) for x in g) for g in got])
    assert abs(mass - 1) < 0.05 and total < 0


def test_frames(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(50, None, "x"), (None, "no key", "x"), (1, "Hello world", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(2)
    out = pieces.encode(df)
    back = pieces.decode(out).collect()
    want = {}
    for d, t, _ in rows:
        want.setdefault(d, t or "")
    assert {r.doc_id for r in back} == set(want) and all(r.text == want[r.doc_id] for r in back)
    figures = pieces.digests(df).collect()
    assert len(figures) == len(back) and all(r.exact for r in figures)
    assert pieces.encode(df.limit(0)).collect() == []


def test_kept_lattices_are_small_and_change_nothing(monkeypatch):
    rng = np.random.default_rng(3)
    words = ["".join(map(chr, rng.integers(97, 123, rng.integers(3, 12)))) for _ in range(20_000)]
    enc = pieces.Encoder(pieces.MODEL, 2)
    enc.encode([0], [" ".join(words)])
    held = sum(x.nbytes for x in vars(enc.lat).values() if isinstance(x, np.ndarray))
    assert held / len(enc.lat.beta) * pieces.NODES_KEPT < 64e6
    texts = [" ".join(words[i : i + 30]) for i in range(0, 300, 30)]
    kept = [enc.encode([i], [t]) for i, t in enumerate(texts)]
    monkeypatch.setattr(pieces, "NODES_KEPT", 0)
    for i, t in enumerate(texts):
        for (a, *x), (b, *y) in zip(kept[i][0], enc.encode([i], [t])[0], strict=True):
            assert a.tolist() == b.tolist() and x == y


def test_lattices_are_those_of_a_plain_search(monkeypatch):
    monkeypatch.setattr(pieces, "NODES_AT_ONCE", 50)
    voc = pieces.vocabulary(pieces.MODEL)
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    ids = {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
    words = [" the", "   ", "\n", " é😀x\uffff", " ▁▁a", "x" * 300, " internationalization.", "=" * 70_000]
    lat = pieces.Lattices(voc, words)
    for w, word in enumerate(words):
        s = "".join({" ": "▁", "▁": "\0"}.get(c, c) for c in word)  # a blank sign that is meant is no piece
        beta = np.zeros(len(s) + 1)
        for at in reversed(range(len(s))):
            edges = [(n, ids[s[at : at + n]]) for n in range(1, min(voc.longest, len(s) - at) + 1) if s[at : at + n] in ids]
            weights = [float(voc.logp[i]) for _, i in edges]
            if not edges or edges[0][0] > 1:
                edges.insert(0, (1, -2 - ord(word[at])))
                weights.insert(0, voc.byte_logp * len(word[at].encode()))
            masses = [x + beta[at + n] for x, (n, _) in zip(weights, edges)]
            beta[at] = max(masses) + math.log(sum(math.exp(x - max(masses)) for x in masses))
            node = int(lat.node[w]) + at
            a, b = lat.edge[node], lat.edge[node + 1]
            assert list(zip(lat.length[a:b].tolist(), lat.code[a:b].tolist())) == edges
            shares = [math.exp(x - beta[at]) for x in masses]
            assert np.allclose(np.diff(lat.cum[a:b], prepend=0), shares, rtol=0, atol=1e-9) and lat.cum[b - 1] == 1
        got = lat.beta[lat.node[w] : lat.node[w] + len(s)]
        assert np.allclose(got, beta[:-1], rtol=1e-9)


def test_setting_up_works_on_edges_alone():
    """Most characters begin two or three pieces, not one of each length: what is set up follows the former."""
    rng = np.random.default_rng(3)
    words = ["".join(map(chr, rng.integers(97, 123, rng.integers(3, 12)))) for _ in range(20_000)]
    voc = pieces.vocabulary(pieces.MODEL)
    tracemalloc.start()
    try:
        lat = pieces.Lattices(voc, words)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(lat.code) < 3 * len(lat.beta) and most < 200 * len(lat.beta)


def test_ids_of_any_number_are_decoded(monkeypatch):
    enc = pieces.Encoder(pieces.MODEL, 1)
    whole = [[], *(x[0][0].tolist() for x in enc.encode(list(range(len(TEXTS))), TEXTS))]
    want = [b"".join(enc.voc.bytes_of[i] for i in ids)[1:].decode() for ids in whole]
    for n in (50_000, 3, 1):
        monkeypatch.setattr(pieces, "IDS_AT_ONCE", n)
        assert [enc.decode(ids) for ids in whole] == [enc.decode(np.array(ids, np.int32)) for ids in whole] == want
