"""Benchmark decontamination by latent semantic retrieval.

Passages are blocks of BLOCK words (hashed to TERMS columns). One pass over all documents sums the
document frequencies and the sketch T'(T Omega) of the passage-term matrix T; since inverse document
frequencies D only scale columns, D T'(T Omega) is the sketch of the TF-IDF matrix T D for the test
matrix D^-1 Omega, and a Nystrom step gives its leading right singular vectors and values: a
randomised SVD whose size does not depend on the input. A second pass projects passages of one, two
and four blocks and compares them with all benchmark items by cosine in the whitened latent space.
What passes CANDIDATE is verified on the words themselves: the longest common subsequence of the
item and a stretch of at most one and a half times its length, and for paraphrases the answer (the
item's last words) as well.

Texts and items are lower-cased. Items are handled in rounds of at most some ITEMS and ROUND_BYTES, one
round after the other, so what the driver and the tasks hold of the benchmark is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulegrove.llm.common import arrow_bounded, fresh, numbered, table, written

BLOCK = 16
TERMS = 1 << 13
RANK = 32
EXTRA = 8
SCALES = (1, 2, 4)
CANDIDATE = 0.25
#: Share of an item's words, in order, that makes a match; with the answer found, a lower one does.
VERBATIM = 0.6
PARAPHRASE = 0.5
ANSWER_WORDS = 8
PREFIX = 0.75
ANSWER = 0.75
#: Items longer than this are searched by pieces.
ITEM_PIECE = 48
ITEMS = 20_000
#: Items are also split into rounds of at most so many bytes in all.
ROUND_BYTES = 32_000_000
#: Places where item words are found that are held at once.
PLACES = 1_000_000
BYTES_PER_BATCH = 400_000

_ODD = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_WORDY = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, name: str, n: int) -> np.ndarray:
    if len(_powers.get(name, ())) < n:
        steps = np.full(1 << max(16, n.bit_length()), base, np.uint64)
        steps[0] = 1
        _powers[name] = np.multiply.accumulate(steps)
    return _powers[name][:n]


def _hashed(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash, start) of every word of data: runs of letters, digits and non-ASCII bytes."""
    raw = np.frombuffer(data, np.uint8)
    wordy = np.r_[False, _WORDY[raw], False]
    edge = np.flatnonzero(wordy[1:] != wordy[:-1])
    s, e = edge[::2], edge[1::2]
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _power(_ODD, "up", len(raw)), out=sums[1:])
    h = (sums[e] - sums[s]) * _power(_INVERSE, "down", len(raw) + 1)[s]
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9), s


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, text of each) of all texts, long ones in pieces that end between words."""
    parts, owner = [], []
    for i, t in enumerate(texts):
        at = 0
        while len(t) - at > 2 * BYTES_PER_BATCH:
            cut = at + BYTES_PER_BATCH
            while cut < len(t) and _WORDY[t[cut]]:
                cut += 1
            parts.append(t[at:cut])
            owner.append(i)
            at = cut
        parts.append(t[at:])
        owner.append(i)
    hashes, texts_of, at = [], [], 0
    while at < len(parts):
        start, size = at, 0
        while at < len(parts) and (size + len(parts[at]) <= 2 * BYTES_PER_BATCH or at == start):
            size += len(parts[at]) + 1
            at += 1
        own = parts[start:at]
        h, s = _hashed(b"\n".join(own))
        ends = np.cumsum([len(p) + 1 for p in own])
        hashes.append(h)
        texts_of.append(np.array(owner[start:at], np.int64)[np.searchsorted(ends, s, side="right")])
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(texts_of)


def columns_of(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * np.uint64(0x94D049BB133111EB)) >> np.uint64(64 - 13)).astype(np.uint16)


def blocks_of(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, text) of each block of words."""
    if not len(owner):
        return np.zeros(0, np.int64), owner
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    inside = np.arange(len(owner)) - np.repeat(first, np.diff(np.r_[first, len(owner)]))
    starts = np.flatnonzero(inside % BLOCK == 0)
    return starts, owner[starts]


def block_sums(table_: np.ndarray, col: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of the table's rows over each block of words."""
    size = np.diff(np.r_[starts, len(col)])
    at = starts[:, None] + np.arange(BLOCK)
    inside = np.arange(BLOCK) < size[:, None]
    rows = np.where(inside, col[np.minimum(at, len(col) - 1)], TERMS)
    return np.concatenate([table_, np.zeros((1, table_.shape[1]), table_.dtype)])[rows].sum(axis=1)


def _test_matrix() -> np.ndarray:
    return np.random.default_rng(17).normal(size=(TERMS, RANK + EXTRA)).astype(np.float32)


def _batches(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(start, texts) of slices of bounded size; a text alone may be larger."""
    at = 0
    while at < len(texts):
        start, size, part = at, 0, []
        while at < len(texts) and (size < BYTES_PER_BATCH or not part):
            part.append(texts[at].as_py() or b"")
            size += len(part[-1])
            at += 1
        yield start, part


PIECES = 64


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    omega = _test_matrix()
    total = np.zeros((TERMS, RANK + EXTRA))
    df = np.zeros(TERMS)
    n = 0
    for batch in batches:
        for _, texts in _batches(batch.column(0)):
            h, owner = words_of(texts)
            col = columns_of(h)
            starts, _ = blocks_of(owner)
            for a in range(0, len(starts), 4000):
                lo = starts[a]
                hi = starts[a + 4000] if a + 4000 < len(starts) else len(col)
                w, begin = col[lo:hi].astype(np.int64), starts[a : a + 4000] - lo
                x = block_sums(omega, w, begin)
                block = np.repeat(np.arange(len(begin)), np.diff(np.r_[begin, len(w)]))
                for j, values in enumerate(x.T):
                    total[:, j] += np.bincount(w, weights=values[block], minlength=TERMS)
                pairs = np.sort(block * TERMS + w)
                pairs = pairs[np.r_[True, pairs[1:] != pairs[:-1]]]
                df += np.bincount(pairs % TERMS, minlength=TERMS)
                n += len(begin)
    rows = np.concatenate([total, df[:, None]], axis=1).astype(np.float32).reshape(PIECES, -1)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(PIECES, dtype=np.int32)), pa.array([r.tobytes() for r in rows], pa.binary()), pa.array([n] * PIECES, pa.int64())], names=["piece", "sums", "n"]
    )


def _added(key, rows):
    total = np.zeros(TERMS // PIECES * (RANK + EXTRA + 1))
    for b in rows.column("sums"):
        total += np.frombuffer(b.as_py(), np.float32)
    n = sum(rows.column("n").to_pylist())
    return pa.table({"piece": pa.array([key[0].as_py()], pa.int32()), "sums": pa.array([total.astype(np.float32).tobytes()], pa.binary()), "n": pa.array([n], pa.int64())})


def latent_space(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, np.ndarray] | None:
    """(term weights, TERMS x at most RANK, and term frequencies). A passage's sum of weights is its whitened place."""
    arrow_bounded(docs.sparkSession)
    sums = docs.select(F.lower(F.col(text)).cast("binary").alias("_t")).mapInArrow(_sketch, "piece int, sums binary, n long")
    some = sums.withColumn("salt", F.spark_partition_id() % 256).groupBy("piece", "salt").applyInArrow(_added, "piece int, sums binary, n long")
    rows = some.groupBy("piece").applyInArrow(_added, "piece int, sums binary, n long").collect()  # PIECES rows
    if not rows or not rows[0].n:
        return None
    both = np.zeros((PIECES, TERMS // PIECES * (RANK + EXTRA + 1)))
    for r in rows:
        both[r.piece] = np.frombuffer(r.sums, np.float32)
    both = both.reshape(TERMS, RANK + EXTRA + 1)
    y0, df, n = both[:, :-1], both[:, -1], rows[0].n
    idf = np.log((n + 1) / (df + 1)) + 1
    core = _test_matrix().astype(float).T @ y0
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    fine = values > 1e-7 * values.max()
    factor = (idf[:, None] * y0) @ (vectors[:, fine] / np.sqrt(values[fine]))
    u, s, _ = np.linalg.svd(factor, full_matrices=False)
    keep = s[:RANK] > 1e-4 * s[0]
    return (idf[:, None] * u[:, :RANK][:, keep] / s[:RANK][keep]).astype(np.float32), df


class Item:
    """A benchmark text ready for verification."""

    def __init__(self, ids: list[int], words: list[int]):
        self.ids, self.n = ids, len(words)
        self.masks = masks_of(words)
        self.span = self.n + self.n // 2 + 1
        answer = words[-ANSWER_WORDS:]
        self.answer, self.answer_n = masks_of(answer), len(answer)


def masks_of(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


def common(masks: dict[int, int], n: int, words: list[int]) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    full = (1 << n) - 1
    v = full
    for w in words:
        m = masks.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def verified(item: Item, words: list[int], lo: int, hi: int) -> float:
    """Best share of the item found in order in a stretch of words that meets [lo, hi); 0 if no match."""
    begin = max(0, lo - item.n)
    near = words[begin : hi + item.span]
    held = [0, *accumulate(map(item.masks.__contains__, near))]
    best = 0.0
    for at in range(0, max(1, hi - begin), max(1, item.n // 4)):
        if held[min(at + item.span, len(near))] - held[min(at, len(near))] < PARAPHRASE * item.n:
            continue
        part = near[at : at + item.span]
        share = common(item.masks, item.n, part) / item.n
        if share >= VERBATIM or share >= PARAPHRASE and common(item.answer, item.answer_n, part) >= ANSWER * item.answer_n:
            best = max(best, share)
    return best


class Benchmark:
    """Items, unit vectors of their pieces, and the words that a match cannot do without.

    A match has at least the share PARAPHRASE of an item's n words within `span` words. Of the
    item's rarest PREFIX n words it then has at least `least` (the others can make up for the rest),
    so texts without as many of them so close together are left out before anything is compared.
    """

    def __init__(self, rows: list[tuple[list[int], str]], space: np.ndarray, df: np.ndarray):
        self.space, self.items = space, []
        vectors, of, keys, owner, least, span = [], [], [], [], [], []
        for ids, text in rows:
            h, _ = words_of([(text or "").encode()])
            if not len(h):
                continue
            for part in np.array_split(columns_of(h), max(1, -(-len(h) // ITEM_PIECE))):
                v = space[part].sum(axis=0)
                vectors.append(v / max(float(np.linalg.norm(v)), 1e-12))
                of.append(len(self.items))
            n = len(h)
            rarest = h[np.argsort(df[columns_of(h)], kind="stable")]
            size = max(int(np.ceil(PREFIX * n)), n - int(np.ceil(PARAPHRASE * n)) + 1)
            own = np.unique(rarest[:size])
            keys.append(own)
            owner.append(np.full(len(own), len(self.items)))
            least.append(int(np.ceil(PARAPHRASE * n)) - (n - size))
            self.items.append(Item(ids, h.tolist()))
            span.append(self.items[-1].span)
        self.vectors = np.array(vectors, np.float32).reshape(len(of), space.shape[1])
        self.of, self.least, self.span = np.array(of, np.int64), np.array(least, np.int64), np.array(span, np.int64)
        key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        who = np.concatenate(owner) if owner else np.zeros(0, np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.owner = key[order], who[order]
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.key >> np.uint64(44)).astype(np.int64)] = True

    def holders(self, h: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys text * items + item, sorted, and places where enough of an item's words begin close together."""
        at = np.flatnonzero(self.seen[(h >> np.uint64(44)).astype(np.int64)])
        lo, hi = np.searchsorted(self.key, h[at], side="left"), np.searchsorted(self.key, h[at], side="right")
        total = int((hi - lo).sum())
        if total <= PLACES:
            return self._close(self.owner, at, lo, hi, text)
        # a word that many items share: a few items at a time, each with all its places
        change = np.zeros(len(self.key) + 1, np.int64)
        np.add.at(change, lo, 1)
        np.add.at(change, hi, -1)
        of_item = np.bincount(self.owner, weights=np.cumsum(change)[:-1], minlength=len(self.items))
        group = (np.cumsum(of_item) // PLACES).astype(np.int64)
        parts = []
        for g in np.unique(group[of_item > 0]).tolist():
            mine = group[self.owner] == g
            before = np.r_[0, np.cumsum(mine)]
            some = before[hi] > before[lo]
            parts.append(self._close(self.owner[mine], at[some], before[lo[some]], before[hi[some]], text))
        key, place = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((place, key))
        return key[order], place[order]

    def _close(self, owner: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the words at places `at`, which the items owner[lo:hi] hold: those that begin a stretch with enough of them."""
        n = hi - lo
        item = owner[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]
        place = np.repeat(at, n)
        key = text[place] * len(self.items) + item
        order = np.argsort(key, kind="stable")  # places stay in order
        key, place, item = key[order], place[order], item[order]
        last = np.arange(len(key)) + self.least[item] - 1
        fine = last < len(key)
        last = np.minimum(last, len(key) - 1)
        fine &= (key[last] == key) & (place[last] - place < self.span[item])
        return key[fine], place[fine]


MATCHES = "array<struct<item_id:long,share:double,cosine:double>>"
_MATCH = pa.list_(pa.struct([("item_id", pa.int64()), ("share", pa.float64()), ("cosine", pa.float64())]))


def search(texts: list[bytes], bench: Benchmark) -> list[list[dict]]:
    """Matches of each text."""
    found: dict[tuple[int, int], list] = {}
    items, of = bench.items, bench.of
    h, owner = words_of(texts)
    keys, places = bench.holders(h, owner)
    if len(keys):
        mine = np.isin(owner, np.unique(keys // len(items)))
        places = (np.cumsum(mine) - 1)[places]
        spots = keys << 32 | places
        h, owner = h[mine], owner[mine]
        starts, text_of = blocks_of(owner)
        col = columns_of(h).astype(np.int64)
        place = np.concatenate([block_sums(bench.space, col[starts[a] : starts[a + 4000] if a + 4000 < len(starts) else len(col)], starts[a : a + 4000] - starts[a]) for a in range(0, len(starts), 4000)])
        for scale in SCALES:
            if scale == 1:
                sums, at = place, np.arange(len(starts))
            else:
                at = np.flatnonzero(text_of[scale - 1 :] == text_of[: len(text_of) - scale + 1]) if len(text_of) >= scale else np.zeros(0, np.int64)
                sums = sum(place[at + i] for i in range(scale)) if len(at) else place[:0]
            norms = np.maximum(np.sqrt(np.einsum("ij,ij->i", sums, sums)), 1e-12)
            for b in range(0, len(at), 4096):
                cos = (sums[b : b + 4096] @ bench.vectors.T) / norms[b : b + 4096, None]
                r, c = np.nonzero(cos >= CANDIDATE)
                key = (text_of[at[b + r]] * len(items) + of[c]) << 32
                begin, span = starts[at[b + r]], bench.span[of[c]]
                where = np.minimum(np.searchsorted(spots, key | np.maximum(0, begin - span)), len(spots) - 1)
                hit = (spots[where] >= key | np.maximum(0, begin - span)) & (spots[where] <= (key | (begin + scale * BLOCK + span)))
                for i, j in zip(r[hit].tolist(), c[hit].tolist()):
                    k = int(at[b + i])
                    found.setdefault((int(text_of[k]), int(of[j])), []).append((k, scale, float(cos[i, j])))
    out: list[list[dict]] = [[] for _ in texts]
    if not found:
        return out
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    held: dict[int, list[int]] = {}
    for (t, j), hits in found.items():
        if t not in held:
            held = {t: h[first[t] : first[t + 1]].tolist()}
        stretches: list[list] = []  # hits that overlap are verified together
        for k, scale, cos in sorted(hits):
            lo = int(starts[k] - first[t])
            hi = lo + scale * BLOCK
            if stretches and lo <= stretches[-1][1]:
                stretches[-1][1] = max(stretches[-1][1], hi)
                stretches[-1][2] = max(stretches[-1][2], cos)
            else:
                stretches.append([lo, hi, cos])
        share, cos = max((verified(items[j], held[t], lo, hi), cos) for lo, hi, cos in stretches)
        if share:
            out[t] += [{"item_id": i, "share": share, "cosine": cos} for i in items[j].ids]
    return out


def _finder(spark, bench: Benchmark):
    """(column function from a text to its matches, broadcast that it reads)."""
    held = spark.sparkContext.broadcast(bench)

    @F.arrow_udf(MATCHES)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = held.value
        for column in batches:
            hits = [x for _, texts in _batches(column) for x in search(texts, own)]
            yield pa.array(hits, _MATCH)

    find = find.asNondeterministic()  # runs once, wherever its result is used
    return lambda text: find(F.lower(F.col(text)).cast("binary")), held


def matched(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", into: str = "matches") -> DataFrame:
    """docs with `into`: array of struct(item_id, share, cosine), empty for clean rows.

    Items without words match nothing; equal items are searched once and all reported. Null and
    empty texts are clean. Every row is searched on its own, whole; repeated rows get equal matches.
    An empty benchmark or table gives no matches. A column of that name is replaced; all others
    stay, whatever they are called. A benchmark of several rounds numbers and writes the rows once.
    """
    spark = docs.sparkSession
    arrow_bounded(spark)
    none = F.expr(f"CAST(array() AS {MATCHES})")
    fitted = latent_space(docs, text)
    once = benchmark.filter(F.col(item_text).isNotNull()).groupBy(F.lower(F.col(item_text)).alias("t")).agg(F.sort_array(F.collect_list(F.col(item).cast("long"))).alias("ids"))
    size = once.agg(F.count("*").alias("n"), F.sum(F.octet_length("t")).alias("bytes")).first()
    rounds = max(-(-size.n // ITEMS), -(-(size.bytes or 0) // ROUND_BYTES)) if fitted is not None else 0
    if not rounds:
        return docs.withColumn(into, none)

    def finder(k: int):
        part = once.filter(F.pmod(F.xxhash64("t"), F.lit(rounds)) == k) if rounds > 1 else once
        return _finder(spark, Benchmark([(r.ids, r.t) for r in part.orderBy("t").collect()], *fitted))

    if rounds == 1:
        return docs.withColumn(into, finder(0)[0](text))
    row, hit = fresh("_row", docs), fresh("_hit", docs)
    rows, found = numbered(docs, row), None
    for k in range(rounds):
        find, held = finder(k)
        some = written(rows.select(row, find(text).alias(hit)).filter(F.size(hit) > 0))
        held.destroy()
        found = some if found is None else found.union(some)
    every = written(found.groupBy(row).agg(F.flatten(F.collect_list(hit)).alias(hit)))
    return rows.join(every, row, "left").withColumn(into, F.coalesce(hit, none)).select(*[c for c in docs.columns if c != into], into)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """docs without the rows that match a benchmark item."""
    into = fresh("_matches", docs)
    return matched(docs, benchmark, text, into=into).filter(F.size(into) == 0).select(*docs.columns)


def op10_decontamination(spark, sf_dir):
    """Contaminated documents with the items they hold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = matched(docs, table(spark, sf_dir, "benchmark")).filter(F.size("matches") > 0)
    hit = hits.select("doc_id", F.explode("matches").alias("m"))
    return hit.select("doc_id", "m.item_id", F.round("m.share", 6).alias("share"), F.round("m.cosine", 4).alias("cosine"))
