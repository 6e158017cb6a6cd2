"""Repeated byte strings across documents, by suffix arrays.

A byte goes if a string of LEAST bytes that covers it also starts in a document with a smaller key.
Comparing all suffixes of all documents would move every text many times, so equal strings are first
brought together: each string of LEAST bytes is filed under the least hash of the GRAM-byte pieces
in it. Neighbouring strings mostly share that piece, so a document falls into contexts: stretches
all of whose strings have one piece. Equal strings have equal pieces, wherever they stand, so no
match is lost; and only pieces that two documents hold need any more work.

So the pieces travel first, as hashes alone: each source (SOURCE_ROWS rows in a row) is told which
of its pieces occur elsewhere as well. Then the contexts of those are dealt by piece to buckets,
equal ones once with their holders. In each bucket they are
laid out in shards of at most SHARD bytes. A shard's suffix array is built by Larsson-Sadakane
refinement (prefix doubling that sorts only groups not yet split) on packed 64-bit keys, Kasai's
rule gives the common prefixes of neighbours, and runs with LEAST bytes in common are the classes of
equal strings; each knows the smallest document that holds it. Where the contexts of one piece fill
several shards, their sorted classes are merged by binary search. Holders with a larger key lose the
string; the stretches go back to the documents, which are cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulegrove.llm.common import numbered, table, written

LEAST = 50
GRAM = 20
#: Positions are packed in 21 bits.
SHARD = (1 << 21) - 64
FLUSH_BYTES = 24_000_000
TEXT_PER_STEP = 1_000_000
SOURCE_ROWS = 512
#: Text per bucket of contexts and of piece hashes.
BUCKET_BYTES = 24_000_000
PIECE_BUCKET_BYTES = 60_000_000
LAST_KEY = np.iinfo(np.int64).max

_ODD = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, name: str, n: int) -> np.ndarray:
    if len(_powers.get(name, ())) < n:
        steps = np.full(1 << max(16, n.bit_length()), base, np.uint64)
        steps[0] = 1
        _powers[name] = np.multiply.accumulate(steps)
    return _powers[name][:n]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return h ^ (h >> np.uint64(29))


def contexts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(joined bytes, piece hash, text, start in joined, start in text, length) of all contexts."""
    joined = b"".join(texts)
    data = np.frombuffer(joined, np.uint8)
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_ODD, "up", n), out=sums[1:])
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    none = np.zeros(0, np.int64)
    windows = n - LEAST + 1
    if windows < 1 or not (sizes >= LEAST).any():
        return data, none.astype(np.uint64), none, none, none, none
    low = _mixed((sums[GRAM:] - sums[:-GRAM]) * _power(_INVERSE, "down", n + 1)[: n + 1 - GRAM])
    width, span = 1, LEAST - GRAM + 1
    while width * 2 <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span:
        low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
    starts = ends - sizes
    fine = np.zeros(windows + 1, np.int8)
    ok = sizes >= LEAST
    np.add.at(fine, starts[ok], 1)
    np.add.at(fine, ends[ok] - LEAST + 1, -1)
    fine = np.cumsum(fine[:windows]).astype(bool)
    new = np.ones(windows, bool)
    new[1:] = (low[1:] != low[:-1]) | ~fine[:-1]
    new[starts[ok]] = True
    first = np.flatnonzero(new & fine)
    stop = np.flatnonzero(np.r_[(new[1:] & fine[1:]) | ~fine[1:], True] & fine)
    text = np.searchsorted(ends, first, side="right")
    return data, low[first], text, first, first - starts[text], stop - first + LEAST


def _hash_of(sums: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    return (sums[at + size] - sums[at]) * _power(_INVERSE, "down", len(sums))[at]


def _gather(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of data, joined."""
    total = int(size.sum())
    if not total:
        return np.zeros(0, np.uint8)
    step = np.ones(total, np.int64)
    heads = np.cumsum(size) - size
    step[0] = at[0]
    step[heads[1:]] = at[1:] - (at[:-1] + size[:-1] - 1)
    return data[np.cumsum(step)]


class _Filer:
    """Collects contexts of a task and emits one blob a bucket when enough have come."""

    def __init__(self, buckets: int):
        self.buckets, self.parts, self.size = buckets, [], 0
        self.pack = zstandard.ZstdCompressor(level=1)

    def add(self, rows: np.ndarray, keys: np.ndarray, texts: list[bytes], shared: np.ndarray | None = None) -> None:
        data, piece, text, at, start, size = contexts(texts)
        if shared is not None:
            where = np.searchsorted(shared, piece >> np.uint64(8))
            hit = where < len(shared)
            hit[hit] = shared[where[hit]] == (piece >> np.uint64(8))[hit]
            piece, text, at, start, size = (x[hit] for x in (piece, text, at, start, size))
        if not len(piece):
            return
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_ODD, "up", len(data)), out=sums[1:])
        self.parts.append((piece, _hash_of(sums, at, size), rows[text], keys[text], start.astype(np.int32), size.astype(np.int32), _gather(data, at, size)))
        self.size += int(size.sum()) + 40 * len(size)

    def flush(self) -> Iterator[tuple[int, bytes]]:
        if not self.parts:
            return
        piece, whole, row, key, start, size, data = (np.concatenate(x) for x in zip(*self.parts))
        self.parts, self.size = [], 0
        at = np.cumsum(size, dtype=np.int64) - size
        bucket = ((piece >> np.uint64(8)) % np.uint64(self.buckets)).astype(np.int64)
        order = np.lexsort((whole, piece, bucket))
        piece, whole, row, key, start, size, at, bucket = (x[order] for x in (piece, whole, row, key, start, size, at, bucket))
        fresh = np.r_[True, (piece[1:] != piece[:-1]) | (whole[1:] != whole[:-1]) | (size[1:] != size[:-1])]
        heads = np.flatnonzero(fresh)
        counts = np.diff(np.r_[heads, len(piece)])
        b_heads = bucket[heads]
        cuts = np.flatnonzero(np.r_[True, b_heads[1:] != b_heads[:-1]])
        for lo, hi in zip(cuts, np.r_[cuts[1:], len(heads)]):
            u = heads[lo:hi]
            a, b = heads[lo], heads[hi] if hi < len(heads) else len(piece)
            docs, own = np.unique(row[a:b], return_inverse=True)
            first = np.zeros(len(docs), np.int64)
            first[own] = key[a:b]
            head = np.array([len(u), b - a, len(docs)], np.int64)
            body = [head, piece[u], size[u], counts[lo:hi].astype(np.int32), own.astype(np.int32), start[a:b], docs, first]
            raw = b"".join(x.tobytes() for x in body) + _gather(data, at[u], size[u].astype(np.int64)).tobytes()
            yield int(b_heads[lo]), self.pack.compress(raw)


def _unpacked(blob: bytes):
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, holders, docs = np.frombuffer(raw, np.int64, 3)
    at, out = 24, []
    for kind, count in ((np.uint64, n), (np.int32, n), (np.int32, n), (np.int32, holders), (np.int32, holders), (np.int64, docs), (np.int64, docs)):
        out.append(np.frombuffer(raw, kind, count, at))
        at += out[-1].nbytes
    return (*out, np.frombuffer(raw, np.uint8, offset=at))


def suffix_array(data: np.ndarray, depth: int = LEAST) -> np.ndarray:
    """Suffixes in order of their first `depth` bytes (ends count as smallest), by Larsson-Sadakane refinement.

    A group of suffixes that agree so far carries the place of its first member as rank. Each round
    sorts the members of unsplit groups by the rank of the suffix that begins where their common
    prefix ends; group, rank and position share one 64-bit key.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    bits = np.uint64(21)
    low = np.uint64((1 << 21) - 1)
    padded = np.zeros(n + depth + 8, np.uint16)
    padded[:n] = data.astype(np.uint16) + 1
    # five symbols of 257 values fit in 41 bits
    key = np.zeros(n, np.uint64)
    for i in range(5):
        key = key * np.uint64(257) + padded[i : i + n]
    rest = np.arange(n, dtype=np.uint64)
    packed = np.sort((key << bits) | rest)
    sa = (packed & low).astype(np.int64)
    head = np.r_[True, (packed[1:] >> bits) != (packed[:-1] >> bits)]
    rank = np.zeros(n + depth + 8, np.int64)
    h = 5
    while True:
        place = np.flatnonzero(head)
        first = np.repeat(place, np.diff(np.r_[place, n]))
        rank[sa] = first + 1
        if h >= depth or len(place) == n:
            return sa
        step = min(h, depth - h)
        single = head & np.r_[head[1:], True]
        open_ = np.flatnonzero(~single)
        own = sa[open_]
        packed = np.sort(((first[open_].astype(np.uint64) << np.uint64(42)) | (rank[own + step].astype(np.uint64) << bits)) | own.astype(np.uint64))
        sa[open_] = (packed & low).astype(np.int64)
        head[open_[1:]] |= (packed[1:] >> bits) != (packed[:-1] >> bits)
        h += step


def common_prefixes(data: np.ndarray, sa: np.ndarray, cap: int = LEAST) -> np.ndarray:
    """lcp[i]: bytes that suffixes sa[i - 1] and sa[i] have in common, at most cap; lcp[0] = 0.

    Kasai's rule in vector form: positions divisible by STRIDE are compared from their start; the
    others begin at what their predecessor's prefix leaves, which holds where that is below the cap
    (at the cap, the order beyond it is open).
    """
    stride, n = 8, len(data)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    padded = np.zeros(n + cap + 16, np.uint8)
    padded[:n] = data
    words = np.ndarray((n + cap + 8,), "<u8", padded, 0, (1,))
    prev = np.full(n, -1, np.int64)
    prev[sa[1:]] = sa[:-1]
    plcp = np.zeros(n, np.int64)

    def compare(at: np.ndarray, known: np.ndarray) -> None:
        other = prev[at]
        fine = other >= 0
        at, other, size = at[fine], other[fine], known[fine].copy()
        limit = np.minimum(cap, n - np.maximum(at, other))
        live = np.arange(len(at))
        while len(live):
            x = words[at[live] + size[live]] ^ words[other[live] + size[live]]
            same = np.where(x == 0, 8, np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)) >> 3)
            size[live] += same
            live = live[(same == 8) & (size[live] < limit[live])]
        plcp[at] = np.minimum(size, limit)

    bases = np.arange(0, n, stride)
    compare(bases, np.zeros(len(bases), np.int64))
    others = np.flatnonzero(np.arange(n) % stride)
    base = plcp[others - others % stride]
    compare(others, np.where(base < cap, np.maximum(0, base - others % stride), 0))
    out[1:] = plcp[sa[1:]]
    return out


def _shard_classes(data: np.ndarray, start: np.ndarray, size: np.ndarray, least: np.ndarray):
    """(positions of whole strings in suffix order, their class, each class's smallest key)."""
    sa = suffix_array(data)
    lcp = common_prefixes(data, sa)
    cls = np.cumsum(lcp < LEAST) - 1
    whole = np.zeros(len(data) + 1, np.int8)
    np.add.at(whole, start, 1)
    np.add.at(whole, start + size - LEAST + 1, -1)
    whole = np.cumsum(whole[:-1]).astype(bool)
    mine = whole[sa]
    pos, cls = sa[mine], cls[mine]
    _, cls = np.unique(cls, return_inverse=True)
    of = np.searchsorted(start, pos, side="right") - 1
    heads = np.flatnonzero(np.r_[True, cls[1:] != cls[:-1]])
    return pos, cls, np.minimum.reduceat(least[of], heads)


def _keys(data: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """The strings at pos, as sortable fixed-width bytes."""
    return np.ndarray((len(data) - LEAST + 1,), f"S{LEAST}", data.tobytes(), 0, (1,))[pos]


def smallest_holders(piece: np.ndarray, data: np.ndarray, size: np.ndarray, least: np.ndarray, shard: int = SHARD) -> np.ndarray:
    """For each string of each context (in order): the smallest key among all contexts that hold it.

    Contexts come sorted by piece and joined in data; least is the smallest key of each.
    """
    at = np.cumsum(size) - size
    counts = size - LEAST + 1
    out_at = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.int64)
    # cut contexts that are too long for a shard; pieces overlap so that every string is in one
    cut = []
    for i in np.flatnonzero(size > shard):
        for a in range(0, int(size[i]) - LEAST + 1, shard - LEAST + 1):
            cut.append((int(i), a, min(shard, int(size[i]) - a)))
    fits = np.flatnonzero(size <= shard)
    ctx = np.r_[fits, np.array([c[0] for c in cut], np.int64)]
    off = np.r_[np.zeros(len(fits), np.int64), np.array([c[1] for c in cut], np.int64)]
    length = np.r_[size[fits], np.array([c[2] for c in cut], np.int64)]
    order = np.lexsort((off, ctx))
    ctx, off, length = ctx[order], off[order], length[order]
    # shards: as many pieces in a row as fit
    bounds, total = [0], 0
    for i, n in enumerate(length.tolist()):
        if total + n > shard:
            bounds.append(i)
            total = 0
        total += n
    bounds.append(len(length))
    edges = {int(piece[ctx[b]]) for b in bounds[1:-1] if piece[ctx[b]] == piece[ctx[b - 1]]}
    held = []  # shards whose classes must be merged with another's
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        own, part = ctx[lo:hi], length[lo:hi]
        text = _gather(data, at[own] + off[lo:hi], part)
        begin = np.cumsum(part) - part
        pos, cls, smallest = _shard_classes(text, begin, part, least[own])
        of = np.searchsorted(begin, pos, side="right") - 1
        where = out_at[own[of]] + off[lo:hi][of] + pos - begin[of]
        out[where] = smallest[cls]
        if edges and np.isin(piece[own], np.array(list(edges), np.uint64)).any():
            mine = np.isin(piece[own[of]], np.array(list(edges), np.uint64))
            # one place of each class, in suffix order
            heads = np.flatnonzero(mine & np.r_[True, cls[1:] != cls[:-1]])
            held.append((_keys(text, pos[heads]), smallest[cls[heads]], where[mine], cls[mine], cls[heads]))
    if len(held) > 1:
        keys, best = held[0][0], held[0][1].copy()
        for own, low, *_ in held[1:]:
            at_ = np.searchsorted(keys, own)
            hit = at_ < len(keys)
            hit[hit] = keys[at_[hit]] == own[hit]
            np.minimum.at(best, at_[hit], low[hit])
            keys, best = np.insert(keys, at_[~hit], own[~hit]), np.insert(best, at_[~hit], low[~hit])
        for own, _, where, cls, classes in held:
            merged = best[np.searchsorted(keys, own)]
            out[where] = merged[np.searchsorted(classes, cls)]
    return out


def covered(blobs: list[bytes], shard: int = SHARD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the stretches that holders with a larger key lose, for one bucket."""
    parts = [_unpacked(b) for b in blobs]
    none = np.zeros(0, np.int64)
    if not parts:
        return none, none, none
    piece = np.concatenate([p[0] for p in parts])
    size = np.concatenate([p[1] for p in parts]).astype(np.int64)
    count = np.concatenate([p[2] for p in parts]).astype(np.int64)
    start = np.concatenate([p[4] for p in parts]).astype(np.int64)
    row = np.concatenate([p[5][p[3]] for p in parts])
    key = np.concatenate([p[6][p[3]] for p in parts])
    data = np.concatenate([p[7] for p in parts])
    del parts
    h_at = np.cumsum(count) - count
    low, high = np.minimum.reduceat(key, h_at), np.maximum.reduceat(key, h_at)
    at = np.cumsum(size) - size
    order = np.argsort(piece, kind="stable")
    sorted_piece = piece[order]
    heads = np.flatnonzero(np.r_[True, sorted_piece[1:] != sorted_piece[:-1]])
    differ = np.minimum.reduceat(low[order], heads) < np.maximum.reduceat(high[order], heads)
    pick = order[np.repeat(differ, np.diff(np.r_[heads, len(order)]))]
    if not len(pick):
        return none, none, none
    # equal contexts of several tasks become one
    known: dict[tuple[int, bytes], int] = {}
    buffer = data.tobytes()
    same = np.empty(len(pick), np.int64)
    firsts = []
    for i, (c, a, n) in enumerate(zip(pick.tolist(), at[pick].tolist(), size[pick].tolist())):
        j = known.setdefault(buffer[a : a + n], len(firsts))
        if j == len(firsts):
            firsts.append(c)
        same[i] = j
    firsts = np.array(firsts, np.int64)
    least = np.full(len(firsts), LAST_KEY)
    np.minimum.at(least, same, low[pick])
    del known, buffer
    by_string = smallest_holders(piece[firsts], _gather(data, at[firsts], size[firsts]), size[firsts], least, shard)
    s_count = size[firsts] - LEAST + 1
    s_at = np.cumsum(s_count) - s_count
    # every holder against every string of its context, in slices
    holders = np.repeat(np.arange(len(pick)), count[pick])
    h_of = np.repeat(h_at[pick], count[pick]) + (np.arange(len(holders)) - np.repeat(np.cumsum(count[pick]) - count[pick], count[pick]))
    rows, begins, stops = [], [], []
    work = s_count[same[holders]]
    slices = np.searchsorted(np.cumsum(work), np.arange(0, int(work.sum()), 4_000_000))
    for a, b in zip(slices, np.r_[slices[1:], len(holders)]):
        if a == b:
            continue
        h, n, ctx = h_of[a:b], work[a:b], same[holders[a:b]]
        inside = np.cumsum(n) - n
        offset = np.arange(int(n.sum())) - np.repeat(inside, n)
        gone = by_string[np.repeat(s_at[ctx], n) + offset] < np.repeat(key[h], n)
        on = gone & np.r_[True, ~gone[:-1]]
        on[inside] = gone[inside]
        off = gone & np.r_[~gone[1:], True]
        lasts = inside + n - 1
        off[lasts] = gone[lasts]
        first, last = np.flatnonzero(on), np.flatnonzero(off)
        who = h[np.searchsorted(inside, first, side="right") - 1]
        rows.append(row[who])
        begins.append(start[who] + offset[first])
        stops.append(start[who] + offset[last] + LEAST)
    if not rows:
        return none, none, none
    return np.concatenate(rows), np.concatenate(begins), np.concatenate(stops)


def merged(begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint stretches that do not touch."""
    if not len(begin):
        return begin, stop
    order = np.argsort(begin, kind="stable")
    begin, stop = begin[order], np.maximum.accumulate(stop[order])
    new = np.r_[True, begin[1:] > stop[:-1]]
    return begin[new], stop[np.r_[new[1:], True]]


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[bytes]]]:
    """(source, rows, keys, texts) of columns source, row, key, text, in runs of one source."""
    for batch in batches:
        source, rows, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        texts, at = batch.column(3), 0
        while at < len(batch):
            begin, size, part = at, 0, []
            while at < len(batch) and source[at] == source[begin] and (size < TEXT_PER_STEP or not part):
                part.append(texts[at].as_py() or b"")
                size += len(part[-1])
                at += 1
            yield int(source[begin]), rows[begin:at], keys[begin:at], part


def _packed(source: np.ndarray, piece: np.ndarray, many: np.ndarray, pack) -> bytes:
    """Sorted pieces of 56 bits by byte planes, with their sources."""
    ids, own = np.unique(source, return_inverse=True)
    planes = piece.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 1:].T
    return pack.compress(np.array([len(piece), len(ids)], np.int64).tobytes() + ids.tobytes() + own.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes() + many.astype(np.uint8).tobytes() + planes.tobytes())


def _opened(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, m = np.frombuffer(raw, np.int64, 2)
    ids = np.frombuffer(raw, np.int64, m, 16)
    at = 16 + 8 * m
    own = np.frombuffer(raw, np.uint8, 4 * n, at).reshape(4, n).T.copy().view(np.uint32).ravel()
    many = np.frombuffer(raw, np.uint8, n, at + 4 * n).astype(bool)
    planes = np.frombuffer(raw, np.uint8, 7 * n, at + 5 * n).reshape(7, n)
    full = np.zeros((n, 8), np.uint8)
    full[:, 1:] = planes.T
    return ids[own], full.view(">u8").ravel().astype(np.uint64), many


def _announce(buckets: int):
    """The distinct pieces of each source, filed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            if not parts:
                return
            source, piece, key = (np.concatenate(x) for x in zip(*parts))
            parts.clear()
            order = np.lexsort((source, piece, piece % np.uint64(buckets)))
            source, piece, key = source[order], piece[order], key[order]
            heads = np.flatnonzero(np.r_[True, (piece[1:] != piece[:-1]) | (source[1:] != source[:-1])])
            many = np.minimum.reduceat(key, heads) < np.maximum.reduceat(key, heads)
            source, piece = source[heads], piece[heads]
            bucket = piece % np.uint64(buckets)
            cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            for a, b in zip(cuts, np.r_[cuts[1:], len(piece)]):
                blob = _packed(source[a:b], piece[a:b], many[a:b], pack)
                yield pa.RecordBatch.from_arrays([pa.array([int(bucket[a])], pa.int32()), pa.array([blob], pa.binary())], names=["bucket", "blob"])

        for source, _, keys, texts in _steps(batches):
            _, piece, text, *_ = contexts(texts)
            if len(piece):
                parts.append((np.full(len(piece), source), piece >> np.uint64(8), keys[text]))
                size += 24 * len(piece)
                if size > 2 * FLUSH_BYTES:
                    yield from out()
                    size = 0
        yield from out()

    return run


def _shared(key, rows):
    """The pieces of a bucket that two sources, or two keys of one source, hold, by source.

    A source that is flushed in parts announces a piece once a part; those count as two holders,
    since `many` knows the keys of one part only.
    """
    source, piece, many = (np.concatenate(x) for x in zip(*(_opened(b.as_py()) for b in rows.column("blob"))))
    order = np.argsort(piece, kind="stable")
    source, piece, many = source[order], piece[order], many[order]
    heads = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
    count = np.diff(np.r_[heads, len(piece)])
    told = np.repeat(np.maximum.reduceat(many, heads) | (count > 1), count)
    source, piece = source[told], piece[told]
    order = np.argsort(source, kind="stable")
    source, piece = source[order], piece[order]
    heads = np.flatnonzero(np.r_[True, source[1:] != source[:-1]]) if len(source) else np.zeros(0, np.int64)
    blobs = [np.unique(piece[a:b]).tobytes() for a, b in zip(heads, np.r_[heads[1:], len(piece)])]
    return pa.table({"source": pa.array(source[heads], pa.int64()), "pieces": pa.array(blobs, pa.binary())})


def _file(buckets: int):
    """Contexts of shared pieces. Rows come by source: first its lists of pieces, then its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filer = _Filer(buckets)
        current, lists, shared = None, [], None

        def out() -> Iterator[pa.RecordBatch]:
            for bucket, blob in filer.flush():
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([blob], pa.binary())], names=["bucket", "blob"])

        for batch in batches:
            source = batch.column(0).to_numpy(zero_copy_only=False)
            pieces = batch.column(4)
            cuts = np.flatnonzero(np.r_[True, source[1:] != source[:-1]]) if len(source) else []
            for a, b in zip(cuts, np.r_[cuts[1:], len(source)]):
                if source[a] != current:
                    current, lists, shared = source[a], [], None
                part = batch.slice(a, b - a)
                own = [x.as_py() for x in pieces.slice(a, b - a) if x.is_valid]
                lists += [np.frombuffer(x, np.uint64) for x in own]
                rest = part.slice(len(own))
                if not len(rest) or not lists:
                    continue
                if shared is None:
                    shared = np.sort(np.concatenate(lists))
                for _, rows, keys, texts in _steps(iter([rest])):
                    filer.add(rows, keys, texts, shared)
                    if filer.size >= FLUSH_BYTES:
                        yield from out()
        yield from out()

    return run


def _lost(key, rows):
    row, begin, stop = covered([b.as_py() for b in rows.column("blob")])
    return pa.table({"row": pa.array(row, pa.int64()), "lost": pa.array(begin << 32 | stop, pa.int64())})


def stretches(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return merged(packed >> 32, packed & 0xFFFFFFFF)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for key, cell, lost in zip(*batch.columns):
            text = cell.as_py() or b""
            begin, stop = stretches(np.array(lost.as_py() or [], np.int64))
            edges = [0, *np.stack([begin, stop], axis=1).ravel().tolist(), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
            out.append((key.as_py(), len(text), len(text) - len(kept), len(begin), hashlib.sha256(kept).hexdigest(), kept))
        cols = list(zip(*out)) or [()] * 6
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def drop_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", with_kept: bool = True) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept_sha256 and kept (bytes) of every row of docs.

    Strings are judged on the input, overlaps count, and matches never cross rows. Null and empty
    texts and texts shorter than LEAST lose nothing. A null key counts as larger than all others;
    rows with equal keys do not take from each other. Repeated rows are returned as often as they
    come; an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).cast("string").cast("binary").alias("_text"))
    rows = numbered(rows, "_row")
    total = rows.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0)).alias("n")).first().n
    filed = rows.filter(F.octet_length("_text") >= LEAST).select(
        F.expr(f"_row div {SOURCE_ROWS}").alias("source"), F.col("_row").alias("row"), F.coalesce("_key", F.lit(int(LAST_KEY))).alias("key"), "_text"
    )
    announced = filed.mapInArrow(_announce(max(1, -(-total // PIECE_BUCKET_BYTES))), "bucket int, blob binary")
    shared = announced.groupBy("bucket").applyInArrow(_shared, "source long, pieces binary")
    # within a source, lists come before texts
    both = filed.withColumn("pieces", F.lit(None).cast("binary")).unionByName(shared, allowMissingColumns=True)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = both.repartition(n, "source").sortWithinPartitions("source", F.col("pieces").isNull())
    blobs = both.mapInArrow(_file(max(1, -(-total // BUCKET_BYTES))), "bucket int, blob binary")
    lost = written(blobs.groupBy("bucket").applyInArrow(_lost, "row long, lost long"))
    per = lost.groupBy("row").agg(F.collect_list("lost").alias("lost"))
    joined = rows.join(per.hint("shuffle_hash"), rows._row == per.row, "left").select("_key", "_text", "lost")
    out = joined.mapInArrow(_cut, "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out.withColumnRenamed("key", key) if with_kept else out.drop("kept").withColumnRenamed("key", key)


def op4_repeats(spark, sf_dir):
    return drop_repeats(table(spark, sf_dir, "documents"), with_kept=False)
