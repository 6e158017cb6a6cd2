"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints. Texts are lower-cased (A-Z), split at ASCII blanks, and every run of four words is
hashed with XXH64; a bit of the 64-bit fingerprint is one if over half the hashes have it.

Links. Two fingerprints link when at most RADIUS = 4 bits differ. Equal fingerprints are one node
from the start. If two differ by at most four bits, some half of 32 bits differs by at most two, so
flipping up to half of that (one bit) on either side meets at a common variant: each fingerprint
emits the 33 variants of each half (66 rows), the rows are shuffled on the variant, and what
collides is verified bit by bit: what all pairs of a variant would connect comes out as a spanning
forest, fewer links than members. A variant with more than DENSE fingerprints would need too many
comparisons; all fingerprints in such a variant go to the full-width form instead: each emits its
2,081 variants within two bits of all 64. There any two in one variant are within four bits of each
other, so a star to the least is exact and nothing is compared. Both ends of a link in a dense
variant are dense, so no link is lost, and no task holds or pairs an unbounded group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulegrove.llm.common import arrow_bounded, fresh, numbered, table, written
from rulegrove.llm.components import components

RADIUS = 4
SHINGLE = 4
SEED = 42
DENSE = 4096
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
BYTES_PER_BATCH = 1_000_000


def shingle_hashes(text: bytes, width: int = SHINGLE) -> list[int]:
    words = text.translate(LOWER).split()
    if not words:
        return []
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    joined = b" ".join(words)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *[e + 1 for e in ends[: len(words) - width]]]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :])]


def majority(hashes: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprints of consecutive groups of hashes; none: zero."""
    out = np.zeros(len(counts), dtype=np.uint64)
    full = np.flatnonzero(counts)
    # in slices, so that the unpacked bits (64 bytes a hash) stay small
    for part in np.array_split(full, max(1, int(counts.sum() // 200_000))):
        if not len(part):
            continue
        a, b = starts[part[0]], starts[part[-1]] + counts[part[-1]]
        bits = np.unpackbits(hashes[a:b].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones = np.add.reduceat(bits, starts[part] - a, axis=0, dtype=np.int32)
        out[part] = np.packbits(ones * 2 > counts[part][:, None], axis=1).view(">u8").ravel()
    return out


def fingerprints_of(texts: list[bytes]) -> np.ndarray:
    lists = [shingle_hashes(t) for t in texts]
    counts = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    hashes = np.fromiter((h for x in lists for h in x), dtype=np.uint64, count=int(counts.sum()))
    return majority(hashes, np.cumsum(counts) - counts, counts)


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, texts = batch.column(0), batch.column(1)
        at = 0
        while at < len(batch):
            own, size = [], 0
            start = at
            while at < len(batch) and (size < BYTES_PER_BATCH or not own):
                own.append(texts[at].as_py() or b"")
                size += len(own[-1])
                at += 1
            fps = fingerprints_of(own)
            yield pa.RecordBatch.from_arrays([keys.slice(start, at - start), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp): the fingerprint as a signed 64-bit number. Null texts count as empty (zero)."""
    arrow_bounded(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(_fingerprint_batches, "doc_id long, fp long").withColumnRenamed("doc_id", key)


HALF_FLIPS = np.array([0, *[1 << i for i in range(32)]], dtype=np.uint64)


def _full_flips() -> np.ndarray:
    one = [1 << i for i in range(64)]
    return np.array([0, *one, *[a | b for i, a in enumerate(one) for b in one[:i]]], dtype=np.uint64)


def _half_variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (variant, fp). The top bit of nothing is needed: 33 bits hold half and value."""
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for part in np.array_split(fps, max(1, len(fps) // 4096)):
            low = (part & np.uint64(0xFFFFFFFF))[:, None] ^ HALF_FLIPS
            high = ((part >> np.uint64(32))[:, None] ^ HALF_FLIPS) | np.uint64(1 << 32)
            keys = np.concatenate([low, high], axis=1).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.repeat(part, 66).view(np.int64))], names=["variant", "fp"])


def _full_variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flips = _full_flips()
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for part in np.array_split(fps, max(1, len(fps) // 64)):
            keys = (part[:, None] ^ flips).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.repeat(part, len(flips)).view(np.int64))], names=["variant", "fp"])


def spanning(x: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Index of an earlier linked member for each of a group's fingerprints (its own: none).

    Breadth-first: a member is compared with those not reached yet, so a tight group of any size
    takes a few passes, and the links that come out connect what all pairs would.
    """
    n = len(x)
    parent = np.arange(n)
    open_ = np.arange(1, n)
    frontier = [0] if n else []
    while len(open_):
        if not frontier:
            frontier = [int(open_[0])]
            open_ = open_[1:]
            continue
        at = frontier.pop()
        near = np.bitwise_count(x[open_] ^ x[at]) <= radius
        hit = open_[near]
        if len(hit):
            parent[hit] = at
            frontier.extend(hit.tolist())
            open_ = open_[~near]
    return parent


def _verify_runs(batches: Iterator[pa.RecordBatch], limit: int = DENSE) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by variant. Emits a forest of links (a, b) within RADIUS for each run, or (a, null) for dense members."""

    def forest(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All whole runs in keys, each of at most `limit` rows."""
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        two = starts[sizes == 2]
        two = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= RADIUS]
        found_a, found_b = [fps[two]], [fps[two + 1]]
        for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            part = fps[s : s + n]
            parent = spanning(part)
            own = np.flatnonzero(parent != np.arange(n))
            found_a.append(part[own])
            found_b.append(part[parent[own]])
        return np.concatenate(found_a), np.concatenate(found_b)

    def out(a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
        other = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b.view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), other], names=["a", "b"])

    held_k, held_f = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    dense_key = None  # the variant whose run is known to be dense
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        fps = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        keys, fps = np.concatenate([held_k, keys]), np.concatenate([held_f, fps])
        if not len(keys):
            continue
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        big = (sizes > limit) | (keys[starts] == dense_key if dense_key is not None else False)
        last = starts[-1]
        if big[-1]:  # the last run may go on; its members are dense whatever follows
            dense_key, keep = keys[last], len(keys)
        else:
            keep = last
        row_big = np.repeat(big, sizes)
        if row_big.any():
            yield out(np.unique(fps[row_big]), None)
        small = ~row_big
        small[keep:] = False
        if small.any():
            a, b = forest(keys[small], fps[small])
            if len(a):
                yield out(a, b)
        held_k, held_f = keys[keep:], fps[keep:]
    if len(held_k):
        a, b = forest(held_k, held_f)
        if len(a):
            yield out(a, b)


def links_of(nodes: DataFrame, dense_over: int = DENSE) -> DataFrame:
    """Links (a, b) between the distinct fingerprints of nodes(fp) that connect all within RADIUS bits."""
    keyed = nodes.select("fp").mapInArrow(_half_variants, "variant long, fp long")
    n = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_runs = keyed.repartition(n, "variant").sortWithinPartitions("variant")
    found = written(sorted_runs.mapInArrow(lambda it: _verify_runs(it, dense_over), "a long, b long"))
    dense = found.filter("b IS NULL").select(F.col("a").alias("fp")).distinct()
    ball = dense.mapInArrow(_full_variants, "variant long, fp long")
    least = ball.groupBy("variant").agg(F.min("fp").alias("m"), F.max("fp").alias("x")).filter("m <> x").select("variant", "m")
    stars = ball.join(least.hint("merge"), "variant").select(F.col("fp").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
    return found.filter("b IS NOT NULL").union(stars)


def simhash_components(docs: DataFrame, key: str = "doc_id", text: str = "text", dense_over: int = DENSE) -> DataFrame:
    """One row per document: key, fingerprint (16 hex digits), component_id, group_size.

    component_id is the least key reachable over links of at most RADIUS bits, the row's own
    included. Null and empty texts have fingerprint zero and are linked like any other; null keys
    form part of their component but never name it, unless all its keys are null. Repeated rows are
    returned as often as they come. An empty table gives an empty result. Other columns are ignored.
    """
    marked = written(fingerprints(docs, key, text).toDF("doc", "fp"))
    nodes = written(marked.groupBy("fp").agg(F.min("doc").alias("least"), F.count("*").alias("rows")))
    comps = components(links_of(nodes, dense_over))
    placed = nodes.join(comps.hint("merge"), nodes.fp == comps.node, "left").select("fp", "least", "rows", F.coalesce("component", "fp").alias("component"))
    ids = placed.groupBy("component").agg(F.min("least").alias("component_id"), F.sum("rows").alias("group_size"))
    # on ~component both sides are shuffled for the join alone, so a hot component can be split over tasks
    ids = ids.select(F.bitwise_not("component").alias("k"), "component_id", "group_size")
    by_fp = placed.withColumn("k", F.bitwise_not("component")).join(ids.hint("merge"), "k").select(F.col("fp").alias("_fp"), "component_id", "group_size")
    joined = marked.join(by_fp.hint("merge"), F.col("fp") == F.col("_fp"))
    return joined.select(F.col("doc").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "group_size")


def op8_simhash(spark, sf_dir):
    return simhash_components(table(spark, sf_dir, "documents"))


#: The wide form: 128 bits of a text's distinct words, in four pieces of 32.
PIECE_RADIUS = 2
WIDE_RADIUS = 14


def wide_fingerprints_of(texts: list[bytes]) -> np.ndarray:
    """Two 64-bit halves of each text's wide fingerprint."""
    lists = []
    for t in texts:
        lists.append([xxhash.xxh64_intdigest(w, SEED) for w in set(t.translate(LOWER).split())])
    counts = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    first = np.fromiter((h for x in lists for h in x), dtype=np.uint64, count=int(counts.sum()))
    second = (first ^ (first >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    second = (second ^ (second >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    starts = np.cumsum(counts) - counts
    return np.stack([majority(first, starts, counts), majority(second ^ (second >> np.uint64(30)), starts, counts)], axis=1)


def _wide_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, texts, at = batch.column(0), batch.column(1), 0
        while at < len(batch):
            own, size, start = [], 0, at
            while at < len(batch) and (size < BYTES_PER_BATCH or not own):
                own.append(texts[at].as_py() or b"")
                size += len(own[-1])
                at += 1
            fps = wide_fingerprints_of(own).view(np.int64)
            yield pa.RecordBatch.from_arrays([rows.slice(start, at - start), pa.array(fps[:, 0]), pa.array(fps[:, 1])], names=["row", "x", "y"])


def _wide_variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (variant, node, x, y): 33 variants of each of the four pieces."""
    for batch in batches:
        node, x, y = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        for a in range(0, len(node), 2048):
            part = slice(a, a + 2048)
            keys = []
            for n, word in enumerate((x[part].view(np.uint64), y[part].view(np.uint64))):
                for m, value in enumerate((word & np.uint64(0xFFFFFFFF), word >> np.uint64(32))):
                    keys.append((value[:, None] ^ HALF_FLIPS) | np.uint64((2 * n + m) << 32))
            keys = np.concatenate(keys, axis=1)
            each = keys.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)), *[pa.array(np.repeat(c[part], each)) for c in (node, x, y)]], names=["variant", "node", "x", "y"]
            )


def _wide_forest(x: np.ndarray, y: np.ndarray, radius: int) -> np.ndarray:
    """spanning() for the two halves of wide fingerprints."""
    n = len(x)
    parent, open_, frontier = np.arange(n), np.arange(n), []
    while len(open_):
        if not frontier:
            frontier, open_ = [int(open_[0])], open_[1:]
            continue
        at = frontier.pop()
        near = np.bitwise_count(x[open_] ^ x[at]).astype(np.int16) + np.bitwise_count(y[open_] ^ y[at]) <= radius
        parent[open_[near]] = at
        frontier.extend(open_[near].tolist())
        open_ = open_[~near]
    return parent


def _wide_runs(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if held is not None:
                cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
            if not len(cols[0]):
                continue
            starts = np.flatnonzero(np.r_[True, cols[0][1:] != cols[0][:-1]])
            held = [c[starts[-1] :] for c in cols]
            yield from linked(*[c[: starts[-1]] for c in cols])
        if held is not None:
            yield from linked(*held)

    def linked(key, node, x, y) -> Iterator[pa.RecordBatch]:
        """Links of whole runs of equal keys."""
        if not len(key):
            return
        x, y = x.view(np.uint64), y.view(np.uint64)
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[starts, len(key)])
        a, b = [], []
        two = starts[sizes == 2]
        near = np.bitwise_count(x[two] ^ x[two + 1]).astype(np.int16) + np.bitwise_count(y[two] ^ y[two + 1]) <= radius
        a.append(node[two[near]])
        b.append(node[two[near] + 1])
        for s, n in zip(starts[sizes > 2], sizes[sizes > 2]):
            parent = _wide_forest(x[s : s + n], y[s : s + n], radius)
            own = np.flatnonzero(parent != np.arange(n))
            a.append(node[s + own])
            b.append(node[s + parent[own]])
        a, b = np.concatenate(a), np.concatenate(b)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def near_groups(docs: DataFrame, row: str, text: str = "text", radius: int = WIDE_RADIUS) -> DataFrame:
    """(row, component): near-duplicate groups of docs by the wide fingerprint.

    Fingerprints link if one of the four pieces differs by at most PIECE_RADIUS bits and all 128 by
    at most `radius`. Ball hashing runs on the pieces (each emits its 33 variants within half the
    piece radius) and collisions are verified on all bits. A variant's members are held in one task
    as 32 bytes each and reduced to a spanning forest there. Two texts that share 0.8 of their
    five-word shingles differ in about one word in forty, which is some nine bits of 128.
    row: a unique long. Null and empty texts are one group; an empty table gives an empty result.
    """
    marked = written(docs.select(F.col(row).alias("row"), F.col(text).cast("binary").alias("text")).mapInArrow(_wide_batches, "row long, x long, y long"))
    nodes = marked.groupBy("x", "y").agg(F.min("row").alias("node"))
    keyed = nodes.select("node", "x", "y").mapInArrow(_wide_variants, "variant long, node long, x long, y long")
    n = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = keyed.repartition(n, "variant").sortWithinPartitions("variant")
    comps = components(runs.mapInArrow(_wide_runs(radius), "a long, b long"))
    placed = nodes.join(comps, "node", "left").select("x", "y", F.coalesce("component", "node").alias("component"))
    return marked.join(placed, ["x", "y"]).select(F.col("row").alias(row), "component")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = WIDE_RADIUS) -> DataFrame:
    """docs with one row of each near-duplicate group: the one with the smallest key (null keys last)."""
    row = fresh("_row", docs)
    rows = numbered(docs, row)
    named = near_groups(rows, row, text, radius).toDF("r", "c").join(rows.select(F.col(row).alias("r"), F.col(key).alias("k")), "r")
    kept = named.groupBy("c").agg(F.min(F.struct(F.col("k").isNull(), "k", "r")).alias("m")).select(F.col("m.r").alias(row))
    return rows.join(kept.hint("shuffle_hash"), row, "left_semi").select(*docs.columns)
