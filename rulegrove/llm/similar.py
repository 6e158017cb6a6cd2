"""Near-duplicates by five-word shingles: candidates by fingerprints, links by exact similarity.

Texts are lower-cased (A-Z) and split at ASCII blanks; a text is the set of its runs of five words,
as XXH64. Texts with equal sets are one node. Two kinds of fingerprint propose pairs: the wide
SimHash of simhash.py, and BANDS keys of DEEP min-wise hashes of the set each, of which two sets that
share 0.8 have one in common with probability 1 - (1 - 0.8 ** DEEP) ** BANDS = 0.9996. A pair links
only if the Jaccard similarity of its sets, counted in full, is at least LEAST.

Members of one key are not all counted at once, which would grow with the square of a tight group.
Neighbours come first, then neighbours of different groups, and in the end all that share a key and
are in different groups still: their sketches of BITS bits are compared in blocks of BLOCK members,
and pairs that may share 0.8 are counted in full, so what all pairs would connect is connected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rulegrove.llm.common import arrow_bounded, flagged, fresh, numbered, written
from rulegrove.llm.components import components
from rulegrove.llm.simhash import BYTES_PER_BATCH, WIDE_RADIUS, _wide_runs, _wide_variants, shingle_hashes, wide_fingerprints_of

WIDTH = 5
#: Jaccard similarity in tenths.
LEAST = 8
BANDS = 20
DEEP = 5
_RNG = np.random.default_rng(8)
_XOR = _RNG.integers(0, 1 << 63, (BANDS, DEEP), np.uint64)
_ODD = _RNG.integers(0, 1 << 63, (BANDS, DEEP), np.uint64) << np.uint64(1) | np.uint64(1)
#: Sketches of one-bit min-wise hashes. Sets that share 0.8 differ in a tenth of the bits; in over FAR with probability 0.0001.
BITS = 1024
FAR = 138
#: Members of a key that are compared in one task.
BLOCK = 2048
_SKETCH_XOR = _RNG.integers(0, 1 << 63, BITS, np.uint64)
_SKETCH_ODD = _RNG.integers(0, 1 << 63, BITS, np.uint64) << np.uint64(1) | np.uint64(1)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    return [np.unique(np.array(shingle_hashes(t, WIDTH), np.uint64)) for t in texts]


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """BANDS keys of each set, none of them empty."""
    counts = np.array([len(s) for s in sets], np.int64)
    out = np.zeros((len(sets), BANDS), np.uint64)
    if not len(sets):
        return out
    joined, starts = np.concatenate(sets), np.cumsum(counts) - counts
    for i in range(BANDS):
        key = np.full(len(sets), i + 1, np.uint64)
        for xor, odd in zip(_XOR[i], _ODD[i]):
            key = (key ^ np.minimum.reduceat((joined ^ xor) * odd, starts)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(32)
        out[:, i] = key
    return out


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes]]]:
    for batch in batches:
        texts, at = batch.column(1), 0
        while at < len(batch):
            own, size, start = [], 0, at
            while at < len(batch) and (size < BYTES_PER_BATCH or not own):
                own.append(texts[at].as_py() or b"")
                size += len(own[-1])
                at += 1
            yield batch.column(0).slice(start, at - start), own


MARKED = "row long, x long, y long, d long, e long, keys array<long>"


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in _slices(batches):
        fps, sets = wide_fingerprints_of(texts).view(np.int64), shingle_sets(texts)
        digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), np.int64).reshape(-1, 2)
        full = [i for i, s in enumerate(sets) if len(s)]
        keys: list = [None] * len(sets)
        for i, k in zip(full, band_keys([sets[i] for i in full]).view(np.int64)):
            keys[i] = k
        columns = [pa.array(c) for c in (fps[:, 0], fps[:, 1], digests[:, 0], digests[:, 1])]
        yield pa.RecordBatch.from_arrays([rows, *columns, pa.array(keys, pa.list_(pa.int64()))], names=["row", "x", "y", "d", "e", "keys"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in _slices(batches):
        yield pa.RecordBatch.from_arrays([rows, pa.array([s.view(np.int64) for s in shingle_sets(texts)], pa.list_(pa.int64()))], names=["node", "set"])


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """BITS one-bit min-wise hashes of each set, none of them empty, as rows of 64-bit words."""
    starts = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    joined = np.concatenate(sets)
    bits = np.empty((len(sets), BITS), np.uint8)
    for i in range(BITS):
        least = np.minimum.reduceat((joined ^ _SKETCH_XOR[i]) * _SKETCH_ODD[i], starts)
        bits[:, i] = (least >> np.uint64(13)) & np.uint64(1)
    return np.packbits(bits, axis=1).view(np.uint64)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = [np.array(x, np.int64).view(np.uint64) for x in batch.column(1).to_pylist()]
        full = [i for i, x in enumerate(own) if len(x)]
        if full:
            bits = [r.tobytes() for r in sketches([own[i] for i in full])]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(full)), pa.array(bits, pa.binary())], names=["node", "bits"])


CROSSED = ("key", "i", "j", "block", "band", "component", "node", "bits", "keys")


def _crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows CROSSED by (key, i, j). Pairs of blocks i and j in two components whose sketches are FAR bits apart at most.

    A pair that shares several keys comes out once, at the first of them.
    """
    held = None

    def pairs(block, band, comp, node, bits, keys) -> Iterator[pa.RecordBatch]:
        low, high = block.min(), block.max()
        left = np.flatnonzero(block == low)
        for at in left.tolist():
            others = np.flatnonzero(block == high) if high != low else np.arange(at + 1, len(node))
            others = others[comp[others] != comp[at]]
            others = others[np.bitwise_count(bits[others] ^ bits[at]).sum(axis=1) <= FAR]
            others = others[(keys[others] == keys[at]).argmax(axis=1) == band[at]]
            if len(others):
                b = node[others]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(node[at], b)), pa.array(np.maximum(node[at], b))], names=["a", "b"])

    def runs(cols, whole: bool):
        """(columns of each run, what is left of the last one)."""
        key = np.stack(cols[:3], axis=1)
        cuts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1), True])
        last = cuts[-1] if whole else cuts[-2]
        spans = [(a, b) for a, b in zip(cuts[:-1], cuts[1:]) if b <= last]
        return [[c[a:b] for c in cols[3:]] for a, b in spans if cols[1][a] == cols[2][a] or len(set(cols[3][a:b].tolist())) == 2], [c[last:] for c in cols]

    for batch in batches:
        n = len(batch)
        if not n:
            continue
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(7)]
        cols.append(np.frombuffer(b"".join(batch.column(7).to_pylist()), np.uint64).reshape(n, -1))
        cols.append(np.array(batch.column(8).to_pylist(), np.int64).reshape(n, BANDS))
        if held is not None:
            cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
        done, held = runs(cols, False)
        for run in done:
            yield from pairs(*run)
    if held is not None:
        for run in runs(held, True)[0]:
            yield from pairs(*run)


def similar_groups(docs: DataFrame, row: str, text: str = "text") -> DataFrame:
    """(row, component): groups of docs connected by pairs that share LEAST tenths of their shingles.

    row: a unique long. Null and empty texts are one group; an empty table gives an empty result.
    """
    arrow_bounded(docs.sparkSession)
    source = docs.select(F.col(row).alias("row"), F.col(text).cast("binary").alias("text"))
    marked = written(source.mapInArrow(_mark, MARKED))
    least = marked.groupBy("d", "e").agg(F.min("row").alias("node"))
    nodes = marked.join(least.select("node").hint("merge"), F.col("row") == F.col("node")).select("node", "x", "y", "keys")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    variants = nodes.select("node", "x", "y").mapInArrow(_wide_variants, "variant long, node long, x long, y long")
    runs = variants.repartition(n, "variant").sortWithinPartitions("variant")
    ordered = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    close = runs.mapInArrow(_wide_runs(WIDE_RADIUS), "a long, b long").select(*ordered("a", "b"))
    keyed = nodes.select("node", F.posexplode("keys").alias("band", "key"))
    beside = Window.partitionBy("key").orderBy("node")
    keyed = written(keyed.withColumn("before", F.lag("node").over(beside)).withColumn("after", F.lead("node").over(beside)).filter("before IS NOT NULL OR after IS NOT NULL"))
    pairs = written(close.union(keyed.filter("before IS NOT NULL").select(*ordered("before", "node"))).distinct())
    needed = pairs.select(F.col("a").alias("row")).union(pairs.select("b")).distinct()
    # of the texts, those that some pair needs are moved, and few others
    likely = flagged(source, "row", needed, "likely").filter("likely").drop("likely")
    sets = written(likely.join(needed, "row", "left_semi").mapInArrow(_sets, "node long, set array<long>"))

    def linked(pairs: DataFrame) -> DataFrame:
        both = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("p")), "a").join(sets.select(F.col("node").alias("b"), F.col("set").alias("q")), "b")
        counted = both.select("a", "b", F.expr("size(array_intersect(p, q))").alias("k"), F.expr("size(p) + size(q)").alias("n"))
        return written(counted.filter(f"10 * k >= {LEAST} * (n - k)").select("a", "b"))

    def grouped(links: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(components, members of keys that hold more than one of them)."""
        comps = written(components(links))
        placed = written(keyed.select("key", "band", "node").join(comps.hint("merge"), "node", "left").withColumn("component", F.coalesce("component", "node")))
        shared = placed.groupBy("key").agg(F.min("component").alias("m"), F.max("component").alias("x"), F.count("*").alias("members")).filter("m <> x")
        shared = shared.select(F.bitwise_not("key").alias("k"), "members")
        return comps, written(placed.withColumn("k", F.bitwise_not("key")).join(shared.hint("merge"), "k").drop("k"))

    def beside(open_: DataFrame) -> DataFrame:
        order = Window.partitionBy("key").orderBy("component", "node")
        near = open_.withColumn("other", F.lag("node").over(order)).withColumn("c", F.lag("component").over(order))
        return near.filter("c <> component").select(*ordered("node", "other"))

    def crossed(open_: DataFrame) -> DataFrame:
        """A key's members are dealt to blocks by hash; two blocks meet in one place."""
        these = open_.select("node").distinct()
        bits = written(sets.join(these.hint("merge"), "node", "left_semi").mapInArrow(_sketched, "node long, bits binary"))
        full = open_.join(bits.hint("merge"), "node").join(nodes.select("node", "keys").hint("merge"), "node")
        blocks = F.ceil(F.col("members") / BLOCK)
        dealt = full.withColumn("block", F.pmod(F.xxhash64("node"), blocks)).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        dealt = dealt.withColumn("i", F.least("block", "with")).withColumn("j", F.greatest("block", "with"))
        return dealt.select(*CROSSED).repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_crossed, "a long, b long")

    links, tested = linked(pairs), pairs
    comps, open_ = grouped(links)
    for step in (beside, crossed):
        more = written(step(open_).distinct().join(tested, ["a", "b"], "left_anti"))
        if more.isEmpty():
            continue
        links, tested = links.union(linked(more)), tested.union(more)
        comps, open_ = grouped(links)
    placed = least.join(comps.hint("merge"), "node", "left").select("d", "e", F.coalesce("component", "node").alias("component"))
    return marked.join(placed.hint("merge"), ["d", "e"]).select(F.col("row").alias(row), "component")


def drop_similar(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one row of each group of similar texts: the one with the smallest key (null keys last)."""
    row = fresh("_row", docs)
    rows = numbered(docs, row)
    named = written(similar_groups(rows, row, text).toDF("r", "c").join(rows.select(F.col(row).alias("r"), F.col(key).alias("k")), "r"))
    kept = named.groupBy("c").agg(F.min(F.struct(F.col("k").isNull(), "k", "r")).alias("m")).select(F.col("m.r").alias("r"))
    dropped = written(named.join(kept, "r", "left_anti").select(F.col("r").alias(row)))
    # the texts that stay are not moved, but for few that look like dropped ones
    flag = fresh("_flag", rows)
    told = flagged(rows, row, dropped, flag)
    spared = told.filter(F.col(flag)).join(dropped.hint("shuffle_hash"), row, "left_anti")
    return told.filter(~F.col(flag)).select(*docs.columns).union(spared.select(*docs.columns))
