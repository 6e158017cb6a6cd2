"""Exact top-k inner products: norm-sorted, SVD-rotated partial sums with Cauchy-Schwarz bounds.

The Gram matrix of all vectors (d x d, summed over partitions) gives the right singular vectors;
rotated into them, the first coordinates of a vector hold most of its length. Candidates are taken by
descending length: the STRIPE_ROWS longest first, which give every query a k-th best score to beat,
then the others in BANDS of falling length, each in stripes of about STRIPE_ROWS rows. A query goes
only to the stripes of bands whose longest vector times its own length reaches its score, and a
stripe reports only what reaches it. Inside a stripe the vectors are again in order of descending
length. A block is left out, with all after it, once |q| |x| is below the query's k-th best score so
far; inside a block the sum over the first HEAD rotated coordinates plus |q_rest| |x_rest| bounds the
score, and only what passes is scored exactly in integers. Bounds carry a margin for rounding, so
nothing that ties the k-th score is lost. A window keeps the k best of all stripes.

Memory: one group of QUERY_ROWS queries and one stripe a task. For g groups and s stripes that are
reached, candidates are shuffled g times and queries as often as they reach a stripe.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rulegrove.llm.common import table, written

STRIPE_ROWS = 8192
QUERY_ROWS = 4096
BLOCK_ROWS = 1024
#: Bands of length that candidates are cut into.
BANDS = 32
HEAD = 16
#: Up to here sums of products are exact in doubles.
EXACT = float(1 << 53)


def _stacked(column, dims: int) -> np.ndarray:
    """Integer vectors as doubles, zero-padded to dims."""
    out = np.zeros((len(column), dims))
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def rotation(vectors: DataFrame, dims: int) -> np.ndarray:
    """Right singular vectors of all rows of vectors(z), by falling singular value."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((dims, dims))
        for b in batches:
            rows = _stacked([v.as_py() for v in b.column(0)], dims)
            gram += rows.T @ rows
        at = np.arange(dims, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(list(gram), pa.list_(pa.float64()))], names=["i", "row"])

    rows = vectors.select("z").mapInArrow(partial, "i int, row array<double>")
    sums = rows.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    gram = np.zeros((dims, dims))
    for r in sums.collect():  # dims^2 numbers
        gram[r.i, r.j] = r.v
    return np.linalg.eigh(gram)[1][:, ::-1].copy()


def best_of(queries: np.ndarray, qids: np.ndarray, cands: np.ndarray, cids: np.ndarray, turn: np.ndarray, k: int, least: np.ndarray | None = None):
    """(query index, candidate id, score) of each query's k best candidates other than itself.

    least: scores below which a query's candidates do not matter, known from other candidates.
    """
    dims = queries.shape[1]
    head = min(HEAD, dims)
    length = np.sqrt((cands**2).sum(axis=1))
    order = np.argsort(-length, kind="stable")
    cands, cids, length = cands[order], cids[order], length[order]
    q_len = np.sqrt((queries**2).sum(axis=1))
    q_rot = queries @ turn
    q_rest = np.sqrt((q_rot[:, head:] ** 2).sum(axis=1))
    floor = np.full(len(queries), -np.inf) if least is None else least.copy()  # the k-th best score so far
    kept_q, kept_c, kept_s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    for at in range(0, len(cands), BLOCK_ROWS):
        x, ids, size = cands[at : at + BLOCK_ROWS], cids[at : at + BLOCK_ROWS], length[at : at + BLOCK_ROWS]
        live = np.flatnonzero(q_len * size[0] * (1 + 1e-9) + 1e-6 >= floor)
        if not len(live):
            break
        x_rot = x @ turn
        rest = np.sqrt((x_rot[:, head:] ** 2).sum(axis=1))
        found = []
        for part in np.array_split(live, max(1, len(live) // 512)):
            bound = q_rot[part, :head] @ x_rot[:, :head].T + q_rest[part, None] * rest
            bound += 1e-9 * q_len[part, None] * size + 1e-6
            alive = bound >= floor[part, None]
            rows, cols = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
            if not len(rows):
                continue
            if (q_len[part].max() * size[0]) < EXACT:
                score = queries[part[rows]] @ x[cols].T
            else:
                score = np.array([[sum(int(a) * int(b) for a, b in zip(q, y)) for y in x[cols]] for q in queries[part[rows]]], dtype=object)
            mine = qids[part[rows], None] == ids[cols]
            open_ = alive[np.ix_(rows, cols)] & ~mine & (score >= floor[part[rows], None]).astype(bool)
            if score.dtype != object and open_.shape[1] > k:  # the k-th best of this block bounds as well
                masked = np.where(open_, score, -np.inf)
                kth = np.partition(masked, open_.shape[1] - k, axis=1)[:, -k]
                open_ &= masked >= kth[:, None]
            r, c = np.nonzero(open_)
            found.append((part[rows[r]], ids[cols[c]], score[r, c]))
        if not found:
            continue
        kept_q = np.concatenate([kept_q, *[f[0] for f in found]])
        kept_c = np.concatenate([kept_c, *[f[1] for f in found]])
        kept_s = np.concatenate([kept_s, *[f[2] for f in found]])
        by = np.lexsort((kept_c, -kept_s, kept_q)) if kept_s.dtype != object else np.array(sorted(range(len(kept_q)), key=lambda i: (kept_q[i], -kept_s[i], kept_c[i])), dtype=np.int64)
        kept_q, kept_c, kept_s = kept_q[by], kept_c[by], kept_s[by]
        starts = np.flatnonzero(np.r_[True, kept_q[1:] != kept_q[:-1]])
        rank = np.arange(len(kept_q)) - np.repeat(starts, np.diff(np.r_[starts, len(kept_q)]))
        top = rank < k
        kept_q, kept_c, kept_s, rank = kept_q[top], kept_c[top], kept_s[top], rank[top]
        full = rank == k - 1
        floor[kept_q[full]] = np.maximum(floor[kept_q[full]], kept_s[full].astype(float))
    return kept_q, kept_c, kept_s


def exact_topk(vectors: DataFrame, k: int, every: int, *, key: str = "vec_id", vector: str = "embedding", scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates for each row whose key divides by `every`.

    Components x become floor(scale * x); scores are integer inner products. Candidates are all rows
    but those with the query's own key; ties go to the smaller key. Rows with a null key or a vector
    that is null or holds null or non-finite components take no part. Vectors of different lengths
    are compared over their common prefix. Rows with repeated keys take part each, as query and as
    candidate (a query that comes n times is answered once). Empty tables give empty results; other
    columns are ignored. A score beyond 64 bits is an error.
    """
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    fine = F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    rows = vectors.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & fine)
    squares = F.aggregate("z", F.lit(0.0), lambda a, x: a + x * x)
    rows = rows.select(F.col(key).cast("long").alias("id"), whole.alias("z"), (F.col(key) % every == 0).alias("asks"))
    rows = written(rows.withColumn("size", F.sqrt(squares)).withColumn("deal", F.monotonically_increasing_id()))
    facts = rows.agg(
        F.count("*").alias("n"), F.coalesce(F.max(F.size("z")), F.lit(0)).alias("dims"), F.sum(F.col("asks").cast("long")).alias("q"), F.percentile_approx("size", F.lit([i / BANDS for i in range(1, BANDS)]), 10_000).alias("cuts")
    ).first()
    dims = max(1, facts.dims)
    turn = rotation(rows, dims)
    groups = max(1, -(-(facts.q or 0) // QUERY_ROWS))
    asked = written(rows.filter("asks").dropDuplicates(["id", "z"]).select("id", "z", "size", "deal", (F.col("deal") % groups).cast("int").alias("g")))

    def met(queries: DataFrame, candidates: DataFrame) -> DataFrame:
        """(deal, query_id, vec_id, score): the best of each group's queries in each stripe s that meets it."""

        def search(pdf: pd.DataFrame) -> pd.DataFrame:
            ask = pdf["asks"].to_numpy(bool)
            z = _stacked(pdf["z"], dims)
            ids, deal = pdf["id"].to_numpy(np.int64), pdf["deal"].to_numpy(np.int64)
            q, c, s = best_of(z[ask], ids[ask], z[~ask], ids[~ask], turn, k, pdf["least"].to_numpy(float)[ask])
            if len(s) and max(abs(int(s.max())), abs(int(s.min()))) >= 1 << 63:
                raise ValueError("a score does not fit 64 bits")
            return pd.DataFrame({"deal": deal[ask][q], "query_id": ids[ask][q], "vec_id": c, "score": np.array(s, dtype=np.int64) if s.dtype == object else s.astype(np.int64)})

        ask_rows = queries.select("id", "z", "deal", "least", F.lit(True).alias("asks"), "g", "s")
        own_rows = candidates.select("id", "z", "deal", F.lit(0.0).alias("least"), F.lit(False).alias("asks"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), "s")
        return ask_rows.unionByName(own_rows).groupBy("g", "s").applyInPandas(search, "deal long, query_id long, vec_id long, score long")

    # the longest vectors give every query a k-th best score to beat
    longest = written(rows.orderBy(F.desc("size"), "deal").limit(STRIPE_ROWS).select("id", "z", "deal", F.lit(0).alias("s")))
    first = written(met(asked.withColumn("least", F.lit(float("-inf"))).withColumn("s", F.lit(0)), longest))
    place = Window.partitionBy("deal").orderBy(F.desc("score"), "vec_id")
    floors = first.withColumn("r", F.row_number().over(place)).filter(F.col("r") == k).select("deal", F.col("score").cast("double").alias("least"))
    # the rest lies in bands of falling length, a band in stripes of bounded size; runs of equal rows are spread by `deal`
    rest = rows.join(longest.select("deal"), "deal", "left_anti")
    cuts = sorted(set(facts.cuts or ()))
    band = F.lit(0) if not cuts else sum((F.col("size") < F.lit(c)).cast("int") for c in cuts)
    banded = written(rest.withColumn("band", band).select("id", "z", "size", "deal", "band"))
    bands = banded.groupBy("band").agg(F.count("*").alias("n"), F.max("size").alias("top")).orderBy("band").collect()  # BANDS rows at most
    found = first
    if bands:
        tops, counts, start = {}, {}, 0
        for r in bands:
            tops[r.band], counts[r.band] = r.top, (start, -(-r.n // STRIPE_ROWS))
            start += counts[r.band][1]
        pick = lambda values: F.create_map(*[F.lit(x) for kv in values.items() for x in kv])
        own = asked.join(floors, "deal", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
        # bands fall in length, so the stripes that can beat the floor come first
        reach = F.lit(0)
        for b in sorted(tops):
            reach = F.when(F.col("size") * tops[b] * (1 + 1e-9) + 1e-6 >= F.col("least"), sum(counts[b])).otherwise(reach)
        own = written(own.withColumn("reach", reach))
        used = own.agg(F.max("reach").alias("m")).first().m or 0
        asks = own.filter("reach > 0").withColumn("s", F.explode(F.sequence(F.lit(0), F.col("reach") - 1)))
        at = pick({b: c[0] for b, c in counts.items()})[F.col("band")] + (F.col("deal") % pick({b: c[1] for b, c in counts.items()})[F.col("band")])
        dealt = banded.withColumn("s", at.cast("int")).filter(F.col("s") < used)
        found = first.unionByName(met(asks, dealt))
    by = Window.partitionBy("query_id", "deal").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


K, EVERY = 20, 20


def op3_topk(spark, sf_dir):
    return exact_topk(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), K, EVERY)


def op3_sql() -> str:
    return f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS z FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.z, c.z)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {EVERY} = 0
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
