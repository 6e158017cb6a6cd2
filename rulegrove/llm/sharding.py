"""Sharding by a Feistel permutation of global row numbers.

Every row gets a number 0..N-1: rows are dealt to hash buckets of their columns, numbered inside each
bucket, and shifted by the rows of all earlier buckets. Equal rows are counted before that. A keyed Feistel network permutes the
smallest power-of-two domain that holds N; cycle walking repeats it until the value is below N, so
0..N-1 is permuted onto itself. With p the permuted number, the shard is p mod S and the slot
p div S: both follow from the row number alone, and shard sizes differ by one at most (law `rows`).

Only DataFrame expressions run here. The bucket counts are the one thing broadcast; there are at
most MAX_BUCKETS of them whatever the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_BUCKETS = 65_536
ROWS_PER_BUCKET = 250
ROUNDS = 4
#: Round keys and odd multipliers below 2^31, so that products stay below 2^62.
ROUND_KEYS = (608_135_816, 1_143_135_748, 320_440_878, 57_701_188)
MULTIPLIER_A, MULTIPLIER_B = 1_103_515_245, 1_664_525_181
MASK_31 = (1 << 31) - 1
#: The domain is below 4N (even number of bits), so a walk needs over w steps with chance (3/4)^w.
WALKS = 256


def half_bits(n: int) -> int:
    """Bits of one half of the smallest even-bit domain that holds n numbers."""
    bits = max(2, (max(n, 1) - 1).bit_length())
    return (bits + 1) // 2


def permute_number(x: int, n: int, seed: int = 0) -> int:
    """The same permutation for one number in plain Python, for look-ups and tests."""
    k = half_bits(n)
    mask = (1 << k) - 1
    for _ in range(WALKS):
        left, right = x >> k, x & mask
        for key in ROUND_KEYS[:ROUNDS]:
            t = (right * MULTIPLIER_A + key + seed) & MASK_31
            t = ((t ^ (t >> 15)) * MULTIPLIER_B) & MASK_31
            t ^= t >> 13
            left, right = right, (left ^ t) & mask
        x = (left << k) | right
        if x < n:
            return x
    raise ValueError("the walk did not return below n")


def _feistel_sql(x: str, k: int, seed: int) -> str:
    """One pass of the network as a SQL expression of x; each round is a struct step of a fold."""
    mask = (1 << k) - 1
    keys = ", ".join(f"{key + seed}L" for key in ROUND_KEYS[:ROUNDS])
    mixed = f"((s.r * {MULTIPLIER_A}L + q) & {MASK_31}L)"
    once = f"((({mixed} ^ shiftright({mixed}, 15)) * {MULTIPLIER_B}L) & {MASK_31}L)"
    twice = f"({once} ^ shiftright({once}, 13))"
    return (
        f"aggregate(array({keys}), named_struct('l', shiftright({x}, {k}), 'r', {x} & {mask}L),"
        f" (s, q) -> named_struct('l', s.r, 'r', (s.l ^ {twice}) & {mask}L),"
        f" s -> shiftleft(s.l, {k}) | s.r)"
    )


def permuted(number: str, n: int, seed: int = 0) -> Column:
    """Column: the place of row number `number` (0..n-1) under the permutation."""
    if n >= 1 << 60:
        raise ValueError("row numbers are limited to 2^60")
    k = half_bits(n)
    if k > 31:
        raise ValueError("halves are limited to 31 bits")
    step = _feistel_sql("x", k, seed)
    walk = (
        f"aggregate(sequence(1, {WALKS}), named_struct('x', CAST({number} AS BIGINT), 'go', true),"
        f" (a, i) -> IF(a.go, transform(array(a.x), x -> named_struct('x', {step}, 'go', {step} >= {n}L))[0], a),"
        f" a -> IF(a.go, CAST(raise_error('the walk did not return below n') AS BIGINT), a.x))"
    )
    return F.expr(walk)


def feistel_shards(
    df: DataFrame, key: str, shards: int, *, seed: int = 0, keep: list[str] | None = None, prefix: str = ""
) -> DataFrame:
    """Add `<prefix>row_number`, `<prefix>shard` and `<prefix>slot` to the columns `keep` of df.

    key: column that orders rows (any type that can be ordered; nulls and repeated keys are allowed:
    rows with equal keys are numbered by their kept columns, and rows equal in all of them are
    interchangeable: they are counted first and take consecutive numbers). Buckets are chosen by the
    key and all kept columns, so neither a hot key nor a hot row fills one. An empty table gives an
    empty result. Slots of a shard run from 0 without gaps. Columns named like the added ones are
    replaced; any other name may occur. `keep` defaults to all columns.
    """
    added = [f"{prefix}{c}" for c in ("row_number", "shard", "slot")]
    keep = [c for c in (keep or df.columns) if c not in added]
    # every column of df in one, so that no name of its own can clash
    rows = df.select(F.struct(*keep).alias("doc"), F.col(key).alias("key"))
    equal = rows.groupBy("key", "doc").agg(F.count("*").alias("copies"))
    n = df.select(key).count()
    buckets = max(1, min(MAX_BUCKETS, -(-n // ROWS_PER_BUCKET)))
    # from an MD5 digest, so that any engine can compute the same bucket
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("key", *[f"doc.`{c}`" for c in keep if c != key])])
    bucket = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % buckets
    dealt = equal.withColumn("bucket", bucket)
    sizes = dealt.groupBy("bucket").agg(F.sum("copies").alias("size"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.broadcast(sizes.select("bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start")))
    inside = Window.partitionBy("bucket").orderBy("key", "doc").rowsBetween(Window.unboundedPreceding, -1)
    first = dealt.withColumn("inside", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(starts, "bucket")
    numbered = first.select("doc", F.explode(F.expr("sequence(start + inside, start + inside + copies - 1)")).alias("number"))
    place = numbered.withColumn("place", permuted("number", n, seed))
    return place.select(
        *[F.col(f"doc.`{c}`").alias(c) for c in keep],
        F.col("number").alias(added[0]),
        (F.col("place") % shards).cast("int").alias(added[1]),
        F.expr(f"place div {shards}").alias(added[2]),
    )


SHARDS = 24


def op2_sharding(spark, sf_dir):
    """All documents in shards 0..23 under the law `rows`."""
    from rulegrove.llm.common import table, text_or_empty

    text = text_or_empty()
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    out = feistel_shards(docs, "doc_id", SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_sql() -> str:
    """The same in DuckDB, CRC-32 and permutation included."""
    poly = "3988292384"
    crc_table = (
        "SELECT list(c ORDER BY i) AS steps FROM (SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)),"
        f" lambda a, j: CASE WHEN a & 1 = 1 THEN xor(a >> 1, {poly}) ELSE a >> 1 END) AS c FROM range(256) r(i))"
    )
    keys = ", ".join(f"{k}" for k in ROUND_KEYS[:ROUNDS])
    return f"""
WITH crc_table AS ({crc_table}),
base AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
),
sized AS (
  SELECT doc_id, (octet_length(encode(t)) + 8)::BIGINT AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda a, b: xor(a >> 8, crc_table.steps[xor(a & 255, b) + 1])), 4294967295)::BIGINT AS text_crc32
  FROM base, crc_table
),
counted AS (SELECT count(*) AS n, greatest(1, least({MAX_BUCKETS}, ceil(count(*) / {ROWS_PER_BUCKET}.0)::BIGINT)) AS buckets,
  greatest(2, length(ltrim(bin(greatest(count(*), 1) - 1), '0'))) AS bits FROM documents),
params AS (SELECT n, buckets, ((bits + 1) // 2)::BIGINT AS k, (1::BIGINT << ((bits + 1) // 2)::BIGINT) - 1 AS mask FROM counted),
numbered AS (
  SELECT s.*, row_number() OVER (ORDER BY ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || size || '|' || text_crc32), 1, 8))::BIGINT % buckets,
    doc_id NULLS FIRST, size, text_crc32) - 1 AS number, n, k, mask
  FROM sized s, params
),
placed AS (
  SELECT *, list_reduce(list_prepend({{'x': number::BIGINT, 'go': true}}, list_transform(range({WALKS}), lambda i: {{'x': 0::BIGINT, 'go': true}})),
    lambda a, i: CASE WHEN NOT a.go THEN a ELSE list_transform([
      list_reduce(list_prepend({{'l': a.x >> k, 'r': a.x & mask, 'q': 0::BIGINT}}, list_transform([{keys}], lambda q: {{'l': 0::BIGINT, 'r': 0::BIGINT, 'q': q::BIGINT}})),
        lambda s, q: {{'l': s.r, 'q': 0::BIGINT, 'r': xor(s.l, list_transform([(s.r * {MULTIPLIER_A} + q.q) & {MASK_31}],
          lambda m: list_transform([(xor(m, m >> 15) * {MULTIPLIER_B}) & {MASK_31}], lambda o: xor(o, o >> 13))[1])[1]) & mask}})],
      lambda f: {{'x': (f.l << k) | f.r, 'go': ((f.l << k) | f.r) >= n}})[1] END).x AS place
  FROM numbered
)
SELECT doc_id, size, text_crc32, 'rows' AS law, (place % {SHARDS})::INTEGER AS shard, place // {SHARDS} AS slot, NULL::INTEGER AS grown_shard
FROM placed
"""
