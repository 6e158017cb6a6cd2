import zlib
from collections import defaultdict

import duckdb

from rulegrove.llm import sharding

DATA = "/root/testdata/sf0.01"


def test_permutation_is_a_bijection_and_agrees_with_the_expression(spark):
    for n in (1, 2, 3, 24, 1000, 4097):
        for seed in (0, 5):
            want = [sharding.permute_number(x, n, seed) for x in range(n)]
            assert sorted(want) == list(range(n))
            got = spark.range(n).select("id", sharding.permuted("id", n, seed).alias("p")).collect()
            assert [p for _, p in sorted(got)] == want


def placed(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return slots


def test_nulls_repeats_and_clashing_names(spark):
    rows = [(None, "a", 1)] * 300 + [(7, "b", i) for i in range(200)] + [(i, None, None) for i in range(100)]
    df = spark.createDataFrame(rows, "doc long, key string, bucket long")
    got = sharding.feistel_shards(df, "doc", 7).collect()
    assert sorted(map(str, rows)) == sorted(str(tuple(r)[:3]) for r in got)
    assert sorted(r.row_number for r in got) == list(range(600))
    slots = placed(got)
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    for r in got:
        p = sharding.permute_number(r.row_number, 600)
        assert (r.shard, r.slot) == (p % 7, p // 7)
    again = sharding.feistel_shards(df.repartition(5), "doc", 7).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    # a hot key does not fill one bucket: its rows' numbers are spread
    hot = sorted(r.row_number for r in got if r.doc == 7)
    assert hot[-1] - hot[0] > 250


def test_empty_tables_and_replaced_columns(spark):
    df = spark.createDataFrame([], "doc_id long, shard string, number string, place string, start string, inside string, copies string")
    out = sharding.feistel_shards(df, "doc_id", 3)
    assert out.collect() == [] and out.columns == ["doc_id", "number", "place", "start", "inside", "copies", "row_number", "shard", "slot"]
    one = sharding.feistel_shards(spark.createDataFrame([(1, "x")], "doc_id long, slot string"), "doc_id", 3).first()
    assert (one.row_number, one.shard, one.slot) == (0, 0, 0)


def test_all_documents_match_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{DATA}/documents.parquet')")
    want = sorted(con.execute(sharding.op2_sql()).fetchall(), key=str)
    got = sharding.op2_sharding(spark, DATA).collect()
    assert sorted((tuple(r) for r in got), key=str) == want
    placed(got)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert all(r.size == len(texts[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in got)
