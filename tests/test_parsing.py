import json

import pytest
from pyspark.sql import functions as F

from rulegrove.operators import parsing, provider


def parsed(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    return provider.loose_json(rows, "t")


def test_blocks_of_replies(spark):
    one = {"block_id": "B1", "intent": "Opening", "text_span": "x", "order_index": 4}
    texts = [
        json.dumps({"blocks": [one, "noise", {"block_id": "B2", "intent": None}], "order": ["B2", "B1"]}),
        f"Sure!\n```json\n[{json.dumps(one)}]\n```",
        json.dumps({"blocks": "none"}),
        "no json",
        json.dumps({"blocks": [one], "order": 3}),
    ]
    got = {r.id: r for r in parsing.segmentation(parsed(spark, texts), "parsed").collect()}
    assert [(b.block_id, b.order_index) for b in got[0].blocks] == [("B1", 4), ("B2", 2)] and got[0].order == ["B2", "B1"]
    # the first balanced object comes before the list around it
    assert [b.block_id for b in got[1].blocks] in ([], ["B1"])
    assert got[2].blocks == [] and got[2].order == [] and got[3].blocks == []
    assert got[4].order == ["B1"]


def test_rules_of_replies(spark):
    a = {"desc": "d1", "verifier_spec": {"check": "c", "args": {"n": 2}}}
    b = {"cid": "X", "description": "d2", "verifier": {"check": "k"}, "scope": "global"}
    texts = [json.dumps({"constraints": [a, 5, b, a]}), json.dumps([b]), json.dumps(a), json.dumps({"global_constraints": [a], "constraints": 1}), "broken", json.dumps({"block_constraints": []})]
    rows = parsed(spark, texts).withColumn("r", parsing.rules_of("parsed")).collect()
    got = {r.id: [(x.cid, x.desc, x.scope, x.verifier_spec.check, x.verifier_spec.args) for x in r.r or []] for r in rows}
    first = ("AUTO_C0", "d1", "local", "c", '{"n":2}')
    second = ("X", "d2", "global", "k", "{}")
    assert got[0] == [first, second, ("AUTO_C1", *first[1:])]
    assert got[1] == [second] and got[2] == [first] and got[3] == [first] and got[4] == [] and got[5] == []


def test_block_and_branch_replies(spark):
    rule = {"desc": "d", "verifier": {"check": "c", "args": {}}}
    texts = [json.dumps({"logic": "sub-chain", "constraints": [rule]}), json.dumps({"constraints": 3}), "[1]"]
    got = {r.id: (r.logic, None if r.rules is None else len(r.rules)) for r in parsing.block_reply(parsed(spark, texts), "parsed").collect()}
    assert got == {0: ("sub-chain", 1), 1: ("AND", 1), 2: (None, None)}  # a list that is none leaves the object as the one rule
    texts = [json.dumps({"condition": "If so", "merge_point": "B3", "truncated": True, "alt_constraints": [rule, {"desc": " "}, {"desc": "e"}]}), "{}"]
    rows = parsing.branch_reply(parsed(spark, texts), "parsed").orderBy("id").collect()
    assert (rows[0].condition, rows[0].merge_point, rows[0].truncated, [x.desc for x in rows[0].rules]) == ("If so", "B3", True, ["d"])
    assert (rows[1].condition, rows[1].merge_point, rows[1].truncated) == ("If an alternative stance applies", None, False)


def test_texts_of_replies(spark):
    rows = spark.createDataFrame([("a</think>\n b",), ("plain",), (None,), ("x </think> y </think> z",)], "t string")
    got = rows.select(parsing.without_reasoning("t"), parsing.had_reasoning("t"), parsing.widest_object("t")).collect()
    assert [tuple(r)[:2] for r in got] == [("b", True), ("plain", False), (None, False), ("y </think> z", True)]
    wide = spark.createDataFrame([('a {"x": {1}} b } c',), ("none",), ("} {",)], "t string").select(parsing.widest_object("t").alias("w")).collect()
    assert [r.w for r in wide] == ['{"x": {1}} b }', "none", "} {"]


@pytest.mark.parametrize(
    "check,args,want",
    [
        ("min_word_count", '{"min_words": 3}', ("min_word_count", {"min_words": 3}, False)),
        ("must_present_three_examples", '{"min_items": 9, "x": "y"}', ("must_list_n_subpoints", {"min_items": 3, "x": "y"}, False)),
        ("must_use_numbered_list", None, ("min_numbered_items", {"min_items": 2}, False)),
        ("be_nice", "{}", ("custom:be_nice", {}, True)),
    ],
)
def test_mapped_checks(spark, check, args, want):
    got = spark.createDataFrame([(check, args)], "check string, args string").select(parsing.mapped_check().alias("m")).first().m
    assert (got.check, json.loads(got.args), got.is_custom) == want


def test_distinct_capped(spark):
    rows = [
        (0, "Say it!", None, False), (1, "say  it", "e", False), (2, "Longer custom rule text", "e", True), (3, "short", "e", False), (4, "", "e", False),
        (5, "another one here", None, False), (6, "another two here", None, False), (7, "z", None, True), (8, None, None, False),
    ]
    df = spark.createDataFrame([("s", *r) for r in rows], "k string, pos int, descr string, evidence_str string, is_custom boolean")
    order = lambda cap: {r.pos for r in parsing.distinct_capped(df, "k", cap=cap).collect()}
    assert order(1) == {3} and order(3) == {3, 5, 6} and order(5) == {3, 5, 6, 0, 2} and order(9) == {3, 5, 6, 0, 2, 7}


def test_lists_references_and_outline(spark):
    values = parsed(spark, ['["a", " ", "b "]', '"x"', "3", "null"]).select("id", parsing.listed("parsed").alias("l")).orderBy("id").collect()
    assert [r.l for r in values] == [["a", "b"], ["x"], [], []]
    texts = ['{"references": {"b1": {"title": "T"}, "b2": {}}}', '{"b3": {"doi": "10.1"}, " ": {"title": "x"}}', "broken"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, e string")
    assert sorted((r.k, r.ref_id) for r in parsing.evidence_refs(df, "e", "k").collect()) == [(0, "b1"), (0, "b2"), (1, "b3")]
    assert sorted(r.ref_id for r in parsing.evidence_refs(df, "e", "k", described=True).collect()) == ["b1", "b3"]
    blocks = spark.createDataFrame([("s", f"B{i}", "w " * (150 if i == 1 else 1), i) for i in range(14)], "sample_id string, block_id string, intent string, order_index int")
    lines = parsing.outline(blocks).first().outline.split("\n")
    assert len(lines) == 12 and lines[0] == "B0 (w)" and lines[1].endswith("w ...)") and len(lines[1]) < 215
    graph = spark.createDataFrame([([("Opening scene",), ("Main",), ("Outlook",)],), ([("Opening",)],)], "block_specs array<struct<intent:string>>")
    assert [r[0] for r in graph.select(parsing.structured()).collect()] == [True, False]
    nodes = spark.createDataFrame([([("C1", "d", ("k", '{"n": 1}'))],)], "constraints array<struct<cid:string,desc:string,verifier_spec:struct<check:string,args:string>>>")
    assert json.loads(nodes.select(parsing.rules_as_lines()).first()[0]) == {"cid": "C1", "desc": "d", "verifier": {"check": "k", "args": {"n": 1}}}
    assert nodes.filter(F.lit(False)).select(parsing.rules_as_lines()).collect() == []
