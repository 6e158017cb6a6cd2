import json
import os

import pytest
from pyspark.sql import functions as F

from rulegrove import drivers
from rulegrove.operators import scoring
from rulegrove.plans import render, shape, surveys
from rulegrove.sources import files

ANSWER = "\n\n".join(
    [
        "Opening words about rivers and bridges. " * 12,
        "1. First count the boats\n2. Then count the bridges\n3. Finally count the birds",
        "The middle part compares rivers in value 1.25 and 2.50 and 3.75; it goes on; and on. " * 8,
        "- one point\n- two points\n- three points",
        "A conclusion about rivers, bridges and boats closes the text. " * 10,
    ]
)


@pytest.fixture(scope="module")
def samples(spark):
    rows = [(f"s{i}", f"Please write about rivers number {i}. Keep it short.", ANSWER.replace("rivers", f"rivers{i}")) for i in range(6)] + [("empty", "", ""), ("null", None, None)]
    return spark.createDataFrame(rows, "sample_id string, instruction string, answer string")


@pytest.fixture(scope="module")
def graphs(spark, samples, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("graphs"))
    files.write_graphs(drivers.graphs_of(samples), where)
    return files.read_written_graphs(spark, where)


def rules_of(g):
    return {n.cid: n for n in [*g.global_constraints, *(n for s in g.block_constraint_sets for n in s.constraints)]}


def test_assembled_graphs_hold_together(graphs):
    got = {r.sample_id: r for r in graphs.collect()}
    assert got["s0"].seed_task == "write about rivers number 0."
    seen = 0
    for name, g in got.items():
        if not name.startswith("s"):
            continue
        main = [b for b in g.block_specs if not b.is_alternate]
        assert [b.block_id for b in main] == [f"B{i}" for i in range(1, 6)]
        assert {s.block_id: s.logic_type for s in g.block_constraint_sets}["B2"] == "sub-chain"
        own = rules_of(g)
        alternates = {b.block_id: b for b in g.block_specs if b.is_alternate}
        for s in g.selections:
            seen += 1
            assert s.sid == f"SEL_{s.trace_to}" and s.branch_alt.block_id == f"{s.trace_to}_ALT" and s.branch_real.block_id == s.trace_to
            assert s.branch_real.constraints == [n.cid for t in g.block_constraint_sets if t.block_id == s.trace_to for n in t.constraints]
            assert set(s.branch_alt.constraints) <= set(own) and s.alt_path_blocks[0] == s.branch_alt.block_id and set(s.alt_path_blocks) <= set(alternates)
            assert [own[c].trace_to for c in s.branch_alt.constraints] == sorted((own[c].trace_to for c in s.branch_alt.constraints), key=s.alt_path_blocks.index)
            assert (s.selection_type == "global") == (s.merge_point is None and len(s.alt_path_blocks) >= 1 and s.selection_type == "global")
        assert {b.origin_block for b in alternates.values()} <= {b.block_id for b in main}
    assert seen >= 6


def test_pipeline_saves_and_scores(spark, samples, graphs, tmp_path):
    some = graphs.filter("sample_id IN ('s0', 's1')")
    drivers.save(drivers.bundles(some), str(tmp_path), each=True)
    rows = {r.sample_id: r for r in spark.read.parquet(f"{tmp_path}/bundles").collect()}
    assert set(rows) == {"s0", "s1"} and all(r.reason == "disabled" and r.prompt == r.machine_prompt and "branch - when" in r.prompt for r in rows.values())
    for place, ends in drivers.FILES.values():
        assert sorted(x for x in os.listdir(f"{tmp_path}/{place}") if x.endswith(ends) and not x.startswith(".")) == [f"s0{ends}", f"s1{ends}"]
    with open(f"{tmp_path}/instructions/s0.prompt.txt") as f:
        assert f.read() == rows["s0"].prompt
    record = json.loads(rows["s0"].eval_json)
    g = {r.sample_id: r for r in some.collect()}["s0"]
    assert record["sample_id"] == "s0" and [x["cid"] for x in record["eval_protocol"]["global_scoring"]] == [n.cid for n in g.global_constraints]
    assert [x["sid"] for x in record["eval_protocol"]["conditional_scoring"]] == [s.sid for s in g.selections]
    figures = shape.figures(some).filter("sample_id = 's0'").first()
    own = rules_of(g)
    assert (figures.total_constraints, figures.conditional_branches, figures.blocks, figures.variant_type) == (len(own), len(g.selections), 5, "base")
    assert rows["s0"].prompt_length_words == len(rows["s0"].prompt.split())
    # stored protocols score as the graphs do
    answers = samples.filter("sample_id IN ('s0', 's1')").select("sample_id", F.col("answer").alias("text"))
    stored = files.read_protocols(spark, f"{tmp_path}/reports/*.eval.json")
    direct = render.eval_items(some, "sample_id")
    columns = ["sample_id", "section", "block_id", "sid", "branch", "cid", "check"]
    assert sorted(map(str, stored.select(*columns).collect())) == sorted(map(str, direct.select(*columns).collect()))
    parts = drivers.run_scoring(spark, f"{tmp_path}/reports/*.eval.json", answers)
    want = {r.sample_id: r.overall_pass_rate for r in scoring.score(answers, direct)[2].collect()}
    assert {r.sample_id: r.overall_pass_rate for r in parts[2].collect()} == want and len(want) == 2
    scores = {r.sample_id: json.loads(r.json) for r in drivers.score_records(parts).collect()}
    assert scores["s0"]["summary"]["overall_pass_rate"] == want["s0"] and len(scores["s0"]["per_constraint"]) == direct.filter("sample_id = 's0'").count()
    with open(f"{tmp_path}/bad.eval.json", "w") as f:
        f.write('{"sample_id": "x", "eval_protocol": {}}')
    with pytest.raises(Exception, match="no evaluation protocol"):
        files.read_protocols(spark, f"{tmp_path}/bad.eval.json").collect()


def test_edits_keep_selections_sound(graphs):
    g = graphs.filter("sample_id = 's0'")
    row = g.first()
    alone = {s_.constraints[0] for s in row.selections for s_ in (s.branch_real, s.branch_alt) if len(s_.constraints) == 1}
    assert {r.cid for r in shape.holders(g).collect()} == alone
    assert set(g.select(F.expr(shape.removable()).alias("x")).first().x) == set(rules_of(row)) - alone
    assert set(g.select(F.expr(shape.selection_cids()).alias("x")).first().x) == {c for s in row.selections for b in (s.branch_real, s.branch_alt) for c in b.constraints}
    sel = row.selections[0]
    old = sel.branch_alt.constraints[0]
    swapped = shape.replace_cid(g, f"'{old}'", "'NEW'").first().selections[0].branch_alt.constraints
    assert swapped == ["NEW", *sel.branch_alt.constraints[1:]]
    kept = [c for c in rules_of(row) if c not in sel.branch_alt.constraints]
    less = shape.prune_selections(shape.keep_cids(g, "array(" + ", ".join(f"'{c}'" for c in kept) + ")")).first()
    assert set(rules_of(less)) == set(kept) and sel.sid not in [s.sid for s in less.selections] and all(s.branch_real.constraints and s.branch_alt.constraints for s in less.selections)
    assert {r.cid: r.node.cid for r in shape.nodes_by_cid(g).collect()} == {c: c for c in rules_of(row)}


def test_variants(graphs):
    got = {r.sample_id: r for r in drivers.augmented(graphs.filter("sample_id IN ('s0', 's1', 's2', 's3')"), least=8, floor=4, priority_ratio=1.0).collect()}
    base = {r.sample_id: r for r in graphs.collect()}
    assert len({r.parent for r in got.values()}) == 4
    for p in {r.parent for r in got.values()}:
        levels = [got[f"{p}__g{k}"] for k in range(1, 6)]
        sizes = [len(rules_of(g)) for g in levels]
        assert set(rules_of(levels[4])) == set(rules_of(base[p])) and all(0 <= b - a <= 3 for a, b in zip(sizes, sizes[1:])) and sizes[0] >= 4
        assert all(set(rules_of(a)) <= set(rules_of(b)) for a, b in zip(levels, levels[1:]))
        assert json.loads(levels[2].meta)["curriculum_level"] == 3 and "assembled_from" in json.loads(levels[2].meta)
        assert sum(n.priority_level == 1 for n in rules_of(levels[4]).values()) in (0, 1, 2)
        for g in got.values():
            assert all(set(s.branch_real.constraints) | set(s.branch_alt.constraints) <= set(rules_of(g)) and s.branch_real.constraints and s.branch_alt.constraints for s in g.selections)
        if f"{p}__m1_t1" in got:
            one, two, three = (got[f"{p}__m1_t{k}"] for k in (1, 2, 3))
            assert set(rules_of(one)) < set(rules_of(two)) < set(rules_of(three)) == set(rules_of(base[p]))
            assert {n.change_type for n in rules_of(one).values()} == {"add"} and {c for c, n in rules_of(two).items() if n.change_type == "add"} == set(rules_of(two)) - set(rules_of(one))
            assert json.loads(two.meta)["delta_only_instruction"] is True and json.loads(one.meta)["turn_total"] == 3
        first, second = rules_of(got[f"{p}__m2_t1"]), rules_of(got[f"{p}__m2_t2"])
        (alt,) = [c for c in first if c.endswith("__m2_alt")]
        old = alt.removesuffix("__m2_alt")
        assert set(second) == set(rules_of(base[p])) and set(first) == set(second) - {old} | {alt} and first[alt].priority_level == 1
        assert first[alt].verifier_spec.args != second[old].verifier_spec.args and second[old].change_type == "modify"
    assert any(f"{p}__m1_t1" in got for p in base)


def test_batch_rendering_resumes_and_shards(spark, graphs):
    done = spark.createDataFrame([("s1",), ("s2",), ("s3",), ("s4",), ("s5",)], "sample_id string")
    prompts, styled = drivers.render_batch(graphs.filter("sample_id LIKE 's%'"), None, done=done, least=8, floor=4, ratio=0.0)
    rows = prompts.collect()
    assert {r.parent for r in rows} == {"s0"} and len({r.sample_id for r in rows}) == len(rows) >= 7
    first = {r.template for r in rows if not r.sample_id[-5:] in ("m1_t2", "m1_t3", "m2_t2")}
    assert len(first) == 1 and {r.template for r in rows if r.sample_id[-5:] in ("m1_t2", "m1_t3", "m2_t2")} == {"stage_blueprint"}
    assert all(r.prompt == r.machine_prompt and r.prompt.startswith("SYSTEM INSTRUCTIONS") for r in rows) and styled.collect() == []
    parts = [{r.sample_id for r in drivers.shard(graphs, 3, i).collect()} for i in range(3)]
    assert set.union(*parts) == {r.sample_id for r in graphs.collect()} and sum(map(len, parts)) == len(set.union(*parts))


def test_template_choice():
    assert shape.template_pool(["Branch-First", "branch_first", "x"]) == (["branch_first"], ["branch_first", "x"]) and shape.template_pool([])[0] == list(render.TEMPLATES)
    assert shape.template_weights("") == shape.WEIGHTS and shape.template_weights("x:3,branch_first:0") == shape.WEIGHTS
    assert shape.template_weights("Branch-First: 7 , junk, stage_blueprint:a") == {"stage_blueprint": 1, "branch_first": 7, "grouped_by_check": 1, "priority_layered": 1}


def test_weighted_draw_follows_its_weights(spark):
    rows = spark.range(10_000).select((F.col("id") / 10_000).alias("u"))
    got = dict(rows.select(F.expr(shape.weighted_template("u", shape.WEIGHTS)).alias("t")).groupBy("t").count().collect())
    assert got == {"stage_blueprint": 4000, "branch_first": 2000, "grouped_by_check": 2000, "priority_layered": 2000}


def test_survey_samples(spark, tmp_path):
    from rulegrove.queries import surveys as fixture

    df = fixture(spark)
    got = {r.sample_id: r for r in surveys.samples(df).collect()}
    assert set(got) == {"surveygen_s1", "surveygen_s2"}
    en = got["surveygen_s1"].instruction.split("\n")
    assert en[0] == 'Please produce a multi-angle research survey report on: "Title s1 words".' and en[-3] == "- Keywords: kw" and en[-2] == "- Abstract: N/A" and en[-1] == ""
    assert "2. Organize the report into at least 4 titled sections." in en and "4. Cite at least 3 distinct sources." in en
    zh = surveys.samples(df, lang="zh", inline=False, start=1, limit=1).collect()
    assert [r.sample_id for r in zh] == ["surveygen_s2"] and zh[0].instruction.startswith("请围绕“Title s2 words”完成") and "- 关键词：无" in zh[0].instruction
    four = surveys.introductions(df).collect()
    assert len(four) == 8 and {r.variant for r in four} == {"explicit_whole", "explicit_section", "abstract_whole", "abstract_section"}
    assert all(r.block_mode == ("llm" if r.granularity == "section" else "heading") and r.instruction.startswith("Please write a rigorous Introduction") for r in four)
    ids = surveys.sample_ids(spark.createDataFrame([(" 7 ", 1), (None, 12), ("", 123456)], "corpusId string, n int"), "p_", "n").collect()
    assert [r.sample_id for r in ids] == ["p_7", "p_00012", "p_123456"]
    assert files.find_record(df, "corpusId", " s2 ").count() == 1 and files.find_record(df, "corpusId", "x").count() == 0
    with open(tmp_path / "batch.json", "w") as f:
        json.dump([{"id": "a", "messages": [{"role": "user", "content": "x"}]}, {"id": "b", "messages": []}], f, indent=1)
    rows = files.read_array(spark, str(tmp_path / "batch.json"), "id string, messages array<struct<role:string,content:string>>").collect()
    assert [(r.id, len(r.messages)) for r in rows] == [("a", 1), ("b", 0)]
