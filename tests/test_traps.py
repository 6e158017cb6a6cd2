"""One test for each place where the behaviour to keep is not the one that would be expected."""

import pytest

from rulegrove import drivers
from rulegrove.functions.dialect import SPARK
from rulegrove.operators import augment, mining, parsing, scoring
from rulegrove.plans import render, shape
from rulegrove.queries import check_sql

ITEM = "sample_id string, section string, block_id string, sid string, branch string, cid string, check string, args string, priority_level int"


def scored(spark, items, text, **options):
    rows = [("s", *i) for i in items]
    answers = spark.createDataFrame([("s", text)], "sample_id string, text string")
    checked, choice, summary = scoring.score(answers, spark.createDataFrame(rows, ITEM), **options)
    return {r.cid + (r.branch or ""): r.passed for r in checked.collect()}, {r.sid: r.chosen for r in choice.collect()}, summary.first()


def glob(cid, check, args="{}", level=2):
    return "global", None, None, None, cid, check, args, level


def block(cid, check, args="{}", level=2, of="B1"):
    return "block", of, None, None, cid, check, args, level


def side(branch, cid, check, args="{}", level=2):
    return "branch", None, "SEL_B1", branch, cid, check, args, level


YES, NO = ("min_word_count", '{"min_words": 1}'), ("min_word_count", '{"min_words": 999}')


def test_trap_01_mined_item_counts_fail_unless_aliases_are_on(spark):
    items = [block("C1", "min_numbered_items", '{"min_items": 2}'), block("C2", "min_numbered_items", '{"n": 2}'), block("C3", "must_list_n_subpoints", '{"min_items": 2}')]
    text = "1. one\n2. two"
    assert scored(spark, items, text)[0] == {"C1": False, "C2": True, "C3": False}
    assert scored(spark, items, text, aliases=True)[0] == {"C1": True, "C2": True, "C3": True}


def test_trap_02_unknown_checks_give_no_verdict_and_03_failed_judges_false(spark):
    got, _, total = scored(spark, [glob("G1", "custom:x"), glob("G2", "preference_y"), glob("G3", "tone_neutral_llm_judge"), glob("G4", *YES)], "words")
    assert got == {"G1": None, "G2": None, "G3": False, "G4": True} and total.global_pass_rate == 0.5


def test_trap_04_blocks_are_checked_on_the_whole_answer_and_06_in_any_order(spark):
    text = "2. second\n1. first\n\n" + "word " * 50
    got = scored(spark, [block("B1_C1", "min_word_count", '{"min_words": 50}', of="B1"), block("B2_C1", "min_numbered_items", '{"n": 2}', of="B2")], text)[0]
    assert got == {"B1_C1": True, "B2_C1": True}


def test_trap_05_rules_of_a_chosen_block_count_in_both_rates(spark):
    got, choice, total = scored(spark, [block("C1", *YES), block("C2", *NO), side("real", "C1", *YES), side("real", "C2", *NO), side("alt", "A1", *NO)], "words")
    assert choice == {"SEL_B1": "branch_real"} and (total.block_pass_rate, total.branch_pass_rate) == (0.5, 0.5) and len(got) == 5


@pytest.mark.parametrize(
    "real,alt,want",
    [
        ([(*YES, 2)], [(*YES, 2)], "branch_real"),
        ([(*NO, 2)], [(*YES, 2)], "branch_alt"),
        ([("custom:x", "{}", 2)], [(*NO, 2)], "branch_alt"),
        ([(*NO, 2)], [(*YES, 1)], "branch_real"),
        ([(*NO, 1)], [(*YES, 1)], "branch_alt"),
        ([(*YES, 1)], [(*YES, 1)], "branch_real"),
        ([("custom:x", "{}", 2)], [("custom:y", "{}", 1)], "undecided"),
    ],
)
def test_trap_07_branch_choice(spark, real, alt, want):
    items = [side(b, f"{b}{i}", *x) for b, xs in (("real", real), ("alt", alt)) for i, x in enumerate(xs)]
    assert scored(spark, items, "some words")[1] == {"SEL_B1": want}


def test_trap_08_overall_is_the_mean_of_the_rates_that_exist(spark):
    items = [glob("G1", *YES), glob("G2", *YES), glob("G3", *YES), block("C1", *NO), glob("G4", *NO, 1), block("C2", *YES, 1)]
    total = scored(spark, items, "words")[2]
    assert (total.global_pass_rate, total.block_pass_rate, total.branch_pass_rate, total.overall_pass_rate, total.best_effort_rate) == (1.0, 0.0, None, 0.5, 0.5)


def test_trap_09_mining_and_checking_measure_differently(spark):
    texts = ["一二三四五六", "pasta \U00020000 here", "1. one\n2. two", "a\n \nb\n \nc", "we think"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    mined = {k: v for k, v in mining.features(SPARK).items() if k in ("wc", "emoji", "bullet", "paras", "first_person")}
    told = {"words": check_sql(SPARK, "min_word_count", {"min_words": 2}), "emojis": check_sql(SPARK, "forbid_emojis", {}), "two": check_sql(SPARK, "min_paragraphs", {"min_paras": 3}), "third": check_sql(SPARK, "forbid_first_person", {})}
    rows = df.selectExpr("id", *[f"{v} AS {k}" for k, v in {**mined, **told}.items()]).orderBy("id").collect()
    assert rows[0].wc == 7 and not rows[0].words  # each character and the run; one word
    assert rows[1].emoji and rows[1].emojis  # beyond the basic plane; no emoji
    assert rows[2].bullet == "1."
    assert rows[3].paras < 3 and rows[3].two  # blanks between line feeds
    assert not rows[4].first_person and not rows[4].third  # no blank before it; a word of its own


def test_trap_11_lists_are_searched_as_substrings_and_12_empty_texts_pass(spark):
    df = spark.createDataFrame([("The classic caterpillar",), ("",)], "text string")
    has = lambda name, args: [r[0] for r in df.selectExpr(check_sql(SPARK, name, args)).collect()]
    assert has("forbid_words", {"banned": ["cat"]}) == [False, True] and has("must_include_keywords", {"keywords": ["CLASS"]}) == [True, False]
    assert has("must_include_keywords", {"keywords": []}) == [True, True] and has("is_english", {}) == [True, True] and has("require_language", {"lang": "fr"}) == [True, True]


def test_trap_13_pools_thresholds_and_resolution_differ_by_job(spark):
    assert shape.template_pool(["branch_first", "branch_first"]) == (["branch_first"], ["branch_first"])
    rules = [(f"G{i}", "d", "global", (c, "{}"), 2, None) for i, c in enumerate(("a", "b"))]
    df = spark.createDataFrame(
        [(rules, [], [])],
        "global_constraints array<struct<cid:string,desc:string,scope:string,verifier_spec:struct<check:string,args:string>,priority_level:int,trace_to:string>>,"
        " block_constraint_sets array<struct<block_id:string,constraints:array<struct<cid:string,desc:string,scope:string,verifier_spec:struct<check:string,args:string>,priority_level:int,trace_to:string>>>>, selections array<string>",
    )
    assert df.selectExpr(render.heuristic_template(), render.heuristic_template(3)).first()[:] == ("grouped_by_check", "stage_blueprint")


def test_trap_16_vanished_rules_leave_no_mark_and_17_small_graphs_have_no_curriculum(spark):
    turns = spark.createDataFrame([("s", 1, "a", "x"), ("s", 1, "b", "y"), ("s", 2, "a", "z")], "s string, turn int, cid string, text string")
    got = {(r.turn, r.cid): r.change_type for r in augment.turn_changes(turns, "s", "turn", "cid", augment.fingerprint("text")).collect()}
    assert got == {(1, "a"): "add", (1, "b"): "add", (2, "a"): "modify"}
    rules = spark.createDataFrame([("s", None, f"G{i}", "c", "{}", "d", 2) for i in range(14)], "sample_id string, owner string, cid string, check string, args string, descr string, priority_level int")
    assert augment.curriculum(rules).collect() == []


def test_trap_19_bare_evidence_maps_are_read_in_two_ways(spark):
    df = spark.createDataFrame([("k", '{"b1": {}, "b2": {"title": "T"}}')], "k string, e string")
    assert parsing.evidence_refs(df, "e", "k").count() == 2 and parsing.evidence_refs(df, "e", "k", described=True).count() == 1


def test_shards_refuse_a_wrong_index(spark):
    with pytest.raises(ValueError):
        drivers.shard(spark.range(3), 3, 3, "id")
