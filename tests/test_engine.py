import glob
import os
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from rulegrove import queries as Q
from rulegrove.operators import augment, provider, scoring, segment
from rulegrove.plans import mermaid, render
from rulegrove.sources import files
from rulegrove.streaming import scoring as streamed

DATA = "/root/testdata/sf0.001"
SLOW = {"curriculum", "mine_global_rules", "priority_injection", "render_branch_first", "m2_turns", "remove_cids", "renumber_ids"}


def plain(rows):
    def v(x):
        if isinstance(x, float):
            return f"{x:.9g}"
        return "[" + ",".join(map(v, x)) + "]" if isinstance(x, (list, tuple)) else str(x)

    return sorted("|".join(map(v, r)) for r in rows)


@pytest.mark.parametrize("name", [n for n in Q.SQL if n not in SLOW and not n.startswith("check_")])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    want = con.sql(Q.SQL[name])
    columns = sorted(want.columns)
    df = Q.QUERIES[name](spark, DATA)
    assert sorted(df.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert plain(df.select(*columns).collect()) == plain([tuple(r[i] for i in at) for r in want.fetchall()])


def machine(text):
    """Paragraphs by a plain state machine."""
    done, cur, listed = [], [], False

    def flush():
        nonlocal cur, listed
        chunk = "\n".join(cur).strip()
        if chunk:
            done.append(chunk)
        cur, listed = [], False

    for raw in text.splitlines():
        line = raw.rstrip()
        bullet = bool(re.match(r"\s*(?:[-*•]+|\d+[.)]|[A-Za-z][.)])\s+", line)) and bool(line.strip())
        if not line.strip():
            cur.append("") if listed else flush()
        elif bullet:
            if not listed and cur:
                flush()
            listed = True
            cur.append(line)
        else:
            if listed:
                flush()
            cur.append(line)
    flush()
    return done


def test_paragraph_fold_matches_a_state_machine(spark):
    rng = random.Random(5)
    texts = ["\n".join(rng.choice(["", " ", "- a", "* b c", "1. d", "text", "  more text ", "x) y"]) for _ in range(rng.randrange(0, 12))) for _ in range(200)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    for r in df.select("id", segment.blocks("paragraph").alias("b")).collect():
        assert [x.text_span for x in r.b] == machine(texts[r.id])


def node(cid, desc, check, p=2, owner=None, change=None):
    return {"cid": cid, "desc": desc, "scope": "local", "verifier_spec": {"check": check, "args": {"n": 2}}, "priority_level": p, "trace_to": owner, "derived_from": "x", "change_type": change}


def graph(kind="local", meta=None):
    block = lambda i, name, at, alt=False: {"block_id": i, "intent": name, "text_span": name, "order_index": at, "is_alternate": alt, "origin_block": "B1" if alt else None}
    return {
        "seed_task": "Write it.",
        "global_constraints": [node("G1", "Be short.", "max_word_count"), node("G2", "Be kind.", "tone", 1)],
        "block_specs": [block("B1", "Opening", 0), block("B2", "Body", 1), block("B1_ALT", "Opening", 0, True)],
        "block_constraint_sets": [
            {"block_id": "B1", "logic_type": "AND", "constraints": [node("B1_C1", "Say hello.", "x", 2, "B1", "add")]},
            {"block_id": "B1_ALT", "logic_type": "AND", "constraints": [node("B1_ALT_C1", "Say no.", "x", 1, "B1_ALT")]},
            {"block_id": "B2", "logic_type": "sub-chain", "constraints": [node("B2_C1", "Tell.", "x", 2, "B2"), node("B2_C2", "Show.", "max_word_count", 1, "B2")]},
        ],
        "selections": [
            {
                "sid": "SEL_B1", "condition": "If the stance is critical", "trace_to": "B1", "branch_real": {"block_id": "B1", "constraints": ["B1_C1"]},
                "branch_alt": {"block_id": "B1_ALT", "constraints": ["B1_ALT_C1"]}, "derived_from": "step5", "selection_type": kind, "merge_point": "B2", "truncated": False, "alt_path_blocks": ["B1_ALT"],
            }
        ],
        "meta": meta or {},
    }


def graphs(spark, *items):
    import json

    return render.decode(spark.createDataFrame([(str(i), g if isinstance(g, str) else json.dumps(g)) for i, g in enumerate(items)], "sample_id string, json string"))


def test_prompts(spark):
    df = graphs(spark, graph(), graph("global"), "{}", "no json")
    out = {r.sample_id: r.prompt for r in render.render_main(df).collect()}
    assert "      LOCAL branch - when The stance is critical:\n        Primary constraints (priority=2, must satisfy):\n          • None.\n" in out["0"]
    assert "      Otherwise at this same decision point:\n        • Say hello.\n\n   Stage 2 - Body\n" in out["0"]
    assert "   - Opening: The stance is not critical.\n" in out["0"]
    assert "        - Step 2: Body\n            Logic cue: Sequential micro-steps" in out["1"] and "Stage 2 - Body" not in out["1"]
    assert out["2"] == out["3"] and "No additional global constraints were supplied." in out["2"]
    told = {(r.sample_id, r.template): r.prompt for r in render.render_templates(df).collect()}
    assert len(told) == 16
    assert "- max_word_count:\n  Global:\n    * Be short.\n  Stage: Body:\n    * Show.\n" in told["0", "grouped_by_check"]
    assert "- Secondary:\n  Global:\n    * Be kind.\n" in told["0", "priority_layered"]
    assert "Branch map:\n- Decision at Opening:\n  IF The stance is critical:\n    - Say no.\n  OTHERWISE:\n    - Say hello.\n" in told["0", "branch_first"]


def test_mermaid(spark):
    text = mermaid.render_mermaid(graphs(spark, graph())).first().mermaid.split("\n")
    assert text[0] == "flowchart LR" and text[1] == "    SEED(((Write it)))"
    assert text[-5:] == ['    DEC_SEL_B1{"If the stance is critical"}', "    G2 --> DEC_SEL_B1", "    DEC_SEL_B1 --> B1_C1", "    DEC_SEL_B1 --> B1_ALT_C1", "    B1_ALT_C1 --> B2_C1"]
    assert "        B2_C1 --> B2_C2" in text and "    B1_C1 --> B2_C1" in text


def test_graph_spellings_delta_and_items(spark):
    one = graph()
    two = {k if k != "block_specs" else "blocks": v for k, v in one.items()}
    for s in two["block_constraint_sets"]:
        s["constraints"] = [{("verifier" if k == "verifier_spec" else k): v for k, v in c.items() if k != "change_type"} for c in s["constraints"]]
    df = graphs(spark, graph(), two)
    prompts = [r.prompt for r in render.render_main(df).collect()]
    assert prompts[0] == prompts[1]
    small = render.delta_view(df).collect()[0]
    assert [s.block_id for s in small.block_constraint_sets] == ["B1"] and small.global_constraints == [] and len(small.selections) == 1
    items = render.eval_items(df.filter("sample_id = '0'"), "sample_id")
    assert [(r.section, r.cid) for r in items.orderBy("pos").collect()] == [
        ("global", "G1"), ("global", "G2"), ("block", "B1_C1"), ("block", "B2_C1"), ("block", "B2_C2"), ("branch", "B1_C1"), ("branch", "B1_ALT_C1")
    ]
    chosen = render.choose_template(df, "sample_id", ratio=1.0).collect()
    assert {r.template for r in chosen} == {"branch_first"}


def test_files_resume_and_streams(spark, tmp_path):
    df = graphs(spark, graph())
    files.write_graphs(df, f"{tmp_path}/g")
    again = files.read_written_graphs(spark, f"{tmp_path}/g")
    columns = [c for c in again.columns if c in df.columns]
    assert len(columns) == 7 and again.select(*columns).collect() == df.select(*columns).collect()
    text = render.encode(df).first().json
    os.makedirs(f"{tmp_path}/in")
    for name in ("a.graph.json", "a__g1.graph.json", "b.txt"):
        with open(f"{tmp_path}/in/{name}", "w") as to:
            to.write(text)
    open(f"{tmp_path}/in/empty.txt", "w").close()
    assert {r.name: len(r.text) for r in files.read_texts(spark, f"{tmp_path}/in/*.txt").collect()} == {"b.txt": len(text), "empty.txt": 0}
    with pytest.raises(Exception, match="blank file"):
        files.read_texts(spark, f"{tmp_path}/in/*.txt", strict=True).collect()
    back = files.read_graphs(spark, f"{tmp_path}/in/*")
    assert [r.sample_id for r in back.collect()] == ["a"] and back.first().global_constraints[0].verifier_spec.args == '{"n":2}'
    assert files.read_texts(spark, f"{tmp_path}/none/*").count() == 0
    with pytest.raises(FileNotFoundError):
        files.read_texts(spark, f"{tmp_path}/none", strict=True)
    objects = files.read_json_objects(spark, f"{tmp_path}/in/b.txt").select(F.expr("variant_get(json, '$.seed_task', 'string')").alias("s")).first()
    assert objects.s == "Write it."
    answers = spark.createDataFrame([("0", "one two three")], "sample_id string, text string")
    answers.write.json(f"{tmp_path}/answers")
    items = render.eval_items(df, "sample_id")
    items.write.parquet(f"{tmp_path}/items")
    items = spark.read.parquet(f"{tmp_path}/items")
    seen = []
    q = streamed.score_batches(files.stream_lines(spark, f"{tmp_path}/answers", "sample_id string, text string"), items, lambda b, n: seen.extend(b.collect()), f"{tmp_path}/ck")
    q.processAllAvailable()
    q.stop()
    whole = scoring.score(answers, items)[2].collect()
    assert seen == whole and len(whole) == 1


def test_provider_and_variants(spark):
    def make():
        calls = []

        def model(prompt):
            calls.append(prompt)
            if "boom" in prompt:
                raise RuntimeError("down")
            return "NEUTRAL\nbecause"

        return model

    items = spark.createDataFrame([(1, "tone_neutral_llm_judge", "fine"), (2, "actionability_judge", "fine"), (3, "tone_neutral_llm_judge", "boom")], "id int, check string, text string")
    assert {r.id: r.judged for r in provider.judged(items, make).collect()} == {1: True, 2: False, 3: False}
    assert not any(r.judged for r in provider.judged(items, None).collect())
    asked = provider.ask(items, "text", make, retries=1, backoff=0).orderBy("id").collect()
    assert [r.attempts for r in asked] == [1, 1, 2] and asked[2].error == "down"
    assert provider.first_json('x {"a": {"b": 1}} y') == '{"a": {"b": 1}}' and provider.first_json("[1, [2]] {") == "[1, [2]]" and provider.first_json(None) is None

    rules = spark.createDataFrame([("s", None if i < 6 else f"B{i % 4}", f"C{i:02d}", "min_word_count", '{"min_words": 100}', "d", 2) for i in range(24)], "sample_id string, owner string, cid string, check string, args string, descr string, priority_level int")
    levels = {}
    for r in augment.curriculum(rules).collect():
        levels.setdefault(r.level, set()).add(r.cid)
    assert sorted(levels) == [1, 2, 3, 4, 5] and all(levels[k] < levels[k + 1] for k in (1, 2, 3, 4)) and len(levels[1]) >= 5
    assert all(1 <= len(levels[k + 1]) - len(levels[k]) <= 3 for k in (1, 2, 3, 4))
    turns = augment.m1_turns(rules).groupBy("turn").count().orderBy("turn").collect()
    assert turns[0]["count"] < turns[1]["count"] < turns[2]["count"] == 24
    two = augment.m2_turns(rules).collect()
    assert sum(r.cid.endswith("__m2_alt") and r.priority_level == 1 for r in two if r.turn == 1) == 1 and sum(r.restored for r in two if r.turn == 2) == 1
    assert augment.inject_priorities(rules).filter("priority_level = 1").count() in (1, 2)
