import json
import re

from rulegrove.operators import provider, refine

PROMPT = """SYSTEM INSTRUCTIONS:

1. mission brief & deliverable
   - Primary directive: Write a report about tidal energy.

2. NON-NEGOTIABLE GLOBAL RULES
   1. Use at least 200 words in every answer.
   2. Mention turbines, grids and storage explicitly.

3. STRUCTURED RESPONSE BLUEPRINT
   Stage 1 - Opening: describe coastal sites, currents and engineering history in detail.

4. CURRENT CONDITION ASSUMPTION
   - Opening: The budget is not limited.
"""


def brute_sections(text, headings, exact=False):
    hay = text if exact else text.lower()
    at = []
    for name, hs in headings.items():
        hs = (hs,) if isinstance(hs, str) else hs
        places = [hay.find(h if exact else h.lower()) for h in hs]
        places = [p for p in places if p >= 0]
        if places:
            at.append((min(places), name))
    at.sort()
    return [(n, text[a : at[i + 1][0] if i + 1 < len(at) else len(text)].strip()) for i, (a, n) in enumerate(at)]


def test_sections(spark):
    numbered = "intro\n1. First thing\nx\n  2. Second\ny\n3. Third\n4. Fourth\n5. Fifth\nz"
    rows = spark.createDataFrame([(0, PROMPT), (1, numbered), (2, "nothing"), (3, "")], "id int, t string")
    got = {r.id: r for r in rows.select("id", refine.sections("t").alias("a"), refine.exact_sections("t").alias("b")).collect()}
    assert [tuple(x) for x in got[0].a] == brute_sections(PROMPT, refine.HEADINGS)
    assert [tuple(x) for x in got[0].b] == brute_sections(PROMPT, refine.EXACT, True)
    assert [x.name for x in got[1].a] == ["mission", "global", "blueprint", "conditions"]
    assert got[1].a[0].body == "1. First thing\nx" and got[1].a[3].body == "4. Fourth\n5. Fifth\nz" and got[1].b == []
    assert got[2].a == [] and got[3].a == []


def brute_failure(old, new, rules, lists):
    if not new.strip():
        return "empty_output"
    if not lists and any(re.match(r"(#{1,6}|[-*]|\d+[.)])\s+\S", line.strip()) for line in new.splitlines()):
        return "disallowed_formatting"
    n, m = len(old.split()), len(new.split())
    floor = next(f for k, f in ((800, 0.18), (400, 0.22), (200, 0.26), (120, 0.32), (0, 0.38)) if n >= k)
    if n and m / n < floor:
        return f"length_ratio({m / n:.2f}<{floor:.2f})"
    words = lambda t: set(re.findall(r"[A-Za-z0-9']+", t.lower()))
    out = []
    for name, body in brute_sections(old, refine.HEADINGS):
        hits = len(words(body) & words(new))
        if hits < rules[name][1] or hits / len(words(body)) < rules[name][0]:
            out.append(f"{name}:{hits / len(words(body)):.2f}|{hits}")
    return f"coverage_missing({'/'.join(out)})" if out else ""


def test_failures(spark):
    flat = PROMPT.replace("\n", " ").replace("   - ", "")
    news = ["", "short text", flat, "- item\n" + flat, "word " * 80, "1) one\n" + "the primary directive mission brief " * 10, PROMPT]
    rows = spark.createDataFrame([(i, PROMPT, n) for i, n in enumerate(news)], "id int, o string, n string").withColumn("parts", refine.sections("o"))
    for lists in (True, False):
        got = rows.withColumn("f", refine.failure("o", "n", "parts", refine.COVERAGE, lists)).orderBy("id").collect()
        assert [r.f for r in got] == [brute_failure(PROMPT, n, refine.COVERAGE, lists) for n in news]


def test_reference_lists(spark):
    listed = "Head\n   - Required evidence references (cite by ref_id):\n     • [b1] One\n\n     • [b2] Two\n   - Next rule\n     • stays\n"
    refs = [("b1", "One", "http://x"), ("b2", "Two", None), (None, None, "http://y"), ("", " ", "")]
    rows = spark.createDataFrame([(0, listed, refs), (1, "no list\n", []), (2, "", []), (3, None, None)], "id int, t string, refs array<struct<ref_id:string,title:string,url:string>>")
    cut = {r.id: r.c for r in rows.select("id", refine.cut_references("t").alias("c")).collect()}
    assert cut[0].text == "Head\n   - Use the fixed reference list provided at the end of this instruction.\n   - Next rule\n     • stays\n"
    assert (cut[0].removed_lines, cut[0].replaced_header) == (4, True)
    assert (cut[1].text, cut[1].removed_lines, cut[1].replaced_header) == ("no list\n", 0, False) and cut[2].text == "" and cut[3].text == ""
    back = {r.id: r.p for r in rows.select("id", refine.append_references("t", "refs").alias("p")).collect()}
    assert back[0].endswith("     • stays\n\nReference List:\n- [b1] One | http://x\n- [b2] Two\n- (untitled) | http://y\n- (untitled)\n") and back[1] == "no list\n"


def test_styles(spark):
    assert refine.style_pool(["Question-Led", "narrative", "narrative", "pirate"]) == (["question_led", "narrative"], ["pirate"])
    assert refine.style_pool(["pirate"]) == (list(refine.STYLES), ["pirate"]) and refine.style_pool(None)[0] == list(refine.STYLES)
    rows = spark.createDataFrame([(f"s{i}",) for i in range(40)], "k string")
    pool = ["briefing", "narrative", "outcome_first"]
    for n in (0, 2, 7):
        got = {}
        for r in refine.choose_styles(rows, "k", n, pool).orderBy("k", "nth").collect():
            got.setdefault(r.k, []).append(r.style)
        assert len(got) == (40 if n else 0) and all(len(x) == n for x in got.values())
        assert all(set(x[3 * c : 3 * c + 3]) == set(pool) for x in got.values() for c in range(n // 3))
        assert all(len(set(x[:3])) == min(3, n) for x in got.values())
    assert len({tuple(x[:3]) for x in got.values()}) > 3
    marks = spark.createDataFrame([("# h",), ("a\n  - x",), ("12) z",), ("a - b",), ("#x",), ("1.5 apples",)], "t string")
    from pyspark.sql import functions as F

    assert [r[0] for r in marks.select(F.expr(refine.marked_up("t"))).collect()] == [True, True, True, False, False, False]


def test_polish_and_variants(spark):
    def make():
        seen = {}

        def model(ask):
            seen[ask[:400]] = seen.get(ask[:400], 0) + 1
            if "FAIL" in ask:
                raise RuntimeError("down")
            body = ask.split("<<<\n")[1].split("\n>>>")[0]
            if "lacked required content" not in ask and "RETRY" in ask:
                return "too short"
            return "<think>hm</think> " + re.sub(r"(?m)^\s*(\d+\.|-)\s*", "", body).replace("\n", " ")

        return model

    rows = spark.createDataFrame([("a", "task", PROMPT), ("b", "RETRY", PROMPT), ("c", "FAIL", PROMPT), ("d", "x", " "), ("e", "x", None)], "sample_id string, seed_task string, machine_prompt string")
    got = {r.sample_id: r for r in refine.polish(rows, make, retries=0).collect()}
    assert (got["a"].reason, got["a"].used_llm, got["a"].attempts) == ("success", True, 1) and got["a"].prompt.startswith("SYSTEM INSTRUCTIONS:") and "think" not in got["a"].prompt
    assert (got["b"].reason, got["b"].attempts) == ("success", 2)
    assert got["c"].reason == "llm_error: down" and got["c"].prompt == PROMPT and not got["c"].used_llm
    assert got["d"].reason == "empty_prompt" and got["d"].prompt == " " and got["e"].reason == "empty_prompt" and got["e"].prompt is None
    off = {r.sample_id: r.reason for r in refine.polish(rows, None).collect()}
    assert off == {"a": "disabled", "b": "disabled", "c": "disabled", "d": "empty_prompt", "e": "empty_prompt"}
    made = refine.variants(rows, "sample_id", make, n=2, retries=0)
    by = {}
    for r in made.collect():
        by.setdefault(r.sample_id, []).append(r)
    assert sorted(by) == ["a", "b", "c"] and all(len(x) == 2 for x in by.values())
    assert all(r.reason == "success" and r.variant for r in by["a"]) and all(not r.variant for r in by["c"])
    status = {r.sample_id: (r.requested, r.succeeded, r.status) for r in refine.outcome(made, "sample_id").collect()}
    assert status["a"] == (2, 2, "success") and status["c"] == (2, 0, "failed")
    assert refine.variants(rows, "sample_id", None).collect() == []


def test_each_judge_is_asked_its_own_question(spark):
    items = spark.createDataFrame([(c, "the text") for c in provider.JUDGES], "check string, text string")
    right = dict(provider.JUDGES)
    make = lambda: lambda ask: next(right[c] for c, q in provider.QUESTIONS.items() if ask.startswith(q))
    assert all(r.judged for r in provider.judged(items, make).collect())
    assert all(right[c] in q for c, q in provider.QUESTIONS.items()) and json.dumps(sorted(provider.QUESTIONS)) == json.dumps(sorted(right))
