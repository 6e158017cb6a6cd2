import json
import re

import pytest

from rulegrove import queries as Q
from rulegrove.functions import checks
from rulegrove.functions import text as X
from rulegrove.functions.dialect import SPARK

EDGE = [
    *Q.FIXTURES, "don't stop", "U+2028 - not a line", " - nbsp bullet", "I am", "us", "status", "1.25", "1.5x 2.5", "x1.23", "12.34.56", "2024-01-02x", "[1]", "[b12]", "## h\n### i", "a\n\n \n\nb",
]


def python_rule(name, t, a):
    low = t.lower()
    cites = re.findall(r"\[\s*\d{1,4}(?:\s*[-,;]\s*\d{1,4})*\s*\]", t), re.findall(r"\([A-Z][A-Za-z.\-]+(?:\s+et\s+al\.)?,\s*\d{4}[a-z]?\)", t), re.findall(r"\[[A-Za-z][A-Za-z0-9_-]*\d+\]", t)
    if name == "forbid_first_person":
        return not re.search(r"\b(?:i|me|my|we|our|us)\b", low)
    if name == "min_word_count":
        return len(re.findall(r"\w+", t)) >= a["min_words"]
    if name == "min_paragraphs":
        return len([p for p in re.split(r"\n\s*\n+", t.strip()) if p.strip()]) >= a["min_paras"]
    if name == "heading_levels_only":
        found = [len(m) for m in re.findall(r"^(#{1,6})\s+\S", t, re.M)]
        return bool(found) and set(found) <= set(a["levels"])
    if name == "decimal_places":
        found = re.findall(r"\b\d+\.(\d+)\b", t)
        return bool(found) and all(len(x) == a["places"] for x in found)
    if name == "is_english":
        bare = len(re.findall(r"[^\x00-\x7F]", t))
        return not bare or len(re.findall("[A-Za-z]", t)) >= 5 * bare
    if name == "forbid_emojis":
        return not re.search("[\U0001f300-\U0001faff✀-➿]", t)
    if name == "avoid_contractions":
        return not re.search(r"\b(?:" + "|".join(X.CONTRACTIONS_CHECKED) + r")\b", t, re.I)
    if name == "must_list_n_subpoints":
        return len(re.findall(r"(^\s*(?:[-*]|\d+[.)])\s+.+)", t, re.M)) >= a["n"]
    if name == "min_distinct_citations":
        return len({x.lower() for c in cites for x in c}) >= a["min_unique"]
    if name == "keyword_min_frequency":
        return len(re.findall(re.escape(a["keyword"].lower()), low)) >= a["min_count"]
    return None


CASES = {
    "forbid_first_person": {}, "min_word_count": {"min_words": 4}, "min_paragraphs": {"min_paras": 2}, "heading_levels_only": {"levels": [1, 2]}, "decimal_places": {"places": 2}, "is_english": {},
    "forbid_emojis": {}, "avoid_contractions": {}, "min_distinct_citations": {"min_unique": 2}, "keyword_min_frequency": {"keyword": "KEY", "min_count": 2},
}


def test_rules_match_python_regexes(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(EDGE)], "id int, text string")
    flags = df.selectExpr("id", *[f"{Q.check_sql(SPARK, n, a)} AS {n}" for n, a in CASES.items()]).collect()
    for r in flags:
        for n, a in CASES.items():
            assert r[n] == python_rule(n, EDGE[r.id], a), (n, EDGE[r.id])


@pytest.mark.parametrize("aliases", [False, True])
def test_arguments_decide_between_null_false_and_a_verdict(spark, aliases):
    rows = [
        ("min_word_count", '{"min_words": "2"}', "a b c", True), ("min_word_count", '{"min_words": "1.5"}', "a b c", False), ("min_word_count", '{"min_words": 3.9}', "a b c", True),
        ("min_word_count", "{}", "a b c", False), ("is_english", '{"x": 1}', "a", False), ("custom:x", "{}", "a", None), (None, "{}", "a", None), ("is_english", "{}", None, None),
        ("tone_neutral_llm_judge", '{"any": 1}', "a", False), ("must_include_keywords", '{"keywords": []}', "a", True), ("min_numbered_items", '{"min_items": 1}', "1. a", aliases),
        ("forbid_words", '{"banned": ["SAND"]}', "a thousand", False), ("word_count_around", '{"center": 3, "tolerance_pct": 0.4}', "a b", True), ("require_language", '{"lang": "xx"}', "a", True),
    ]
    df = spark.createDataFrame([(i, c, a, t) for i, (c, a, t, _) in enumerate(rows)], "id int, check string, a string, text string").selectExpr("*", "try_parse_json(a) AS args")
    got = {r.id: r.v for r in df.selectExpr("id", checks.verdict_sql(aliases=aliases) + " AS v").collect()}
    assert got == {i: want for i, (*_, want) in enumerate(rows)}


def test_registry_is_complete():
    hard = [c for c in checks.REGISTRY.values() if c.kind == "hard"]
    assert len(hard) == 29 and len(checks.REGISTRY) == 34 and set(Q.CHECK_ARGS) == {c.name for c in hard}
    assert all(json.loads(json.dumps(a)) == a for s in Q.CHECK_ARGS.values() for a in s)
