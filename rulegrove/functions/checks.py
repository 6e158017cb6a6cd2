"""The registry of checks and the verdict of a rule on a text.

A verdict is null for an unknown check or a null text, false for wrong or missing arguments, and the
check's result otherwise. Judges need a text model: without one they are false.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from rulegrove.functions import text as X
from rulegrove.functions.dialect import SPARK


@dataclass(frozen=True)
class Check:
    """build(d, t, args) gives SQL; args maps argument names to SQL of their values."""

    name: str
    required: dict[str, str]
    optional: dict[str, tuple[str, str]]
    build: Callable
    kind: str = "hard"


REGISTRY: dict[str, Check] = {}


def register(name, required=None, optional=None, build=None, kind="hard"):
    """Add a check. required: argument -> SQL type; optional: argument -> (SQL type, default)."""
    REGISTRY[name] = Check(name, required or {}, optional or {}, build, kind)


def _substrings(arg):
    return lambda d, t, a: d.forall(a[arg], "x", d.contains(f"lower({t})", "lower(x)"))


def _around(d, t, a):
    low = f"greatest(0, CAST(trunc({a['center']} * (1 - {a['tolerance_pct']})) AS BIGINT))" if d.name == "duck" else f"greatest(0, CAST({a['center']} * (1 - {a['tolerance_pct']}) AS BIGINT))"
    high = f"CAST(trunc({a['center']} * (1 + {a['tolerance_pct']})) AS BIGINT)" if d.name == "duck" else f"CAST({a['center']} * (1 + {a['tolerance_pct']}) AS BIGINT)"
    return f"({X.words(d, t)} BETWEEN {low} AND {high})"


def _all_and_some(xs, cond):
    return lambda d, t, a: f"({d.size(xs(d, t))} > 0 AND {d.forall(xs(d, t), 'x', cond(d, a))})"


def _date(d, t, a):
    iso, long = d.has(t, X.ISO_DATE), d.has(t, X.LONG_DATE)
    return f"CASE {a['style']} WHEN 'yyyy-mm-dd' THEN {iso} AND NOT {long} WHEN 'mon dd, yyyy' THEN {long} AND NOT {iso} ELSE false END"


def _cite(d, t, a):
    num, who, ref = (d.has(t, p) for p in (X.NUMERIC_CITE, X.AUTHOR_CITE, X.REF_CITE))
    return (
        f"CASE {a['style']} WHEN 'numeric' THEN {num} AND NOT {who} AND NOT {ref}"
        f" WHEN 'author_year' THEN {who} AND NOT {num} AND NOT {ref} WHEN 'ref_id' THEN {ref} ELSE false END"
    )


def _allowed(d, t, a):
    allowed = d.keep(d.map(d.keep(a["allowed_ref_ids"], "x", "x IS NOT NULL"), "x", f"lower({X.strip(d, 'x')})"), "x", "x <> ''")
    found = X.cited(d, t)
    inside = d.size(d.keep(found, "y", d.member(allowed, "y")))
    return f"({d.size(allowed)} > 0 AND {d.size(found)} > 0 AND {inside} >= {a['min_unique']} AND {d.size(found)} - {inside} <= {a['max_out_of_set']})"


LIST, INT, TEXT, REAL, BOOL = "array<string>", "bigint", "string", "double", "boolean"

register("is_english", build=lambda d, t, a: X.is_english(d, t))
register("forbid_first_person", build=lambda d, t, a: f"NOT {d.has(f'lower({t})', X.FIRST_PERSON)}")
register("forbid_words", {"banned": LIST}, build=lambda d, t, a: d.forall(a["banned"], "x", f"NOT {d.contains(f'lower({t})', 'lower(x)')}"))
register("min_word_count", {"min_words": INT}, build=lambda d, t, a: f"({X.words(d, t)} >= {a['min_words']})")
register("max_word_count", {"max_words": INT}, build=lambda d, t, a: f"({X.words(d, t)} <= {a['max_words']})")
register("word_count_between", {"min_words": INT, "max_words": INT}, build=lambda d, t, a: f"({X.words(d, t)} BETWEEN {a['min_words']} AND {a['max_words']})")
register("word_count_around", {"center": INT}, {"tolerance_pct": (REAL, "0.15")}, build=_around)
register(
    "min_char_count",
    {"min_chars": INT},
    {"ignore_whitespace": (BOOL, "false")},
    build=lambda d, t, a: f"(CASE WHEN {a['ignore_whitespace']} THEN {X.chars_dense(d, t)} ELSE {X.chars(d, t)} END >= {a['min_chars']})",
)
register("must_list_n_subpoints", {"n": INT}, build=lambda d, t, a: f"({d.count(t, X.lines(d, X.SUBPOINT))} >= {a['n']})")
register("has_sections", {"sections": LIST}, build=_substrings("sections"))
register("require_sections", {"sections": LIST}, build=_substrings("sections"))
register("min_numbered_items", {"n": INT}, build=lambda d, t, a: f"({d.count(t, X.lines(d, X.NUMBERED))} >= {a['n']})")
register("min_paragraphs", {"min_paras": INT}, build=lambda d, t, a: f"({X.paragraphs_checked(d, t)} >= {a['min_paras']})")
register("heading_levels_only", {"levels": "array<bigint>"}, build=_all_and_some(X.heading_levels, lambda d, a: d.member(a["levels"], "x")))
register("bullet_style_consistent", {"marker": TEXT}, build=_all_and_some(X.bullets, lambda d, a: f"x = {a['marker']}"))
register("decimal_places", {"places": INT}, build=_all_and_some(X.decimals, lambda d, a: f"length(x) = {a['places']}"))
register("date_format", {"style": TEXT}, build=_date)
register("must_include_keywords", {"keywords": LIST}, build=_substrings("keywords"))
register("keyword_min_frequency", {"keyword": TEXT, "min_count": INT}, build=lambda d, t, a: f"({X.occurrences(d, f'lower({t})', f'lower({a["keyword"]})')} >= {a['min_count']})")
register("must_cover_topics", {"topics": LIST}, build=_substrings("topics"))
register(
    "require_language",
    {"lang": TEXT},
    build=lambda d, t, a: f"CASE {a['lang']} WHEN 'en' THEN {X.is_english(d, t)} WHEN 'zh' THEN {d.count(t, X.HAN)} >= 10 ELSE true END",
)
register("must_end_with_template", {"template_suffix": TEXT}, build=lambda d, t, a: d.ends(f"lower({X.strip(d, t)})", f"lower({X.strip(d, a['template_suffix'])})"))
register("forbid_emojis", build=lambda d, t, a: f"NOT {d.has(t, X.EMOJI_CHECKED)}")
register("avoid_contractions", build=lambda d, t, a: f"NOT {d.has(t, X.either(X.CONTRACTIONS_CHECKED))}")
register("forbid_symbol", {"symbol": TEXT}, build=lambda d, t, a: f"NOT {d.contains(t, a['symbol'])}")
register("citation_style", {"style": TEXT}, build=_cite)
register("min_citation_markers", {"min_count": INT}, build=lambda d, t, a: f"({d.size(X.markers(d, t))} >= {a['min_count']})")
register(
    "min_distinct_citations", {"min_unique": INT}, build=lambda d, t, a: f"({d.size(d.distinct(d.map(X.markers(d, t), 'x', 'lower(x)')))} >= {a['min_unique']})"
)
register("citation_refs_from_allowed_set", {"allowed_ref_ids": LIST}, {"min_unique": (INT, "1"), "max_out_of_set": (INT, "0")}, build=_allowed)

#: Judges by the label that a text model must give; any argument is allowed.
JUDGES = {
    "tone_neutral_llm_judge": "NEUTRAL",
    "tone_negative_llm_judge": "YES",
    "role_consistency_judge": "MATCH",
    "actionability_judge": "YES",
    "non_extremeness_judge": "SAFE",
}
for _name in JUDGES:
    register(_name, build=None, kind="soft")


def typed(arg: str, kind: str, args: str) -> str:
    return f"try_variant_get({args}, '$.{arg}', '{kind}')"


def verdict_sql(text: str = "text", check: str = "check", args: str = "args", judged: str = "false", aliases: bool = False) -> str:
    """Spark SQL of the verdict; args is a VARIANT column, judged the SQL of the judges' verdict.

    aliases: repair rules whose producers call the item count min_items.
    """
    cases = []
    keys = f"coalesce(map_keys(try_variant_get({args}, '$', 'map<string,variant>')), array())"
    for name, c in REGISTRY.items():
        if c.kind == "soft":
            cases.append(f"WHEN '{name}' THEN {judged}")
            continue
        alias = aliases and "n" in c.required
        known = [*c.required, *c.optional, *(["min_items"] if alias else [])]
        values = {k: typed(k, kind, args) for k, kind in c.required.items()}
        if alias:
            values["n"] = f"coalesce({values['n']}, {typed('min_items', 'bigint', args)})"
        values |= {k: f"IF(array_contains({keys}, '{k}'), {typed(k, kind, args)}, {default})" for k, (kind, default) in c.optional.items()}
        fine = [f"size(array_except({keys}, array({', '.join(repr(k) for k in known) or ''}))) = 0"] if known else [f"size({keys}) = 0"]
        fine += [f"{v} IS NOT NULL" for v in values.values()]
        cases.append(f"WHEN '{name}' THEN coalesce({' AND '.join(fine)} AND {c.build(SPARK, text, values)}, false)")
    return f"CASE WHEN {text} IS NULL THEN CAST(NULL AS BOOLEAN) ELSE CASE {check} {' '.join(cases)} ELSE CAST(NULL AS BOOLEAN) END END"
