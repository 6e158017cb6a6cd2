"""What text models reply, read into typed rows: blocks, rules, branch parts, evidence maps.

Replies are VARIANTs (provider.loose_json gives them) or JSON text; everything is a column
expression but for the two window operators at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rulegrove.functions import text as X
from rulegrove.functions.dialect import SPARK as D

BLOCKS = "array<struct<block_id:string,intent:string,text_span:string,order_index:int>>"
RULES = "array<struct<cid:string,desc:string,scope:string,verifier_spec:struct<check:string,args:string>>>"


def without_reasoning(text: str) -> Column:
    """Text after the first </think>, its leading blanks gone; all of it if there is none."""
    at = f"instr({text}, '</think>')"
    return F.expr(f"IF({at} > 0, {D.replace_all(f'substring({text}, {at} + 8)', '^' + X.SPACE + '+', '')}, {text})")


def had_reasoning(text: str) -> Column:
    return F.coalesce(F.col(text).contains("</think>"), F.lit(False))


def widest_object(text: str) -> Column:
    """From the first { to the last }; the text itself if there is no such stretch."""
    return F.expr(f"coalesce(nullif(regexp_extract({text}, '(?s)[{{].*[}}]', 0), ''), {text})")


def _kind(v: str, kind: str) -> str:
    return f"startswith(coalesce(schema_of_variant({v}), ''), '{kind}')"


def _items(v: str) -> str:
    return f"IF({_kind(v, 'ARRAY')}, CAST({v} AS array<variant>), CAST(array() AS array<variant>))"


def _get(v: str, path: str, kind: str = "string") -> str:
    return f"try_variant_get({v}, '$.{path}', '{kind}')"


def blocks_of(parsed: str) -> Column:
    """Blocks of a reply: an object's `blocks`, or a bare list; anything else gives none.

    What is no object is left out; a missing order_index is the place in the list.
    """
    own = f"IF({_kind(parsed, 'OBJECT')}, {_items(_get(parsed, 'blocks', 'variant'))}, {_items(parsed)})"
    placed = f"transform({own}, (b, i) -> named_struct('b', b, 'i', i))"
    row = f"named_struct('block_id', {_get('x.b', 'block_id')}, 'intent', {_get('x.b', 'intent')}, 'text_span', {_get('x.b', 'text_span')}, 'order_index', coalesce({_get('x.b', 'order_index', 'int')}, x.i))"
    return F.expr(f"CAST(transform(filter({placed}, x -> {_kind('x.b', 'OBJECT')}), x -> {row}) AS {BLOCKS})")


def order_of(parsed: str) -> Column:
    """An object's `order`; the blocks' ids where it is no list or the reply is a bare list."""
    ids = "transform(_b, b -> b.block_id)"
    listed = f"IF({_kind(parsed, 'OBJECT')} AND {_kind(_get(parsed, 'order', 'variant'), 'ARRAY')}, transform({_items(_get(parsed, 'order', 'variant'))}, x -> CAST(x AS string)), {ids})"
    missing = f"{_kind(parsed, 'OBJECT')} AND {_get(parsed, 'order', 'variant')} IS NULL"
    return F.expr(f"IF({missing}, CAST(array() AS array<string>), {listed})")


def segmentation(replies: DataFrame, parsed: str) -> DataFrame:
    """replies with `blocks` and `order`."""
    return replies.withColumn("_b", blocks_of(parsed)).withColumn("order", order_of(parsed)).withColumnRenamed("_b", "blocks")


def rules_of(parsed: str) -> Column:
    """Rules of a reply: the first of its lists `constraints`, `global_constraints`, `block_constraints`,
    a bare list, or the object itself as the one rule.

    desc may be called description and verifier_spec verifier; rules without an id are AUTO_C0,
    AUTO_C1, ... in their order.
    """
    lists = " ".join(f"WHEN {_kind(_get(parsed, k, 'variant'), 'ARRAY')} THEN {_items(_get(parsed, k, 'variant'))}" for k in ("constraints", "global_constraints", "block_constraints"))
    own = f"CASE WHEN {_kind(parsed, 'ARRAY')} THEN {_items(parsed)} WHEN NOT {_kind(parsed, 'OBJECT')} THEN CAST(array() AS array<variant>) {lists} ELSE array({parsed}) END"
    cid = f"nullif({_get('x', 'cid')}, '')"
    spec = lambda k, part: f"{_get('x', k + '.' + part, 'variant' if part == 'args' else 'string')}"
    either = lambda part: f"coalesce({spec('verifier_spec', part)}, IF({spec('verifier_spec', 'check')} IS NULL, {spec('verifier', part)}, NULL))"
    row = (
        f"named_struct('cid', {cid}, 'desc', coalesce(nullif({_get('x', 'desc')}, ''), {_get('x', 'description')}, ''), 'scope', coalesce({_get('x', 'scope')}, 'local'),"
        f" 'verifier_spec', named_struct('check', {either('check')}, 'args', coalesce(to_json({either('args')}), '{{}}')))"
    )
    told = f"transform(filter({own}, x -> {_kind('x', 'OBJECT')}), x -> {row})"
    auto = "concat('AUTO_C', size(filter(slice(_r, 1, i + 1), y -> y.cid IS NULL)) - 1)"
    named = f"transform(_r, (x, i) -> named_struct('cid', coalesce(x.cid, {auto}), 'desc', x.desc, 'scope', x.scope, 'verifier_spec', x.verifier_spec))"
    return F.expr(f"CAST(transform(array({told}), _r -> {named})[0] AS {RULES})")


def block_reply(replies: DataFrame, parsed: str) -> DataFrame:
    """replies of the block step with `logic` (AND if not said) and `rules`; no object gives neither."""
    fine = F.expr(_kind(parsed, "OBJECT"))
    rules = rules_of("parse_json(to_json(named_struct('constraints', coalesce(" + _get(parsed, "constraints", "variant") + ", parse_json('[]')))))")
    return replies.withColumn("logic", F.when(fine, F.expr(f"coalesce({_get(parsed, 'logic')}, 'AND')"))).withColumn("rules", F.when(fine, rules))


def branch_reply(replies: DataFrame, parsed: str) -> DataFrame:
    """replies of the branch step with condition, merge_point, truncated and `rules` that name a check."""
    rules = rules_of("parse_json(to_json(named_struct('constraints', coalesce(" + _get(parsed, "alt_constraints", "variant") + ", parse_json('[]')))))")
    out = replies.withColumn("condition", F.expr(f"coalesce({_get(parsed, 'condition')}, 'If an alternative stance applies')"))
    out = out.withColumn("merge_point", F.expr(_get(parsed, "merge_point"))).withColumn("truncated", F.expr(f"coalesce({_get(parsed, 'truncated', 'boolean')}, false)"))
    return out.withColumn("rules", F.filter(rules, lambda r: (F.trim(r["desc"]) != "") & (F.coalesce(r["verifier_spec"]["check"], F.lit("")) != "")))


# Checks that a model may name, and what other names mean, with the argument they imply.
KNOWN = (
    "tone_neutral_llm_judge", "tone_negative_llm_judge", "non_extremeness_judge", "role_consistency_judge", "actionability_judge", "forbid_first_person", "min_word_count", "must_list_n_subpoints",
    "min_numbered_items", "must_include_keywords", "keyword_min_frequency", "must_cover_topics", "min_char_count", "require_language", "has_sections", "must_end_with_template",
)
SYNONYMS = {
    "must_present_two_examples": ("must_list_n_subpoints", 2),
    "must_present_three_examples": ("must_list_n_subpoints", 3),
    "must_list_two_items": ("must_list_n_subpoints", 2),
    "must_use_numbered_list": ("min_numbered_items", 2),
}


def mapped_check(check: str = "check", args: str = "args") -> Column:
    """struct(check, args, is_custom): known checks as they are, synonyms by their meaning, others as custom:<name>."""
    names = ", ".join(f"'{c}'" for c in KNOWN)
    meant = " ".join(f"WHEN '{a}' THEN '{b}'" for a, (b, _) in SYNONYMS.items())
    least = " ".join(f"WHEN '{a}' THEN {n}" for a, (_, n) in SYNONYMS.items())
    plain = f"coalesce(nullif(trim({args}), ''), '{{}}')"
    others = f"map_filter(coalesce(from_json({plain}, 'map<string,variant>'), CAST(map() AS map<string,variant>)), (k, v) -> k <> 'min_items')"
    patched = f"to_json(map_concat({others}, map('min_items', parse_json(CAST(CASE {check} {least} END AS string)))))"
    synonyms = ", ".join(f"'{c}'" for c in SYNONYMS)
    return F.expr(
        f"CASE WHEN {check} IN ({names}) THEN named_struct('check', {check}, 'args', {plain}, 'is_custom', false)"
        f" WHEN {check} IN ({synonyms}) THEN named_struct('check', CASE {check} {meant} END, 'args', {patched}, 'is_custom', false)"
        f" ELSE named_struct('check', concat('custom:', coalesce({check}, '')), 'args', {plain}, 'is_custom', true) END"
    )


def distinct_capped(rules: DataFrame, *keys: str, pos: str = "pos", cap: int = 5) -> DataFrame:
    """rules(keys, pos, descr, evidence_str, is_custom): the first of each wording, then the best `cap`.

    Wordings are compared without case and punctuation. Programmatic checks come first, then rules
    with evidence, then longer ones, then earlier ones. Rules without a wording go.
    """
    norm = F.trim(F.regexp_replace(F.regexp_replace(F.lower("descr"), "[^a-z0-9\\s]", " "), "\\s+", " "))
    once = Window.partitionBy(*keys, "_norm").orderBy(pos)
    best = Window.partitionBy(*keys).orderBy("is_custom", F.coalesce(F.col("evidence_str"), F.lit("")) == "", F.desc(F.length("descr")), pos)
    told = rules.filter(F.coalesce("descr", F.lit("")) != "").withColumn("_norm", norm)
    first = told.withColumn("_n", F.row_number().over(once)).filter("_n = 1")
    return first.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= cap).drop("_n", "_norm")


def listed(value: str) -> Column:
    """A VARIANT that is null, one text or a list as its trimmed, non-empty texts."""
    texts = f"CASE WHEN {_kind(value, 'ARRAY')} THEN transform({_items(value)}, x -> CAST(x AS string)) WHEN {_kind(value, 'STRING')} THEN array(CAST({value} AS string)) ELSE CAST(array() AS array<string>) END"
    return F.expr(f"filter(transform({texts}, x -> trim(x)), x -> x <> '')")


REFERENCE = "struct<title:string,doi:string,pdfUrl:string,citationCount:int>"


def evidence_refs(rows: DataFrame, column: str, *keys: str, described: bool = False) -> DataFrame:
    """(keys, ref_id, title, doi, pdfUrl, citationCount) of evidence JSON: its `references`, or a bare map.

    described: only references that have a title, a DOI or a link.
    """
    own = F.expr(f"coalesce(from_json(get_json_object({column}, '$.references'), 'map<string,{REFERENCE}>'), from_json({column}, 'map<string,{REFERENCE}>'))")
    out = rows.select(*keys, F.explode(own).alias("ref_id", "r")).filter("r IS NOT NULL").select(*keys, F.trim("ref_id").alias("ref_id"), "r.*")
    some = " OR ".join(f"coalesce(trim({c}), '') <> ''" for c in ("title", "doi", "pdfUrl"))
    return out.filter(f"ref_id <> ''{f' AND ({some})' if described else ''}")


def outline(blocks: DataFrame, most: int = 12, longest: int = 200) -> DataFrame:
    """(sample_id, outline): the first blocks by order as lines `id (intent)`, long intents clipped."""
    intent = F.expr(f"coalesce(nullif({X.normalised(D, 'intent')}, ''), '?')")
    short = F.when(F.length("_t") > longest, F.concat(F.rtrim(F.substring("_t", 1, longest)), F.lit(" ..."))).otherwise(F.col("_t"))
    line = blocks.withColumn("_t", intent).withColumn("_l", F.concat(F.coalesce("block_id", F.lit("?")), F.lit(" ("), short, F.lit(")")))
    rows = line.groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("order_index", F.lit(0)).alias("o"), "block_id", "_l"))).alias("x"))
    return rows.select("sample_id", F.expr(f"array_join(transform(slice(x, 1, {most}), y -> y._l), '\\n')").alias("outline"))


#: Words of which a structured text has one of each group among its intents.
STRUCTURE = (("opening", "intro", "context", "background"), ("analysis", "discussion", "main", "argument", "evaluation"), ("conclusion", "summary", "outlook", "recommendation"))


def structured(blocks: str = "block_specs") -> Column:
    """Whether a block array has an opening, a body and a conclusion by its intents."""
    return F.expr(" AND ".join(f"exists({blocks}, b -> regexp_like(lower(coalesce(b.intent, '')), '{'|'.join(words)}'))" for words in STRUCTURE))


def rules_as_lines(nodes: str = "constraints") -> Column:
    """Rules as one JSON object a line, the form in which a model is shown them."""
    one = "to_json(named_struct('cid', n.cid, 'desc', n.desc, 'verifier', named_struct('check', n.verifier_spec.check, 'args', parse_json(coalesce(n.verifier_spec.args, '{}')))))"
    return F.expr(f"array_join(transform({nodes}, n -> {one}), '\\n')")
