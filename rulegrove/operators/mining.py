"""Rules mined from texts: guarded candidates per text or block, then a seeded sample of them.

A candidate is struct(pos, check, args, descr) with args as JSON text. All guards are expressions
over one row; only the keyword counts need a grouping, on (text, token), which is pre-aggregated
where the text is read. Draws are ordered by MD5 of seed, text and check, so they repeat anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rulegrove.functions import text as X
from rulegrove.functions.dialect import SPARK

SEED = 7
SAMPLE = (3, 5)
KEYWORDS = 3


def record(d, *fields: tuple[str, str]) -> str:
    if d.name == "spark":
        return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields) + ")"
    return "{" + ", ".join(f"'{k}': {v}" for k, v in fields) + "}"


def _text(v: str) -> str:
    return f"CAST({v} AS STRING)"


def _json(d, **values) -> str:
    parts = []
    for i, (k, v) in enumerate(values.items()):
        parts.append(d.lit(("{" if i == 0 else ", ") + f'"{k}": '))
        parts.append(_text(v))
    return f"concat({', '.join(parts)}, '}}')" if parts else "'{}'"


def _phrase(d, before: str, value: str | None = None, after: str = "") -> str:
    return d.lit(before) if value is None else f"concat({d.lit(before)}, {_text(value)}, {d.lit(after)})"


def mode_of(d, xs: str, least: int, share: float | None) -> str:
    """Most frequent item of a list of numbers, first seen on ties; null unless it is frequent enough."""
    if d.name == "spark":
        count = "size(filter(xs, z -> z = y))"
        best = f"aggregate(array_distinct(xs), named_struct('v', CAST(NULL AS BIGINT), 'n', 0), (a, y) -> IF({count} > a.n, named_struct('v', y, 'n', {count}), a))"
        need = f"greatest({least}, CAST(floor({share} * size(xs)) AS INT))" if share else str(least)
        return f"transform(array({xs}), xs -> transform(array({best}), b -> IF(size(xs) >= {least} AND b.n >= {need}, b.v, CAST(NULL AS BIGINT)))[0])[0]"
    need = f"greatest({least}, floor({share} * len({xs})))" if share else str(least)
    per = f"list_transform(list_filter({xs}, lambda y, i: list_position({xs}, y) = i), lambda y: {{'v': y, 'n': len(list_filter({xs}, lambda z: z = y))}})"
    best = f"list_reduce({per}, lambda a, b: CASE WHEN b.n > a.n THEN b ELSE a END)"
    return f"CASE WHEN len({xs}) >= {least} AND ({best}).n >= {need} THEN ({best}).v END"


def _lengths(d, t):
    return d.map(X.decimals(d, t), "x", "CAST(length(x) AS BIGINT)")


def features(d, t: str = "text") -> dict[str, str]:
    """What the global guards look at."""
    low = f"lower({t})"
    num, who = d.has(t, X.NUMERIC_CITE_MINED), d.has(t, X.AUTHOR_CITE_MINED)
    levels = f"array_sort({d.distinct(X.heading_levels(d, t))})" if d.name == "spark" else f"list_sort({d.distinct(X.heading_levels(d, t))})"
    return {
        "wc": X.words_mined(d, t),
        "lang_": X.language(d, t),
        "contractions": d.count(t, X.either(X.CONTRACTIONS_MINED)),
        "paras": X.paragraphs_mined(d, t),
        "levels": levels,
        "bullet": d.item(d.all(t, X.lines(d, X.BULLET_MINED), 1), 1),
        "places": mode_of(d, _lengths(d, t), 3, 0.6),
        "dates": f"CASE WHEN {d.has(t, X.ISO_DATE)} THEN 'yyyy-mm-dd' WHEN {d.has(t, X.LONG_DATE)} THEN 'mon dd, yyyy' END",
        "first_person": "(" + " OR ".join(d.contains(low, repr(w)) for w in (" i ", " we ", " my ", " our ")) + ")",
        "emoji": d.has(t, X.EMOJI_MINED),
        "symbol": X.forbidden_symbol(d, t),
        "cite": f"CASE WHEN {num} AND NOT {who} THEN 'numeric' WHEN {who} AND NOT {num} THEN 'author_year' END",
    }


def bounds(d) -> dict[str, str]:
    """Word limits from wc."""
    low = "greatest(100, CAST(floor(wc * 0.85) AS BIGINT))"
    high = f"greatest({low} + 10, CAST(floor(wc * 1.20) AS BIGINT))"
    up = lambda v: f"CAST(ceil({v} / 10.0) * 10 AS BIGINT)"
    least = up(low)
    return {"least": least, "most": f"CASE WHEN {up(high)} <= {least} THEN {least} + 10 ELSE {up(high)} END", "centre": "CAST(floor((greatest(1, wc) + 5) / 10.0) * 10 AS BIGINT)"}


def global_candidates(d, kws: str = "kws") -> str:
    """SQL array of candidates, in order, from features, bounds and the keyword list (null or empty: none)."""
    listed = lambda quote: d.join(d.map(kws, "x", f"concat('\"', x, '\"')"), ", ")  # noqa: E731, ARG005
    levels = f"concat('[', {d.join(d.map('levels', 'x', _text('x')), ', ')}, ']')"
    q = lambda v: f"concat('\"', {v}, '\"')"
    both = f"concat('Keep the answer length between ', {_text('least')}, ' and ', {_text('most')}, ' words.')"
    rules = [
        ("wc > 0", "word_count_between", _json(d, min_words="least", max_words="most"), both),
        ("wc > 0", "word_count_around", _json(d, center="centre", tolerance_pct="'0.15'"), _phrase(d, "Keep the answer length around ", "centre", " words (±15%).")),
        ("wc > 0", "min_word_count", _json(d, min_words="least"), _phrase(d, "The answer must be at least ", "least", " words long.")),
        ("wc > 0", "max_word_count", _json(d, max_words="most"), _phrase(d, "Keep the answer under ", "most", " words.")),
        ("true", "require_language", _json(d, lang=q("lang_")), "CASE WHEN lang_ = 'zh' THEN 'The answer must be written primarily in Chinese.' ELSE 'The answer must be written primarily in English.' END"),
        ("lang_ = 'en' AND contractions = 0", "avoid_contractions", "'{}'", _phrase(d, "Avoid contractions (use 'do not' instead of 'don't').")),
        ("paras >= 3", "min_paragraphs", _json(d, min_paras="paras"), _phrase(d, "Organize the answer into at least ", "paras", " paragraphs.")),
        (f"{d.size('levels')} > 0", "heading_levels_only", _json(d, levels=levels), _phrase(d, "Use consistent Markdown heading levels: only ", levels, ".")),
        ("bullet IS NOT NULL", "bullet_style_consistent", _json(d, marker=q("bullet")), _phrase(d, "Use a consistent list marker style ('", "bullet", "'); do not mix list markers.")),
        ("places IS NOT NULL", "decimal_places", _json(d, places="places"), _phrase(d, "Keep numeric values to ", "places", " decimal places consistently.")),
        ("dates IS NOT NULL", "date_format", _json(d, style=q("dates")), "CASE WHEN dates = 'yyyy-mm-dd' THEN 'Use the date format YYYY-MM-DD.' ELSE " + d.lit("Use the date format 'Month DD, YYYY'.") + " END"),
        ("NOT first_person", "forbid_first_person", "'{}'", _phrase(d, "Maintain an objective, third-person analytic voice; do not use first-person pronouns.")),
        ("NOT emoji", "forbid_emojis", "'{}'", _phrase(d, "Do not use emojis or decorative unicode symbols.")),
        ("symbol IS NOT NULL", "forbid_symbol", _json(d, symbol=q("symbol")), _phrase(d, "Do not use the symbol '", "symbol", "'.")),
        (f"lang_ = 'en' AND {d.size(kws)} > 0", "must_include_keywords", _json(d, keywords=f"concat('[', {listed(0)}, ']')"), _phrase(d, "Include the following keywords: ", listed(0), ".")),
        ("cite IS NOT NULL", "citation_style", _json(d, style=q("cite")), "CASE WHEN cite = 'numeric' THEN 'Use numeric bracket citations like [1], [2].' ELSE 'Use author-year citations like (Smith, 2021).' END"),
    ]
    return _guarded(d, rules)


def _guarded(d, rules) -> str:
    items = [
        f"CASE WHEN {guard} THEN {record(d, ('pos', f'CAST({i} AS BIGINT)'), ('check', d.lit(check)), ('args', args), ('descr', descr))} END" for i, (guard, check, args, descr) in enumerate(rules)
    ]
    return d.keep(d.array(*items), "c", "c IS NOT NULL")


def top_keywords(docs: DataFrame, key: str, text: str = "text", k: int = KEYWORDS) -> DataFrame:
    """(key, kws): the k most frequent tokens of over three letters that are no stopwords, first seen on ties."""
    tokens = docs.select(key, F.posexplode(F.expr(SPARK.all(f"lower({text})", X.TOKEN_MINED))).alias("at", "raw"))
    word = F.regexp_replace(F.regexp_replace("raw", "^'+|'+$", ""), "^-+|-+$", "")
    kept = tokens.select(key, "at", word.alias("w")).filter((F.length("w") > 3) & ~F.col("w").isin(X.STOPWORDS))
    counts = kept.groupBy(key, "w").agg(F.count("*").alias("n"), F.min("at").alias("at"))
    best = Window.partitionBy(key).orderBy(F.desc("n"), "at")
    top = counts.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k)
    return top.groupBy(key).agg(F.expr("transform(array_sort(collect_list(struct(r, w))), x -> x.w)").alias("kws"))


def mine_global(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, pos, check, args, descr) of every candidate."""
    base = docs.select(key, F.col(text).alias("text"))
    facts = base.select(key, *[F.expr(v).alias(k) for k, v in features(SPARK).items()])
    facts = facts.select("*", *[F.expr(v).alias(k) for k, v in bounds(SPARK).items()])
    joined = facts.join(top_keywords(base, key), key, "left").withColumn("kws", F.coalesce("kws", F.array().cast("array<string>")))
    return joined.select(key, F.explode(F.expr(global_candidates(SPARK))).alias("c")).select(key, "c.*")


def uniform(*parts: str) -> str:
    return SPARK.uniform("concat(" + ", ".join(parts) + ")")


def sample_global(candidates: DataFrame, key: str, seed: int = SEED, sizes: tuple[int, int] = SAMPLE) -> DataFrame:
    """A seeded draw of sizes[0]..sizes[1] candidates per text, numbered G1.. in drawn order."""
    low, high = sizes
    target = F.expr(f"{low} + CAST(floor({uniform(repr(str(seed)), repr(':'), key, repr(':size'))} * {high - low + 1}) AS INT)")
    order = Window.partitionBy(key).orderBy(F.expr(f"md5(concat('{seed}:', {key}, ':hard:', check))"))
    ranked = candidates.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= target)
    return ranked.select(key, F.concat(F.lit("G"), "r").alias("cid"), "check", "args", "descr")


def block_features(d, t: str = "text_span") -> dict[str, str]:
    marks = d.all(t, X.lines(d, r"^\s*([-*])\s+\S"), 1)
    dash, star = d.size(d.keep(marks, "x", "x = '-'")), d.size(d.keep(marks, "x", "x = '*'"))
    return {
        "least": f"CAST(floor((greatest(30, floor({X.words_mined(d, t)} * 0.6)) + 9) / 10.0) * 10 AS BIGINT)",
        "numbered": d.count(t, X.NUMBERED_MINED),
        "paras": X.paragraphs_mined(d, t, strip_first=False),
        "n_bullets": d.size(marks),
        "bullet": f"CASE WHEN {dash} > {star} THEN '-' WHEN {star} > {dash} THEN '*' ELSE {d.item(marks, 1)} END",
        "places": mode_of(d, _lengths(d, t), 2, None),
    }


def block_candidates(d) -> str:
    """Fallback rules first (one of them judged), then what the block's text shows."""
    q = "concat('\"', bullet, '\"')"
    rules = [
        ("true", "tone_neutral_llm_judge", "'{}'", _phrase(d, "Maintain a neutral, analytical tone without emotional or inflammatory language.")),
        ("numbered >= 2", "min_numbered_items", _json(d, min_items="numbered"), _phrase(d, "Provide a numbered list with at least ", "numbered", " items.")),
        ("numbered < 2", "min_word_count", _json(d, min_words="least"), _phrase(d, "Provide a sufficiently detailed explanation with at least ", "least", " words.")),
        ("true", "min_word_count", _json(d, min_words="least"), _phrase(d, "Provide a sufficiently detailed explanation in this block with at least ", "least", " words.")),
        ("numbered >= 2", "min_numbered_items", _json(d, min_items="numbered"), _phrase(d, "Provide a numbered list in this block with at least ", "numbered", " items.")),
        ("paras >= 2", "min_paragraphs", _json(d, min_paras="paras"), _phrase(d, "Organize this block into at least ", "paras", " logical paragraphs.")),
        ("n_bullets >= 2", "bullet_style_consistent", _json(d, marker=q), _phrase(d, "Use a consistent bullet style '", "bullet", "' for list items in this block.")),
        ("n_bullets >= 2", "must_list_n_subpoints", _json(d, min_items="n_bullets"), _phrase(d, "Provide a bulleted list in this block with at least ", "n_bullets", " items.")),
        ("places > 0", "decimal_places", _json(d, places="places"), _phrase(d, "Keep numerical values in this block to ", "places", " decimal places consistently.")),
    ]
    return _guarded(d, rules)


HARD_BLOCK = ("min_word_count", "min_paragraphs", "bullet_style_consistent", "decimal_places", "min_numbered_items", "must_list_n_subpoints")
MOST_PER_BLOCK = 5


def mine_blocks(blocks: DataFrame, key: str) -> DataFrame:
    """(key, block_id, pos, check, args, descr) of every candidate of blocks(key, block_id, text_span)."""
    facts = blocks.select(key, "block_id", *[F.expr(v).alias(k) for k, v in block_features(SPARK).items()])
    return facts.select(key, "block_id", F.explode(F.expr(block_candidates(SPARK))).alias("c")).select(key, "block_id", "c.*")


def sample_blocks(candidates: DataFrame, key: str, seed: int = SEED) -> DataFrame:
    """Seeded draw of 1 to MOST_PER_BLOCK rules a block: some hard ones, then soft, then left-over hard ones."""
    hard = F.col("check").isin(*HARD_BLOCK)
    unit = Window.partitionBy(key, "block_id")
    tag = lambda what: F.expr(uniform(repr(f"{seed}:"), key, repr(":"), "block_id", repr(f":{what}")))
    own = Window.partitionBy(key, "block_id", "hard").orderBy(F.expr(f"md5(concat('{seed}:', {key}, ':', block_id, ':', pos))"))
    ranked = (
        candidates.withColumn("hard", hard)
        .withColumn("n_hard", F.count_if(hard).over(unit))
        .withColumn("n_soft", F.count_if(~hard).over(unit))
        .withColumn("r", F.row_number().over(own))
        .withColumn("total", 1 + F.floor(tag("total") * F.least(F.lit(MOST_PER_BLOCK), F.col("n_hard") + F.col("n_soft"))))
        .withColumn("pick", F.floor(tag("hard") * (F.least("n_hard", "total") + 1)))
    )
    more = F.greatest(F.lit(0), F.col("total") - F.col("pick") - F.col("n_soft"))
    kept = ranked.filter((F.col("hard") & (F.col("r") <= F.col("pick") + more)) | (~F.col("hard") & (F.col("r") <= F.col("total") - F.col("pick"))))
    phase = F.when(~F.col("hard"), 1).when(F.col("r") <= F.col("pick"), 0).otherwise(2)
    number = F.row_number().over(unit.orderBy(phase, "r"))
    return kept.select(key, "block_id", F.concat("block_id", F.lit("_C"), number).alias("cid"), "check", "args", "descr")


def evidence_bounds(d, n: str = "n") -> dict[str, str]:
    """Least distinct sources and markers from the number of references; halves round to even."""
    even = "bround" if d.name == "spark" else "round_even"
    at = lambda share: f"CAST({even}({n} * CAST({share} AS DOUBLE), 0) AS BIGINT)"
    unique = f"greatest(1, least({n}, greatest(3, least(12, {at(0.12)}))))"
    return {"min_unique": f"CAST({unique} AS BIGINT)", "min_markers": f"CAST(greatest({unique}, least(30, greatest(4, {at(0.2)}))) AS BIGINT)"}


