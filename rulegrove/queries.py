"""The registered queries of the rule engine, each with DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rulegrove.functions import checks
from rulegrove.functions import text as X
from rulegrove.functions.dialect import DUCK, SPARK
from rulegrove.operators import scoring
from rulegrove.sources.files import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The documents' columns, over all cores."""
    return spread(table(spark, sf_dir, "documents").select(*columns))


#: Texts that exercise what the documents lack; they are scored beside them under negative ids.
FIXTURES = [
    "",
    "   \n\t ",
    "# Title\n\nIntro text here.\n\n## Part\n- one\n- two\n\n1. first\n2) second\n\nDone.",
    "* star\n- dash\nWe like it: I do, don't you?",
    "Value 1.25 and 2.50 and 3.75 on 2024-01-02.",
    "Value 1.2 and 2.55 on March 14, 2024 and Jan 3, 2020",
    "As shown [1], [2, 3] and [4-6] again [1].",
    "As shown (Lee et al., 2020) and (Smith, 2021a).",
    "Refs [b12] and [B3] with [b12] and [x_9].",
    "Mixed [1] (Lee, 2020) [b2].",
    "Emoji ❗ and pasta \U0001F35D",
    "caféus ié us",
    "If the plan is good, we go. The end",
    "keyword Keyword KEYWORD key",
    "The results are fine; they should hold; all must agree.\nFirst do this, then that.",
    "一二三四五六七八九十百千万亿甲乙丙丁戊己庚辛壬癸天地玄黄",
    "a\r\nb\r\n\r\n\r\nc    d\te",
    "Please, could you please write a poem about x.",
    "half ½ x² 三",
]


def fixture_rows(d) -> str:
    rows = ", ".join(f"({-1 - i}, {d.lit(t)})" for i, t in enumerate(FIXTURES))
    return f"SELECT CAST(doc_id AS BIGINT) AS doc_id, text FROM (VALUES {rows}) AS f(doc_id, text)"


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir, "doc_id", "text").unionByName(spark.sql(fixture_rows(SPARK)))


TEXTS_SQL = f"(SELECT doc_id, text FROM documents UNION ALL {fixture_rows(DUCK)})"


def per_text(name: str, **columns) -> None:
    """A query of expressions over every text, written once for both dialects."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return texts(spark, sf_dir).select("doc_id", *[F.expr(build(SPARK, "text")).alias(c) for c, build in columns.items()])

    QUERIES[name] = run
    SQL[name] = f"SELECT doc_id, {', '.join(f'{build(DUCK, "text")} AS {c}' for c, build in columns.items())} FROM {TEXTS_SQL} t"


per_text(
    "text_features",
    n_words=X.words,
    n_words_mined=X.words_mined,
    n_chars=X.chars,
    n_chars_dense=X.chars_dense,
    n_han=lambda d, t: d.count(t, X.HAN),
    n_paragraphs=X.paragraphs_checked,
    n_markers=lambda d, t: d.size(X.markers(d, t)),
    n_cited=lambda d, t: d.size(X.cited(d, t)),
    language=X.language,
)
per_text("whitespace_normalize", normalised=lambda d, t: f"md5({X.normalised(d, t)})", squeezed=lambda d, t: f"md5({X.squeezed(d, t)})")
per_text("clip", hard=lambda d, t: f"md5({X.clipped(d, t, 40)})", dots=lambda d, t: X.clipped_dots(d, t, 30), none=lambda d, t: X.clipped(d, t, 0))
per_text("slugify", slug=lambda d, t: f"md5({X.slug(d, t)})")
per_text("negate_condition", statement=lambda d, t: f"md5({X.condition(d, t)})", negated=lambda d, t: f"md5({X.negated(d, t)})")
per_text("polite_prefix", cleaned=lambda d, t: f"md5({X.polite(d, t)})")
per_text("first_sentence", sentence=X.first_sentence)
per_text("seed_task_fallback", seed=lambda d, t: X.imperative(d, X.polite(d, X.first_sentence(d, t))))
per_text("block_logic", logic=X.logic)
per_text(
    "text_detectors",
    n_contractions=lambda d, t: d.count(t, X.either(X.CONTRACTIONS_MINED)),
    has_emoji=lambda d, t: d.has(t, X.EMOJI_MINED),
    iso_date=lambda d, t: d.has(t, X.ISO_DATE),
    long_date=lambda d, t: d.has(t, X.LONG_DATE),
    numeric_cite=lambda d, t: d.has(t, X.NUMERIC_CITE_MINED),
    author_cite=lambda d, t: d.has(t, X.AUTHOR_CITE_MINED),
    symbol=X.forbidden_symbol,
    n_numbered=lambda d, t: d.count(t, X.lines(d, X.NUMBERED)),
    n_subpoints=lambda d, t: d.count(t, X.lines(d, X.SUBPOINT)),
)
per_text(
    "rounding",
    up=lambda d, t: f"CAST(ceil(greatest({X.words(d, t)}, 1) / 10.0) * 10 AS BIGINT)",
    nearest=lambda d, t: f"CAST(floor((greatest({X.words(d, t)}, 1) + 5) / 10.0) * 10 AS BIGINT)",
    block_min=lambda d, t: f"CAST(floor((greatest(30, floor({X.words_mined(d, t)} * 0.6)) + 9) / 10.0) * 10 AS BIGINT)",
)

#: Argument values that each check is run with: JSON and SQL agree.
CHECK_ARGS: dict[str, list[dict]] = {
    "is_english": [{}],
    "forbid_first_person": [{}],
    "forbid_words": [{"banned": ["worthless", "IDIOT"]}, {"banned": []}],
    "min_word_count": [{"min_words": 200}],
    "max_word_count": [{"max_words": 300}],
    "word_count_between": [{"min_words": 100, "max_words": 400}],
    "word_count_around": [{"center": 250}, {"center": 250, "tolerance_pct": 0.4}],
    "min_char_count": [{"min_chars": 900}, {"min_chars": 900, "ignore_whitespace": True}],
    "must_list_n_subpoints": [{"n": 2}],
    "has_sections": [{"sections": ["the", "of"]}],
    "require_sections": [{"sections": ["Title", "PART"]}],
    "min_numbered_items": [{"n": 2}],
    "min_paragraphs": [{"min_paras": 2}],
    "heading_levels_only": [{"levels": [1, 2]}, {"levels": [1]}],
    "bullet_style_consistent": [{"marker": "-"}],
    "decimal_places": [{"places": 2}],
    "date_format": [{"style": "yyyy-mm-dd"}, {"style": "mon dd, yyyy"}, {"style": "other"}],
    "must_include_keywords": [{"keywords": ["the", "Result"]}, {"keywords": []}],
    "keyword_min_frequency": [{"keyword": "the", "min_count": 5}, {"keyword": "", "min_count": 5}],
    "must_cover_topics": [{"topics": ["poem"]}],
    "require_language": [{"lang": "en"}, {"lang": "zh"}, {"lang": "de"}],
    "must_end_with_template": [{"template_suffix": " The End "}],
    "forbid_emojis": [{}],
    "avoid_contractions": [{}],
    "forbid_symbol": [{"symbol": ":"}],
    "citation_style": [{"style": "numeric"}, {"style": "author_year"}, {"style": "ref_id"}],
    "min_citation_markers": [{"min_count": 3}],
    "min_distinct_citations": [{"min_unique": 3}],
    "citation_refs_from_allowed_set": [{"allowed_ref_ids": ["B12", " x_9 "], "max_out_of_set": 1}, {"allowed_ref_ids": []}],
}


def value_sql(d, value) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, float)):
        return str(value) if isinstance(value, int) else f"CAST({value} AS DOUBLE)"
    if isinstance(value, list):
        kind = "BIGINT" if value and isinstance(value[0], int) else ("STRING" if d.name == "spark" else "VARCHAR")
        items = d.array(*[value_sql(d, v) for v in value])
        return f"CAST({items} AS array<{kind}>)" if d.name == "spark" else f"CAST({items} AS {kind}[])"
    return d.lit(value)


def check_sql(d, name: str, args: dict, t: str = "text") -> str:
    c = checks.REGISTRY[name]
    values = {k: value_sql(d, args[k]) for k in c.required}
    values |= {k: value_sql(d, args[k]) if k in args else (f"CAST({v} AS {kind})") for k, (kind, v) in c.optional.items()}
    return c.build(d, t, values)


for _name, _sets in CHECK_ARGS.items():
    per_text(f"check_{_name}", **{f"passed_{i}": (lambda d, t, n=_name, a=a: check_sql(d, n, a, t)) for i, a in enumerate(_sets)})


# ---- scoring -------------------------------------------------------------------------------------

#: Evaluation items applied to every document: (section, block, sid, branch, cid, check, args, priority).
ITEMS = [
    ("global", None, None, None, "G1", "min_word_count", '{"min_words": 150}', 2),
    ("global", None, None, None, "G2", "is_english", "{}", 2),
    ("global", None, None, None, "G3", "custom:style", "{}", 2),
    ("global", None, None, None, "G4", "forbid_words", '{"banned": ["worthless"]}', 1),
    ("global", None, None, None, "G5", None, "{}", 2),
    ("block", "B1", None, None, "B1_C1", "max_word_count", '{"max_words": 600}', None),
    ("block", "B1", None, None, "B1_C2", "min_numbered_items", '{"min_items": 2}', 2),
    ("block", "B2", None, None, "B2_C1", "tone_neutral_llm_judge", "{}", 1),
    ("block", "B2", None, None, "B2_C2", "forbid_symbol", '{"symbol": ":"}', 3),
    ("branch", None, "SEL_B1", "real", "B1_C1", "max_word_count", '{"max_words": "300"}', 2),
    ("branch", None, "SEL_B1", "alt", "B1_ALT_C1", "min_word_count", '{"min_words": 301.9}', 2),
    ("branch", None, "SEL_B1", "alt", "B1_ALT_C2", "avoid_contractions", "{}", 1),
    ("branch", None, "SEL_B2", "real", "B2_C1", "custom:none", "{}", 2),
    ("branch", None, "SEL_B2", "real", "B2_C2", "forbid_symbol", '{"symbol": "!"}', 1),
    ("branch", None, "SEL_B2", "alt", "B2_ALT_C1", "forbid_symbol", '{"symbol": "|"}', 1),
    ("branch", None, "SEL_B3", "real", "B3_C1", "preference_x", "{}", 2),
]
ITEM_COLUMNS = "section string, block_id string, sid string, branch string, cid string, check string, args string, priority_level int"


def document_items(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """ITEMS for each document: an array literal exploded in place, so nothing is joined."""
    rows = F.array(*[F.struct(*[F.lit(v).cast(c.split()[1]).alias(c.split()[0]) for v, c in zip(row, ITEM_COLUMNS.split(", "))], F.lit(i).alias("pos")) for i, row in enumerate(ITEMS)])
    return docs.select(F.col("doc_id").alias("sample_id"), F.explode(rows).alias("i")).select("sample_id", "i.*")


def checked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir)
    return scoring.verdicts(docs.withColumnRenamed("doc_id", "sample_id"), document_items(spark, docs))


def _item_verdict_sql(check, args) -> str:
    import json

    if check is None or check not in checks.REGISTRY:
        return "NULL::BOOLEAN"
    c, given = checks.REGISTRY[check], json.loads(args)
    if c.kind == "soft" or set(given) - {*c.required, *c.optional} or set(c.required) - set(given):
        return "false"
    return check_sql(DUCK, check, {k: int(float(v)) if c.required.get(k) == "bigint" else v for k, v in given.items()})


CHECKED_SQL = " UNION ALL ".join(
    f"SELECT doc_id AS sample_id, {', '.join('NULL' if v is None else DUCK.lit(v) for v in row[:5])}, {row[7] if row[7] is not None else 'NULL'}, {_item_verdict_sql(row[5], row[6])} FROM t" for row in ITEMS
)
CHECKED_SQL = f"WITH t AS {TEXTS_SQL}, checked(sample_id, section, block_id, sid, branch, cid, priority_level, passed) AS ({CHECKED_SQL}),"
_MAND, _BEST = "coalesce(priority_level, 2) <> 1", "priority_level = 1"
CHOICE_SQL = f"""
per AS (
  SELECT sample_id, sid, avg(passed::INT) FILTER (WHERE branch = 'real' AND {_MAND}) AS score_branch_real, avg(passed::INT) FILTER (WHERE branch = 'alt' AND {_MAND}) AS score_branch_alt,
    avg(passed::INT) FILTER (WHERE branch = 'real' AND {_BEST}) AS r, avg(passed::INT) FILTER (WHERE branch = 'alt' AND {_BEST}) AS a
  FROM checked WHERE section = 'branch' GROUP BY ALL
),
choice AS (
  SELECT sample_id, sid, score_branch_real, score_branch_alt, CASE
    WHEN coalesce(score_branch_real, score_branch_alt) IS NOT NULL THEN CASE WHEN score_branch_alt IS NULL OR score_branch_real >= score_branch_alt THEN 'branch_real' ELSE 'branch_alt' END
    WHEN coalesce(r, a) IS NOT NULL THEN CASE WHEN a IS NULL OR r >= a THEN 'branch_real' ELSE 'branch_alt' END
    ELSE 'undecided' END AS chosen
  FROM per
)"""
QUERIES["verdicts_dispatch"] = lambda spark, d: checked_documents(spark, d).select("sample_id", "section", "sid", "branch", "cid", "passed")
SQL["verdicts_dispatch"] = f"{CHECKED_SQL} x AS (SELECT 1) SELECT sample_id, section, sid, branch, cid, passed FROM checked"
QUERIES["score_branch_choice"] = lambda spark, d: scoring.branch_choice(checked_documents(spark, d))
SQL["score_branch_choice"] = f"{CHECKED_SQL} {CHOICE_SQL} SELECT * FROM choice"


def _rounded(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, *[F.round(c, 6).alias(c) for c in df.columns if c not in keys])


QUERIES["score_summary"] = lambda spark, d: _rounded(scoring.summary(checked_documents(spark, d)), "sample_id")
SQL["score_summary"] = f"""{CHECKED_SQL} {CHOICE_SQL},
counted AS (
  SELECT c.* FROM checked c LEFT JOIN choice USING (sample_id, sid)
  WHERE section <> 'branch' OR chosen = 'undecided' OR chosen = 'branch_' || branch
),
rates AS (
  SELECT sample_id, {', '.join(f"avg(passed::INT) FILTER (WHERE section = '{s}' AND {_MAND}) AS {s[0]}{s[1]}, avg(passed::INT) FILTER (WHERE section = '{s}' AND {_BEST}) AS {s[0]}{s[1]}_best" for s in ('global', 'block', 'branch'))}
  FROM counted GROUP BY sample_id
)
SELECT sample_id, round(gl, 6) AS global_pass_rate, round(bl, 6) AS block_pass_rate, round(br, 6) AS branch_pass_rate,
  round(list_avg([gl, bl, br]), 6) AS overall_pass_rate, round(list_avg([gl_best, bl_best, br_best]), 6) AS best_effort_rate
FROM rates"""


def score_by_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = checked_documents(spark, sf_dir).groupBy("section", "cid", F.coalesce("branch", F.lit("-")).alias("branch"))
    return per.agg(F.round(F.avg(F.col("passed").cast("double")), 6).alias("pass_rate"), F.count("passed").alias("n_scored"), F.count("*").alias("n_items"))


QUERIES["score_by_scope"] = score_by_scope
SQL["score_by_scope"] = f"""{CHECKED_SQL} x AS (SELECT 1) SELECT section, cid, coalesce(branch, '-') AS branch, round(avg(passed::INT), 6) AS pass_rate,
count(passed) AS n_scored, count(*) AS n_items FROM checked GROUP BY ALL"""

#: The flagship: four rules on every document, rates by language.
RULES = {"enough_words": ("min_word_count", {"min_words": 150}), "english": ("is_english", {}), "third_person": ("forbid_first_person", {}), "polite": ("forbid_words", {"banned": ["worthless"]})}


def score_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "lang", "text")
    flags = docs.select("lang", *[F.expr(check_sql(SPARK, c, a)).alias(n) for n, (c, a) in RULES.items()])
    return flags.groupBy("lang").agg(*[F.round(F.avg(F.col(n).cast("double")), 6).alias(n) for n in RULES], F.count("*").alias("n_docs"))


QUERIES["score_documents"] = score_documents
SQL["score_documents"] = (
    f"SELECT lang, {', '.join(f'round(avg(({check_sql(DUCK, c, a)})::INT), 6) AS {n}' for n, (c, a) in RULES.items())}, count(*) AS n_docs FROM documents GROUP BY lang"
)


def pass_rate_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text").join(table(spark, sf_dir, "labels"), "doc_id")
    flags = docs.select("quality", "toxic", *[F.expr(check_sql(SPARK, c, a)).alias(n) for n, (c, a) in RULES.items()])
    return flags.groupBy("quality", "toxic").agg(*[F.round(F.avg(F.col(n).cast("double")), 6).alias(n) for n in RULES], F.count("*").alias("n_docs"))


QUERIES["pass_rate_by_label"] = pass_rate_by_label
SQL["pass_rate_by_label"] = (
    f"SELECT quality, toxic, {', '.join(f'round(avg(({check_sql(DUCK, c, a)})::INT), 6) AS {n}' for n, (c, a) in RULES.items())}, count(*) AS n_docs"
    " FROM documents JOIN labels USING (doc_id) GROUP BY quality, toxic"
)

# ---- segmentation --------------------------------------------------------------------------------

from rulegrove.operators import segment as S  # noqa: E402

_STRIP = lambda x: X.strip(DUCK, x)
LINES_SQL = f"""
lines AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS n, unnest(ls) AS line
  FROM (SELECT doc_id, CASE WHEN p[len(p)] = '' THEN p[:len(p) - 1] ELSE p END AS ls FROM (SELECT doc_id, {DUCK.split('text', S.LINE_BREAK)} AS p FROM {TEXTS_SQL} t))
)"""
BULLET_SQL = f"""
classed AS (
  SELECT doc_id, n, {DUCK.replace_all('line', X.SPACE + '+$', '')} AS line,
    CASE WHEN NOT {DUCK.has('line', X.NOT_SPACE)} THEN 'z' WHEN {DUCK.has(DUCK.replace_all('line', X.SPACE + '+$', ''), S.BULLET_LINE)} THEN 'b' ELSE 't' END AS k FROM lines
),
ahead AS (
  SELECT *, last_value(nullif(k, 'z') IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m,
    lag(k) OVER (PARTITION BY doc_id ORDER BY n) AS pk FROM classed
),
grouped AS (
  SELECT *, sum(CASE WHEN (k = 'b' AND m IS DISTINCT FROM 'b') OR (k = 't' AND (m = 'b' OR pk IS NULL OR pk = 'z')) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) AS g FROM ahead
  WHERE NOT (k = 'z' AND m IS DISTINCT FROM 'b')
),
chunks AS (SELECT doc_id, g, {_STRIP("string_agg(line, chr(10) ORDER BY n)")} AS text_span FROM grouped GROUP BY doc_id, g),
paras AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY g) AS i, text_span FROM chunks WHERE text_span <> '')"""


def digest_blocks(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "block_id", "intent", F.md5("text_span").alias("span_md5"), F.col("order_index").cast("long").alias("order_index"))


QUERIES["split_bullet_groups"] = lambda spark, d: digest_blocks(S.segment(texts(spark, d), "doc_id", "paragraph"))
SQL["split_bullet_groups"] = (
    f"WITH {LINES_SQL}, {BULLET_SQL} SELECT doc_id, 'B' || i AS block_id, 'Paragraph ' || i AS intent, md5(text_span) AS span_md5, (i - 1)::BIGINT AS order_index FROM paras"
)
QUERIES["split_headings"] = lambda spark, d: digest_blocks(S.segment(texts(spark, d), "doc_id", "heading"))
SQL["split_headings"] = f"""WITH {LINES_SQL}, {BULLET_SQL},
headed AS (
  SELECT *, {DUCK.has('line', S.HEADING_LINE)} AS is_head, {_STRIP(DUCK.first('line', S.HEADING_LINE, 2))} AS h FROM lines
),
valid AS (SELECT *, is_head AND h <> '' AND NOT {DUCK.has('h', S.VISUAL)} AND {DUCK.has('h', '[A-Za-z0-9]')} AS ok FROM headed),
spans AS (SELECT *, sum(is_head::INT) OVER (PARTITION BY doc_id ORDER BY n) AS g FROM valid),
own AS (
  SELECT doc_id, g, max(CASE WHEN is_head THEN h END) AS intent, bool_or(ok) AS ok, {_STRIP("string_agg(line, chr(10) ORDER BY n)")} AS text_span FROM spans GROUP BY doc_id, g
),
kept AS (SELECT doc_id, g, coalesce(intent, 'Preamble') AS intent, text_span FROM own WHERE ok OR (g = 0 AND text_span <> '')),
numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY g) AS i, row_number() OVER (PARTITION BY doc_id, intent ORDER BY g) AS k FROM kept)
SELECT doc_id, 'B' || i AS block_id, CASE WHEN k = 1 THEN intent ELSE intent || ' (' || k || ')' END AS intent, md5(text_span) AS span_md5, (i - 1)::BIGINT AS order_index FROM numbered
UNION ALL
SELECT doc_id, 'B' || i, 'Paragraph ' || i, md5(text_span), (i - 1)::BIGINT FROM paras WHERE doc_id NOT IN (SELECT doc_id FROM kept)"""
QUERIES["split_parts"] = lambda spark, d: digest_blocks(S.segment(texts(spark, d), "doc_id", "parts"))
# a leading heading names the parts, and its line is none of them unless nothing follows it
SQL["split_parts"] = f"""WITH {LINES_SQL.replace('lines AS', 'every AS')},
shown AS (SELECT doc_id, min(n) AS n FROM every WHERE {DUCK.has('line', X.SPACE_NOT)} GROUP BY doc_id),
leads AS (SELECT doc_id, n, {_STRIP(DUCK.first('line', S.HEADING_LINE, 2))} AS h FROM every JOIN shown USING (doc_id, n) WHERE {DUCK.has('line', S.HEADING_LINE)}),
bodies AS (SELECT DISTINCT e.doc_id FROM every e JOIN leads l ON l.doc_id = e.doc_id AND e.n > l.n WHERE {DUCK.has('e.line', X.SPACE_NOT)}),
lines AS (SELECT e.doc_id, e.n, e.line FROM every e LEFT JOIN leads l ON l.doc_id = e.doc_id LEFT JOIN bodies b ON b.doc_id = e.doc_id WHERE l.doc_id IS NULL OR b.doc_id IS NULL OR e.n > l.n),
{BULLET_SQL}
SELECT p.doc_id, 'B' || i AS block_id, coalesce(l.h, 'Section') || ' / Part ' || i AS intent, md5(text_span) AS span_md5, (i - 1)::BIGINT AS order_index FROM paras p LEFT JOIN leads l ON l.doc_id = p.doc_id"""


def intent_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks named by their first three letters, made unique within the document."""
    nested = texts(spark, sf_dir).select("doc_id", S.blocks("paragraph").alias("b")).withColumn("b", F.expr("transform(b, x -> named_struct('intent', lower(substring(x.text_span, 1, 2)), 'text_span', x.text_span))"))
    rows = nested.select("doc_id", F.posexplode(F.expr(S.unique_intents("b"))).alias("i", "b"))
    return rows.select("doc_id", F.col("i").cast("long").alias("i"), "b.intent")


QUERIES["intent_dedup"] = intent_dedup
SQL["intent_dedup"] = f"""WITH {LINES_SQL}, {BULLET_SQL},
named AS (SELECT doc_id, i - 1 AS i, CASE WHEN {_STRIP("lower(substring(text_span, 1, 2))")} = '' THEN 'Stage ' || i ELSE {_STRIP("lower(substring(text_span, 1, 2))")} END AS intent FROM paras),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, intent ORDER BY i) AS k FROM named)
SELECT doc_id, i::BIGINT AS i, CASE WHEN k = 1 THEN intent ELSE intent || ' (' || k || ')' END AS intent FROM k"""

# ---- mining --------------------------------------------------------------------------------------

from rulegrove.operators import mining as M  # noqa: E402


def _names(d: dict[str, str]) -> str:
    return ", ".join(f"{v} AS {k}" for k, v in d.items())


KEYWORDS_SQL = f"""
tokens AS (SELECT doc_id, generate_subscripts(ws, 1) AS place, unnest(ws) AS raw FROM (SELECT doc_id, {DUCK.all('lower(text)', X.TOKEN_MINED)} AS ws FROM t)),
cleaned AS (SELECT doc_id, place, trim(trim(raw, ''''), '-') AS w FROM tokens),
counted AS (SELECT doc_id, w, count(*) AS n, min(place) AS place FROM cleaned WHERE length(w) > 3 AND w NOT IN ({', '.join(f"'{w}'" for w in X.STOPWORDS)}) GROUP BY doc_id, w),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, place) AS r FROM counted),
keywords AS (SELECT doc_id, list(w ORDER BY r) AS kws FROM ranked WHERE r <= {M.KEYWORDS} GROUP BY doc_id)"""
GLOBAL_SQL = f"""WITH t AS (SELECT doc_id, text FROM {TEXTS_SQL} x), {KEYWORDS_SQL},
facts AS (SELECT doc_id, {_names(M.features(DUCK))} FROM t),
limits AS (SELECT *, {_names(M.bounds(DUCK))} FROM facts),
joined AS (SELECT l.*, coalesce(k.kws, []) AS kws FROM limits l LEFT JOIN keywords k USING (doc_id)),
candidates AS (SELECT doc_id, unnest({M.global_candidates(DUCK)}, recursive := true) FROM joined)"""


def global_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.mine_global(texts(spark, sf_dir), "doc_id")


QUERIES["top_keywords"] = lambda spark, d: M.top_keywords(texts(spark, d), "doc_id").select("doc_id", F.array_join("kws", ",").alias("keywords"))
SQL["top_keywords"] = f"WITH t AS (SELECT doc_id, text FROM {TEXTS_SQL} x), {KEYWORDS_SQL} SELECT doc_id, array_to_string(kws, ',') AS keywords FROM keywords"
QUERIES["mine_global_candidates"] = global_rules
SQL["mine_global_candidates"] = f'{GLOBAL_SQL} SELECT doc_id, pos, "check", args, descr FROM candidates'
QUERIES["mine_global_rules"] = lambda spark, d: M.sample_global(global_rules(spark, d), "doc_id")
SQL["mine_global_rules"] = f"""{GLOBAL_SQL},
drawn AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY md5('{M.SEED}:' || doc_id || ':hard:' || "check")) AS r,
  {M.SAMPLE[0]} + floor({DUCK.uniform(f"'{M.SEED}:' || doc_id || ':size'")} * {M.SAMPLE[1] - M.SAMPLE[0] + 1}) AS target FROM candidates)
SELECT doc_id, 'G' || r AS cid, "check", args, descr FROM drawn WHERE r <= target"""
per_text("dominant_decimal_places", places=lambda d, t: M.mode_of(d, M._lengths(d, t), 3, 0.6), block_places=lambda d, t: M.mode_of(d, M._lengths(d, t), 2, None))

BLOCK_SQL = f"""WITH {LINES_SQL}, {BULLET_SQL},
facts AS (SELECT doc_id, 'B' || i AS block_id, {_names(M.block_features(DUCK))} FROM paras),
candidates AS (SELECT doc_id, block_id, unnest({M.block_candidates(DUCK)}, recursive := true) FROM facts)"""


def block_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.mine_blocks(S.segment(texts(spark, sf_dir), "doc_id", "paragraph"), "doc_id")


_TAG = lambda what: DUCK.uniform(f"'{M.SEED}:' || doc_id || ':' || block_id || ':{what}'")
QUERIES["mine_block_candidates"] = block_rules
SQL["mine_block_candidates"] = f'{BLOCK_SQL} SELECT doc_id, block_id, pos, "check", args, descr FROM candidates'
QUERIES["mine_block_rules"] = lambda spark, d: M.sample_blocks(block_rules(spark, d), "doc_id")
SAMPLED_BLOCK_SQL = f"""{BLOCK_SQL},
sided AS (SELECT *, "check" IN ({', '.join(f"'{c}'" for c in M.HARD_BLOCK)}) AS hard FROM candidates),
ranked AS (SELECT *, count(*) FILTER (WHERE hard) OVER u AS n_hard, count(*) FILTER (WHERE NOT hard) OVER u AS n_soft,
  row_number() OVER (PARTITION BY doc_id, block_id, hard ORDER BY md5('{M.SEED}:' || doc_id || ':' || block_id || ':' || pos)) AS r FROM sided WINDOW u AS (PARTITION BY doc_id, block_id)),
totals AS (SELECT *, 1 + floor({_TAG('total')} * least({M.MOST_PER_BLOCK}, n_hard + n_soft)) AS total FROM ranked),
picks AS (SELECT *, floor({_TAG('hard')} * (least(n_hard, total) + 1)) AS pick FROM totals),
kept AS (SELECT *, CASE WHEN NOT hard THEN 1 WHEN r <= pick THEN 0 ELSE 2 END AS phase FROM picks
  WHERE (hard AND r <= pick + greatest(0, total - pick - n_soft)) OR (NOT hard AND r <= total - pick)),
rules AS (SELECT doc_id, block_id, block_id || '_C' || row_number() OVER (PARTITION BY doc_id, block_id ORDER BY phase, r) AS cid, "check", args, descr FROM kept)"""
SQL["mine_block_rules"] = f'{SAMPLED_BLOCK_SQL} SELECT doc_id, block_id, cid, "check", args, descr FROM rules'


def evidence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "documents").select(F.col("doc_id"), F.expr("n_chars % 200 + 1").alias("n"))
    return n.select("doc_id", "n", *[F.expr(v).alias(k) for k, v in M.evidence_bounds(SPARK).items()])


QUERIES["mine_evidence_rules"] = evidence_rules
SQL["mine_evidence_rules"] = f"SELECT doc_id, n, {_names(M.evidence_bounds(DUCK))} FROM (SELECT doc_id, n_chars % 200 + 1 AS n FROM documents)"

# ---- variants ------------------------------------------------------------------------------------

from rulegrove.operators import augment as A  # noqa: E402


def document_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mined rules of every text: sampled global ones and sampled block ones."""
    one = M.sample_global(global_rules(spark, sf_dir), "doc_id").select("doc_id", F.lit(None).cast("string").alias("owner"), "cid", "check", "args", "descr")
    two = M.sample_blocks(block_rules(spark, sf_dir), "doc_id").select("doc_id", F.col("block_id").alias("owner"), "cid", "check", "args", "descr")
    return one.unionByName(two).withColumnRenamed("doc_id", "sample_id").withColumn("priority_level", F.lit(2))


RULES_SQL = f"""WITH global_part AS ({SQL['mine_global_rules']}), block_part AS ({SQL['mine_block_rules']}),
all_rules AS (SELECT doc_id AS sample_id, NULL AS owner, cid, "check", args, descr FROM global_part UNION ALL SELECT doc_id, block_id, cid, "check", args, descr FROM block_part)"""
_KEY = lambda *p: "md5('" + str(A.SEED) + ":' || " + " || ':' || ".join(p) + ")"
_U = lambda *p: DUCK.uniform("'" + str(A.SEED) + ":' || " + " || ':' || ".join(p))

QUERIES["priority_injection"] = lambda spark, d: A.inject_priorities(document_rules(spark, d)).select("sample_id", "owner", "cid", "priority_level")
SQL["priority_injection"] = f"""{RULES_SQL},
blocks AS (SELECT *, count(*) OVER (PARTITION BY sample_id) AS n, row_number() OVER (PARTITION BY sample_id ORDER BY {_KEY('sample_id', "'block'", 'owner')}) AS r
  FROM (SELECT DISTINCT sample_id, owner FROM all_rules WHERE owner IS NOT NULL)),
picked AS (SELECT sample_id, owner FROM blocks WHERE r <= least(n, 1 + floor({_U('sample_id', "'blocks'")} * 2))),
chosen AS (SELECT sample_id, cid FROM (SELECT *, row_number() OVER (PARTITION BY sample_id, owner ORDER BY {_KEY('sample_id', "'rule'", 'cid')}) AS r
  FROM all_rules WHERE (sample_id, owner) IN (SELECT (sample_id, owner) FROM picked)) WHERE r = 1)
SELECT sample_id, owner, cid, CASE WHEN (sample_id, cid) IN (SELECT (sample_id, cid) FROM chosen) THEN 1 ELSE 2 END AS priority_level FROM all_rules"""
QUERIES["m1_turns"] = lambda spark, d: A.m1_turns(document_rules(spark, d)).select("sample_id", "cid", "activation", "turn")
SQL["m1_turns"] = f"""{RULES_SQL},
marked AS (SELECT *, count(*) OVER (PARTITION BY sample_id, owner) AS n, row_number() OVER (PARTITION BY sample_id, owner ORDER BY {_KEY('sample_id', "'m1'", 'cid')}) AS r FROM all_rules),
two AS (SELECT sample_id, owner, 2 + (row_number() OVER (PARTITION BY sample_id ORDER BY owner) - 1) % 2 AS t FROM marked WHERE owner IS NOT NULL AND n = 2 AND r = 1),
cut AS (SELECT m.*, t, greatest(1, round_even(n * 0.4, 0)) AS c1, greatest(1, round_even(n * 0.3, 0)) AS c2 FROM marked m LEFT JOIN two USING (sample_id, owner)),
active AS (SELECT sample_id, cid, (CASE WHEN owner IS NULL THEN CASE WHEN n <= 2 THEN r WHEN r <= c1 THEN 1 WHEN r <= c1 + c2 THEN 2 ELSE 3 END
  ELSE CASE WHEN r = 1 THEN 1 WHEN n = 2 THEN t WHEN r <= 3 THEN r ELSE 2 + r % 2 END END)::INT AS activation FROM cut),
fine AS (SELECT sample_id FROM active GROUP BY sample_id HAVING count(DISTINCT activation) = 3)
SELECT sample_id, cid, activation, turn::INT AS turn FROM active JOIN range(1, 4) t(turn) ON turn >= activation WHERE sample_id IN (SELECT sample_id FROM fine)"""
QUERIES["m2_turns"] = lambda spark, d: A.m2_turns(document_rules(spark, d)).select("sample_id", "turn", "cid", "check", "args", "priority_level", "restored")
_BASE2 = "coalesce(" + ", ".join(f"try_cast(json_extract_string(args, '$.{n}') AS BIGINT)" for n in ("min_items", "min_paras", "min_words", "n", "places")) + ")"
_NAME2 = "CASE " + " ".join(f"WHEN json_extract_string(args, '$.{n}') IS NOT NULL THEN '{n}'" for n in ("min_items", "min_paras", "min_words", "n", "places")) + " END"
SQL["m2_turns"] = f"""{RULES_SQL},
based AS (SELECT *, {_BASE2} AS base, {_NAME2} AS name, {_U('sample_id', "'m2'", 'cid')} AS u FROM all_rules),
valued AS (SELECT *, {A.mutated_value('"check"', 'base', 'u')} AS new FROM based),
picked AS (SELECT *, owner IS NOT NULL AND new IS NOT NULL AS able, row_number() OVER (PARTITION BY sample_id ORDER BY NOT (owner IS NOT NULL AND new IS NOT NULL), "check" = 'min_word_count', {_KEY('sample_id', "'m2pick'", 'cid')}) AS r FROM valued),
hits AS (SELECT *, r = 1 AND able AS hit, bool_or(r = 1 AND able) OVER (PARTITION BY sample_id) AS any_hit FROM picked)
SELECT sample_id, turn::INT AS turn, CASE WHEN hit AND turn = 1 THEN cid || '__m2_alt' ELSE cid END AS cid, "check",
  CASE WHEN hit AND turn = 1 THEN '{{"' || name || '": ' || new || '}}' ELSE args END AS args, CASE WHEN hit AND turn = 1 THEN 1 ELSE 2 END AS priority_level, hit AND turn = 2 AS restored
FROM hits, range(1, 3) t(turn) WHERE any_hit"""
QUERIES["curriculum"] = lambda spark, d: A.curriculum(document_rules(spark, d), least=6, floor=1).select("sample_id", "level", "cid")  # no text here has 15 rules
_LEVELS = ", ".join(
    f"l{k} AS (SELECT sample_id, cid FROM (SELECT sample_id, cid, count(*) OVER (PARTITION BY sample_id) AS n, row_number() OVER (PARTITION BY sample_id ORDER BY {_KEY('sample_id', repr(f'level{k}'), 'cid')}) AS r FROM l{k + 1})"
    f" WHERE r > 1 + floor({_U('sample_id', repr(f'level{k}'))} * least(3, n - {k})))"
    for k in (4, 3, 2, 1)
)
SQL["curriculum"] = f"""{RULES_SQL}, l5 AS (SELECT sample_id, cid FROM (SELECT *, count(*) OVER (PARTITION BY sample_id) AS n FROM all_rules) WHERE n >= 6), {_LEVELS}
{' UNION ALL '.join(f'SELECT sample_id, {k}::INT AS level, cid FROM l{k}' for k in (5, 4, 3, 2, 1))}"""


def conversation_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.turn_changes(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", A.fingerprint("text")).select("conv_id", "turn", "role", "change_type")


QUERIES["turn_changes"] = conversation_turns
SQL["turn_changes"] = """SELECT conv_id, turn, role, CASE WHEN turn = min(turn) OVER (PARTITION BY conv_id) THEN 'add' WHEN lag(turn) OVER w IS DISTINCT FROM turn - 1 THEN 'add'
WHEN trim(coalesce(lag(text) OVER w, '')) <> trim(coalesce(text, '')) THEN 'modify' ELSE 'unchanged' END AS change_type FROM conversations WINDOW w AS (PARTITION BY conv_id, role ORDER BY turn)"""


def conversation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(instruction, answer): a user turn and the assistant turn after it."""
    c = table(spark, sf_dir, "conversations")
    ask = c.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("instruction"))
    reply = c.filter("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return ask.join(reply, ["conv_id", "turn"])


QUERIES["conversation_pairs"] = conversation_pairs
SQL["conversation_pairs"] = "SELECT u.conv_id, u.turn, u.text AS instruction, a.text AS answer FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'"


def planned(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    blocks = S.segment(texts(spark, sf_dir), "doc_id", "paragraph").select(F.col("doc_id").alias("sample_id"), "block_id", "order_index")
    return A.plan_selections(blocks), blocks


PLAN_SQL = f"""WITH {LINES_SQL}, {BULLET_SQL},
blocks AS (SELECT doc_id AS sample_id, 'B' || i AS block_id, i - 1 AS o FROM paras),
ranked AS (SELECT *, count(*) OVER (PARTITION BY sample_id) AS n, lead(block_id) OVER (PARTITION BY sample_id ORDER BY o, block_id) AS nxt,
  row_number() OVER (PARTITION BY sample_id ORDER BY {_KEY('sample_id', "'select'", 'block_id')}) AS r FROM blocks),
wide AS (SELECT *, floor({_U('sample_id', "'wide'")} * (least(1, n - 1) + 1)) AS w FROM ranked),
plan AS (SELECT sample_id, block_id, o, CASE WHEN r <= w THEN 'global' ELSE 'local' END AS selection_type, CASE WHEN r > w THEN nxt END AS merge_point FROM wide
  WHERE r <= w + least(1 + floor({_U('sample_id', "'near'")} * least(3, n - w)), n - w))"""
QUERIES["plan_selections"] = lambda spark, d: planned(spark, d)[0].drop("order_index")
SQL["plan_selections"] = f"{PLAN_SQL} SELECT sample_id, block_id, selection_type, merge_point FROM plan"
QUERIES["branch_rules"] = lambda spark, d: A.branch_rules(*planned(spark, d)).select("sample_id", "owner", "origin_block", "cid", "check")
_FIRST = " UNION ALL ".join(f"SELECT '{k}' AS kind, {i + 1} AS k, '{c}' AS c" for k, (_, rs) in A.FALLBACK.items() for i, (c, _, _) in enumerate(rs))
_NEXT = " UNION ALL ".join(f"SELECT {j + 1} AS e, {i + 1} AS k, '{c}' AS c" for j, rs in enumerate(A.FOLLOW) for i, (c, _, _) in enumerate(rs))
SQL["branch_rules"] = f"""{PLAN_SQL}, firsts AS ({_FIRST}), nexts AS ({_NEXT}),
tail AS (SELECT p.sample_id, p.block_id, b.block_id AS origin, row_number() OVER (PARTITION BY p.sample_id, p.block_id ORDER BY b.o, b.block_id) AS s FROM plan p JOIN blocks b ON b.sample_id = p.sample_id AND b.o > p.o WHERE selection_type = 'global')
SELECT sample_id, block_id || '_ALT' AS owner, block_id AS origin_block, block_id || '_ALT_C' || k AS cid, c AS "check" FROM plan JOIN firsts ON kind = selection_type
UNION ALL SELECT sample_id, block_id || '_ALT_NEXT' || s, origin, block_id || '_ALT_NEXT' || s || '_C' || k, c FROM tail JOIN nexts ON e = least(s, {len(A.FOLLOW)})"""

# ---- evidence, models, resume --------------------------------------------------------------------

from rulegrove.operators import evidence as E  # noqa: E402
from rulegrove.operators import provider as P  # noqa: E402
from rulegrove.plans import render as R  # noqa: E402
from rulegrove.plans import shape as SH  # noqa: E402
from rulegrove.sources import files as FS  # noqa: E402

#: Rows (corpus, section, paragraph, ref, title) and (corpus, ref, title, count) of two small surveys.
CITES = [("s1", 0, 0, "b1", "One"), ("s1", 0, 0, "b1", "One"), ("s1", 0, 1, "b2", ""), ("s1", 1, 0, "b1", "Uno"), ("s1", 1, 0, "b9", "Nine"), ("s2", 0, 0, "b2", "Two")]
REFS = [("s1", "b1", "First", 10), ("s1", "b2", "Second", 30), ("s1", "b3", "Third", 30), ("s2", "b2", "", None), ("s2", "b5", "Five", 1)]


def surveys(spark: SparkSession) -> DataFrame:
    from collections import defaultdict

    rows = []
    for c in ("s1", "s2"):
        parts: dict = defaultdict(lambda: defaultdict(list))
        for _, s, p, r, t in (x for x in CITES if x[0] == c):
            parts[s][p].append((r, t))
        sections = [(s, f"Section {s}", [(f"Text {s}.{p}.", parts[s][p]) for p in sorted(parts[s])]) for s in sorted(parts)]
        none = (None,) * 12
        refs = [(r, t, None, None, (*none[:9], None if n is None else str(n), None, None)) for k, r, t, n in REFS if k == c]
        rows.append((c, (f"Title {c} words", ["kw"] if c == "s1" else None, None, ["Field", "kw"] if c == "s1" else None, None, None), sections, refs))
    return spark.createDataFrame(rows, E.SURVEY)


_CITES_SQL = "(VALUES " + ", ".join(str(x) for x in CITES) + ") c(corpusId, section, para, ref_id, title)"
_REFS_SQL = "(VALUES " + ", ".join(str(x).replace("None", "NULL") for x in REFS) + ") r(corpusId, ref_id, title, n)"
QUERIES["evidence_usage"] = lambda spark, d: E.evidence(surveys(spark)).select("corpusId", "ref_id", "title", "citationCount", F.col("citation_count_in_survey").cast("long").alias("n"), F.array_join("cited_in_sections", ",").alias("sections"))
SQL["evidence_usage"] = f"""WITH once AS (SELECT corpusId, section, para, ref_id, max(title) AS title FROM {_CITES_SQL} GROUP BY ALL),
used AS (SELECT corpusId, ref_id, count(*) AS n, string_agg(DISTINCT section::VARCHAR, ',' ORDER BY section::VARCHAR) AS sections, min(nullif(title, '')) AS title FROM once GROUP BY ALL)
SELECT corpusId, ref_id, coalesce(nullif(r.title, ''), u.title, '') AS title, coalesce(r.n, 0)::INT AS citationCount, coalesce(u.n, 0) AS n, coalesce(sections, '') AS sections
FROM {_REFS_SQL} FULL JOIN used u USING (corpusId, ref_id)"""
QUERIES["high_impact_topk"] = lambda spark, d: E.high_impact(E.evidence(surveys(spark), cited_only_too=False), k=2).select("corpusId", "ref_id", "rank")
SQL["high_impact_topk"] = f"SELECT corpusId, ref_id, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY corpusId ORDER BY coalesce(n, 0) DESC, ref_id DESC) AS rank FROM {_REFS_SQL}) WHERE rank <= 2"
QUERIES["survey_answers"] = lambda spark, d: E.answers(surveys(spark))


def _answer(corpus: str) -> str:
    """The fixture's answer by plain loops."""
    rows = [x for x in CITES if x[0] == corpus]
    told = []
    for s in sorted({x[1] for x in rows}):
        paras = []
        for p in sorted({x[2] for x in rows if x[1] == s}):
            marks = dict.fromkeys(f"[{x[3]}]" for x in rows if x[1:3] == (s, p))
            paras.append(f"Text {s}.{p}. " + " ".join(marks))
        told.append(f"## Section {s}\n\n" + "\n\n".join(paras))
    return "\n\n".join(told)


SQL["survey_answers"] = "SELECT * FROM (VALUES " + ", ".join(f"('{c}', {DUCK.lit(_answer(c))})" for c in ("s1", "s2")) + ") a(corpusId, text)"


def benchmark_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twelve longest benchmark items of each of ten groups: the same top-k on a real table."""
    refs = table(spark, sf_dir, "benchmark").select((F.col("item_id") % 10).alias("corpusId"), F.col("item_id").cast("string").alias("ref_id"), F.length("text").alias("citationCount"))
    return E.high_impact(refs).select("corpusId", "ref_id", "citationCount", "rank")


QUERIES["benchmark_topk"] = benchmark_impact
SQL["benchmark_topk"] = "SELECT * FROM (SELECT item_id % 10 AS corpusId, item_id::VARCHAR AS ref_id, length(text)::INT AS citationCount, row_number() OVER (PARTITION BY item_id % 10 ORDER BY length(text) DESC, item_id::VARCHAR DESC)::INT AS rank FROM benchmark) WHERE rank <= 12"

per_text("validate_rewrite", short=lambda d, t: P.rewrite_reason(d, t, d.replace_all(t, "[a-z]{4,}", "")), other=lambda d, t: P.rewrite_reason(d, t, f"concat(upper({t}), ' the of and the rest of it all')"))


def llm_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as calls: a purchase failed, a view is no call, anything else succeeded."""
    success = F.when(F.col("event_type") == "view", None).otherwise(F.col("event_type") != "purchase")
    return P.status(table(spark, sf_dir, "events").select("user_id", success.alias("success")), "user_id")


QUERIES["llm_status_rollup"] = llm_status
SQL["llm_status_rollup"] = """SELECT user_id, count(s) AS calls, CASE WHEN count(s) = 0 THEN 'no-llm' WHEN bool_and(s) THEN 'success' ELSE 'failed' END AS status
FROM (SELECT user_id, CASE WHEN event_type <> 'view' THEN event_type <> 'purchase' END AS s FROM events) GROUP BY user_id"""
QUERIES["resume_antijoin"] = lambda spark, d: FS.not_done(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels").select("doc_id"), "doc_id")
SQL["resume_antijoin"] = "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"

LOOSE = ["{'a': 1,}", 'noise {"a": {"b": [1, 2]}} tail', "[1, 2,]", "no json", '{"a": 1}', "{broken", None]
QUERIES["json_loose_parse"] = lambda spark, d: P.loose_json(spark.createDataFrame([(i, t) for i, t in enumerate(LOOSE)], "id int, t string"), "t").select("id", F.expr("to_json(parsed)").alias("parsed"))
SQL["json_loose_parse"] = """SELECT * FROM (VALUES (0, '{"a":1}'), (1, '{"a":{"b":[1,2]}}'), (2, '[1,2]'), (3, NULL), (4, '{"a":1}'), (5, NULL), (6, NULL)) p(id, parsed)"""


# ---- graphs and prompts --------------------------------------------------------------------------


def document_graphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mined rules, logic and planned selections assembled into one nested graph per text.

    Rules whose id ends in 1 count as unchanged, so that change views have something to leave out.
    """
    rules = document_rules(spark, sf_dir).withColumn("derived_from", F.lit("mined"))
    blocks = S.segment(texts(spark, sf_dir), "doc_id", "paragraph").withColumnRenamed("doc_id", "sample_id")
    plan = A.plan_selections(blocks.select("sample_id", "block_id", "order_index"))
    more = A.branch_rules(plan, blocks.select("sample_id", "block_id", "order_index"))
    rules = rules.withColumn("pos", F.regexp_extract("cid", "([0-9]+)$", 1).cast("int"))
    picked, extra = SH.selections(plan, blocks, rules, more, {k: v[0] for k, v in A.FALLBACK.items()})
    added = more.select("sample_id", "owner", "cid", "check", "args", "descr", F.lit(2).alias("priority_level"), F.regexp_extract("cid", "([0-9]+)$", 1).cast("int").alias("pos"), F.lit("step5").alias("derived_from"))
    every = rules.unionByName(added).withColumn("change_type", F.when(F.endswith("cid", F.lit("1")), "unchanged").otherwise("add"))
    logic = blocks.select("sample_id", "block_id", F.expr(X.logic(SPARK, "text_span")).alias("logic"))
    seeds = blocks.select("sample_id", F.concat(F.lit("Task "), "sample_id").alias("seed_task")).distinct()
    return SH.assemble(blocks, every, seeds, logic, extra, picked)


QUERIES["render_prompt"] = lambda spark, d: R.render_main(document_graphs(spark, d)).select("sample_id", F.md5("prompt").alias("prompt_md5"))
for _t in R.TEMPLATES:
    QUERIES[f"render_{_t}"] = lambda spark, d, t=_t: R.render_templates(document_graphs(spark, d), (t,)).select("sample_id", "template", F.md5("prompt").alias("prompt_md5"))
# alternate rules with their text and place; a global selection's path runs over all later blocks
_FIRST_D = " UNION ALL ".join(f"SELECT '{k}' AS kind, {i + 1} AS k, '{c}' AS c, {DUCK.lit(t)} AS descr" for k, (_, rs) in A.FALLBACK.items() for i, (c, _, t) in enumerate(rs))
_NEXT_D = " UNION ALL ".join(f"SELECT {j + 1} AS e, {i + 1} AS k, '{c}' AS c, {DUCK.lit(t)} AS descr" for j, rs in enumerate(A.FOLLOW) for i, (c, _, t) in enumerate(rs))
_COND = {k: DUCK.lit(v[0]) for k, v in A.FALLBACK.items()}
_SAID = "CASE selection_type " + " ".join(f"WHEN '{k}' THEN {DUCK.replace_all(X.condition(DUCK, c), '[.]+$', '')}" for k, c in _COND.items()) + " END"
_NOT = "CASE selection_type " + " ".join(f"WHEN '{k}' THEN {X.negated(DUCK, c)}" for k, c in _COND.items()) + " END"
GRAPH_SQL = f"""WITH {LINES_SQL}, {BULLET_SQL}, {RULES_SQL.removeprefix('WITH ')}, {PLAN_SQL.removeprefix('WITH ').split(BULLET_SQL + ',', 1)[1]},
firsts AS ({_FIRST_D}), nexts AS ({_NEXT_D}),
tails AS (SELECT p.sample_id, p.block_id, row_number() OVER (PARTITION BY p.sample_id, p.block_id ORDER BY b.o, b.block_id) AS s FROM plan p JOIN blocks b ON b.sample_id = p.sample_id AND b.o > p.o WHERE selection_type = 'global'),
alts AS (SELECT sample_id, block_id, 0 AS step, k, block_id || '_ALT' AS owner, block_id || '_ALT_C' || k AS cid, c AS "check", descr FROM plan JOIN firsts ON kind = selection_type
  UNION ALL SELECT sample_id, block_id, s, k, block_id || '_ALT_NEXT' || s, block_id || '_ALT_NEXT' || s || '_C' || k, c, descr FROM tails JOIN nexts ON e = least(s, {len(A.FOLLOW)})),
numbered_rules AS (SELECT *, regexp_extract(cid, '([0-9]+)$', 1)::INT AS pos FROM all_rules),
g AS (SELECT sample_id, string_agg('  - ' || descr, chr(10) ORDER BY pos) AS lines FROM numbered_rules WHERE owner IS NULL GROUP BY sample_id),
own AS (SELECT sample_id, owner, string_agg('  - ' || descr, chr(10) ORDER BY pos) AS lines, string_agg('    - ' || descr, chr(10) ORDER BY pos) AS inner_lines FROM numbered_rules WHERE owner IS NOT NULL GROUP BY sample_id, owner),
alt_lines AS (SELECT sample_id, block_id, string_agg('    - ' || descr, chr(10) ORDER BY step, k) AS lines FROM alts GROUP BY sample_id, block_id),
choices AS (SELECT p.sample_id, p.block_id, p.o, selection_type, merge_point, '  IF ' || {_SAID} || ':' || chr(10) || a.lines || chr(10) || '  OTHERWISE:' || chr(10) || w.inner_lines AS lines, {_NOT} AS negated
  FROM plan p JOIN alt_lines a USING (sample_id, block_id) JOIN own w ON w.sample_id = p.sample_id AND w.owner = p.block_id),
notes AS (SELECT sample_id, '4. CURRENT CONDITION ASSUMPTION' || chr(10) || 'Unless explicitly told otherwise, assume each trigger below is FALSE:' || chr(10) || string_agg('- Paragraph ' || (o + 1) || ': ' || negated, chr(10) ORDER BY o) || chr(10) AS lines FROM choices GROUP BY sample_id),
stages AS (SELECT doc_id AS sample_id, i, 'B' || i AS block_id, '- Stage ' || i || ': Paragraph ' || i AS head, CASE WHEN {X.logic(DUCK, 'text_span')} = 'sub-chain' THEN '  Logic cue: Address listed duties as a short sequence.' ELSE '  Logic cue: Cover all listed duties for this stage.' END AS cue,
  coalesce(w.lines, '  - Follow the intent of this stage even if no explicit duty exists.') AS duties FROM paras LEFT JOIN own w ON w.sample_id = doc_id AND w.owner = 'B' || i)"""
_HEAD = "'SYSTEM INSTRUCTIONS:' || chr(10) || chr(10) || '1. MISSION BRIEF' || chr(10) || '- Primary directive: Task ' || body.sample_id || chr(10) || chr(10) || '2. NON-NEGOTIABLE GLOBAL RULES' || chr(10) || CASE WHEN g.lines IS NULL THEN '- No additional global constraints were supplied.' ELSE {} END || chr(10) || chr(10) || '3. STRUCTURED RESPONSE BLUEPRINT' || chr(10)"
_END = "CASE WHEN n.lines IS NULL THEN '' ELSE chr(10) || n.lines END"
_TAIL = "FROM body LEFT JOIN g USING (sample_id) LEFT JOIN notes n USING (sample_id)"
SQL["render_stage_blueprint"] = f"""{GRAPH_SQL},
body AS (SELECT s.sample_id, string_agg(head || chr(10) || cue || chr(10) || coalesce(c.lines, duties), chr(10) ORDER BY i) AS lines FROM stages s LEFT JOIN choices c USING (sample_id, block_id) GROUP BY s.sample_id)
SELECT body.sample_id, 'stage_blueprint' AS template, md5({_HEAD.format("'All global rules must be satisfied throughout the response:' || chr(10) || g.lines")}
  || 'Follow stages in order and apply branch logic where stated.' || chr(10) || body.lines || chr(10) || {_END}) AS prompt_md5 {_TAIL}"""
SQL["render_branch_first"] = f"""{GRAPH_SQL},
map AS (SELECT sample_id, string_agg('- Decision at Paragraph ' || (o + 1) || ':' || chr(10) || lines, chr(10) ORDER BY o) AS lines FROM choices GROUP BY sample_id),
body AS (SELECT sample_id, string_agg(head || chr(10) || duties, chr(10) ORDER BY i) AS lines FROM stages GROUP BY sample_id)
SELECT body.sample_id, 'branch_first' AS template, md5({_HEAD.format("replace(chr(10) || g.lines, chr(10) || '  - ', chr(10) || '- ')[2:]")}
  || coalesce('Branch map:' || chr(10) || m.lines, 'No conditional branches were supplied.') || chr(10) || chr(10) || 'Stage flow (follow in order):' || chr(10) || body.lines || chr(10) || {_END}) AS prompt_md5
{_TAIL} LEFT JOIN map m USING (sample_id)"""


_SCOPED_SQL = f"""{GRAPH_SQL},
scoped AS (SELECT sample_id, cid, "check" AS kind, descr, pos, 0 AS k, 'Global' AS scope FROM numbered_rules WHERE owner IS NULL
  UNION ALL SELECT sample_id, cid, "check", descr, pos, 1, 'Stage: Paragraph ' || owner[2:] FROM numbered_rules WHERE owner IS NOT NULL AND (sample_id, owner) NOT IN (SELECT (sample_id, block_id) FROM choices))"""
_BRIEF = "'SYSTEM INSTRUCTIONS:' || chr(10) || chr(10) || '1. MISSION BRIEF' || chr(10) || '- Primary directive: Task ' || body.sample_id || chr(10) || chr(10)"
_LISTED = "'Follow stages in order. Selection stages list their local constraints below.' || chr(10) || body.lines || chr(10)"
SQL["render_priority_layered"] = f"""{_SCOPED_SQL},
by_scope AS (SELECT sample_id, k, scope, '  ' || scope || ':' || chr(10) || string_agg('    * ' || descr, chr(10) ORDER BY pos) AS lines FROM scoped GROUP BY sample_id, k, scope),
told AS (SELECT sample_id, '- Primary:' || chr(10) || string_agg(lines, chr(10) ORDER BY k, scope) AS lines FROM by_scope GROUP BY sample_id),
alt_parts AS (SELECT sample_id, block_id, step, '    - Primary constraints:' || chr(10) || string_agg('      * ' || descr, chr(10) ORDER BY k) AS lines FROM alts GROUP BY ALL),
alt_layers AS (SELECT sample_id, block_id, string_agg(lines, chr(10) ORDER BY step) AS lines FROM alt_parts GROUP BY ALL),
real_layers AS (SELECT sample_id, owner AS block_id, '    - Primary constraints:' || chr(10) || string_agg('      * ' || descr, chr(10) ORDER BY pos) AS lines FROM numbered_rules WHERE owner IS NOT NULL GROUP BY ALL),
layers AS (SELECT p.sample_id, p.block_id, '  IF ' || {_SAID} || ':' || chr(10) || a.lines || chr(10) || '  OTHERWISE:' || chr(10) || r.lines AS lines FROM plan p JOIN alt_layers a USING (sample_id, block_id) JOIN real_layers r USING (sample_id, block_id)),
body AS (SELECT s.sample_id, string_agg(head || coalesce(chr(10) || l.lines, ''), chr(10) ORDER BY i) AS lines FROM stages s LEFT JOIN layers l USING (sample_id, block_id) GROUP BY s.sample_id)
SELECT body.sample_id, 'priority_layered' AS template, md5({_BRIEF} || '2. CONSTRAINT SUMMARY BY PRIORITY' || chr(10) || 'Constraints grouped by priority, then by scope.' || chr(10)
  || coalesce(t.lines, '- No additional global constraints were supplied.') || chr(10) || chr(10) || '3. RESPONSE BLUEPRINT' || chr(10) || {_LISTED} || {_END}) AS prompt_md5
FROM body LEFT JOIN told t USING (sample_id) LEFT JOIN notes n USING (sample_id)"""
SQL["render_grouped_by_check"] = f"""{_SCOPED_SQL},
often AS (SELECT sample_id, kind FROM scoped GROUP BY ALL HAVING count(*) >= 2),
by_scope AS (SELECT s.sample_id, kind, k, scope, '  ' || scope || ':' || chr(10) || string_agg('    * ' || descr, chr(10) ORDER BY pos) AS lines FROM scoped s JOIN often o USING (sample_id, kind) GROUP BY s.sample_id, kind, k, scope),
by_kind AS (SELECT sample_id, kind, '- ' || kind || ':' || chr(10) || string_agg(lines, chr(10) ORDER BY k, scope) AS lines FROM by_scope GROUP BY sample_id, kind),
told AS (SELECT sample_id, string_agg(lines, chr(10) ORDER BY kind) AS lines FROM by_kind GROUP BY sample_id),
gone AS (SELECT s.sample_id, s.cid FROM scoped s JOIN often o USING (sample_id, kind)),
rest AS (SELECT sample_id, owner, string_agg('  - ' || descr, chr(10) ORDER BY pos) AS lines FROM numbered_rules WHERE (sample_id, cid) NOT IN (SELECT (sample_id, cid) FROM gone) GROUP BY ALL),
body AS (SELECT s.sample_id, string_agg(head || coalesce(chr(10) || coalesce(c.lines, r.lines), ''), chr(10) ORDER BY i) AS lines
  FROM stages s LEFT JOIN choices c USING (sample_id, block_id) LEFT JOIN rest r ON r.sample_id = s.sample_id AND r.owner = s.block_id GROUP BY s.sample_id)
SELECT body.sample_id, 'grouped_by_check' AS template, md5({_BRIEF} || '2. CONSTRAINT SUMMARY BY TYPE' || chr(10) || 'Only constraint types with two or more instances are summarized here.' || chr(10)
  || coalesce(t.lines, '- No constraint types met the summary threshold.') || chr(10) || chr(10) || '3. RESPONSE BLUEPRINT & REMAINING RULES' || chr(10)
  || coalesce('Remaining global rules (not included in the summary):' || chr(10) || r.lines || chr(10), '') || {_LISTED} || {_END}) AS prompt_md5
FROM body LEFT JOIN told t USING (sample_id) LEFT JOIN notes n USING (sample_id) LEFT JOIN rest r ON r.sample_id = body.sample_id AND r.owner IS NULL"""


def graph_digest(graphs: DataFrame) -> DataFrame:
    """What a graph holds as three digests: blocks, rules and selections, each in a fixed order."""
    md5 = lambda xs: F.md5(F.array_join(F.array_sort(F.expr(xs)), ";"))
    block = "concat_ws('|', b.block_id, b.intent, md5(b.text_span), b.order_index, coalesce(b.is_alternate, false), coalesce(b.origin_block, '-'))"
    rule = "concat_ws('|', coalesce(n.trace_to, '-'), n.cid, n.verifier_spec.check, md5(n.desc), n.priority_level, n.scope)"
    sel = "concat_ws('|', s.sid, s.condition, s.trace_to, s.selection_type, coalesce(s.merge_point, '-'), array_join(s.branch_real.constraints, ','), array_join(s.branch_alt.constraints, ','), array_join(s.alt_path_blocks, ','))"
    return graphs.select("sample_id", md5(f"transform(block_specs, b -> {block})").alias("blocks_md5"), md5(f"transform({SH.NODES}, n -> {rule})").alias("rules_md5"), md5(f"transform(selections, s -> {sel})").alias("selections_md5"))


def graph_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graphs to JSON in the other spelling and back: digests of what comes out."""
    return graph_digest(R.decode(R.encode(document_graphs(spark, sf_dir), "blocks").select("sample_id", "json")))


QUERIES["graph_round_trip"] = graph_round_trip
SQL["graph_round_trip"] = f"""{GRAPH_SQL},
later AS (SELECT p.sample_id, p.block_id, b.block_id AS origin, b.o, row_number() OVER (PARTITION BY p.sample_id, p.block_id ORDER BY b.o, b.block_id) AS s FROM plan p JOIN blocks b ON b.sample_id = p.sample_id AND b.o > p.o WHERE selection_type = 'global'),
every_block AS (SELECT doc_id AS sample_id, 'B' || i AS block_id, 'B' || i AS origin, i - 1 AS o, false AS alt FROM paras
  UNION ALL SELECT sample_id, block_id || '_ALT', block_id, o, true FROM plan UNION ALL SELECT sample_id, block_id || '_ALT_NEXT' || s, origin, o + s + 1, true FROM later),
b1 AS (SELECT e.sample_id, concat_ws('|', block_id, 'Paragraph ' || p.i, md5(p.text_span), o, alt, CASE WHEN alt THEN origin ELSE '-' END) AS x FROM every_block e JOIN paras p ON p.doc_id = e.sample_id AND 'B' || p.i = e.origin),
r1 AS (SELECT sample_id, concat_ws('|', coalesce(owner, '-'), cid, "check", md5(descr), 2, CASE WHEN owner IS NULL THEN 'global' ELSE 'local' END) AS x FROM all_rules WHERE sample_id IN (SELECT doc_id FROM paras)
  UNION ALL SELECT sample_id, concat_ws('|', owner, cid, "check", md5(descr), 2, 'local') FROM alts),
real_ids AS (SELECT sample_id, owner AS block_id, string_agg(cid, ',' ORDER BY pos) AS ids FROM numbered_rules WHERE owner IS NOT NULL GROUP BY ALL),
alt_ids AS (SELECT sample_id, block_id, string_agg(cid, ',' ORDER BY step, k) AS ids, string_agg(owner, ',' ORDER BY step) FILTER (WHERE k = 1) AS path FROM alts GROUP BY ALL),
s1 AS (SELECT sample_id, concat_ws('|', 'SEL_' || block_id, CASE selection_type {' '.join(f"WHEN '{k}' THEN {c}" for k, c in _COND.items())} END, block_id, selection_type, coalesce(merge_point, '-'), r.ids, a.ids, a.path) AS x FROM choices JOIN real_ids r USING (sample_id, block_id) JOIN alt_ids a USING (sample_id, block_id)),
digests AS (SELECT 'b' AS k, * FROM b1 UNION ALL SELECT 'r', * FROM r1 UNION ALL SELECT 's', * FROM s1)
SELECT sample_id, md5(coalesce(string_agg(x, ';' ORDER BY x) FILTER (WHERE k = 'b'), '')) AS blocks_md5, md5(coalesce(string_agg(x, ';' ORDER BY x) FILTER (WHERE k = 'r'), '')) AS rules_md5,
  md5(coalesce(string_agg(x, ';' ORDER BY x) FILTER (WHERE k = 's'), '')) AS selections_md5 FROM digests GROUP BY sample_id"""
QUERIES["graph_eval_items"] = lambda spark, d: R.eval_items(document_graphs(spark, d), "sample_id").select("sample_id", "section", "block_id", "sid", "branch", "cid", "check")
SQL["graph_eval_items"] = f"""{GRAPH_SQL} SELECT sample_id, CASE WHEN owner IS NULL THEN 'global' ELSE 'block' END AS section, owner AS block_id, NULL AS sid, NULL AS branch, cid, "check" FROM all_rules
WHERE sample_id IN (SELECT doc_id FROM paras)
UNION ALL SELECT c.sample_id, 'branch', NULL, 'SEL_' || c.block_id, 'real', r.cid, r."check" FROM choices c JOIN all_rules r ON r.sample_id = c.sample_id AND r.owner = c.block_id
UNION ALL SELECT sample_id, 'branch', NULL, 'SEL_' || block_id, 'alt', cid, "check" FROM alts"""


def changed_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the change view leaves of each graph."""
    view = R.delta_view(document_graphs(spark, sf_dir))
    ids = lambda xs: F.array_join(F.array_sort(F.expr(xs)), ",")
    return view.select("sample_id", F.md5(ids("transform(block_specs, b -> b.block_id)")).alias("blocks_md5"), F.md5(ids(f"transform({SH.NODES}, n -> n.cid)")).alias("rules_md5"),
                       F.md5(ids("transform(selections, s -> concat(s.sid, ':', size(s.branch_real.constraints), ':', size(s.branch_alt.constraints)))")).alias("selections_md5"))


QUERIES["delta_view"] = changed_views
SQL["delta_view"] = f"""{GRAPH_SQL},
live AS (SELECT sample_id, owner, cid FROM all_rules WHERE NOT ends_with(cid, '1') AND sample_id IN (SELECT doc_id FROM paras) UNION ALL SELECT sample_id, owner, cid FROM alts WHERE NOT ends_with(cid, '1')),
sides AS (SELECT c.sample_id, c.block_id, merge_point, (SELECT count(*) FROM live l WHERE l.sample_id = c.sample_id AND l.owner = c.block_id) AS n_real,
  (SELECT count(*) FROM live l JOIN alts a ON a.sample_id = l.sample_id AND a.cid = l.cid WHERE a.sample_id = c.sample_id AND a.block_id = c.block_id) AS n_alt FROM choices c),
told AS (SELECT * FROM sides WHERE n_real > 0 OR n_alt > 0),
kept AS (SELECT sample_id, owner AS block_id FROM live WHERE owner IS NOT NULL UNION SELECT sample_id, block_id FROM told UNION SELECT sample_id, merge_point FROM told WHERE merge_point IS NOT NULL
  UNION SELECT sample_id, owner FROM alts WHERE (sample_id, block_id) IN (SELECT (sample_id, block_id) FROM told)),
lists AS (SELECT 'b' AS k, sample_id, block_id AS x FROM kept UNION ALL SELECT 'r', sample_id, cid FROM live UNION ALL SELECT 's', sample_id, concat_ws(':', 'SEL_' || block_id, n_real, n_alt) FROM told),
every_doc AS (SELECT DISTINCT doc_id AS sample_id FROM paras)
SELECT sample_id, md5(coalesce(string_agg(x, ',' ORDER BY x) FILTER (WHERE k = 'b'), '')) AS blocks_md5, md5(coalesce(string_agg(x, ',' ORDER BY x) FILTER (WHERE k = 'r'), '')) AS rules_md5,
  md5(coalesce(string_agg(x, ',' ORDER BY x) FILTER (WHERE k = 's'), '')) AS selections_md5 FROM every_doc LEFT JOIN lists USING (sample_id) GROUP BY sample_id"""


from rulegrove.plans import mermaid as MM  # noqa: E402

QUERIES["mermaid"] = lambda spark, d: MM.render_mermaid(document_graphs(spark, d)).select("sample_id", F.md5("mermaid").alias("mermaid_md5"))


def removed_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mined block rules less those of a removal list (here: each block's first)."""
    rules = document_rules(spark, sf_dir).filter("owner IS NOT NULL")
    return A.without(rules, rules.filter(F.col("cid").endswith("_C1")).select("sample_id", "cid")).select("sample_id", "owner", "cid")


QUERIES["remove_cids"] = removed_rules
SQL["remove_cids"] = f"{RULES_SQL} SELECT sample_id, owner, cid FROM all_rules WHERE owner IS NOT NULL AND NOT ends_with(cid, '_C1')"


def renumbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Global candidates re-keyed G1..Gn in order of position."""
    w = Window.partitionBy("doc_id").orderBy("pos")
    return global_rules(spark, sf_dir).select("doc_id", F.concat(F.lit("G"), F.row_number().over(w)).alias("cid"), "check")


QUERIES["renumber_ids"] = renumbered
SQL["renumber_ids"] = f"""{GLOBAL_SQL} SELECT doc_id, 'G' || row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS cid, "check" FROM candidates"""
