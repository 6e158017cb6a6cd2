"""Samples from surveys: ids, instructions in two languages, answers, evidence, introduction variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rulegrove.functions import text as X
from rulegrove.functions.dialect import SPARK as D
from rulegrove.operators import evidence as E

# The lines of an instruction, by language; {} is filled in order.
EN = (
    'Please produce a multi-angle research survey report on: "{title}".', "", "Requirements:",
    "1. Cover background, core problems, methods, key findings, controversies/limitations, and future directions.",
    "2. Organize the report into at least {sections} titled sections.", "3. {cite}", "4. Cite at least {refs} distinct sources.",
    '5. End with a dedicated section: "Research Gaps and Next Questions".', "", "Topic context:", "- Title: {title}", "- Fields: {fields}", "- Keywords: {keywords}", "- Abstract: {abstract}",
)
ZH = (
    "请围绕“{title}”完成一份多角度研究综述报告。", "", "任务要求：", "1. 结合背景、核心问题、方法路线、关键发现、争议与局限、未来方向进行系统性调研。",
    "2. 至少使用 {sections} 个结构化小节组织内容，并给出清晰标题。", "3. {cite}", "4. 至少引用 {refs} 条不同文献来源。",
    "5. 结尾单独给出“研究空白与后续议题”。", "", "题目信息：", "- 标题：{title}", "- 学科：{fields}", "- 关键词：{keywords}", "- 摘要：{abstract}",
)
#: Fixed values by language: defaults of title, fields, keywords and abstract, length of the abstract, how to cite (by reference id, or in the text).
WORDING = {
    "en": (EN, "Untitled topic", "Unknown", "N/A", "N/A", 900, ", ", "Use citation ref_ids from evidence.json (for example [b12]) for evidence-backed claims.", "Use inline citations (for example [1] or (Author, Year)) and keep them aligned with evidence.json."),
    "zh": (ZH, "未命名主题", "未知", "无", "无", 700, "、", "引用请使用 evidence.json 里的 ref_id（如 [b12]），并尽量在关键结论后给出引用。", "请为关键结论附上文内引用（如 [1] 或 (Author, Year)），并确保可在 evidence.json 对齐来源。"),
}
#: The seed of an introduction, and the variants that are made of it.
SEED = ('Please write a rigorous Introduction section for a survey on "', '". The introduction should establish background, explain motivation, summarize key technical directions, and ground claims with literature evidence.\n')
VARIANTS = (("explicit", "whole"), ("explicit", "section"), ("abstract", "whole"), ("abstract", "section"))


def keywords(meta: str = "metadata", most: int = 8) -> Column:
    """The first distinct keywords, then topics."""
    both = f"concat(coalesce({meta}.keywords, array()), coalesce({meta}.topics, array()))"
    return F.expr(f"slice(array_distinct(filter(transform({both}, x -> trim(coalesce(x, ''))), x -> x <> '')), 1, {most})")


def sample_ids(surveys: DataFrame, prefix: str, number: str) -> DataFrame:
    """surveys with sample_id: prefix and corpusId, or prefix and the five-digit number where there is none."""
    corpus = F.trim(F.coalesce("corpusId", F.lit("")))
    padded = F.when(F.length(F.col(number).cast("string")) >= 5, F.col(number).cast("string")).otherwise(F.lpad(F.col(number).cast("string"), 5, "0"))
    return surveys.withColumn("sample_id", F.concat(F.lit(prefix), F.when(corpus != "", corpus).otherwise(padded)))


def instruction(lang: str, sections: str, refs: str, inline: bool = True, meta: str = "metadata") -> Column:
    """The instruction text of a survey; sections and refs are SQL of its numbers of sections and sources."""
    lines, title, fields, kws, abstract, most, sep, by_id, by_text = WORDING[lang]
    told = lambda c, default: F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(default))
    clean = F.expr(f"filter(transform(coalesce({meta}.fieldsOfStudy, array()), x -> trim(coalesce(x, ''))), x -> x <> '')")
    words = keywords(meta)
    values = {
        "title": told(F.col(f"{meta}.title"), title),
        "sections": F.expr(f"CAST(greatest(4, least({sections}, 12)) AS STRING)"),
        "cite": F.lit(by_id if inline else by_text),
        "refs": F.expr(f"CAST({refs} AS STRING)"),
        "fields": told(F.array_join(clean, ", "), fields),
        "keywords": told(F.array_join(words, sep), kws),
        "abstract": told(F.expr(X.clipped_dots(D, f"trim(coalesce({meta}.abstract, ''))", most)), abstract),
    }
    parts: list[Column] = []
    for piece in "\n".join(lines).replace("{", "\x00{").replace("}", "}\x00").split("\x00"):
        if piece:
            parts.append(values[piece[1:-1]] if piece[0] == "{" else F.lit(piece))
    return F.concat(*parts, F.lit("\n"))


def seed_instruction(meta: str = "metadata") -> Column:
    return F.concat(F.lit(SEED[0]), F.coalesce(F.nullif(F.trim(f"{meta}.title"), F.lit("")), F.lit("Untitled Topic")), F.lit(SEED[1]))


def least_refs(n: str) -> str:
    """SQL of how many distinct sources are asked for, of n."""
    return f"greatest(1, least({n}, greatest(3, least(12, CAST(bround({n} * 0.12) AS INT)))))"


def samples(surveys: DataFrame, *, prefix: str = "surveygen_", start: int = 0, limit: int = -1, lang: str = "en", inline: bool = True, order: str = "corpusId") -> DataFrame:
    """sample_id, instruction, answer, n_refs for a stretch of the surveys in order of `order`.

    Surveys whose answer is empty are left out. Numbers come from one ordered window over the keys
    alone; texts join on them.
    """
    keys = surveys.select(order).distinct().withColumn("_n", F.row_number().over(Window.orderBy(order)) - 1).filter(F.col("_n") >= start)
    keys = keys.filter(F.col("_n") < start + limit) if limit >= 0 else keys
    rows = sample_ids(surveys.join(keys, order), prefix, "_n").withColumn("_refs", F.expr("CAST(size(coalesce(references, array())) AS INT)")).withColumn("_sections", F.expr("CAST(size(coalesce(sections, array())) AS INT)"))
    told = rows.select("corpusId", "sample_id", "_refs", instruction(lang, "_sections", least_refs("_refs"), inline).alias("instruction"))
    answers = E.answers(surveys, inline).withColumnRenamed("text", "answer").filter(F.trim("answer") != "")
    return told.join(answers, "corpusId").select("sample_id", "corpusId", "instruction", "answer", F.col("_refs").alias("n_refs"))


def introductions(surveys: DataFrame) -> DataFrame:
    """Four rows a survey with an introduction: sample_id, variant, knowledge_style, granularity, instruction, answer.

    References given explicitly are listed after the rewrite, others inside the guarded prompt; whole
    introductions are segmented by headings, others by the model.
    """
    intro = E.intro_sections(surveys)
    answers = E.answers(intro).filter(F.trim("text") != "").select("corpusId", F.col("text").alias("answer"))
    rows = intro.select("corpusId", seed_instruction().alias("instruction")).join(answers, "corpusId")
    four = F.array(*[F.struct(F.lit(f"{a}_{b}").alias("variant"), F.lit(a).alias("knowledge_style"), F.lit(b).alias("granularity")) for a, b in VARIANTS])
    out = rows.select("corpusId", "instruction", "answer", F.explode(four).alias("v")).select("corpusId", "v.*", "instruction", "answer")
    name = F.concat(F.lit("surveygen_"), "corpusId", F.lit("__intro_"), "variant")
    strategy = F.when(F.col("knowledge_style") == "explicit", "postfix_after_step8").otherwise("in_prompt_guarded")
    mode = F.when(F.col("granularity") == "section", "llm").otherwise("heading")
    return out.select(name.alias("sample_id"), "*", strategy.alias("reference_strategy"), mode.alias("block_mode"))
