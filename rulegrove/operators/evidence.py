"""Surveys into evidence tables, answers and knowledge rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rulegrove.functions import text as X
from rulegrove.functions.dialect import SPARK as D
from rulegrove.operators.segment import VISUAL

# Fixed value: the nested survey record.
META = "struct<title:string,doi:string,url:string,pdfUrl:string,pdf_url:string,pdf:string,openAccessPdf:struct<url:string>,paperId:string,corpusId:string,citationCount:string,referenceCount:string,fieldsOfStudy:array<string>>"
SURVEY = (
    "corpusId string, metadata struct<title:string,keywords:array<string>,topics:array<string>,fieldsOfStudy:array<string>,abstract:string,year:int>,"
    " sections array<struct<index:int,title:string,paragraphs:array<struct<text:string,citations:array<struct<ref_id:string,title:string>>>>>>,"
    f" references array<struct<ref_id:string,title:string,matched_paper_id:string,referenced_works:array<string>,metadata:{META}>>"
)


def safe(col) -> F.Column:
    return F.coalesce(F.trim(F.col(col) if isinstance(col, str) else col), F.lit(""))


def pdf_url(meta: str) -> F.Column:
    """First of the known places of a link."""
    some = lambda c: F.expr(f"nullif(trim({c}), '')")
    doi = F.expr(f"IF(nullif(trim({meta}.doi), '') IS NULL, NULL, concat('https://doi.org/', trim({meta}.doi)))")
    return F.coalesce(*[some(f"{meta}.{c}") for c in ("pdfUrl", "pdf_url", "pdf", "openAccessPdf.url")], doi, some(f"{meta}.url"), F.lit(""))


def intro_sections(surveys: DataFrame) -> DataFrame:
    """Surveys reduced to their introduction: sections so titled, or else the first one."""
    named = "filter(sections, s -> regexp_like(trim(coalesce(s.title, '')), '^(?i:intro|introduction.*)$'))"
    return surveys.withColumn("sections", F.expr(f"IF(size({named}) > 0, {named}, slice(sections, 1, 1))"))


def citation_usage(surveys: DataFrame) -> DataFrame:
    """corpusId, ref_id, n (paragraphs that cite it), cited_in_sections, titles."""
    section = surveys.select("corpusId", F.explode("sections").alias("s"))
    para = section.select("corpusId", F.col("s.index").alias("section"), F.posexplode("s.paragraphs").alias("para", "p"))
    cite = para.select("corpusId", "section", "para", F.explode("p.citations").alias("c"))
    once = cite.select("corpusId", "section", "para", safe("c.ref_id").alias("ref_id"), safe("c.title").alias("title")).filter("ref_id <> ''")
    per = once.groupBy("corpusId", "section", "para", "ref_id").agg(F.max("title").alias("title"))
    return per.groupBy("corpusId", "ref_id").agg(
        F.count("*").alias("n"), F.sort_array(F.collect_set("section")).alias("cited_in_sections"), F.sort_array(F.collect_set(F.expr("nullif(title, '')"))).alias("titles")
    )


def evidence(surveys: DataFrame, usage: DataFrame | None = None, cited_only_too: bool = True) -> DataFrame:
    """Reference table: listed references with their use; cited ones without an entry have empty metadata."""
    refs = surveys.select("corpusId", F.explode("references").alias("r")).select(
        "corpusId",
        safe("r.ref_id").alias("ref_id"),
        F.coalesce(F.expr("nullif(trim(r.metadata.title), '')"), F.expr("nullif(trim(r.title), '')")).alias("title"),
        pdf_url("r.metadata").alias("pdfUrl"),
        F.expr("coalesce(try_cast(r.metadata.citationCount AS INT), 0)").alias("citationCount"),
        F.coalesce("r.referenced_works", F.array().cast("array<string>")).alias("second_level_reference_ids"),
    )
    use = citation_usage(surveys) if usage is None else usage
    joined = refs.filter("ref_id <> ''").join(use, ["corpusId", "ref_id"], "full_outer" if cited_only_too else "left")
    return joined.select(
        "corpusId",
        "ref_id",
        F.coalesce("title", F.get("titles", F.lit(0)), F.lit("")).alias("title"),
        F.coalesce("pdfUrl", F.lit("")).alias("pdfUrl"),
        F.coalesce("citationCount", F.lit(0)).alias("citationCount"),
        F.coalesce("second_level_reference_ids", F.array().cast("array<string>")).alias("second_level_reference_ids"),
        F.coalesce("n", F.lit(0)).alias("citation_count_in_survey"),
        F.coalesce("cited_in_sections", F.array().cast("array<int>")).alias("cited_in_sections"),
    )


def answers(surveys: DataFrame, inline: bool = True, most: int = 0) -> DataFrame:
    """corpusId, text: headed sections in order with paragraphs and, inline, their distinct reference marks."""
    marks = "array_distinct(filter(transform(coalesce(p.citations, array()), c -> trim(coalesce(c.ref_id, ''))), x -> x <> ''))"
    shown = f"slice({marks}, 1, {most})" if most > 0 else marks
    body = f"trim(concat({X.squeezed(D, 'p.text')}, IF(size({shown}) = 0, '', concat(' ', array_join(transform({shown}, x -> concat('[', x, ']')), ' ')))))" if inline else X.squeezed(D, "p.text")
    paras = f"filter(transform(s.paragraphs, p -> {body}), x -> x <> '')"
    fine = f"NOT regexp_like(coalesce(s.title, ''), r'{VISUAL}') AND regexp_like(coalesce(s.title, ''), '[A-Za-z0-9]')"
    ordered = "array_sort(sections, (a, b) -> CASE WHEN a.index <> b.index THEN a.index - b.index WHEN a.title < b.title THEN -1 WHEN a.title > b.title THEN 1 ELSE 0 END)"
    told = f"transform(filter({ordered}, s -> {fine} AND size({paras}) > 0), s -> concat('## ', trim(s.title), '\\n\\n', array_join({paras}, '\\n\\n')))"
    return surveys.select("corpusId", F.expr(f"array_join({told}, '\\n\\n')").alias("text"))


def core_keywords(meta: str = "metadata", most: int = 4) -> F.Column:
    """First distinct keywords, topics and fields; else words of the title."""
    listed = f"array_distinct(filter(transform(concat(coalesce({meta}.keywords, array()), coalesce({meta}.topics, array()), coalesce({meta}.fieldsOfStudy, array())), x -> trim(x)), x -> x <> ''))"
    title = f"array_distinct(filter(regexp_extract_all(coalesce({meta}.title, ''), '[A-Za-z][A-Za-z0-9-]+', 0), x -> length(x) >= 3 AND NOT array_contains(array({', '.join(repr(w) for w in X.STOPWORDS)}), lower(x))))"
    return F.expr(f"slice(IF(size({listed}) > 0, {listed}, {title}), 1, {most})")


def high_impact(refs: DataFrame, key: str = "corpusId", k: int = 12) -> DataFrame:
    """The k most cited references of each survey, by count and then id, both falling."""
    w = Window.partitionBy(key).orderBy(F.desc("citationCount"), F.desc("ref_id"))
    return refs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def block_citations(blocks: DataFrame, refs: DataFrame) -> DataFrame:
    """sample_id, block_id, ref_id, first_block: known references that each block cites, in order.

    refs(sample_id, ref_id). first_block marks the block where a reference comes first.
    """
    found = blocks.select("sample_id", "block_id", "order_index", F.posexplode(F.expr(D.all("text_span", X.REF_CITE, 1))).alias("at", "raw"))
    once = found.groupBy("sample_id", "block_id", "order_index", F.lower("raw").alias("k")).agg(F.min("at").alias("at"))
    known = refs.select("sample_id", "ref_id", F.lower("ref_id").alias("k"))
    joined = once.join(known, ["sample_id", "k"])
    first = F.row_number().over(Window.partitionBy("sample_id", "ref_id").orderBy("order_index", "at")) == 1
    return joined.select("sample_id", "block_id", "order_index", "at", "ref_id", first.alias("first_block"))


def knowledge_rules(blocks: DataFrame, refs: DataFrame, keywords: DataFrame) -> DataFrame:
    """sample_id, owner, cid, check, args, descr of the knowledge rules.

    keywords(sample_id, kws): KG1 asks for the first three; KG2, from three cited sources on, for high
    impact ones; K2 of a block for its own sources; the coverage rule for all cited ones.
    """
    ids = lambda xs: F.concat(F.lit('{"allowed_ref_ids": ["'), F.array_join(xs, '", "'), F.lit('"], "min_unique": '))
    kg1 = keywords.filter(F.size("kws") > 0).select(
        "sample_id", F.lit(None).cast("string").alias("owner"), F.lit("KG1").alias("cid"), F.lit("must_cover_topics").alias("check"),
        F.concat(F.lit('{"topics": ["'), F.array_join(F.slice("kws", 1, 3), '", "'), F.lit('"]}')).alias("args"),
        F.concat(F.lit("Anchor the survey to core domain concepts and explicitly cover: "), F.array_join(F.slice("kws", 1, 3), ", "), F.lit(".")).alias("descr"),
    )
    top = high_impact(refs, "sample_id").groupBy("sample_id").agg(F.sort_array(F.collect_list("ref_id")).alias("ids")).filter(F.size("ids") >= 3)
    tail = lambda n: F.concat(n, F.lit(', "max_out_of_set": 999}'))
    kg2 = top.select("sample_id", F.lit(None).cast("string").alias("owner"), F.lit("KG2").alias("cid"), F.lit("citation_refs_from_allowed_set").alias("check"), F.concat(ids("ids"), tail(F.least(F.lit(3), F.size("ids")).cast("string"))).alias("args"), F.lit("Cite high-impact sources of the evidence set.").alias("descr"))
    cited = block_citations(blocks, refs)
    own = cited.groupBy("sample_id", "block_id").agg(F.expr("transform(array_sort(collect_list(struct(at, ref_id))), x -> x.ref_id)").alias("ids"))
    k2 = own.select("sample_id", F.col("block_id").alias("owner"), F.concat("block_id", F.lit("_K2")).alias("cid"), F.lit("citation_refs_from_allowed_set").alias("check"), F.concat(ids("ids"), tail(F.lit("1"))).alias("args"), F.lit("Ground this block in its own sources.").alias("descr"))
    every = cited.groupBy("sample_id").agg(F.sort_array(F.collect_set("ref_id")).alias("ids"))
    kc = every.select("sample_id", F.lit(None).cast("string").alias("owner"), F.lit("KC").alias("cid"), F.lit("citation_refs_from_allowed_set").alias("check"), F.concat(ids("ids"), tail(F.size("ids").cast("string"))).alias("args"), F.lit("Cover all sources that the exemplar cites.").alias("descr"))
    return kg1.unionByName(kg2).unionByName(k2).unionByName(kc)
