"""Rewrites of prompts by a text model: what must survive, styles, reference lists, polish and variants.

Sections and validations are column expressions; only the model itself runs in Python workers. The
wording of the instructions to the model is this module's own, the style profiles are fixed values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulegrove.functions import text as X
from rulegrove.functions.dialect import SPARK as D
from rulegrove.operators import parsing
from rulegrove.operators.provider import FLOORS, Provider, ask

# Headings that begin the sections of a prompt, any case.
HEADINGS = {
    "mission": ("1. MISSION BRIEF", "1. MISSION BRIEF & DELIVERABLE", "1. TASK BRIEF", "1. SURVEY TASK BRIEF", "SURVEY TASK BRIEF"),
    "global": (
        "2. NON-NEGOTIABLE GLOBAL RULES", "2. SURVEY-LEVEL CONSTRAINTS", "SURVEY-LEVEL CONSTRAINTS", "2. CONSTRAINT SUMMARY (BY TYPE)",
        "2. CONSTRAINT SUMMARY (BY PRIORITY)", "2. CONSTRAINT SUMMARY BY TYPE", "2. CONSTRAINT SUMMARY BY PRIORITY",
    ),
    "blueprint": ("3. STRUCTURED RESPONSE BLUEPRINT", "3. SECTION-BY-SECTION SYNTHESIS PLAN", "SECTION-BY-SECTION SYNTHESIS PLAN", "3. RESPONSE BLUEPRINT", "3. RESPONSE BLUEPRINT & REMAINING RULES"),
    "conditions": ("4. CURRENT CONDITION ASSUMPTION", "4. DEFAULT CONDITION ASSUMPTION", "4. DEFAULT BRANCH ASSUMPTIONS", "DEFAULT BRANCH ASSUMPTIONS"),
}
#: The headings that variants know, in this case only.
EXACT = {"mission": "1. MISSION BRIEF", "global": "2. NON-NEGOTIABLE GLOBAL RULES", "blueprint": "3. STRUCTURED RESPONSE BLUEPRINT", "conditions": "4. CURRENT CONDITION ASSUMPTION"}
#: Least share of a section's words in a rewrite, and least number of them.
COVERAGE = {"mission": (0.12, 3), "global": (0.10, 4), "blueprint": (0.04, 6), "conditions": (0.07, 2)}
VARIANT_COVERAGE = {"mission": (0.18, 4), "global": (0.14, 5), "blueprint": (0.05, 8), "conditions": (0.10, 3)}
SECTION = "array<struct<name:string,body:string>>"

# Style profiles (label, voice, length, two structures), in this order.
STYLES = {
    "briefing": (
        "Mission briefing", "authoritative, concise, directive", "3-5 short paragraphs",
        "Open with the mission and deliverable, then state global rules, then walk the stages in order, and end with the default assumptions.",
        "Start with the desired outcome, then the non-negotiable rules, then the stage duties, and conclude with default condition assumptions.",
    ),
    "collaborative": (
        "Collaborative request", "cooperative, clear, pragmatic", "4-6 paragraphs",
        "Open with a brief request and mission, then explain the global rules, then describe each stage duty in sequence, and finish with the default assumptions.",
        "Start with the mission and context, then summarize constraints, then walk through the staged obligations, and end with condition assumptions.",
    ),
    "question_led": (
        "Question-led request", "inquisitive but still directive", "3-5 paragraphs",
        "Lead with a question about the mission, then answer it by stating constraints, then cover the stage duties in order, and conclude with default assumptions.",
        "Open with a short question or request, then lay out global rules, then the staged duties, then the default assumptions.",
    ),
    "constraints_first": (
        "Constraints first", "precise, compliance-oriented", "3-6 paragraphs",
        "Begin with non-negotiable global rules, then restate the mission, then walk the stages in order, then close with default assumptions.",
        "Open with the constraints, follow with the mission, then the stage duties, and end with condition assumptions.",
    ),
    "outcome_first": (
        "Outcome first", "results-driven, practical", "3-6 paragraphs",
        "Start with the desired output and acceptance expectations, then the mission, then the global rules, then the staged duties, and end with default assumptions.",
        "Lead with the target deliverable, then state constraints, then walk through stages in order, and finish with default assumptions.",
    ),
    "narrative": (
        "Narrative walkthrough", "story-like but still precise", "4-7 paragraphs",
        "Introduce the mission as a scenario, weave in global rules, then narrate the stages in order, and conclude with default assumptions.",
        "Open with a brief scenario for the mission, then present the constraints, then the stages, and end with default assumptions.",
    ),
}


def _cut(found: str, text: str) -> str:
    """SQL: sections from the sorted array of struct(at, name); each ends where the next begins."""
    end = f"coalesce(get(_p, i + 1).at, length({text}) + 1)"
    return f"transform(array({found}), _p -> transform(_p, (p, i) -> named_struct('name', p.name, 'body', {X.strip(D, f'substring({text}, p.at, {end} - p.at)')})))[0]"


def sections(text: str) -> Column:
    """array of struct(name, body): from each section's first heading to the next one's.

    Without any heading the first four numbered lines begin the sections.
    """
    low = f"lower({text})"
    at = lambda hs: "array_min(filter(array(" + ", ".join(f"instr({low}, '{h.lower()}')" for h in hs) + "), a -> a > 0))"
    named = ", ".join(f"named_struct('at', {at(hs)}, 'name', '{n}')" for n, hs in HEADINGS.items())
    found = f"array_sort(filter(array({named}), s -> s.at IS NOT NULL))"
    # places of numbered lines: the lengths of what stands before them
    rows = f"split({text}, '\\n')"
    starts = f"transform({rows}, (l, i) -> named_struct('at', 1 + i + length(array_join(slice({rows}, 1, i), '')), 'l', l))"
    numbered = f"slice(filter({starts}, s -> regexp_like(s.l, '^\\\\s*[0-9]+\\\\.\\\\s+[^\\\\n]+')), 1, 4)"
    names = "array(" + ", ".join(f"'{n}'" for n in HEADINGS) + ")"
    fallback = f"transform({numbered}, (s, i) -> named_struct('at', CAST(s.at AS INT), 'name', get({names}, i)))"
    return F.expr(_cut(f"transform(array({found}), f -> IF(size(f) > 0, f, {fallback}))[0]", text))


def exact_sections(text: str) -> Column:
    named = ", ".join(f"named_struct('at', instr({text}, '{h}'), 'name', '{n}')" for n, h in EXACT.items())
    return F.expr(_cut(f"array_sort(filter(array({named}), s -> s.at > 0))", text))


def marked_up(text: str) -> str:
    """SQL: whether a line is a heading, a bullet or a numbered item."""
    return D.has(text, r"(?m)^[ \t]*(#{1,6}|[-*]|[0-9]+[.)])[ \t]+[^\s]")


def failure(old: str, new: str, parts: str, rules: dict[str, tuple[float, int]], lists: bool = True) -> Column:
    """Why a rewrite does not do; empty if it does.

    parts: the old text's sections. Codes: empty_output, disallowed_formatting (unless lists are
    allowed), length_ratio(a<b), coverage_missing(section:ratio|hits/...).
    """
    n_old, n_new = D.size(D.all(old, r"\S+")), D.size(D.all(new, r"\S+"))
    floor = "CASE " + " ".join(f"WHEN {n_old} >= {n} THEN {f}D" for n, f in FLOORS["polish"]) + " END"
    share = f"CAST({n_new} AS DOUBLE) / {n_old}"
    own = X.tokens(D, "s.body")
    hits = f"size(array_intersect({own}, _new))"
    ratio = f"IF(size({own}) = 0, 1D, {hits} / CAST(size({own}) AS DOUBLE))"
    need = lambda i, default: "CASE s.name " + " ".join(f"WHEN '{k}' THEN {v[i]}" for k, v in rules.items()) + f" ELSE {default} END"
    missing = f"transform(filter({parts}, s -> {hits} < {need(1, 3)} OR {ratio} < {need(0, 0.08)}), s -> concat(s.name, ':', format_number({ratio}, '0.00'), '|', {hits}))"
    told = f"transform(array({X.tokens(D, new)}), _new -> {missing})[0]"
    return F.expr(
        f"CASE WHEN {X.strip(D, new)} = '' THEN 'empty_output'"
        + ("" if lists else f" WHEN {marked_up(new)} THEN 'disallowed_formatting'")
        + f" WHEN {n_old} > 0 AND {share} < {floor} THEN concat('length_ratio(', format_number({share}, '0.00'), '<', format_number({floor}, '0.00'), ')')"
        f" WHEN size({told}) > 0 THEN concat('coverage_missing(', array_join({told}, '/'), ')') ELSE '' END"
    )


# ---- reference lists -----------------------------------------------------------------------------

#: The line that begins a list of references, and what stands for it.
LIST_HEAD = "- Required evidence references"
LIST_NOTE = "   - Use the fixed reference list provided at the end of this instruction."


def cut_references(text: str) -> Column:
    """struct(text, removed_lines, replaced_header): a prompt without its bulleted list of references."""
    lines = f"split(regexp_replace({text}, '\\n$', ''), '\\n')"
    head = f"startswith(trim(l), '{LIST_HEAD}')"
    skip = "a.inside AND (startswith(trim(l), '•') OR trim(l) = '')"
    step = (
        f"CASE WHEN NOT a.inside AND {head} THEN named_struct('out', array_append(a.out, '{LIST_NOTE}'), 'inside', true, 'n', a.n + 1, 'hit', true)"
        f" WHEN {skip} THEN named_struct('out', a.out, 'inside', true, 'n', a.n + 1, 'hit', a.hit)"
        " ELSE named_struct('out', array_append(a.out, l), 'inside', false, 'n', a.n, 'hit', a.hit) END"
    )
    start = "named_struct('out', CAST(array() AS array<string>), 'inside', false, 'n', 0, 'hit', false)"
    end = f"named_struct('text', concat({X.strip(D, chr(97) + '.lines')}, '\\n'), 'removed_lines', a.n, 'replaced_header', a.hit)"
    done = f"transform(array(named_struct('lines', array_join(a.out, '\\n'), 'n', a.n, 'hit', a.hit)), a -> {end})[0]"
    return F.expr(f"IF(coalesce({text}, '') = '', named_struct('text', coalesce({text}, ''), 'removed_lines', 0, 'replaced_header', false), aggregate({lines}, {start}, (a, l) -> {step}, a -> {done}))")


def append_references(text: str, refs: str) -> Column:
    """The prompt with refs, an array of struct(ref_id, title, url), listed after it."""
    clean = lambda c: f"trim(coalesce(r.{c}, ''))"
    line = f"concat('- ', IF({clean('ref_id')} = '', '', concat('[', {clean('ref_id')}, '] ')), coalesce(nullif({clean('title')}, ''), '(untitled)'), IF({clean('url')} = '', '', concat(' | ', {clean('url')})))"
    tail = D.replace_all(f"coalesce({text}, '')", X.SPACE + "+$", "")
    return F.expr(f"IF(size({refs}) > 0, concat({tail}, '\\n\\nReference List:\\n', array_join(transform({refs}, r -> {line}), '\\n'), '\\n'), {text})")


# ---- styles --------------------------------------------------------------------------------------


def style_pool(names: list[str] | None) -> tuple[list[str], list[str]]:
    """(known styles, once each; names that are none). Without a known one: all."""
    slug = lambda s: "_".join("".join(c if c.isascii() and c.isalnum() else " " for c in s.lower()).split())
    known = [slug(x) for x in names or []]
    return list(dict.fromkeys(x for x in known if x in STYLES)) or list(STYLES), [raw for raw, x in zip(names or [], known) if x not in STYLES]


def choose_styles(prompts: DataFrame, key: str, n: int, pool: list[str], seed: int = 0) -> DataFrame:
    """prompts with `nth` (from 1) and `style`, n rows each: without replacement, in new orders once all are used."""
    size = len(pool)
    listed = "array(" + ", ".join(f"'{p}'" for p in pool) + ")"
    shuffled = f"transform(array_sort(transform({listed}, s -> named_struct('k', md5(concat('{seed}:', {key}, ':', c, ':', s)), 's', s))), x -> x.s)"
    every = F.expr(f"slice(flatten(transform(sequence(0, {max(0, -(-n // size) - 1)}), c -> {shuffled})), 1, {max(0, n)})")
    return prompts.select("*", F.posexplode(every).alias("nth", "style")).withColumn("nth", F.col("nth") + 1)


def style_prompt(style: str = "style", key: str = "sample_id", seed_task: str = "seed_task", text: str = "machine_prompt", lists: bool = False, seed: int = 0) -> Column:
    """What a model is asked for a styled rewrite; one of the style's two structures by hash."""
    pick = lambda i: F.create_map(*[F.lit(x) for k, v in STYLES.items() for x in (k, v[i])])[F.col(style)]
    hint = F.when(F.expr(D.uniform(f"concat('{seed}:', {key}, ':', {style}, ':structure')")) < 0.5, pick(3)).otherwise(pick(4))
    form = "Short lists are allowed only where nothing else does." if lists else "Write paragraphs only: no headings, bullets, numbering or Markdown."
    rules = (
        "\nKeep every numeric threshold and every required keyword as it is.\nKeep every global rule, every stage duty and both outcomes of every condition (if ..., then ...; otherwise, ...),"
        "\nand say which outcome holds by default. Invent nothing.\n" + form + "\n\nTASK:\n"
    )
    seed_ = F.coalesce(F.nullif(F.trim(seed_task), F.lit("")), F.lit("N/A"))
    head = F.concat(F.lit("Rewrite the document as a natural request of a user.\n\nStyle: "), pick(0), F.lit("\nVoice: "), pick(1), F.lit("\nStructure: "), hint, F.lit("\nLength: "), pick(2), F.lit(rules))
    return F.concat(head, seed_, F.lit("\n\nDOCUMENT:\n<<<\n"), F.trim(text), F.lit("\n>>>\n\nReturn only the rewritten request."))


# ---- models --------------------------------------------------------------------------------------


def _attempts(rows: DataFrame, make: Callable[[], Provider] | None, judge: Callable[[str], Column], most: int, **options) -> DataFrame:
    """rows(ask, ...) with rewritten, reason, used_llm and attempts; a failed rewrite is asked for again with the reason.

    Every attempt is one pass over all rows; those that are done ask nothing.
    """
    out = rows.withColumns({"rewritten": F.lit(""), "reason": F.lit("not_run"), "used_llm": F.lit(False), "attempts": F.lit(0)})
    if make is None:
        return out
    for k in range(max(1, most)):
        again = F.when(F.lit(k) == 0, F.col("ask")).otherwise(F.concat("ask", F.lit("\n\nThe last rewrite lacked required content ("), "reason", F.lit("). State all of it.")))
        open_ = (F.col("reason") == "not_run") | F.startswith("reason", F.lit("validation_failed"))
        asked = ask(out.withColumn("_open", open_).withColumn("_ask", F.when(open_, again)).withColumnRenamed("attempts", "_before"), "_ask", make, skip_null=True, **options)
        tried = asked.withColumn("_text", F.trim(F.coalesce(parsing.without_reasoning("reply"), F.lit("")))).withColumn("_why", judge("_text"))
        reason = F.when(~F.col("success"), F.concat(F.lit("llm_error: "), F.coalesce("error", F.lit("")))).when(F.col("_why") == "", "success").otherwise(F.concat(F.lit("validation_failed:"), F.col("_why")))
        out = tried.withColumns({
            "rewritten": F.when(F.col("_open") & F.col("success") & (F.col("_why") == ""), F.col("_text")).otherwise(F.col("rewritten")),
            "reason": F.when(F.col("_open"), reason).otherwise(F.col("reason")),
            "used_llm": F.col("used_llm") | (F.col("_open") & F.col("success")),
            "attempts": F.col("_before") + F.col("_open").cast("int"),
        }).drop("_open", "_ask", "_before", "_text", "_why", "reply", "success", "error", "duration_sec")
    return out


def polish(prompts: DataFrame, make: Callable[[], Provider] | None, *, text: str = "machine_prompt", seed_task: str = "seed_task", most: int = 2, **options) -> DataFrame:
    """prompts with `prompt` (the rewrite, or the text itself), reason, used_llm and attempts.

    reason: disabled without a model, empty_prompt, success, llm_error: ... or validation_failed:...
    """
    ask_ = F.concat(
        F.lit("Rewrite the document as clear prose for a writer. Keep every rule, number, keyword, stage and condition with both outcomes; add nothing.\n\nTASK:\n"),
        F.coalesce(F.nullif(F.trim(seed_task), F.lit("")), F.lit("N/A")), F.lit("\n\nDOCUMENT:\n<<<\n"), F.trim(text), F.lit("\n>>>\n\nReturn only the rewritten document."),
    )
    rows = prompts.withColumn("ask", F.when(F.trim(F.coalesce(text, F.lit(""))) != "", ask_)).withColumn("_parts", sections(text))
    out = _attempts(rows, make, lambda new: failure(text, new, "_parts", COVERAGE), most, **options)
    empty = F.trim(F.coalesce(text, F.lit(""))) == ""
    reason = F.when(empty, "empty_prompt").when(F.lit(make is None), "disabled").otherwise(F.col("reason"))
    return out.withColumn("prompt", F.when(F.col("reason") == "success", F.col("rewritten")).otherwise(F.col(text))).withColumn("reason", reason).drop("ask", "_parts", "rewritten")


def variants(prompts: DataFrame, key: str, make: Callable[[], Provider] | None, *, n: int = 3, pool: list[str] | None = None, seed: int = 0, lists: bool = False, text: str = "machine_prompt", seed_task: str = "seed_task", most: int = 2, **options) -> DataFrame:
    """key, nth, style, variant (empty if it failed), reason, used_llm, attempts: n styled rewrites a prompt.

    Empty prompts have none, and without a model there is none at all.
    """
    known, _ = style_pool(pool)
    fine = prompts.filter(F.trim(F.coalesce(text, F.lit(""))) != "")
    rows = choose_styles(fine, key, n if make is not None else 0, known, seed)
    rows = rows.withColumn("ask", style_prompt("style", key, seed_task, text, lists, seed)).withColumn("_parts", exact_sections(text))
    out = _attempts(rows, make, lambda new: failure(text, new, "_parts", VARIANT_COVERAGE, lists), most, **options)
    return out.select(key, "nth", "style", F.col("rewritten").alias("variant"), "reason", "used_llm", "attempts")


def outcome(rows: DataFrame, *keys: str) -> DataFrame:
    """Per key of variants(): how many succeeded and whether any, all or none did."""
    good = F.count_if(F.col("reason") == "success")
    told = F.when(good == F.count("*"), "success").when(good > 0, "partial").otherwise("failed")
    return rows.groupBy(*keys).agg(F.count("*").alias("requested"), good.alias("succeeded"), told.alias("status"))
