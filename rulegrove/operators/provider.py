"""Text models: a provider interface, judged rules, validated rewrites and call accounting.

Without a provider everything falls back: judges are false, rewrites keep the original.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rulegrove.functions import text as X
from rulegrove.functions.checks import JUDGES
from rulegrove.functions.dialect import SPARK as D

#: A provider maps a prompt to a reply and may raise; it is made once per task.
Provider = Callable[[str], str]

CALLS = "reply string, success boolean, attempts integer, duration_sec double, error string"


def ask(prompts: DataFrame, prompt: str, make: Callable[[], Provider] | None, *, retries: int = 2, backoff: float = 0.8, skip_null: bool = False) -> DataFrame:
    """prompts with reply, success, attempts, duration_sec and error; the reply is empty after failure.

    skip_null: rows without a prompt are not asked; their success is null.
    """
    if make is None:
        none = {"reply": F.lit(""), "success": F.lit(False), "attempts": F.lit(0), "duration_sec": F.lit(0.0), "error": F.lit("no provider")}
        return prompts.withColumns(none)
    columns = prompts.columns
    at = columns.index(prompt)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make()
        for b in batches:
            rows = []
            for cell in b.column(at):
                if skip_null and not cell.is_valid:
                    rows.append(("", None, 0, 0.0, None))
                    continue
                began, error, reply, n = time.time(), None, "", 0
                for n in range(1, retries + 2):
                    try:
                        reply, error = model(cell.as_py() or ""), None
                        break
                    except Exception as e:  # a provider's failure is data
                        error = str(e)
                        if n <= retries:
                            time.sleep(backoff * n)
                rows.append((reply, error is None, n, time.time() - began, error))
            cols = list(zip(*rows)) or [()] * 5
            types = (pa.string(), pa.bool_(), pa.int32(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(c, t) for c, t in zip(cols, types)]], names=[*columns, "reply", "success", "attempts", "duration_sec", "error"])

    schema = T.StructType(list(prompts.schema.fields))
    for field in CALLS.split(", "):
        schema = schema.add(*field.split())
    return prompts.mapInArrow(run, schema)


#: What each judge is asked; the answers are those that JUDGES accepts or their opposites.
QUESTIONS = {
    "tone_neutral_llm_judge": "Is the text written in a neutral, balanced tone, without praise, blame or emotion? Answer with one word: NEUTRAL or NOT_NEUTRAL.",
    "tone_negative_llm_judge": "Is the text openly critical or negative about its subject? Answer with one word: YES or NO.",
    "role_consistency_judge": "Does the text keep to one speaker's role and point of view from beginning to end? Answer with one word: MATCH or MISMATCH.",
    "actionability_judge": "Does the text propose concrete steps that a reader could take? Answer with one word: YES or NO.",
    "non_extremeness_judge": "Is the text free of extreme, inflammatory or absolute claims? Answer with one word: SAFE or UNSAFE.",
}


def judged(items: DataFrame, make: Callable[[], Provider] | None) -> DataFrame:
    """Judge items(…, check, text) with `judged`: whether the reply's first line begins with the check's label."""
    label = F.create_map(*[F.lit(x) for kv in JUDGES.items() for x in kv])
    question = F.create_map(*[F.lit(x) for kv in QUESTIONS.items() for x in kv])[F.col("check")]
    prompt = F.concat(F.coalesce(question, F.lit("Does the text meet the rule? Answer YES or NO.")), F.lit("\n\nTEXT:\n<<<\n"), F.coalesce("text", F.lit("")), F.lit("\n>>>"))
    replies = ask(items.withColumn("_prompt", prompt), "_prompt", make)
    first = F.upper(F.trim(F.substring_index("reply", "\n", 1)))
    return replies.withColumn("judged", F.coalesce((first != "") & F.startswith(first, label[F.col("check")]), F.lit(False))).drop("_prompt", "reply", "success", "attempts", "duration_sec", "error")


def status(calls: DataFrame, *keys: str) -> DataFrame:
    """Per key: number of calls and no-llm, success (all succeeded) or failed."""
    per = calls.groupBy(*keys).agg(F.count("success").alias("calls"), F.bool_and("success").alias("_all"))
    return per.withColumn("status", F.when(F.col("calls") == 0, "no-llm").when(F.col("_all"), "success").otherwise("failed")).drop("_all")


#: Least share of words that a rewrite keeps, by the original's size.
FLOORS = {"polish": ((800, 0.18), (400, 0.22), (200, 0.26), (120, 0.32), (0, 0.38))}


def rewrite_reason(d, old: str, new: str, share: float = 0.12, hits: int = 3) -> str:
    """SQL: ok, too_short or coverage, for a rewrite of a text."""
    n_old, n_new = X.words(d, old), X.words(d, new)
    floor = "CASE " + " ".join(f"WHEN {n_old} >= {n} THEN {f}" for n, f in FLOORS["polish"]) + " END"
    both = d.shared(X.tokens(d, old), X.tokens(d, new))
    size = d.size(X.tokens(d, old))
    return (
        f"CASE WHEN {n_old} > 0 AND CAST({n_new} AS DOUBLE) / {n_old} < {floor} THEN 'too_short'"
        f" WHEN {size} > 0 AND (CAST({both} AS DOUBLE) / {size} < {share} OR {both} < least({hits}, {size})) THEN 'coverage' ELSE 'ok' END"
    )


def guarded_references(prompts: DataFrame) -> DataFrame:
    """prompts(raw, polished, refs array of struct(title, url)) with `prompt` and `missing`: the polished
    text if it holds every title and link, else the raw one."""
    missing = F.expr("filter(flatten(transform(refs, r -> array(r.title, r.url))), x -> coalesce(x, '') <> '' AND NOT contains(polished, x))")
    return prompts.withColumn("missing", missing).withColumn("prompt", F.when(F.size("missing") > 0, F.col("raw")).otherwise(F.col("polished")))


def first_json(text: str | None) -> str | None:
    """First balanced object, or else array, in a text; braces inside strings count as well."""
    for opener, closer in ("{}", "[]"):
        depth, start = 0, -1
        for i, c in enumerate(text or ""):
            if c == opener:
                start, depth = (i if depth == 0 else start), depth + 1
            elif c == closer and depth:
                depth -= 1
                if depth == 0:
                    return text[start : i + 1]
    return None


def loose_json(texts: DataFrame, column: str) -> DataFrame:
    """texts with `parsed`, a VARIANT: the text, its first balanced part, or that part with light repairs
    (double quotes, no trailing commas); null if none parses. Only texts that do not parse reach Python."""

    @F.arrow_udf("string")
    def candidate(column: pa.Array) -> pa.Array:
        return pa.array([first_json(t.as_py()) if t.is_valid else None for t in column], pa.string())

    found = texts.withColumn("_part", candidate(F.when(F.expr(f"try_parse_json({column}) IS NULL"), F.col(column))))
    fixed = D.replace_all("replace(coalesce(_part, " + column + "), chr(39), chr(34))", r",\s*([}\]])", "$1")
    return found.withColumn("parsed", F.expr(f"coalesce(try_parse_json({column}), try_parse_json(_part), try_parse_json({fixed}))")).drop("_part")
