"""Scoring of answers against evaluation items.

items: sample_id, section (global, block or branch), block_id, sid, branch (real or alt), pos, cid,
check, args (JSON text), priority_level. answers: sample_id, text. Each item is checked against the
whole answer. Level 1 is best effort, anything else mandatory; rates are means of non-null verdicts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulegrove.functions.checks import verdict_sql


def verdicts(answers: DataFrame, items: DataFrame, *, judged: str | None = None, aliases: bool = False) -> DataFrame:
    """items with `passed`; an item without a check, or of a sample without an answer, is null.

    judged: name of a boolean column of items with the judges' verdicts (false without one).
    """
    texts = answers.select("sample_id", F.col("text").alias("_text"))
    joined = items.join(texts, "sample_id", "left").withColumn("_args", F.expr("try_parse_json(coalesce(args, '{}'))"))
    passed = verdict_sql("_text", "check", "_args", judged or "false", aliases)
    return joined.withColumn("passed", F.expr(passed)).drop("_text", "_args")


def mandatory() -> Column:
    return ~F.coalesce(F.col("priority_level") == 1, F.lit(False))


def rate(kind: Column, where: Column | None = None) -> Column:
    value = F.when(kind if where is None else kind & where, F.col("passed").cast("double"))
    return F.avg(value)


def branch_choice(checked: DataFrame) -> DataFrame:
    """Per sample and selection: the two mandatory rates and the branch that the answer follows.

    The higher mandatory rate wins, ties to real; a side without one loses; without both the best
    effort rates decide likewise; without any the choice is undecided.
    """
    real, alt = F.col("branch") == "real", F.col("branch") == "alt"
    per = checked.filter("section = 'branch'").groupBy("sample_id", "sid").agg(
        rate(mandatory(), real).alias("score_branch_real"),
        rate(mandatory(), alt).alias("score_branch_alt"),
        rate(~mandatory(), real).alias("_real"),
        rate(~mandatory(), alt).alias("_alt"),
    )
    pick = lambda a, b, rest: F.expr(
        f"CASE WHEN {a} IS NULL AND {b} IS NULL THEN {rest} WHEN {b} IS NULL THEN 'branch_real' WHEN {a} IS NULL THEN 'branch_alt'"
        f" WHEN {a} >= {b} THEN 'branch_real' ELSE 'branch_alt' END"
    )
    last = "CASE WHEN _real IS NULL AND _alt IS NULL THEN 'undecided' WHEN _alt IS NULL THEN 'branch_real' WHEN _real IS NULL THEN 'branch_alt' WHEN _real >= _alt THEN 'branch_real' ELSE 'branch_alt' END"
    return per.withColumn("chosen", pick("score_branch_real", "score_branch_alt", last)).drop("_real", "_alt")


def summary(checked: DataFrame, choice: DataFrame | None = None) -> DataFrame:
    """Per sample: global, block, branch, overall and best-effort rates.

    Only the chosen branch of a selection counts, both if undecided. Overall is the plain mean of
    the scope rates that exist.
    """
    choice = branch_choice(checked) if choice is None else choice
    chosen = choice.select("sample_id", "sid", "chosen")
    counted = checked.join(chosen, ["sample_id", "sid"], "left").filter(
        "section <> 'branch' OR chosen = 'undecided' OR chosen = concat('branch_', branch)"
    )
    scope = {s: F.col("section") == s for s in ("global", "block", "branch")}
    per = counted.groupBy("sample_id").agg(
        *[rate(mandatory(), c).alias(f"{s}_pass_rate") for s, c in scope.items()],
        *[rate(~mandatory(), c).alias(f"_{s}") for s, c in scope.items()],
    )
    mean = lambda cols: F.expr(
        f"aggregate(filter(array({cols}), x -> x IS NOT NULL), named_struct('s', 0D, 'n', 0), (a, x) -> named_struct('s', a.s + x, 'n', a.n + 1), a -> IF(a.n = 0, NULL, a.s / a.n))"
    )
    return per.withColumn("overall_pass_rate", mean("global_pass_rate, block_pass_rate, branch_pass_rate")).withColumn("best_effort_rate", mean("_global, _block, _branch")).drop("_global", "_block", "_branch")


def score(answers: DataFrame, items: DataFrame, **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(verdicts, branch choices, summaries)."""
    checked = verdicts(answers, items, **options)
    choice = branch_choice(checked)
    return checked, choice, summary(checked, choice)
