"""Variants of rule sets: change marks over turns, priority injection, multi-turn plans, curricula,
selection plans. All draws are hash ranks, so they repeat whatever the partitioning.

rules: sample_id, owner (null: global), pos, cid, check, args, descr, priority_level.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rulegrove.functions.dialect import SPARK as D

SEED = 11


def draw(*parts: str, seed: int = SEED) -> Column:
    """Uniform in [0, 1) from the parts (SQL)."""
    return F.expr(D.uniform(f"concat('{seed}:', " + ", ':', ".join(parts) + ")"))


def rank_key(*parts: str, seed: int = SEED) -> Column:
    return F.expr(f"md5(concat('{seed}:', " + ", ':', ".join(parts) + "))")


def fingerprint(*columns: str) -> Column:
    return F.sha2(F.to_json(F.struct(*[F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in columns])), 256)


def turn_changes(turns: DataFrame, sequence: str, turn: str, key: str, fp: Column, explicit: Column | None = None) -> DataFrame:
    """turns with change_type: add in the first turn or if absent in the turn before, modify if marked
    explicitly or if the fingerprint differs, else unchanged. What vanishes gets no row."""
    w = Window.partitionBy(sequence, key).orderBy(turn)
    first = F.min(turn).over(Window.partitionBy(sequence))
    marked = turns.withColumn("_fp", fp).withColumn("_first", first)
    before = F.lag(turn).over(w) == F.col(turn) - 1
    change = (
        F.when(F.col(turn) == F.col("_first"), "add")
        .when(explicit if explicit is not None else F.lit(False), "modify")
        .when(F.coalesce(~before, F.lit(True)), "add")
        .when(F.lag("_fp").over(w) != F.col("_fp"), "modify")
        .otherwise("unchanged")
    )
    return marked.withColumn("change_type", change).drop("_fp", "_first")


def inject_priorities(rules: DataFrame, least: int = 1, most: int = 2) -> DataFrame:
    """One rule of 1..2 owners per sample becomes best effort (priority 1); others are 1 or 2 as they were.

    Ranks over the sample's rows alone: one shuffle, no join.
    """
    per = Window.partitionBy("sample_id")
    place = F.dense_rank().over(per.orderBy(F.col("owner").isNull(), rank_key("sample_id", "'block'", "coalesce(owner, '')")))
    ranked = rules.withColumn("_place", F.when(F.col("owner").isNotNull(), place)).withColumn("_n", F.max("_place").over(per))
    target = F.least(F.col("_n"), least + F.floor(draw("sample_id", "'blocks'") * (most - least + 1)))
    one = Window.partitionBy("sample_id", "owner").orderBy(rank_key("sample_id", "'rule'", "cid"))
    hit = F.coalesce((F.col("_place") <= target) & (F.row_number().over(one) == 1), F.lit(False))
    marked = ranked.withColumn("_hit", hit)
    return marked.withColumn("priority_level", F.when(F.col("_hit") | (F.col("priority_level") == 1), 1).otherwise(2)).drop("_place", "_n", "_hit")


def m1_activation(rules: DataFrame) -> DataFrame:
    """rules with `activation`, the turn (1..3) from which each is told.

    Global rules: about 40, 30 and 30 per cent, each turn at least one where there are three. Block
    rules: the first at once; the second of two in turn 2 or 3 by turns over such blocks; from three
    on 1, 2, 3 and then 2 and 3 by turns.
    """
    unit = Window.partitionBy("sample_id", F.coalesce("owner", F.lit("")))
    n, r = F.count("*").over(unit), F.row_number().over(unit.orderBy(rank_key("sample_id", "'m1'", "cid")))
    marked = rules.withColumn("_n", n).withColumn("_r", r)
    # two-rule blocks take turns 2 and 3 in the order of their owners
    pair = F.when(F.col("owner").isNotNull() & (F.col("_n") == 2), F.col("owner"))
    nth = F.dense_rank().over(Window.partitionBy("sample_id").orderBy(F.asc_nulls_last("_pair")))
    marked = marked.withColumn("_pair", pair).withColumn("_turn", 2 + (nth - 1) % 2)
    c1 = F.greatest(F.lit(1), F.bround(F.col("_n") * 0.4).cast("int"))
    c2 = F.greatest(F.lit(1), F.bround(F.col("_n") * 0.3).cast("int"))
    globals_ = F.when(F.col("_n") <= 2, F.col("_r")).when(F.col("_r") <= c1, 1).when(F.col("_r") <= c1 + c2, 2).otherwise(3)
    blocks = F.when(F.col("_r") == 1, 1).when(F.col("_n") == 2, F.col("_turn")).when(F.col("_r") <= 3, F.col("_r")).otherwise(2 + (F.col("_r") % 2))
    return marked.withColumn("activation", F.when(F.col("owner").isNull(), globals_).otherwise(blocks).cast("int")).drop("_n", "_r", "_pair", "_turn")


def m1_turns(rules: DataFrame) -> DataFrame:
    """Three cumulative turns of each sample; samples whose totals do not grow every turn are left out."""
    per = Window.partitionBy("sample_id")
    active = m1_activation(rules)
    for t in (1, 2, 3):
        active = active.withColumn(f"_t{t}", F.max((F.col("activation") == t).cast("int")).over(per))
    fine = active.filter("_t1 = 1 AND _t2 = 1 AND _t3 = 1").drop("_t1", "_t2", "_t3")
    return fine.withColumn("turn", F.explode(F.sequence(F.col("activation"), F.lit(3))))


#: Growth bands of numeric arguments, by check: (upper limit of the base, low, high).
BANDS = {
    "min_word_count": (("min_words",), ((80, 0.5, 1.8), (200, 0.3, 1.2), (None, 0.2, 0.8))),
    "min_numbered_items": (("n", "min_items"), ((3, 0.5, 2.5), (6, 0.4, 1.6), (10, 0.3, 1.0), (None, 0.2, 0.6))),
    "must_list_n_subpoints": (("n", "min_items"), ((3, 0.5, 2.5), (6, 0.4, 1.6), (10, 0.3, 1.0), (None, 0.2, 0.6))),
    "min_paragraphs": (("min_paras",), ((None, 0.5, 1.5),)),
}


def mutated_value(check: str, base: str, u: str) -> str:
    """SQL of the tightened integer; null where the check has no bands."""
    cases = []
    for name, (_, bands) in BANDS.items():
        steps = " ".join(f"WHEN {base} <= {limit} THEN {lo} + {u} * {hi - lo}" for limit, lo, hi in bands if limit)
        lo, hi = bands[-1][1:]
        grown = f"{base} * (1 + {'CASE ' + steps + ' ELSE ' if steps else ''}{lo} + {u} * {hi - lo}{' END' if steps else ''})"
        value = f"CAST(floor((floor({grown}) + 9) / 10) * 10 AS BIGINT)" if name == "min_word_count" else f"greatest({base} + 1, CAST(floor({grown}) AS BIGINT))"
        cases.append(f"WHEN '{name}' THEN {value}")
    cases.append(f"WHEN 'decimal_places' THEN CASE WHEN {base} < 6 THEN least(6, {base} + greatest(1, CAST(floor({base} * (0.3 + {u} * 0.7) + 0.99) AS BIGINT))) END")
    return f"CASE {check} {' '.join(cases)} END"


def m2_turns(rules: DataFrame, touched: DataFrame | None = None) -> DataFrame:
    """Two turns of each sample with a numeric block rule: one rule tightened, then rolled back.

    touched(sample_id, cid): rules in selections, chosen only if there are no others; min_word_count
    likewise comes last. In turn 1 the rule's id ends in __m2_alt and it is best effort; in turn 2 the
    original is marked as modified.
    """
    names = {n for args, _ in BANDS.values() for n in args} | {"places"}
    base = F.coalesce(*[F.get_json_object("args", f"$.{n}").try_cast("bigint") for n in sorted(names)])
    marked = rules.withColumn("_base", base).withColumn("_key", F.coalesce(*[F.when(F.get_json_object("args", f"$.{n}").isNotNull(), F.lit(n)) for n in sorted(names)]))
    marked = marked.withColumn("_u", draw("sample_id", "'m2'", "cid")).withColumn("_new", F.expr(mutated_value("check", "_base", "_u")))
    if touched is not None:
        marked = marked.join(touched.select("sample_id", "cid", F.lit(True).alias("_sel")), ["sample_id", "cid"], "left")
    else:
        marked = marked.withColumn("_sel", F.lit(False))
    able = F.col("owner").isNotNull() & F.col("_new").isNotNull()
    order = Window.partitionBy("sample_id").orderBy(~able, F.col("check") == "min_word_count", F.coalesce("_sel", F.lit(False)), rank_key("sample_id", "'m2pick'", "cid"))
    marked = marked.withColumn("_hit", (F.row_number().over(order) == 1) & able)
    marked = marked.withColumn("_any", F.bool_or("_hit").over(Window.partitionBy("sample_id"))).filter("_any")
    turned = marked.withColumn("turn", F.explode(F.array(F.lit(1), F.lit(2))))
    changed = F.col("_hit") & (F.col("turn") == 1)
    args = F.concat(F.lit('{"'), "_key", F.lit('": '), F.col("_new").cast("string"), F.lit("}"))
    out = turned.withColumn("args", F.when(changed, args).otherwise(F.col("args")))
    out = out.withColumn("cid", F.when(changed, F.concat("cid", F.lit("__m2_alt"))).otherwise(F.col("cid")))
    out = out.withColumn("priority_level", F.when(changed, 1).otherwise(F.col("priority_level")))
    out = out.withColumn("restored", F.col("_hit") & (F.col("turn") == 2))
    return out.select(*[c for c in rules.columns], "turn", "restored")


def without(rules: DataFrame, gone: DataFrame) -> DataFrame:
    """rules less those of gone(sample_id, cid)."""
    return rules.join(gone, ["sample_id", "cid"], "left_anti")


def curriculum(rules: DataFrame, kept_alive: DataFrame | None = None, least: int = 15, floor: int = 5) -> DataFrame:
    """Levels 5 (all) down to 1: one to three rules fewer each, never below `floor` + level - 1.

    Samples with fewer than `least` rules are left out. kept_alive(sample_id, cid) may not be removed
    (rules that alone hold up a branch). Four rounds of ranks and anti-joins, unrolled.
    """
    per = Window.partitionBy("sample_id")
    now = rules.withColumn("_n", F.count("*").over(per)).filter(F.col("_n") >= least).drop("_n")
    if kept_alive is not None:
        now = now.join(kept_alive.select("sample_id", "cid", F.lit(True).alias("_stays")), ["sample_id", "cid"], "left").withColumn("_stays", F.coalesce("_stays", F.lit(False)))
    else:
        now = now.withColumn("_stays", F.lit(False))
    levels = [now.withColumn("level", F.lit(5))]
    for level in (4, 3, 2, 1):
        ranked = now.withColumn("_n", F.count("*").over(per)).withColumn("_free", F.count_if(~F.col("_stays")).over(per))
        size = F.least(F.lit(3), F.col("_n") - (floor + level - 1), F.col("_free"))
        drop = 1 + F.floor(draw("sample_id", f"'level{level}'") * size)
        order = per.orderBy("_stays", rank_key("sample_id", f"'level{level}'", "cid"))
        now = ranked.withColumn("_r", F.row_number().over(order)).filter((F.col("_r") > drop) | F.col("_stays")).drop("_n", "_free", "_r")
        levels.append(now.withColumn("level", F.lit(level)))
    return reduce(DataFrame.unionByName, levels).drop("_stays")


#: Rules of alternate branches that take the place of a text model's.
FALLBACK = {
    "global": ("If a radically different storyline is required", (("must_include_keywords", '{"keywords": ["new path"]}', "Reimagine this stage with a fundamentally different narrative focus."), ("must_include_keywords", '{"keywords": ["conflict"]}', "Introduce a new conflict that redirects the subsequent storyline."))),
    "local": ("If the stance is critical/negative", (("tone_negative_llm_judge", "{}", "Adopt an explicitly critical tone highlighting concrete problems or failures."), ("actionability_judge", "{}", "Propose at least one concrete next-step action to address the identified problems."))),
}
FOLLOW = (
    (("must_list_n_subpoints", '{"n": 2}', "Diagnose at least two critical failures driving the alternate scenario."), ("tone_negative_llm_judge", "{}", "Maintain an openly critical tone that assigns accountability for those failures.")),
    (("min_numbered_items", '{"n": 2}', "Lay out an urgent recovery plan using numbered steps."), ("must_include_keywords", '{"keywords": ["urgent", "collaboration"]}', "Highlight the need for rapid collaborative action to stabilize the situation.")),
    (("must_include_keywords", '{"keywords": ["vigilance", "long-term"]}', "Close with a cautious outlook that stresses long-term vigilance."), ("must_include_keywords", '{"keywords": ["risk", "swiftly"]}', "Warn about the risks if corrective measures are not executed swiftly.")),
)


def plan_selections(blocks: DataFrame) -> DataFrame:
    """blocks(sample_id, block_id, order_index) with rules -> sample_id, block_id, selection_type, merge_point.

    At most one global selection, then one to three local ones among the rest, without replacement.
    """
    per = Window.partitionBy("sample_id")
    ordered = per.orderBy("order_index", "block_id")
    n = F.count("*").over(per)
    ranked = blocks.withColumn("_n", n).withColumn("merge_point", F.lead("block_id").over(ordered)).withColumn("_r", F.row_number().over(per.orderBy(rank_key("sample_id", "'select'", "block_id"))))
    wide = F.floor(draw("sample_id", "'wide'") * (F.least(F.lit(1), F.col("_n") - 1) + 1))
    ranked = ranked.withColumn("_wide", wide)
    rest = F.col("_n") - F.col("_wide")
    near = 1 + F.floor(draw("sample_id", "'near'") * F.least(F.lit(3), rest))
    picked = ranked.filter(F.col("_r") <= F.col("_wide") + F.least(near, rest))
    kind = F.when(F.col("_r") <= F.col("_wide"), "global").otherwise("local")
    return picked.select("sample_id", "block_id", "order_index", kind.alias("selection_type"), F.when(kind == "local", F.col("merge_point")).alias("merge_point"))


def branch_rules(plan: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rules of the alternate blocks of a plan: the block's own two and, for global selections, two for
    each later main block, from a library whose last entry repeats."""
    rows = lambda rules: F.array(*[F.struct(F.lit(i + 1).alias("k"), F.lit(c).alias("check"), F.lit(a).alias("args"), F.lit(d).alias("descr")) for i, (c, a, d) in enumerate(rules)])
    own = F.when(F.col("selection_type") == "global", rows(FALLBACK["global"][1])).otherwise(rows(FALLBACK["local"][1]))
    first = plan.select("sample_id", F.concat("block_id", F.lit("_ALT")).alias("owner"), F.col("block_id").alias("origin_block"), F.lit(0).alias("step"), F.explode(own).alias("x"))
    later = blocks.select("sample_id", F.col("block_id").alias("origin_block"), F.col("order_index").alias("_o"))
    tail = plan.filter("selection_type = 'global'").join(later, "sample_id").filter("_o > order_index")
    tail = tail.withColumn("step", F.row_number().over(Window.partitionBy("sample_id", "block_id").orderBy("_o", "origin_block")))
    library = F.array(*[rows(f) for f in FOLLOW])
    more = tail.select("sample_id", F.concat("block_id", F.lit("_ALT_NEXT"), "step").alias("owner"), "origin_block", "step", F.explode(F.get(library, F.least(F.col("step"), F.lit(len(FOLLOW))) - 1)).alias("x"))
    both = first.unionByName(more)
    return both.select("sample_id", "owner", "origin_block", "step", F.concat("owner", F.lit("_C"), "x.k").alias("cid"), "x.check", "x.args", "x.descr")
