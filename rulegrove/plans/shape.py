"""Graphs as a whole: assembly, figures, and edits that keep selections sound.

Graph rows have the columns that render.decode gives. Edits are per-row expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rulegrove.functions.dialect import SPARK as D
from rulegrove.plans import render as R

NODES = "concat(global_constraints, flatten(transform(block_constraint_sets, s -> s.constraints)))"
#: Fixed value: what assembled graphs say of their making.
MADE_OF = '{"assembled_from": {"step1": "seed_task", "step2": "segmentation", "step3": "global_constraints", "step4": "block_constraints + block_logic", "step5": "selections + augmented block_constraints"}}'


def node() -> Column:
    """A rule row (cid, descr, owner, check, args, priority_level, derived_from) as a graph node."""
    return F.struct(
        "cid", F.col("descr").alias("desc"), F.when(F.col("owner").isNull(), "global").otherwise("local").alias("scope"), F.struct("check", "args").alias("verifier_spec"),
        F.col("priority_level").cast("int").alias("priority_level"), F.col("owner").alias("trace_to"), F.col("derived_from"), F.col("change_type"),
    )


def _nested(rows: DataFrame, keys: list[str], order: list[str], value: Column, into: str) -> DataFrame:
    """One array a key, in the order of `order`."""
    held = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)], value.alias("v")))).alias(into))
    return held.withColumn(into, F.transform(into, lambda x: x["v"]))


def assemble(blocks: DataFrame, rules: DataFrame, seeds: DataFrame | None = None, logic: DataFrame | None = None, extra_blocks: DataFrame | None = None, selections: DataFrame | None = None, meta: str = MADE_OF) -> DataFrame:
    """One graph row a sample of blocks(sample_id, block_id, intent, text_span, order_index).

    rules: sample_id, owner (null: global), pos, cid, check, args, descr, priority_level, and, if
    they have them, derived_from and change_type. seeds(sample_id, seed_task); logic(sample_id,
    block_id, logic): AND unless it begins with sub; extra_blocks: blocks with origin_block, which
    are alternates; selections(sample_id, selections): arrays as `selections()` makes them. A block
    without an id or index takes them from its place. All joins are on sample_id.
    """
    for c, value in (("derived_from", F.lit("mined")), ("change_type", F.lit(None).cast("string"))):
        rules = rules if c in rules.columns else rules.withColumn(c, value)
    spot = F.row_number().over(Window.partitionBy("sample_id").orderBy("order_index", "block_id"))
    fill = lambda c, i: F.coalesce(c, F.concat(F.lit("B"), i) if c == "block_id" else i - 1)
    main = blocks.withColumn("_i", spot).select("sample_id", fill("block_id", F.col("_i")).alias("block_id"), "intent", "text_span", fill("order_index", F.col("_i")).cast("int").alias("order_index"), F.lit(False).alias("is_alternate"), F.lit(None).cast("string").alias("origin_block"))
    if extra_blocks is not None:
        main = main.unionByName(extra_blocks.select("sample_id", "block_id", "intent", "text_span", F.col("order_index").cast("int").alias("order_index"), F.lit(True).alias("is_alternate"), "origin_block"))
    spec = F.struct("block_id", "intent", "text_span", "order_index", "is_alternate", "origin_block")
    out = _nested(main, ["sample_id"], ["order_index", "block_id"], spec, "block_specs")
    one = _nested(rules.filter("owner IS NULL"), ["sample_id"], ["pos", "cid"], node(), "global_constraints")
    two = _nested(rules.filter("owner IS NOT NULL"), ["sample_id", "owner"], ["pos", "cid"], node(), "constraints")
    if logic is not None:
        two = two.join(logic.select("sample_id", F.col("block_id").alias("owner"), F.col("logic").alias("_logic")), ["sample_id", "owner"], "left")
    else:
        two = two.withColumn("_logic", F.lit("AND"))
    kind = F.when(F.startswith(F.lower("_logic"), F.lit("sub")), "sub-chain").otherwise("AND")
    sets = _nested(two, ["sample_id"], ["owner"], F.struct(F.col("owner").alias("block_id"), kind.alias("logic_type"), "constraints"), "block_constraint_sets")
    out = out.join(one, "sample_id", "left").join(sets, "sample_id", "left")
    out = out.join(selections, "sample_id", "left") if selections is not None else out.withColumn("selections", F.expr(f"CAST(NULL AS array<{R.SELECTION}>)"))
    out = out.join(seeds.select("sample_id", "seed_task"), "sample_id", "left") if seeds is not None else out.withColumn("seed_task", F.lit(""))
    empty = lambda c: F.coalesce(c, F.array().cast(dict(out.dtypes)[c])).alias(c)
    return out.select("sample_id", F.coalesce("seed_task", F.lit("")).alias("seed_task"), empty("global_constraints"), "block_specs", empty("block_constraint_sets"), empty("selections"), F.lit(meta).alias("meta"))


def selections(plan: DataFrame, blocks: DataFrame, rules: DataFrame, branch: DataFrame, conditions: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(sample_id, selections), and the alternate blocks, of a selection plan.

    plan: sample_id, block_id, order_index, selection_type, merge_point; blocks and rules as for
    assemble(); branch: rules of alternate blocks with owner, origin_block and step (0: the plan's own
    block); conditions by selection type. Only blocks with rules of their own are selected.
    """
    real = rules.filter("owner IS NOT NULL").groupBy("sample_id", F.col("owner").alias("block_id")).agg(F.array_sort(F.collect_list(F.struct("pos", "cid"))).alias("_real"))
    head = F.when(F.col("step") > 0, F.regexp_extract("owner", "^(.*)_ALT_NEXT[0-9]+$", 1)).otherwise(F.col("origin_block"))
    parts = branch.withColumn("block_id", head)
    alt = parts.groupBy("sample_id", "block_id").agg(F.array_sort(F.collect_list(F.struct("step", "cid"))).alias("_alt"), F.array_sort(F.collect_set(F.struct("step", "owner"))).alias("_path"))
    told = plan.join(real, ["sample_id", "block_id"]).join(alt, ["sample_id", "block_id"])
    said = F.create_map(*[F.lit(x) for kv in conditions.items() for x in kv])
    cids = lambda c: F.transform(c, lambda x: x["cid"])
    home = F.concat("block_id", F.lit("_ALT"))
    sel = F.struct(
        F.concat(F.lit("SEL_"), "block_id").alias("sid"), said[F.col("selection_type")].alias("condition"), F.col("block_id").alias("trace_to"),
        F.struct("block_id", cids("_real").alias("constraints")).alias("branch_real"), F.struct(home.alias("block_id"), cids("_alt").alias("constraints")).alias("branch_alt"),
        F.lit("step5").alias("derived_from"), "selection_type", "merge_point", F.lit(False).alias("truncated"), F.transform("_path", lambda x: x["owner"]).alias("alt_path_blocks"),
    )
    rows = _nested(told, ["sample_id"], ["order_index", "block_id"], sel, "selections")
    origin = blocks.select("sample_id", F.col("block_id").alias("origin_block"), "intent", "text_span", "order_index")
    fine = parts.join(told.select("sample_id", "block_id").distinct(), ["sample_id", "block_id"], "left_semi")
    extra = fine.select("sample_id", F.col("owner").alias("block_id"), "origin_block", "step").distinct().join(origin, ["sample_id", "origin_block"])
    plain = F.trim(F.replace("intent", F.lit("(alternate)"), F.lit("")))
    return rows, extra.select("sample_id", "block_id", plain.alias("intent"), "text_span", (F.col("order_index") + F.col("step") + F.when(F.col("step") > 0, 1).otherwise(0)).alias("order_index"), "origin_block")


# ---- figures -------------------------------------------------------------------------------------


def figures(graphs: DataFrame, key: str = "sample_id") -> DataFrame:
    """Per graph: blocks, alternates, rules by place, best-effort rules, selections, kinds of checks, variant."""
    n = lambda e: F.expr(f"CAST(size({e}) AS INT)")
    return graphs.select(
        key,
        variant_label(key).alias("variant_type"),
        n("filter(block_specs, b -> NOT coalesce(b.is_alternate, false))").alias("blocks"),
        n("filter(block_specs, b -> coalesce(b.is_alternate, false))").alias("alt_blocks"),
        n("global_constraints").alias("global_constraints"),
        n("flatten(transform(block_constraint_sets, s -> s.constraints))").alias("block_constraints"),
        n(NODES).alias("total_constraints"),
        n(f"filter({NODES}, n -> n.priority_level = 1)").alias("priority_level_1"),
        n("selections").alias("conditional_branches"),
        n("array_distinct(" + checks_sql() + ")").alias("check_types"),
    )


def checks_sql() -> str:
    """SQL of all checks that a graph's rules name, repeats included."""
    return f"filter(transform({NODES}, n -> trim(coalesce(n.verifier_spec.check, ''))), c -> c <> '')"


def variant_label(key: str = "sample_id") -> Column:
    """Name of a variant: from meta, else what follows two underscores in the id, else base."""
    of = lambda k: f"nullif(get_json_object(meta, '$.{k}'), '0')"
    return F.expr(
        f"CASE WHEN {of('curriculum_level')} IS NOT NULL THEN concat('g', {of('curriculum_level')})"
        f" WHEN {of('mode')} IN ('m1', 'm2') AND {of('turn_index')} IS NOT NULL THEN concat({of('mode')}, '_t', {of('turn_index')})"
        f" WHEN contains({key}, '__') THEN substring({key}, instr({key}, '__') + 2) ELSE 'base' END"
    )


def wants_styles(key: str = "sample_id") -> Column:
    """Whether a variant is one that gets several styles."""
    return F.col(key).rlike("(__g[1-5]|__m1_t1|__m2_t1)$")


# ---- edits ---------------------------------------------------------------------------------------

_BRANCHES = "s.branch_real.constraints, s.branch_alt.constraints"


def selection_cids() -> str:
    """SQL of the rule ids that selections name."""
    return f"array_distinct(flatten(transform(selections, s -> concat({_BRANCHES}))))"


def holding(cid: str) -> str:
    """SQL: whether a rule is the only one of a branch."""
    alone = lambda side: f"(array_contains(s.{side}.constraints, {cid}) AND size(s.{side}.constraints) <= 1)"
    return f"exists(selections, s -> {alone('branch_real')} OR {alone('branch_alt')})"


def removable() -> str:
    """SQL of the ids that can go without emptying a branch, global ones first."""
    return f"transform(filter({NODES}, n -> NOT {holding('n.cid')}), n -> n.cid)"


def holders(graphs: DataFrame, key: str = "sample_id") -> DataFrame:
    """(key, cid) of the rules that alone hold up a branch."""
    return graphs.select(key, F.explode(F.expr(f"transform(filter({NODES}, n -> {holding('n.cid')}), n -> n.cid)")).alias("cid")).distinct()


def _selection(real: str, alt: str) -> str:
    branch = lambda side, ids: f"named_struct('block_id', s.{side}.block_id, 'constraints', {ids})"
    return (
        f"named_struct('sid', s.sid, 'condition', s.condition, 'trace_to', s.trace_to, 'branch_real', {branch('branch_real', real)}, 'branch_alt', {branch('branch_alt', alt)},"
        " 'derived_from', s.derived_from, 'selection_type', s.selection_type, 'merge_point', s.merge_point, 'truncated', s.truncated, 'alt_path_blocks', s.alt_path_blocks)"
    )


def _both(change) -> str:
    return "transform(selections, s -> " + _selection(change("s.branch_real.constraints"), change("s.branch_alt.constraints")) + ")"


def replace_cid(graphs: DataFrame, old: str, new: str) -> DataFrame:
    """graphs whose selections name `new` (SQL) instead of `old`."""
    return graphs.withColumn("selections", F.expr(_both(lambda ids: f"transform({ids}, c -> IF(c = {old}, {new}, c))")))


def prune_selections(graphs: DataFrame) -> DataFrame:
    """graphs without the selections of which a branch is empty."""
    return graphs.withColumn("selections", F.expr("filter(selections, s -> size(s.branch_real.constraints) > 0 AND size(s.branch_alt.constraints) > 0)"))


def keep_cids(graphs: DataFrame, ids: str) -> DataFrame:
    """graphs with only the rules whose id the array `ids` (SQL) holds, in rules and in selections alike."""
    held = lambda x: f"array_contains({ids}, {x})"
    sets = f"transform(block_constraint_sets, s -> named_struct('block_id', s.block_id, 'logic_type', s.logic_type, 'constraints', filter(s.constraints, n -> {held('n.cid')})))"
    out = graphs.withColumn("global_constraints", F.expr(f"filter(global_constraints, n -> {held('n.cid')})")).withColumn("block_constraint_sets", F.expr(sets))
    return out.withColumn("selections", F.expr(_both(lambda x: f"filter({x}, c -> {held('c')})")))


def with_rules(graphs: DataFrame, rules: DataFrame, key: str = "sample_id") -> DataFrame:
    """graphs whose rules are those of rules(key, cid, args, priority_level, change_type, was).

    was: the id the rule has in the graph. Rules that are not listed go, also from selections, and
    selections with an empty branch go with them. Graphs without any row keep no rules.
    """
    own = rules.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("was", F.struct("cid", "args", "priority_level", "change_type")))).alias("_own"))
    joined = graphs.join(own, key, "left").withColumn("_own", F.coalesce("_own", F.create_map().cast(dict(own.dtypes)["_own"])))
    kept = keep_cids(joined, "map_keys(_own)")
    to = "_own[n.cid]"
    new = f"named_struct('cid', {to}.cid, 'desc', n.desc, 'scope', n.scope, 'verifier_spec', named_struct('check', n.verifier_spec.check, 'args', {to}.args), 'priority_level', {to}.priority_level, 'trace_to', n.trace_to, 'derived_from', n.derived_from, 'change_type', {to}.change_type)"
    kept = kept.withColumn("global_constraints", F.expr(f"transform(global_constraints, n -> {new})"))
    kept = kept.withColumn("block_constraint_sets", F.expr(f"transform(block_constraint_sets, s -> named_struct('block_id', s.block_id, 'logic_type', s.logic_type, 'constraints', transform(s.constraints, n -> {new})))"))
    kept = kept.withColumn("selections", F.expr(_both(lambda x: f"transform({x}, c -> _own[c].cid)")))
    return prune_selections(kept.drop("_own"))


def rule_rows(graphs: DataFrame, key: str = "sample_id") -> DataFrame:
    """Graphs' rules as rows: key, owner, pos, cid, check, args, descr, priority_level, alternate (of an alternate block)."""
    item = lambda owner, alternate: f"named_struct('owner', {owner}, 'cid', n.cid, 'check', n.verifier_spec.check, 'args', n.verifier_spec.args, 'descr', n.desc, 'priority_level', n.priority_level, 'alternate', {alternate})"
    other = "exists(block_specs, b -> b.block_id = s.block_id AND coalesce(b.is_alternate, false))"
    rows = f"concat(transform(global_constraints, n -> {item('CAST(NULL AS STRING)', 'false')}), flatten(transform(block_constraint_sets, s -> transform(s.constraints, n -> {item('s.block_id', other)}))))"
    return graphs.select(key, F.posexplode(F.expr(rows)).alias("pos", "x")).select(key, "pos", "x.*")


def nodes_by_cid(graphs: DataFrame, key: str = "sample_id") -> DataFrame:
    """(key, cid, node): the last rule of each id."""
    rows = graphs.select(key, F.posexplode(F.expr(NODES)).alias("pos", "node")).withColumn("cid", F.col("node.cid"))
    return rows.groupBy(key, "cid").agg(F.max_by("node", "pos").alias("node"))


# ---- choice of templates -------------------------------------------------------------------------

#: How often the batch job draws each template.
WEIGHTS = {"stage_blueprint": 4, "branch_first": 2, "grouped_by_check": 2, "priority_layered": 2}


def template_name(name: str) -> str:
    return name.strip().lower().replace("-", "_")


def template_pool(names: list[str] | None) -> tuple[list[str], list[str]]:
    """(known templates, once each; names that are none or come again). Without a known one: all."""
    fine: list[str] = []
    other = []
    for raw in names or []:
        known = template_name(raw) in R.TEMPLATES and template_name(raw) not in fine
        (fine if known else other).append(template_name(raw) if known else raw)
    return fine or list(R.TEMPLATES), other


def template_weights(raw: str = "") -> dict[str, int]:
    """name:weight, ... as weights; unknown names and weights below one go, missing names weigh one."""
    out: dict[str, int] = {}
    for name, _, value in (x.strip().partition(":") for x in raw.split(",")):
        if template_name(name) in R.TEMPLATES and value.strip().lstrip("+-").isdigit() and int(value) > 0:
            out[template_name(name)] = int(value)
    return {t: out.get(t, 1) for t in R.TEMPLATES} if out else dict(WEIGHTS)


def weighted_template(u: str, weights: dict[str, int]) -> str:
    """SQL of a template for a uniform number u, drawn by weight (one at least)."""
    total, run, cases = sum(max(1, weights.get(t, 1)) for t in R.TEMPLATES), 0, []
    for t in R.TEMPLATES:
        run += max(1, weights.get(t, 1))
        cases.append(f"WHEN {u} * {total} < {run} THEN '{t}'")
    return f"CASE {' '.join(cases)} END"


def choose_weighted(graphs: DataFrame, parent: str, seed: int = 0, ratio: float = 0.5, weights: dict[str, int] | None = None, follow: str = "sample_id") -> DataFrame:
    """graphs with `template`, the same for all variants of a parent but for later turns (stage_blueprint)."""
    u = lambda what: D.uniform(f"concat('{seed}:', {parent}, ':{what}')")
    drawn = f"IF({u('how')} < {ratio}, {R.heuristic_template(3)}, {weighted_template(u('which'), weights or WEIGHTS)})"
    return graphs.withColumn("template", F.expr(f"IF(regexp_like({follow}, '__m[12]_t[2-9]$'), 'stage_blueprint', {drawn})"))
