"""Prompts rendered from nested graph rows, as expressions: one row in, one text out, no shuffle.

A graph row has seed_task, global_constraints, block_specs, block_constraint_sets, selections and
meta (JSON text). view() resolves it into an ordered plan and selections with their paths; the
templates turn those into arrays of lines that are joined at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulegrove.functions import text as X
from rulegrove.functions.dialect import SPARK as D

NODE = "struct<cid:string,desc:string,scope:string,verifier_spec:struct<check:string,args:string>,verifier:struct<check:string,args:string>,priority_level:int,trace_to:string,derived_from:string,change_type:string>"
BLOCK = "struct<block_id:string,intent:string,text_span:string,order_index:int,is_alternate:boolean,origin_block:string>"
BRANCH = "struct<block_id:string,constraints:array<string>>"
SELECTION = (
    f"struct<sid:string,condition:string,trace_to:string,branch_real:{BRANCH},branch_alt:{BRANCH},derived_from:string,"
    "selection_type:string,merge_point:string,truncated:boolean,alt_path_blocks:array<string>>"
)
SET = f"struct<block_id:string,logic_type:string,constraints:array<{NODE}>>"
GRAPH = (
    f"struct<seed_task:string,global_constraints:array<{NODE}>,block_specs:array<{BLOCK}>,blocks:array<{BLOCK}>,"
    f"block_constraint_sets:array<{SET}>,selections:array<{SELECTION}>,meta:string>"
)
ITEM = "struct<cid:string,descr:string,p:int,owner:string,kind:string,change_type:string>"


def let(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def decode(df: DataFrame, column: str = "json") -> DataFrame:
    """Graph columns from JSON text in either spelling (block_specs or blocks, verifier_spec or verifier).

    Missing arrays are empty, a missing priority is 2 and a missing change type null; text that is no
    JSON object gives an empty graph.
    """
    g = df.withColumn("_g", F.from_json(column, GRAPH))
    none = lambda kind: f"CAST(array() AS array<{kind}>)"
    node = "named_struct('cid', n.cid, 'desc', n.desc, 'scope', n.scope, 'verifier_spec', coalesce(n.verifier_spec, n.verifier), 'priority_level', coalesce(n.priority_level, 2), 'trace_to', n.trace_to, 'derived_from', n.derived_from, 'change_type', n.change_type)"
    return g.select(
        *df.columns,
        F.expr("coalesce(_g.seed_task, '')").alias("seed_task"),
        F.expr(f"transform(coalesce(_g.global_constraints, {none(NODE)}), n -> {node})").alias("global_constraints"),
        F.expr(f"coalesce(_g.block_specs, _g.blocks, {none(BLOCK)})").alias("block_specs"),
        F.expr(
            f"transform(coalesce(_g.block_constraint_sets, {none(SET)}), s -> named_struct('block_id', s.block_id, 'logic_type', coalesce(s.logic_type, 'AND'), 'constraints', transform(s.constraints, n -> {node})))"
        ).alias("block_constraint_sets"),
        F.expr(f"coalesce(_g.selections, {none(SELECTION)})").alias("selections"),
        F.coalesce("_g.meta", F.lit("{}")).alias("meta"),
    )


def encode(df: DataFrame, spelling: str = "block_specs") -> DataFrame:
    """df with `json`, the graph as JSON text; spelling names the key of the blocks."""
    args = "from_json(n.verifier_spec.args, 'map<string,string>')"
    node = f"named_struct('cid', n.cid, 'desc', n.desc, 'scope', n.scope, 'verifier_spec', named_struct('check', n.verifier_spec.check, 'args', parse_json(coalesce(n.verifier_spec.args, '{{}}'))), 'priority_level', n.priority_level, 'trace_to', n.trace_to, 'derived_from', n.derived_from, 'change_type', n.change_type)"
    del args
    graph = (
        f"named_struct('seed_task', seed_task, 'global_constraints', transform(global_constraints, n -> {node}), '{spelling}', block_specs,"
        f" 'block_constraint_sets', transform(block_constraint_sets, s -> named_struct('block_id', s.block_id, 'logic_type', s.logic_type, 'constraints', transform(s.constraints, n -> {node}))),"
        " 'selections', selections, 'meta', parse_json(meta))"
    )
    return df.withColumn("json", F.expr(f"to_json({graph}, map('ignoreNullFields', 'false'))"))


def view(graphs: DataFrame) -> DataFrame:
    """graphs with rules, plan, sels, sels_main and labels for the templates.

    sels resolves rule ids over global and block rules and extends paths by unseen owners; sels_main,
    for the main prompt, over block rules only: unknown ids are left out of real paths, and an
    alternate block without rules takes those whose id begins with its own.
    """
    item = "named_struct('cid', n.cid, 'descr', {}, 'p', n.priority_level, 'owner', {}, 'kind', coalesce(nullif(trim(n.verifier_spec.check), ''), 'unspecified'), 'change_type', n.change_type)"
    plain = item.format("trim(coalesce(n.desc, ''))", "n.trace_to")
    order = "(a, b) -> CASE WHEN a.order_index <> b.order_index THEN a.order_index - b.order_index WHEN a.block_id < b.block_id THEN -1 WHEN a.block_id > b.block_id THEN 1 ELSE 0 END"
    own_set = "try_element_at(filter(block_constraint_sets, s -> s.block_id = b.block_id), -1)"
    plan = let(
        "_",
        "1",
        f"transform(array_sort(filter(block_specs, b -> NOT coalesce(b.is_alternate, false)), {order}), b -> {let('own', own_set, 'named_struct(' + repr('block_id') + ', b.block_id, ' + repr('role') + ', b.intent, ' + repr('logic') + ', coalesce(own.logic_type, ' + repr('AND') + '), ' + repr('reqs') + ', coalesce(transform(own.constraints, n -> ' + plain + f'), CAST(array() AS array<{ITEM}>)))')})",
    )
    # labels: main blocks in order, then alternates as listed; repeats are numbered
    main_name = "IF(trim(coalesce(b.role, '')) = '', concat('Stage ', i + 1), trim(b.role))"
    base = (
        f"concat(transform(plan, (b, i) -> named_struct('id', b.block_id, 'name', {main_name})),"
        " transform(filter(block_specs, b -> coalesce(b.is_alternate, false)), b -> named_struct('id', b.block_id, 'name',"
        f" CASE WHEN trim(coalesce(b.intent, '')) <> '' THEN trim(b.intent) WHEN exists(plan, q -> q.block_id = b.origin_block) THEN concat('Alternate: ', try_element_at(transform(filter(plan, q -> q.block_id = b.origin_block), (b, i) -> {main_name}), 1)) ELSE 'Alternate stage' END)))"
    )
    labels = let("base", base, "transform(base, (x, i) -> " + let("k", "size(filter(slice(base, 1, i + 1), y -> y.name = x.name))", "named_struct('id', x.id, 'name', IF(k = 1, x.name, concat(x.name, ' (', k, ')')))") + ")")
    nodes = "flatten(transform(block_constraint_sets, s -> s.constraints))"

    def resolved(cids: str, fallback: str, pool: str) -> str:
        found = f"try_element_at(filter({pool}, m -> m.cid = c), -1)"
        missing = f"named_struct('cid', c, 'descr', '', 'p', 2, 'owner', {fallback}, 'kind', 'unspecified', 'change_type', CAST(NULL AS STRING))"
        here = item.format("trim(coalesce(n.desc, ''))", f"coalesce(nullif(n.trace_to, ''), {fallback})")
        return f"transform(coalesce({cids}, CAST(array() AS array<string>)), c -> {let('n', found, f'IF(n.cid IS NULL, {missing}, {here})')})"

    def paths(pool: str, main: bool) -> str:
        home = "coalesce(nullif(s.branch_real.block_id, ''), s.trace_to)"
        alt_home = "s.branch_alt.block_id" if main else "coalesce(nullif(s.branch_alt.block_id, ''), s.trace_to)"
        listed = "IF(size(s.alt_path_blocks) > 0, s.alt_path_blocks, array(s.branch_alt.block_id))"
        alt = listed if main else f"array_distinct(concat({listed}, transform(a, x -> x.owner)))"
        shown = "filter(r, x -> x.kind <> 'unspecified' OR x.descr <> '')" if main else "r"
        real = f"array_distinct(concat(array({home}), transform({shown}, x -> x.owner)))"
        real = let("p", real, "IF(s.trace_to <> '' AND NOT array_contains(p, s.trace_to), concat(array(s.trace_to), p), p)")
        alt_reqs = "filter(a, x -> x.owner = b AND x.descr <> '')" if main else "filter(a, x -> x.owner = b)"
        if main:
            alt_reqs = let("own", alt_reqs, "IF(size(own) > 0, own, filter(a, x -> startswith(x.cid, concat(b, '_'))))")
        name = "coalesce(try_element_at(transform(filter(labels, l -> l.id = b), l -> l.name), 1), b)" if not main else "coalesce(try_element_at(transform(filter(block_specs, l -> l.block_id = b), l -> l.intent), -1), b)"
        path = lambda ids, reqs: f"transform({ids}, b -> named_struct('block_id', b, 'label', {name}, 'reqs', {reqs}))"
        body = (
            "named_struct('sid', s.sid, 'trace_to', s.trace_to, 'condition', coalesce(s.condition, ''), 'stype', lower(coalesce(s.selection_type, 'local')),"
            f" 'alt', {path(alt, alt_reqs)}, 'real', {path(real, f'filter({shown}, x -> x.owner = b)')})"
        )
        return f"transform(selections, s -> {let('r', resolved('s.branch_real.constraints', home, pool), let('a', resolved('s.branch_alt.constraints', alt_home, pool), body))})"

    return (
        graphs.withColumn("rules", F.expr(f"transform(global_constraints, n -> {plain})"))
        .withColumn("plan", F.expr(plan))
        .withColumn("labels", F.expr(labels))
        .withColumn("sels", F.expr(paths(f"concat(global_constraints, {nodes})", False)))
        .withColumn("sels_main", F.expr(paths(nodes, True)))
        .withColumn("delta", F.expr("coalesce(get_json_object(meta, '$.delta_only_instruction') = 'true', false)"))
        .withColumn("notice", F.expr("coalesce(get_json_object(meta, '$.turn_notice') NOT IN ('', 'false', 'null'), false)"))
    )


# ---- lines ---------------------------------------------------------------------------------------


def q(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def bullets(reqs: str, indent: str, default: str, emit: str = "true", mark: str = "- ") -> str:
    shown = f"transform(filter({reqs}, x -> x.descr <> ''), x -> concat({q(indent + mark)}, x.descr))"
    return f"IF(size({reqs}) > 0, {shown}, IF({emit}, array(concat({q(indent + mark)}, {default})), array()))"


def layered(reqs: str, indent: str, default: str) -> str:
    part = lambda cond, head: (
        f"IF(exists({reqs}, x -> {cond}), concat(array({q(indent + '- ' + head)}), transform(filter({reqs}, x -> ({cond}) AND x.descr <> ''), x -> concat({q(indent + '  * ')}, x.descr))), array())"
    )
    return f"IF(size({reqs}) = 0, array(concat({q(indent + '- ')}, {default})), concat({part('x.p <> 1', 'Primary constraints:')}, {part('x.p = 1', 'Secondary constraints:')}))"


def bare(condition: str) -> str:
    """A condition's statement without its full stop; a general one if there is none."""
    s = D.replace_all(X.condition(D, condition), "[.]+$", "")
    return f"IF({X.condition(D, condition)} = '', 'the condition applies', {s})"


def label(block: str) -> str:
    return f"coalesce(try_element_at(transform(filter(labels, l -> l.id = {block}), l -> l.name), 1), 'Stage')"


def assumptions(sels: str, head: str, intro: str, indent: str, name: str) -> str:
    said = X.negated(D, "s.condition")
    line = f"concat({q(indent + '- ')}, {name}, ': ', IF({said} = '', 'The specified condition does not apply.', {said}))"
    return f"IF(size({sels}) > 0, concat(array({q(head)}, {q(intro)}), transform({sels}, s -> {line}), array('')), array())"


def branches(sel: str, show, delta_skips: bool, empty_alt: str, empty_real: str) -> str:
    """IF and OTHERWISE lines of a selection."""
    has = lambda side: f"exists({sel}.{side}, b -> size(b.reqs) > 0)"
    body = lambda side, default: f"flatten(transform({sel}.{side}, b -> {show('b.reqs', '    ', default)}))"
    alt = f"concat(array(concat('  IF ', {bare(sel + '.condition')}, ':')), {body('alt', empty_alt)})"
    real = f"concat(array('  OTHERWISE:'), {body('real', empty_real)})"
    if not delta_skips:
        return f"concat({alt}, {real})"
    return (
        f"concat(IF({has('alt')} OR NOT delta, {alt}, array()),"
        f" IF({has('real')} OR NOT delta, concat(array(IF({has('alt')} OR NOT delta, '  OTHERWISE:', '  Default path:')), {body('real', empty_real)}), array()))"
    )


def head() -> str:
    first = f"IF({X.strip(D, 'seed_task')} = '', '- Follow the staged plan and constraints below to construct the final answer.', concat('- Primary directive: ', {X.strip(D, 'seed_task')}))"
    return (
        f"concat(array('SYSTEM INSTRUCTIONS:', '', '1. MISSION BRIEF', {first}), IF(notice, array('- Only constraints in the current graph are active.'), array()),"
        " IF(delta, array('- This turn only introduces new or modified constraints; keep prior constraints unless explicitly changed.'), array()), array(''))"
    )


ALT, REAL = q("Carry out the alternate storyline requirements for this stage."), q("Return to the duties defined for this stage.")
SAME_ALT = f"IF(delta, 'No new or modified constraints in this branch.', {ALT})"
SAME_REAL = f"IF(delta, 'No new or modified constraints in this branch.', {REAL})"
DUTY = q("Follow the intent of this stage even if no explicit duty exists.")
STAGE = "concat('- Stage ', i + 1, ': ', coalesce(nullif(b.role, ''), concat('Stage ', i + 1)))"
FALSE_NOTE = assumptions("sels", "4. CURRENT CONDITION ASSUMPTION", "Unless explicitly told otherwise, assume each trigger below is FALSE:", "", label("s.trace_to"))


def _joined(*parts: str) -> str:
    cast = [f"CAST({p} AS array<string>)" for p in parts]
    return f"concat({X.strip(D, f'array_join(concat({', '.join(cast)}), {q(chr(10)).replace(chr(10), chr(92) + 'n')})')}, '\\n')"


def _plain_globals(indent: str, intro: str | None) -> str:
    lead = f"array({q(intro)})" if intro else "array()"
    shown = bullets("rules", indent, q("No global rules provided."))
    return (
        "IF(size(rules) > 0 OR NOT delta, concat(array('2. NON-NEGOTIABLE GLOBAL RULES'),"
        f" IF(size(rules) > 0, concat({lead}, {shown}), array('- No additional global constraints were supplied.')), array('')), array())"
    )


def stage_blueprint() -> str:
    show = lambda reqs, indent, default: bullets(reqs, indent, default, "NOT delta")
    active = "filter(sels, s -> s.trace_to = b.block_id AND (NOT delta OR exists(s.alt, y -> size(y.reqs) > 0) OR exists(s.real, y -> size(y.reqs) > 0)))"
    cue = "IF(startswith(lower(b.logic), 'sub'), '  Logic cue: Address listed duties as a short sequence.', '  Logic cue: Cover all listed duties for this stage.')"
    stage = let(
        "own",
        active,
        f"IF(delta AND size(b.reqs) = 0 AND size(own) = 0, array(), concat(array({STAGE}, {cue}),"
        f" IF(size(own) = 0, {show('b.reqs', '  ', DUTY)}, flatten(transform(own, s -> {branches('s', show, True, ALT, REAL)})))))",
    )
    return _joined(
        head(),
        _plain_globals("  ", "All global rules must be satisfied throughout the response:"),
        "array('3. STRUCTURED RESPONSE BLUEPRINT', 'Follow stages in order and apply branch logic where stated.')",
        f"flatten(transform(plan, (b, i) -> CAST({stage} AS array<string>)))",
        "array('')",
        FALSE_NOTE,
    )


def branch_first() -> str:
    show = lambda reqs, indent, default: bullets(reqs, indent, default, "NOT delta")
    some = "(exists(s.alt, y -> size(y.reqs) > 0) OR exists(s.real, y -> size(y.reqs) > 0))"
    decision = f"IF(delta AND NOT {some}, array(), concat(array(concat('- Decision at ', {label('s.trace_to')}, ':')), {branches('s', show, True, ALT, REAL)}))"
    flow = f"IF(delta AND size(b.reqs) = 0, array(), concat(array({STAGE}), {show('b.reqs', '  ', DUTY)}))"
    return _joined(
        head(),
        _plain_globals("", None),
        "array('3. STRUCTURED RESPONSE BLUEPRINT')",
        f"IF(size(sels) > 0, concat(array('Branch map:'), flatten(transform(sels, s -> CAST({decision} AS array<string>)))), IF(delta, array(), array('No conditional branches were supplied.')))",
        "array('', 'Stage flow (follow in order):')",
        f"flatten(transform(plan, (b, i) -> CAST({flow} AS array<string>)))",
        "array('')",
        FALSE_NOTE,
    )


#: Rules to summarise: global ones, then those of blocks that no selection touches, with their scope.
_TOUCHED = "array_distinct(flatten(transform(sels, s -> concat(array(s.trace_to), transform(s.alt, y -> y.block_id), transform(s.real, y -> y.block_id)))))"
_SCOPE = f"IF(lower({label('t.block_id')}) = 'stage', 'Stage', concat('Stage: ', {label('t.block_id')}))"
_SCOPED = (
    "filter(concat(transform(rules, x -> named_struct('cid', x.cid, 'descr', x.descr, 'p', x.p, 'kind', x.kind, 'scope', 'Global')),"
    f" flatten(transform(filter(block_constraint_sets, t -> NOT array_contains({_TOUCHED}, t.block_id)), t -> transform(t.constraints, n -> named_struct('cid', n.cid, 'descr', trim(coalesce(n.desc, '')), 'p', n.priority_level,"
    f" 'kind', coalesce(nullif(trim(n.verifier_spec.check), ''), 'unspecified'), 'scope', {_SCOPE}))))), x -> x.descr <> '')"
)


def _by_scope(items: str) -> str:
    scopes = f"transform(array_sort(array_distinct(transform({items}, x -> named_struct('k', IF(x.scope = 'Global', 0, 1), 's', x.scope)))), z -> z.s)"
    return f"flatten(transform({scopes}, z -> concat(array(concat('  ', z, ':')), transform(filter({items}, x -> x.scope = z), x -> concat('    * ', x.descr)))))"


def grouped_by_check() -> str:
    often = "array_sort(array_distinct(transform(filter(scoped, x -> size(filter(scoped, y -> y.kind = x.kind)) >= 2), x -> x.kind)))"
    told = "transform(filter(scoped, x -> array_contains(often, x.kind)), x -> x.cid)"
    summary = f"IF(size(often) > 0, flatten(transform(often, k -> concat(array(concat('- ', k, ':')), {_by_scope('filter(scoped, x -> x.kind = k)')}))), array('- No constraint types met the summary threshold.'))"
    rest = lambda xs: f"filter({xs}, x -> NOT array_contains(told, x.cid))"
    local = f"IF(size({rest('b.reqs')}) > 0, {bullets(rest('b.reqs'), '  ', q('No additional stage-specific rules.'))}, array())"
    show = lambda reqs, indent, default: bullets(reqs, indent, default)
    stage = f"concat(array({STAGE}), IF(exists(sels, s -> s.trace_to = b.block_id), flatten(transform(filter(sels, s -> s.trace_to = b.block_id), s -> {branches('s', show, False, SAME_ALT, SAME_REAL)})), {local}))"
    remaining = f"IF(size({rest('rules')}) > 0, concat(array('Remaining global rules (not included in the summary):'), {bullets(rest('rules'), '  ', q('No remaining global rules.'))}), array())"
    body = _joined(
        head(),
        "array('2. CONSTRAINT SUMMARY BY TYPE', 'Only constraint types with two or more instances are summarized here.')",
        summary,
        "array('', '3. RESPONSE BLUEPRINT & REMAINING RULES')",
        remaining,
        "array('Follow stages in order. Selection stages list their local constraints below.')",
        f"flatten(transform(plan, (b, i) -> CAST({stage} AS array<string>)))",
        "array('')",
        FALSE_NOTE,
    )
    return let("scoped", _SCOPED, let("often", often, let("told", told, body)))


def priority_layered() -> str:
    level = lambda cond, name: f"IF(exists(scoped, x -> {cond}), concat(array('- {name}:'), {_by_scope(f'filter(scoped, x -> {cond})')}), array())"
    stage = f"concat(array({STAGE}), flatten(transform(filter(sels, s -> s.trace_to = b.block_id), s -> {branches('s', layered, False, SAME_ALT, SAME_REAL)})))"
    body = _joined(
        head(),
        "array('2. CONSTRAINT SUMMARY BY PRIORITY', 'Constraints grouped by priority, then by scope.')",
        f"IF(size(scoped) > 0, concat({level('x.p <> 1', 'Primary')}, {level('x.p = 1', 'Secondary')}), array('- No additional global constraints were supplied.'))",
        "array('', '3. RESPONSE BLUEPRINT', 'Follow stages in order. Selection stages list their local constraints below.')",
        f"flatten(transform(plan, (b, i) -> CAST({stage} AS array<string>)))",
        "array('')",
        FALSE_NOTE,
    )
    return let("scoped", _SCOPED, body)


TEMPLATES = {"stage_blueprint": stage_blueprint, "branch_first": branch_first, "grouped_by_check": grouped_by_check, "priority_layered": priority_layered}


def render_templates(graphs: DataFrame, pool: tuple[str, ...] = tuple(TEMPLATES)) -> DataFrame:
    """One row per graph and template: the graph's other columns, template, prompt."""
    seen = view(graphs)
    texts = F.array(*[F.struct(F.lit(t).alias("template"), F.expr(TEMPLATES[t]()).alias("prompt")) for t in pool])
    keep = [c for c in graphs.columns if c not in ("seed_task", "global_constraints", "block_specs", "block_constraint_sets", "selections", "meta", "json")]
    return seen.select(*keep, F.explode(texts).alias("t")).select(*keep, "t.template", "t.prompt")


def heuristic_template(kinds: int = 2) -> str:
    """SQL of the template that a graph's shape suggests."""
    nodes = "concat(global_constraints, flatten(transform(block_constraint_sets, s -> s.constraints)))"
    return (
        f"CASE WHEN size(selections) > 0 THEN 'branch_first' WHEN exists({nodes}, n -> n.priority_level = 1) THEN 'priority_layered'"
        f" WHEN size(array_distinct(filter(transform({nodes}, n -> trim(n.verifier_spec.check)), c -> c <> ''))) >= {kinds} THEN 'grouped_by_check' ELSE 'stage_blueprint' END"
    )


def choose_template(graphs: DataFrame, key: str, seed: int = 0, ratio: float = 0.5, pool: tuple[str, ...] = tuple(TEMPLATES)) -> DataFrame:
    """graphs with `template`: the suggested one with chance `ratio` if it is in the pool, else any."""
    u = lambda what: D.uniform(f"concat('{seed}:', {key}, ':{what}')")
    listed = "array(" + ", ".join(f"'{p}'" for p in pool) + ")"
    any_ = f"get({listed}, CAST(floor({u('any')} * {len(pool)}) AS INT))"
    return graphs.withColumn("template", F.expr(f"IF({u('how')} < {ratio} AND array_contains({listed}, {heuristic_template()}), {heuristic_template()}, {any_})"))


def delta_view(graphs: DataFrame) -> DataFrame:
    """Graphs with only added or modified rules, and the selections and blocks that these touch."""
    live = "n -> n.change_type IN ('add', 'modify')"
    sets = f"filter(transform(block_constraint_sets, s -> named_struct('block_id', s.block_id, 'logic_type', s.logic_type, 'constraints', filter(s.constraints, {live}))), s -> size(s.constraints) > 0)"
    kept = graphs.withColumn("global_constraints", F.expr(f"filter(global_constraints, {live})")).withColumn("block_constraint_sets", F.expr(sets))
    ids = "transform(concat(global_constraints, flatten(transform(block_constraint_sets, s -> s.constraints))), n -> n.cid)"
    branch = lambda b: f"named_struct('block_id', s.{b}.block_id, 'constraints', filter(s.{b}.constraints, c -> array_contains(ids, c)))"
    fields = "'sid', s.sid, 'condition', s.condition, 'trace_to', s.trace_to, 'branch_real', {}, 'branch_alt', {}, 'derived_from', s.derived_from, 'selection_type', s.selection_type, 'merge_point', s.merge_point, 'truncated', s.truncated, 'alt_path_blocks', s.alt_path_blocks"
    sels = let("ids", ids, f"filter(transform(selections, s -> named_struct({fields.format(branch('branch_real'), branch('branch_alt'))})), s -> size(s.branch_real.constraints) > 0 OR size(s.branch_alt.constraints) > 0)")
    kept = kept.withColumn("selections", F.expr(sels))
    used = (
        "array_distinct(concat(transform(block_constraint_sets, s -> s.block_id), flatten(transform(selections, s -> concat(array(s.trace_to, s.branch_real.block_id, s.branch_alt.block_id, s.merge_point), coalesce(s.alt_path_blocks, array()))))))"
    )
    return kept.withColumn("block_specs", F.expr(let("used", used, "filter(block_specs, b -> array_contains(used, b.block_id))")))


# ---- main prompt ---------------------------------------------------------------------------------

_HIDDEN = "citation_refs_from_allowed_set"
_WIDE = "Use evidence-grounded citations across the report and ensure the required evidence coverage."
_NEAR = "Use section-relevant evidence citations and maintain coverage of the required evidence set."


def _visible(reqs: str, note: str) -> str:
    """In the survey profile, source-list rules are told as one general rule."""
    shown = f"filter({reqs}, x -> x.kind <> '{_HIDDEN}')"
    general = f"named_struct('cid', '', 'descr', {q(note)}, 'p', 2, 'owner', CAST(NULL AS STRING), 'kind', '', 'change_type', CAST(NULL AS STRING))"
    return f"IF(survey AND exists({reqs}, x -> x.kind = '{_HIDDEN}'), array_append({shown}, {general}), {reqs})"


def _duties(reqs: str, indent: str, default: str) -> str:
    """Bulleted rules; with best-effort ones among them, in two groups."""
    dot = lambda xs, ind: f"transform(filter({xs}, x -> x.descr <> ''), x -> concat({q(ind + '• ')}, x.descr))"
    first, second = "filter(v, x -> x.p <> 1 AND x.descr <> '')", "filter(v, x -> x.p = 1 AND x.descr <> '')"
    group = lambda xs: f"IF(size({xs}) > 0, {dot(xs, indent + '  ')}, array({q(indent + '  • None.')}))"
    primary = f"IF(size({first}) = 0 AND size({second}) = 0, array(concat({q(indent + '  • ')}, {default})), {group(first)})"
    both = (
        f"concat(array({q(indent + 'Primary constraints (priority=2, must satisfy):')}), {primary},"
        f" array({q(indent + 'Secondary constraints (priority=1, best effort; must not violate primary):')}), {group(second)},"
        f" array({q(indent + 'If a secondary constraint conflicts with any primary constraints, prioritize satisfying the primary constraints first, then satisfy the secondary one if possible.')}))"
    )
    return let("v", reqs, f"CAST(IF(exists(v, x -> x.p = 1), {both}, IF(size(v) > 0, {dot('v', indent)}, array(concat({q(indent + '• ')}, {default})))) AS array<string>)")


_WORD = "IF(survey, 'Section', 'Step')"
_CUE = (
    "CASE WHEN survey AND startswith(lower(b.logic), 'sub') THEN 'Present this section as an ordered synthesis pipeline (problem -> evidence -> takeaway).'"
    " WHEN survey THEN 'Synthesize this section\\'s key points with coherent literature context.'"
    " WHEN startswith(lower(b.logic), 'sub') THEN 'Sequential micro-steps: address bullets in a flowing order.' ELSE 'Parallel coverage: hit every bullet for this stage.' END"
)
_OPEN = "Follow the intent of this stage even if no explicit bullet exists."
_KEEP = "IF(survey, 'Maintain survey-style synthesis aligned with this section heading.', " + q(_OPEN) + ")"


def _path(side: str, indent: str, lead: str, tail: str) -> str:
    default = f"concat({q(lead)}, y.label, {q(tail)})"
    stepped = f"concat(array(concat({q(indent + '- ')}, {_WORD}, ' ', j + 1, ': ', y.label)), {_duties(_visible('y.reqs', _NEAR), indent + '    ', default)})"
    return f"flatten(transform(s.{side}, (y, j) -> IF(s.stype = 'global', {stepped}, {_duties(_visible('y.reqs', _NEAR), indent, default)})))"


def _when(indent: str) -> str:
    text = f"IF({X.condition(D, 's.condition')} = '', 'the described condition applies', {D.replace_all(X.condition(D, 's.condition'), '[.]+$', '')})"
    return f"concat({q(indent)}, upper(s.stype), ' branch - when ', {text}, ':')"


def _choice(indent: str, body: str, after: str) -> str:
    return (
        f"concat(array({_when(indent)}), {_path('alt', body, 'Carry out the alternate storyline requirements for ', '.')}, array({q(indent + 'Otherwise at this same decision point:')}),"
        f" {_path('real', body, 'Return to the duties defined for ', '.')}, {after})"
    )


def _inlined(step: str) -> str:
    """A later stage told inside an earlier one's global branch; b is the stage."""
    note = "IF(s.stype = 'global', array('            Global path note: When this condition reshapes the storyline, continue following the nested steps immediately below.'), array())"
    own = "filter(sels_main, s -> s.trace_to = b.block_id)"
    none = f"IF(size({_visible('b.reqs', _NEAR)}) > 0, concat(array('            Duties:'), {_duties(_visible('b.reqs', _NEAR), ' ' * 14, q(_OPEN))}), array(concat('            Duties: ', {_KEEP})))"
    return (
        f"CAST(concat(array(concat('        - ', {_WORD}, ' ', {step}, ': ', coalesce(nullif(b.role, ''), b.block_id)), concat('            Logic cue: ', {_CUE})),"
        f" IF(size({own}) = 0, {none}, flatten(transform({own}, s -> CAST({_choice(' ' * 12, ' ' * 14, note)} AS array<string>))))) AS array<string>)"
    )


def main_prompt() -> str:
    """SQL of the full prompt over a view.

    From the first stage with a global selection on, the later stages are told inside it and not again.
    """
    turn = "size(filter(transform(plan, b -> exists(sels_main, s -> s.trace_to = b.block_id AND s.stype = 'global')), x -> x))"
    first = f"IF({turn} = 0, size(plan), CAST(array_position(transform(plan, b -> exists(sels_main, s -> s.trace_to = b.block_id AND s.stype = 'global')), true) AS INT))"
    follow = f"flatten(transform(slice(plan, i + 2, size(plan)), (b, m) -> {_inlined('size(s.real) + 1 + m')}))"
    leads = "NOT exists(slice(own, 1, n), z -> z.stype = 'global')"
    after = f"IF(s.stype = 'global', concat(IF({leads}, {follow}, array()), array('      Global path note: Once you enter this alternate storyline, remain on it until it naturally merges back into the main sequence.')), array())"
    none = f"IF(size({_visible('b.reqs', _NEAR)}) > 0, concat(array('      Timeline duties:'), {_duties(_visible('b.reqs', _NEAR), ' ' * 8, _KEEP)}), array(concat('      Timeline duties: ', {_KEEP})))"
    stage = let(
        "own",
        "filter(sels_main, s -> s.trace_to = b.block_id)",
        "CAST(concat(array('', concat('   ', IF(survey, 'Section', 'Stage'), ' ', i + 1, ' - ', coalesce(nullif(b.role, ''), concat('Stage ', i + 1))), concat('      Logic cue: ', "
        + _CUE
        + f")), IF(size(own) = 0, {none}, flatten(transform(own, (s, n) -> CAST({_choice(' ' * 6, ' ' * 8, after)} AS array<string>))))) AS array<string>)",
    )
    mission = f"IF({X.strip(D, 'seed_task')} = '', '   - Follow the staged plan and constraints below to construct the final answer.', concat(IF(survey, '   - Core survey objective: ', '   - Primary directive: '), {X.strip(D, 'seed_task')}))"
    title = f"{X.strip(D, chr(99) + 'oalesce(get_json_object(meta, ' + q('$.evidence.title') + '), ' + q('') + ')')}"
    rules = f"transform(filter(transform({_visible('rules', _WIDE)}, (x, j) -> named_struct('j', j + 1, 'd', x.descr)), z -> z.d <> ''), z -> concat('   ', z.j, '. ', z.d))"
    know = "coalesce(get_json_object(meta, '$.knowledge_constraints.enabled') = 'true', false)"
    explicit = "coalesce(get_json_object(meta, '$.knowledge_constraints.instruction_knowledge_style'), 'abstract') = 'explicit'"
    refs = "from_json(coalesce(get_json_object(meta, '$.knowledge_constraints.explicit_reference_list'), '[]'), 'array<struct<ref_id:string,title:string,url:string>>')"
    ref = "concat('     • ', IF(coalesce(r.ref_id, '') = '', '', concat('[', trim(r.ref_id), '] ')), coalesce(nullif(trim(r.title), ''), '(untitled)'), IF(coalesce(r.url, '') = '', '', concat(' | ', trim(r.url))))"
    words = "from_json(coalesce(get_json_object(meta, '$.knowledge_constraints.core_keywords'), '[]'), 'array<string>')"
    themes = f"IF(size({words}) > 0, concat('   - Build the introduction around these themes and synthesize relevant literature: ', array_join({words}, ', '), '.'), '   - Build the introduction around topic-relevant themes and synthesize related literature.')"
    known = f"IF(survey AND {know}, IF({explicit}, IF(size({refs}) > 0, concat(array('   - Required evidence references (cite by ref_id where applicable):'), transform({refs}, r -> {ref})), array()), array({themes})), array())"
    plan_head = "CASE WHEN survey AND whole THEN '3. INTRODUCTION WRITING PLAN' WHEN survey THEN '3. SECTION-BY-SECTION SYNTHESIS PLAN' ELSE '3. STRUCTURED RESPONSE BLUEPRINT' END"
    plan_note = (
        "CASE WHEN survey AND whole THEN '   Write one coherent introduction with clear paragraph flow (background -> motivation -> key methods landscape -> transition).'"
        " WHEN survey THEN '   Follow the original survey section flow; each section should synthesize evidence rather than isolated claims.'"
        " ELSE '   Work chronologically through each stage. Tasks must already be described with the condition that governs when they apply.' END"
    )
    name = "coalesce(try_element_at(transform(filter(block_specs, l -> l.block_id = s.trace_to), l -> l.intent), -1), s.trace_to)"
    said = X.negated(D, "s.condition")
    last = (
        "IF(size(sels_main) > 0, concat(array(IF(survey, '4. DEFAULT BRANCH ASSUMPTIONS', '4. CURRENT CONDITION ASSUMPTION'), IF(survey, '   Unless the evaluator states otherwise, treat each branch trigger below as FALSE by default.', '   Unless the evaluator states otherwise, assume each trigger below is currently FALSE.')),"
        f" transform(sels_main, s -> concat('   - ', {name}, ': ', IF({said} = '', 'The specified condition does not apply.', {said})))), array())"
    )
    return _joined(
        "array(IF(survey, 'SURVEY GENERATION INSTRUCTIONS:', 'SYSTEM INSTRUCTIONS:'), '', IF(survey, '1. SURVEY TASK BRIEF', '1. MISSION BRIEF & DELIVERABLE'))",
        f"array({mission})",
        f"IF(survey, concat(array('   - Deliverable type: a complete survey report with section-level synthesis and citation grounding.'), IF({title} = '', array(), array(concat('   - Source survey topic: ', {title})))), array())",
        "IF(notice, array('   - Only constraints in the current graph are active.'), array())",
        "array('', IF(survey, '2. SURVEY-LEVEL CONSTRAINTS', '2. NON-NEGOTIABLE GLOBAL RULES'))",
        f"IF(size(rules) > 0, concat(array(IF(survey, '   Respect every survey-level rule simultaneously across the full report:', '   Respect every rule simultaneously across the full response:')), {rules}), array('   - No additional global constraints were supplied.'))",
        known,
        f"array('', {plan_head}, {plan_note})",
        f"flatten(transform(slice(plan, 1, {first}), (b, i) -> {stage}))",
        "array('')",
        last,
    )


def render_main(graphs: DataFrame) -> DataFrame:
    """graphs with `prompt`, in the default or survey profile that meta names."""
    seen = view(graphs).withColumn("survey", F.expr("coalesce(get_json_object(meta, '$.prompt_profile') = 'survey', false)"))
    seen = seen.withColumn("whole", F.expr("lower(trim(coalesce(get_json_object(meta, '$.generation_granularity'), 'section'))) = 'whole'"))
    return seen.select(*graphs.columns, F.expr(main_prompt()).alias("prompt"))


def eval_items(graphs: DataFrame, key: str) -> DataFrame:
    """Scoring items of each graph: global rules, rules of main blocks, and both branches of selections."""
    fields = "'cid', n.cid, 'descr', n.desc, 'check', n.verifier_spec.check, 'args', n.verifier_spec.args, 'priority_level', n.priority_level"
    item = lambda section, block, sid, branch: f"named_struct('section', '{section}', 'block_id', {block}, 'sid', {sid}, 'branch', {branch}, {fields})"
    no = "CAST(NULL AS STRING)"
    found = "coalesce(try_element_at(filter(flatten(transform(block_constraint_sets, t -> t.constraints)), m -> m.cid = c), -1), named_struct({}))"
    missing = "'cid', c, 'desc', CAST(NULL AS STRING), 'scope', CAST(NULL AS STRING), 'verifier_spec', CAST(NULL AS struct<check:string,args:string>), 'priority_level', 2, 'trace_to', CAST(NULL AS STRING), 'derived_from', CAST(NULL AS STRING), 'change_type', CAST(NULL AS STRING)"
    side = lambda s_, name: f"transform(s.{s_}.constraints, c -> {let('n', found.format(missing), item('branch', no, 's.sid', repr(name)))})"
    rows = (
        f"concat(transform(global_constraints, n -> {item('global', no, no, no)}),"
        f" flatten(transform(plan, b -> transform(coalesce(try_element_at(filter(block_constraint_sets, t -> t.block_id = b.block_id), -1).constraints, array()), n -> {item('block', 'b.block_id', no, no)}))),"
        f" flatten(transform(selections, s -> concat({side('branch_real', 'real')}, {side('branch_alt', 'alt')}))))"
    )
    return view(graphs).select(F.col(key).alias("sample_id"), F.posexplode(F.expr(rows)).alias("pos", "i")).select("sample_id", "pos", "i.*")


# ---- stored protocols ----------------------------------------------------------------------------

_SCORED = "struct<cid:string,desc:string,verifier:struct<check:string,args:string>,priority_level:int>"
PROTOCOL = (
    f"struct<eval_protocol:struct<global_scoring:array<{_SCORED}>,block_scoring:array<struct<block_id:string,requirements:array<{_SCORED}>>>,"
    f"conditional_scoring:array<struct<sid:string,branch_real:array<{_SCORED}>,branch_alt:array<{_SCORED}>>>>>"
)


def protocols(graphs: DataFrame, key: str) -> DataFrame:
    """(key, json): each graph's evaluation record as JSON text, from the same items that score it."""
    verifier = "named_struct('check', n.verifier_spec.check, 'args', parse_json(coalesce(n.verifier_spec.args, '{}')))"
    plain = f"named_struct('cid', n.cid, 'desc', n.desc, 'verifier', {verifier}, 'priority_level', coalesce(n.priority_level, 2))"
    mandatory = f"{plain[:-1]}, 'logic', 'MANDATORY_GLOBAL')"
    found = "coalesce(try_element_at(filter(flatten(transform(block_constraint_sets, t -> t.constraints)), m -> m.cid = c), -1), named_struct('cid', c, 'desc', CAST(NULL AS STRING), 'scope', CAST(NULL AS STRING), 'verifier_spec', CAST(NULL AS struct<check:string,args:string>), 'priority_level', 2, 'trace_to', CAST(NULL AS STRING), 'derived_from', CAST(NULL AS STRING), 'change_type', CAST(NULL AS STRING)))"
    side = lambda s_: f"transform(s.{s_}.constraints, c -> {let('n', found, plain)})"
    sets = "try_element_at(filter(block_constraint_sets, t -> t.block_id = b.block_id), -1)"
    blocks = f"transform(plan, b -> named_struct('block_id', b.block_id, 'role', b.role, 'logic_type', b.logic, 'is_alternate', false, 'requirements', transform(coalesce({sets}.constraints, array()), n -> {plain})))"
    choices = (
        "transform(selections, s -> named_struct('sid', s.sid, 'where', s.trace_to, 'condition', s.condition, 'selection_type', s.selection_type, 'merge_point', s.merge_point, 'truncated', s.truncated,"
        " 'branch_real_block', s.branch_real.block_id, 'branch_alt_block', s.branch_alt.block_id, 'alt_path_blocks', s.alt_path_blocks,"
        f" 'branch_real', {side('branch_real')}, 'branch_alt', {side('branch_alt')},"
        " 'scoring_rule', named_struct('must_choose_one_branch', true, 'branch_real_logic', 'AND', 'branch_alt_logic', 'AND')))"
    )
    protocol = (
        "named_struct('seed_task', seed_task, 'curriculum_level', CAST(get_json_object(meta, '$.curriculum_level') AS INT),"
        f" 'global_scoring', transform(global_constraints, n -> {mandatory}), 'block_scoring', {blocks}, 'conditional_scoring', {choices}, 'meta', parse_json(meta))"
    )
    record = f"to_json(named_struct('sample_id', CAST({key} AS STRING), 'eval_protocol', {protocol}, 'meta', parse_json(meta)))"
    return view(graphs).select(key, F.expr(record).alias("json"))


def protocol_items(records: DataFrame) -> DataFrame:
    """Scoring items of stored records(sample_id, json), as eval_items gives them for graphs."""
    no = "CAST(NULL AS STRING)"
    item = lambda section, block, sid, branch: f"named_struct('section', '{section}', 'block_id', {block}, 'sid', {sid}, 'branch', {branch}, 'cid', n.cid, 'descr', n.desc, 'check', n.verifier.check, 'args', n.verifier.args, 'priority_level', coalesce(n.priority_level, 2))"
    some = lambda xs, body: f"transform(coalesce({xs}, array()), n -> {body})"
    rows = (
        f"concat({some('p.global_scoring', item('global', no, no, no))},"
        f" flatten(transform(coalesce(p.block_scoring, array()), b -> {some('b.requirements', item('block', 'b.block_id', no, no))})),"
        f" flatten(transform(coalesce(p.conditional_scoring, array()), s -> concat({some('s.branch_real', item('branch', no, 's.sid', q('real')))}, {some('s.branch_alt', item('branch', no, 's.sid', q('alt')))}))))"
    )
    read = records.withColumn("p", F.from_json("json", PROTOCOL)["eval_protocol"])
    return read.select("sample_id", F.posexplode(F.expr(rows)).alias("pos", "i")).select("sample_id", "pos", "i.*")
