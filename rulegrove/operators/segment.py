"""Texts into blocks: paragraphs with list runs kept whole, Markdown headings, heading plus parts.

The line state machines are folds over the array of lines, so a document is segmented where it is
read: nothing is exploded or shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulegrove.functions import text as X
from rulegrove.functions.dialect import SPARK as D

# Line patterns.
LINE_BREAK = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"
BULLET_LINE = r"^\s*(?:[-*•]+|[0-9]+[.)]|[A-Za-z][.)])\s+"
HEADING_LINE = r"^\s{0,3}(#{1,6})\s+(.+?)\s*$"
VISUAL = r"^\s*(?i:figure|fig\.?|table|image|chart|supplementary\s+(?:figure|fig\.?|table|image)|appendix\s+(?:figure|table))(?:[^\p{L}\p{N}_]|$)"

STRINGS = "CAST(array() AS array<string>)"


def lines(t: str) -> str:
    """Lines of a text as an array; a last empty one does not count."""
    parts = D.split(t, LINE_BREAK)
    return f"transform(array({parts}), p -> IF(size(p) > 0 AND p[size(p) - 1] = '', slice(p, 1, size(p) - 1), p))[0]"


def _bound(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def paragraphs(lines_sql: str) -> str:
    """Paragraphs of an array of lines. A run of list lines, blanks inside it included, is one."""
    chunk = X.strip(D, "array_join(s.cur, '\\n')")
    closed = _bound("c", chunk, "IF(c = '', s.done, array_append(s.done, c))")
    state = "named_struct('done', {}, 'cur', {}, 'listed', {})"
    line = "regexp_replace(raw, r'[\\s\\p{Z}\\x{85}]+$', '')"
    step = _bound(
        "line",
        line,
        f"CASE WHEN line = '' AND s.listed THEN {state.format('s.done', 'array_append(s.cur, ' + repr('') + ')', 'true')}"
        f" WHEN line = '' THEN {state.format(closed, STRINGS, 'false')}"
        f" WHEN regexp_like(line, r'{BULLET_LINE}') AND NOT s.listed AND size(s.cur) > 0 THEN {state.format(closed, 'array(line)', 'true')}"
        f" WHEN regexp_like(line, r'{BULLET_LINE}') THEN {state.format('s.done', 'array_append(s.cur, line)', 'true')}"
        f" WHEN s.listed THEN {state.format(closed, 'array(line)', 'false')}"
        f" ELSE {state.format('s.done', 'array_append(s.cur, line)', 'false')} END",
    )
    return f"aggregate({lines_sql}, {state.format(STRINGS, STRINGS, 'false')}, (s, raw) -> {step}, s -> {closed})"


def valid_heading(h: str) -> str:
    return f"({h} <> '' AND NOT regexp_like({h}, r'{VISUAL}') AND regexp_like({h}, r'[A-Za-z0-9]'))"


BLOCKS = "array<struct<intent:string,text_span:string>>"


def headings(lines_sql: str) -> str:
    """(intent, text) per valid heading, what stands before the first one first.

    A heading of a figure or the like drops its text until the next heading.
    """
    chunk = X.strip(D, "array_join(s.cur, '\\n')")
    closed = f"IF(s.head = '', s.done, array_append(s.done, named_struct('intent', s.head, 'text_span', {chunk})))"
    state = "named_struct('done', {}, 'head', {}, 'cur', {}, 'pre', {}, 'drop', {})"
    start = state.format(f"CAST(array() AS {BLOCKS})", "''", STRINGS, STRINGS, "false")
    found = X.strip(D, f"regexp_extract(line, r'{HEADING_LINE}', 2)")
    step = (
        f"CASE WHEN regexp_like(line, r'{HEADING_LINE}') THEN "
        + _bound("h", found, f"IF({valid_heading('h')}, {state.format(closed, 'h', 'array(line)', 's.pre', 'false')}, {state.format(closed, repr(''), STRINGS, 's.pre', 'true')})")
        + f" WHEN s.head <> '' THEN {state.format('s.done', 's.head', 'array_append(s.cur, line)', 's.pre', 's.drop')}"
        + f" WHEN s.drop THEN s ELSE {state.format('s.done', 's.head', 's.cur', 'array_append(s.pre, line)', 's.drop')} END"
    )
    pre = X.strip(D, "array_join(s.pre, '\\n')")
    end = _bound("p", pre, f"IF(p = '', {closed}, concat(array(named_struct('intent', 'Preamble', 'text_span', p)), {closed}))")
    return f"aggregate({lines_sql}, {start}, (s, line) -> {step}, s -> {end})"


def parts(t: str) -> str:
    """Paragraphs named after a leading heading: `heading / Part i`."""
    first = "array_position(transform(ls, l -> regexp_like(l, r'[^\\s\\p{Z}\\x{85}]')), true)"
    lead = f"IF({first} > 0, ls[CAST({first} - 1 AS INT)], '')"
    is_head = f"regexp_like({lead}, r'{HEADING_LINE}')"
    name = f"IF({is_head}, {X.strip(D, f"regexp_extract({lead}, r'{HEADING_LINE}', 2)")}, 'Section')"
    body = f"IF({is_head}, slice(ls, CAST({first} + 1 AS INT), size(ls)), ls)"
    own = _bound("b", body, f"IF(exists(b, l -> regexp_like(l, r'[^\\s\\p{{Z}}\\x{{85}}]')), {paragraphs('b')}, {paragraphs('ls')})")
    return _bound("ls", lines(t), _bound("hint", name, f"transform({own}, (p, i) -> named_struct('intent', concat(hint, ' / Part ', i + 1), 'text_span', p))"))


def blocks(mode: str, text: str = "text") -> Column:
    """Array of struct(intent, text_span) in order. Modes: heading, parts, paragraph; an empty text has none.

    heading and parts fall back to plain paragraphs if they find nothing.
    """
    plain = f"transform({paragraphs(lines(text))}, (p, i) -> named_struct('intent', concat('Paragraph ', i + 1), 'text_span', p))"
    if mode == "paragraph":
        return F.expr(plain)
    own = headings(lines(text)) if mode == "heading" else parts(text)
    return F.expr(_bound("own", own, f"IF(size(own) > 0, own, {plain})"))


def unique_intents(blocks_sql: str) -> str:
    """Blocks with `intent (k)` for the k-th of equal intents; empty ones are called Stage i."""
    named = f"transform({blocks_sql}, (b, i) -> named_struct('intent', IF({X.strip(D, 'b.intent')} = '', concat('Stage ', i + 1), {X.strip(D, 'b.intent')}), 'text_span', b.text_span))"
    count = "size(filter(slice(bs, 1, i + 1), x -> x.intent = b.intent))"
    return _bound("bs", named, f"transform(bs, (b, i) -> {_bound('k', count, 'named_struct(' + repr('intent') + ', IF(k = 1, b.intent, concat(b.intent, ' + repr(' (') + ', k, ' + repr(')') + ')), ' + repr('text_span') + ', b.text_span)')})")


def segment(df: DataFrame, key: str, mode: str = "paragraph", text: str = "text") -> DataFrame:
    """One row a block: key, block_id (B1..), intent, text_span, order_index."""
    nested = df.select(key, blocks(mode, text).alias("_blocks")).withColumn("_blocks", F.expr(unique_intents("_blocks")))
    rows = nested.select(key, F.posexplode("_blocks").alias("order_index", "b"))
    return rows.select(key, F.concat(F.lit("B"), F.col("order_index") + 1).alias("block_id"), "b.intent", "b.text_span", "order_index")
