"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns are context, and only that
reply is trainable. Turns after the last assistant turn (or a conversation without one) make one
more example without a target, so that every turn can be read back.

Template: each turn is `<|role|>text<|end|>`, with role and text escaped so that no control string
can occur inside them: backslash, `<`, `[` and `|` become backslash pairs, which is reversible.

Turns are dealt by conversation, sorted, and streamed: a task holds the rendered prefix of one
conversation at a time and emits its examples one by one in batches of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulegrove.llm.common import table

#: What stands for the characters that control strings are made of.
ESCAPES = (("\\", "\\\\"), ("<", "\\l"), ("[", "\\b"), ("|", "\\p"))
END = "<|end|>"
CHARS_PER_BATCH = 4_000_000


def escape(text: str) -> str:
    for plain, code in ESCAPES:
        text = text.replace(plain, code)
    return text


def unescape(text: str) -> str:
    parts = text.split("\\\\")
    for plain, code in ESCAPES[1:]:
        parts = [p.replace(code, plain) for p in parts]
    return "\\".join(parts)


def unescaped(col: str) -> str:
    """The same as SQL."""
    inner = "p"
    for plain, code in ESCAPES[1:]:
        inner = f"replace({inner}, r'{code}', '{plain}')"
    return rf"array_join(transform(split({col}, r'\\\\'), p -> {inner}), r'\')"


def render(role: str, text: str) -> tuple[str, int]:
    """A turn and where its text starts in it."""
    head = f"<|{escape(role)}|>"
    return head + escape(text) + END, len(head)


EXAMPLE = "conv_id long, example int, target_turn long, formatted string, loss_start int, loss_chars int, last boolean"


def expanded(turns: Iterator[tuple]) -> Iterator[tuple]:
    """Examples of sorted turns (conv_id, turn, role, text); the last one of a conversation is marked."""
    conv, held, prefix, size, n, trailing = object(), None, [], 0, 0, 0

    def close() -> Iterator[tuple]:
        if held is None and not trailing:
            return
        if trailing:
            if held is not None:
                yield (*held, False)
            yield (conv, n, None, "".join(prefix), size, 0, True)
        else:
            yield (*held, True)

    for conv_id, turn, role, text in turns:
        if conv_id != conv or not isinstance(conv_id, type(conv)):
            yield from close()
            conv, held, prefix, size, n, trailing = conv_id, None, [], 0, 0, 0
        rendered, at = render(role or "", text or "")
        prefix.append(rendered)
        if role == "assistant":
            if held is not None:
                yield (*held, False)
            whole = "".join(prefix)
            prefix = [whole]
            held = (conv, n, turn, whole, size + at, len(rendered) - at - len(END))
            n, trailing = n + 1, 0
        else:
            trailing += 1
        size += len(rendered)
    yield from close()


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.bool_()]
    names = [x.split()[0] for x in EXAMPLE.split(", ")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    rows, size = [], 0
    turns = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
    for example in expanded(turns):
        rows.append(example)
        size += len(example[3])
        if size >= CHARS_PER_BATCH:
            yield batch(rows)
            rows, size = [], 0
    if rows:
        yield batch(rows)


def format_chats(turns: DataFrame) -> DataFrame:
    """Examples of turns(conv_id, turn, role, text).

    Rows: conv_id, example (from 0), target_turn (null: no target), formatted, loss_start and
    loss_chars (the trainable code points of formatted), last (the conversation's last example).
    Null texts and roles count as empty; rows with a null conv_id form one conversation; rows of one
    turn number are ordered by role and text, and repeated rows are turns of their own. An empty
    table gives no examples. Other columns are ignored.
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(_expand, EXAMPLE)


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from the examples alone: turns, trainable text and sizes, with digests."""
    body = f"slice(split(formatted, r'<\\|end\\|>', -1), 1, size(split(formatted, r'<\\|end\\|>', -1)) - 1)"
    role = unescaped("substring_index(substr(t, 3), '|>', 1)")
    text = unescaped("substr(t, locate('|>', t) + 2)")
    all_turns = f"transform({body}, t -> concat({role}, '\\n', {text}, '\\n'))"
    per = examples.select(
        "conv_id",
        "example",
        F.expr(unescaped("substring(formatted, loss_start + 1, loss_chars)")).alias("loss"),
        F.length("formatted").cast("long").alias("chars"),
        F.expr(f"IF(last, CAST(size({body}) AS BIGINT), NULL)").alias("n_turns"),
        F.expr(f"IF(last, sha2(array_join({all_turns}, ''), 256), NULL)").alias("turns_sha256"),
    )
    loss = "array_join(transform(array_sort(losses), y -> y.loss), '')"
    return per.groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"),
        F.max("turns_sha256").alias("turns_sha256"),
        F.collect_list(F.struct("example", "loss")).alias("losses"),
        F.sum("chars").alias("formatted_chars"),
        F.count("*").alias("n_examples"),
    ).select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.expr(f"CAST(length({loss}) AS BIGINT)").alias("loss_chars"),
        F.expr(f"sha2({loss}, 256)").alias("loss_sha256"),
        "formatted_chars",
        "n_examples",
    )


#: The added conversation -1.
PROBE = "</s>[INST] ok [/INST]"


def op7_chat(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    return read_back(format_chats(turns.unionByName(probe))).drop("n_examples")


def op7_sql() -> str:
    def esc(x):
        for plain, code in ESCAPES:
            x = f"replace({x}, '{plain}', '{code}')"
        return x

    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n,
    5 + length({esc('role')}) + length({esc('text')}) + 6 AS chars
  FROM turns
),
running AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY n) AS upto, max(CASE WHEN role = 'assistant' THEN n END) OVER (PARTITION BY conv_id) AS last_reply,
    count(*) OVER (PARTITION BY conv_id) AS total
  FROM numbered
)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' OR (n = total AND last_reply IS DISTINCT FROM total) THEN upto END), 0)::BIGINT AS formatted_chars
FROM running GROUP BY conv_id
"""
