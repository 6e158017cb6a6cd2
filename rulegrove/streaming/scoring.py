"""Scoring of a stream of answers. Verdicts are stateless per row; summaries are taken per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulegrove.functions.checks import verdict_sql
from rulegrove.operators import scoring


def stream_verdicts(answers: DataFrame, items: DataFrame) -> DataFrame:
    """Verdicts of streamed answers(sample_id, text) against a static table of items (inner on the sample)."""
    known = answers.select("sample_id", "text").join(items, "sample_id")
    typed = known.withColumn("_args", F.expr("try_parse_json(coalesce(args, '{}'))"))
    return typed.withColumn("passed", F.expr(verdict_sql("text", "check", "_args"))).drop("_args", "text")


def score_batches(answers: DataFrame, items: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str):
    """Start a query that hands each batch's summaries to sink(frame, batch_id)."""

    def each(batch: DataFrame, number: int) -> None:
        own = items.join(batch.select("sample_id").distinct(), "sample_id", "left_semi")
        sink(scoring.score(batch, own)[2], number)

    return answers.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).start()
