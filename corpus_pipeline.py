"""From raw documents to training pieces, in five stages over all documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's result to
the shared folder as Parquet and rereads it for the next one. A stage therefore begins by deleting
the intermediate tables of the stage before it, all but what its docs read.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulegrove.llm import decontam, pieces, pii, quality, similar
from rulegrove.llm.common import released, replaced, table, tables, written

#: Intermediate tables of the last stage that was called.
_used: set[str] = set()


def stage(build):
    """A stage that first deletes what the stage before it has used, all but what its docs read."""

    @wraps(build)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        released(docs, _used)
        before = tables()
        out = build(spark, docs, sf_dir)
        _used.clear()
        _used.update(tables() - before)
        return out

    return run


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


@stage
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs.select(*COLUMNS), model).filter(quality.predicted() == 1).select(*COLUMNS)


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles (Jaccard 0.8): that with the smallest doc_id."""
    return similar.drop_similar(docs.select(*COLUMNS))


@stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


@stage
def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and what reveals it masked; n_chars follows the text."""
    masked = pii.sanitise(docs.select(*COLUMNS))
    return masked.withColumn("n_chars", F.length("text").cast("long"))


@stage
def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two distinct segmentations of every document."""
    return pieces.encode(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("PII", mask_personal_data),
    ("SentencePiece encoding and decoding", encode_pieces),
]

#: A trained classifier, a randomised SVD and seeded sampling are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = replaced(docs, written(step(spark, docs, sf_dir)))
    return STAGES[-1][1](spark, docs, sf_dir)
