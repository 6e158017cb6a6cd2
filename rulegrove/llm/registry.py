"""Queries and SQL of this subpackage, by name."""

from __future__ import annotations

import corpus_pipeline
from rulegrove.llm import chat, decontam, pieces, pii, quality, secrets, sharding, simhash, suffix, topk

QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_sharding": sharding.op2_sharding,
    "op3_topk": topk.op3_topk,
    "op4_repeats": suffix.op4_repeats,
    "op5_secrets": secrets.op5_secrets,
    "op6_sentencepiece": pieces.op6_sentencepiece,
    "op7_chat": chat.op7_chat,
    "op8_simhash": simhash.op8_simhash,
    "op9_pii": pii.op9_pii,
    "op10_decontamination": decontam.op10_decontamination,
    "pipeline": corpus_pipeline.run,
}
SQL = {
    "op2_sharding": sharding.op2_sql(),
    "op3_topk": topk.op3_sql(),
    "op7_chat": chat.op7_sql(),
} | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
