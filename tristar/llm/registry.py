"""Queries of the subpackage: name -> (spark, sf_dir) -> DataFrame, and their DuckDB SQL
where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from tristar.llm import (ann_tree, bpe_words, byte_bpe, conversations, html_text, near_dedup,
                         packing, passage_dedup, ppm_score, quality_rules, token_alignment, toxicity,
                         url_filters)

QUERIES = {
    "op1_passage_dedup": passage_dedup.op1_passages,
    "op2_packing": packing.op2,
    "op3_ann_tree": ann_tree.op3,
    "op4_ppm_score": ppm_score.op4,
    "op5_bpe_words": bpe_words.op5,
    "op6_url_filters": url_filters.op6,
    "op7_near_dedup": near_dedup.op7,
    "op8_quality_rules": quality_rules.op8,
    "op9_toxicity": toxicity.op9,
    "op10_html_text": html_text.op10,
    "op11_token_alignment": token_alignment.op11,
    "op12_byte_bpe": byte_bpe.op12,
    "op13_conversation_repair": conversations.op13,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
