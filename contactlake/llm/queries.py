"""Registered queries of the training-data operators, and their DuckDB SQL."""
from __future__ import annotations

from contactlake.llm import (op1_backoff, op2_winnow, op3_resample, op4_pieces, op5_counts, op6_quality, op7_chat,
                             op8_simhash, op9_secrets, op10_shards, op11_bpe, op12_whiten, op13_phrases)

QUERIES = {f.__name__: f for f in (
    op1_backoff.op1_backoff_scores, op2_winnow.op2_decontaminate, op3_resample.op3_importance_resample,
    op4_pieces.op4_sentencepiece, op5_counts.op5_token_counts,
    op6_quality.op6_quality_rules, op7_chat.op7_chat_format, op8_simhash.op8_near_duplicates,
    op9_secrets.op9_secret_scan, op10_shards.op10_ring_shards,
    op11_bpe.op11_bpe_pair_index, op12_whiten.op12_whiten_blocks, op13_phrases.op13_setm_phrases)}

ORACLE_SQL = {"op1_backoff_scores": op1_backoff.ORACLE, "op2_decontaminate": op2_winnow.ORACLE,
              "op6_quality_rules": op6_quality.ORACLE, "op7_chat_format": op7_chat.ORACLE,
              "op13_setm_phrases": op13_phrases.ORACLE}
