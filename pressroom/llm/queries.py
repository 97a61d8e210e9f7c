"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pressroom.llm import (chat_format, chat_repair, decontaminate, jaccard_join, lm_score, mixing, neighbours,
                            quality, secret_scan, substring_dedup, token_align, token_files, url_filter)

QUERIES = {
    "op1_url_filter": url_filter.op1_url_filter,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_quality": quality.op3_quality,
    "op4_lm_score": lm_score.op4_lm_score,
    "op5_substring_dedup": substring_dedup.op5_substring_dedup,
    "op6_mix_sources": mixing.op6_mix_sources,
    "op7_chat_format": chat_format.op7_chat_format,
    "op8_jaccard_join": jaccard_join.op8_jaccard_join,
    "op9_token_files": token_files.op9_token_files,
    "op10_neighbours": neighbours.op10_neighbours,
    "op11_token_align": token_align.op11_token_align,
    "op12_secret_scan": secret_scan.op12_secret_scan,
    "op13_chat_repair": chat_repair.op13_chat_repair,
}
ORACLES = {
    "op1_url_filter": url_filter.ORACLE,
    "op2_decontaminate": decontaminate.ORACLE,
    "op6_mix_sources": mixing.ORACLE,
    "op7_chat_format": chat_format.ORACLE,
    "op12_secret_scan": secret_scan.ORACLE,
    "op13_chat_repair": chat_repair.ORACLE,
}
