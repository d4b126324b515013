"""The registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from gridagro.llm import (
    decontaminate,
    exact_dedup,
    html_text,
    language_model,
    mixing,
    near_dedup,
    period_runs,
    piece_tokens,
    quality,
    secrets,
    substring_dedup,
    url_filter,
    whitening,
)

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_url_filter": url_filter.op2_url_filter,
    "op3_decontamination": decontaminate.op3_decontamination,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_near_dedup": near_dedup.op5_near_dedup,
    "op6_secrets": secrets.op6_secrets,
    "op7_quality": quality.op7_quality,
    "op8_language_model": language_model.op8_language_model,
    "op9_html_text": html_text.op9_html_text,
    "op10_substring_dedup": substring_dedup.op10_substring_dedup,
    "op11_period_runs": period_runs.op11_period_runs,
    "op12_whitening": whitening.op12_whitening,
    "op13_piece_tokens": piece_tokens.op13_piece_tokens,
}

ORACLE = {
    "op1_mixing": mixing.OP1_SQL,
    "op3_decontamination": decontaminate.OP3_SQL,
    "op4_exact_dedup": exact_dedup.OP4_SQL,
    "op5_near_dedup": near_dedup.OP5_SQL,
    "op10_substring_dedup": substring_dedup.OP10_SQL,
}
