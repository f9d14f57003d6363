"""Registered queries of this subpackage, with their DuckDB texts where SQL can state the result."""

from __future__ import annotations

from tidemart.llm import (
    alignment,
    exact_dedup,
    html_text,
    language,
    manifest,
    mixing,
    near_dedup,
    packing,
    passages,
    sharding,
    token_file,
    topk,
    toxicity,
)

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_mixing": mixing.op2_mixing,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_sharding": sharding.op4_sharding,
    "op5_packing": packing.op5_packing,
    "op6_top_k": topk.op6_top_k,
    "op7_near_dedup": near_dedup.op7_near_dedup,
    "op8_language": language.op8_language,
    "op9_html_text": html_text.op9_html_text,
    "op10_passages": passages.op10_passages,
    "op11_manifest": manifest.op11_manifest,
    "op12_token_file": token_file.op12_token_file,
    "op13_alignment": alignment.op13_alignment,
}
ORACLES = {
    "op2_mixing": mixing.ORACLE,
    "op3_exact_dedup": exact_dedup.ORACLE,
    "op6_top_k": topk.ORACLE,
    "op11_manifest": manifest.ORACLE,
}
