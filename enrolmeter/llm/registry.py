"""Every corpus query by name, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from . import (
    bpe, chat_format, filter_audit, importance, lexicon_bpe, license_scan, line_dedup, minmax_dedup, mixing, pii,
    pivot_topk, quality_net, quality_rules,
)

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_chat_format": chat_format.op2_chat_format,
    "op3_pii": pii.op3_pii,
    "op4_license_scan": license_scan.op4_license_scan,
    "op5_quality_net": quality_net.op5_quality_net,
    "op6_pivot_topk": pivot_topk.op6_pivot_topk,
    "op7_mix_sources": mixing.op7_mix_sources,
    "op8_byte_bpe": bpe.op8_byte_bpe,
    "op9_quality_rules": quality_rules.op9_quality_rules,
    "op10_minmax_dedup": minmax_dedup.op10_minmax_dedup,
    "op11_importance_draw": importance.op11_importance_draw,
    "op12_lexicon_bpe": lexicon_bpe.op12_lexicon_bpe,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}
ORACLES = {
    "op1_line_dedup": line_dedup.ORACLE,
    "op2_chat_format": chat_format.ORACLE,
    "op4_license_scan": license_scan.ORACLE,
    "op6_pivot_topk": pivot_topk.ORACLE,
    "op7_mix_sources": mixing.ORACLE,
    "op9_quality_rules": quality_rules.ORACLE,
    "op11_importance_draw": importance.ORACLE,
    "op13_filter_audit": filter_audit.ORACLE,
}
