"""The registered queries of this subpackage: one per operator."""

from __future__ import annotations

from . import bpe, collocations, edit_counts, exact_dedup, fingerprints, lexical_search, near_join, quality, secret_scan, simhash, source_mix, substring_dedup, warc

_MODULES = {
    "op1_quality": quality,
    "op3_fingerprints": fingerprints,
    "op6_bpe": bpe,
    "op2_substring_dedup": substring_dedup,
    "op4_secret_scan": secret_scan,
    "op5_source_mix": source_mix,
    "op7_near_join": near_join,
    "op8_exact_dedup": exact_dedup,
    "op9_warc": warc,
    "op10_edit_counts": edit_counts,
    "op11_lexical_search": lexical_search,
    "op12_collocations": collocations,
    "op13_simhash": simhash,
}


def queries() -> dict:
    return {name: module.query for name, module in _MODULES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: module.ORACLE_SQL for name, module in _MODULES.items() if getattr(module, "ORACLE_SQL", None)}
