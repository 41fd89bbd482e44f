"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from quire.llm import byte_pairs, fill_middle, pieces, quality_model, quality_rules, secret_scan, shards, simhash, source_mix, substring_dedup, suffix_dedup, token_alignment, topk


def queries() -> dict:
    import corpus_pipeline

    return {
        "op1_secret_scan": secret_scan.op1_secret_scan,
        "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
        "op3_simhash": simhash.op3_simhash,
        "op4_quality_model": quality_model.op4_quality_model,
        "op5_shards": shards.op5_shards,
        "op6_substring_dedup": substring_dedup.op6_substring_dedup,
        "op7_top_k": topk.op7_top_k,
        "op8_quality_rules": quality_rules.op8_quality_rules, "op9_source_mix": source_mix.op9_source_mix,
        "op10_pieces": pieces.op10_pieces,
        "op11_fill_middle": fill_middle.op11_fill_middle,
        "op12_token_alignment": token_alignment.op12_token_alignment,
        "op13_byte_pairs": byte_pairs.op13_byte_pairs,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_secret_scan": secret_scan.oracle(),
        "op2_suffix_dedup": suffix_dedup.oracle(),
        "op6_substring_dedup": substring_dedup.oracle(),
        "op7_top_k": topk.oracle(),
        "op8_quality_rules": quality_rules.oracle(), "op9_source_mix": source_mix.oracle(),
        "op11_fill_middle": fill_middle.oracle(),
    }
