"""Queries and SQL of this subpackage, for __spark_entry__.py."""

from __future__ import annotations

from . import html_text, language_id, maxscore, mixing, packing, pii, probminhash_dedup, rabitq_dedup, recompression_dedup, suffix_dedup, turn_repair, url_rules, whitening


def queries() -> dict:
    return {
        "op1_maxscore_top_k": maxscore.op1_maxscore_top_k,
        "op2_recompression_dedup": recompression_dedup.op2_recompression_dedup,
        "op3_pii_pseudonyms": pii.op3_pii_pseudonyms,
        "op4_best_fit_packing": packing.op4_best_fit_packing,
        "op5_language_id": language_id.op5_language_id,
        "op6_html_main_text": html_text.op6_html_main_text,
        "op7_probminhash_near_dedup": probminhash_dedup.op7_probminhash_near_dedup,
        "op8_embedding_near_dedup": rabitq_dedup.op8_embedding_near_dedup,
        "op9_mixing": mixing.op9_mixing,
        "op10_suffix_array_dedup": suffix_dedup.op10_suffix_array_dedup,
        "op11_whitening": whitening.op11_whitening,
        "op12_url_filters": url_rules.op12_url_filters,
        "op13_turn_repair": turn_repair.op13_turn_repair,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_maxscore_top_k": maxscore.SQL, "op9_mixing": mixing.SQL, "op12_url_filters": url_rules.SQL, "op13_turn_repair": turn_repair.SQL}
