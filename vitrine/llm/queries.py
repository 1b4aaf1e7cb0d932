"""The queries of this package by name, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from vitrine.llm import chat, decontaminate, html_text, kneser_ney, licenses, packing, quality, ranked, secrets, simhash, substrings, token_files, whitening

QUERIES = {
    "op1_license_scan": licenses.op1_license_scan,
    "op2_quality_rules": quality.op2_quality_rules,
    "op3_chat_formatting": chat.op3_chat_formatting,
    "op4_simhash_near_dedup": simhash.op4_simhash_near_dedup,
    "op5_token_files": token_files.op5_token_files,
    "op6_html_extraction": html_text.op6_html_extraction,
    "op7_benchmark_decontamination": decontaminate.op7_benchmark_decontamination,
    "op8_secret_scan": secrets.op8_secret_scan,
    "op9_quality_classifier": kneser_ney.op9_quality_classifier,
    "op10_best_fit_packing": packing.op10_best_fit_packing,
    "op11_ranked_search": ranked.op11_ranked_search,
    "op12_substring_dedup": substrings.op12_substring_dedup,
    "op13_embedding_whitening": whitening.op13_embedding_whitening,
}

ORACLE = {
    "op1_license_scan": licenses.ORACLE,
    "op3_chat_formatting": chat.ORACLE,
    "op7_benchmark_decontamination": decontaminate.ORACLE,
    "op8_secret_scan": secrets.ORACLE,
    "op11_ranked_search": ranked.ORACLE,
}
