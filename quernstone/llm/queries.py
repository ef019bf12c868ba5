"""Queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from . import centroids, decontaminate, exact_dedup, language_id, ngram_join, packing, pii, sharding, spelling, sql, substring_dedup, token_rollup, url_rules, warc


def queries() -> dict:
    return {
        "op1_ngram_join": ngram_join.op1_ngram_join,
        "op2_decontaminate": decontaminate.op2_decontaminate,
        "op3_exact_dedup": exact_dedup.op3_exact_dedup,
        "op4_pii": pii.op4_pii,
        "op5_language_id": language_id.op5_language_id,
        "op6_uniform_shards": sharding.op6_uniform_shards,
        "op7_relative_lz": substring_dedup.op7_relative_lz,
        "op8_best_fit": packing.op8_best_fit,
        "op9_url_rules": url_rules.op9_url_rules,
        "op10_token_rollup": token_rollup.op10_token_rollup,
        "op11_reduced_alphabet": spelling.op11_reduced_alphabet,
        "op12_warc": warc.op12_warc,
        "op13_subvector_centroids": centroids.op13_subvector_centroids,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_ngram_join": sql.OP1,
        "op2_decontaminate": sql.OP2,
        "op3_exact_dedup": sql.OP3,
        "op7_relative_lz": sql.OP7,
        "op11_reduced_alphabet": sql.OP11,
        "op12_warc": sql.OP12,
        "op13_subvector_centroids": sql.OP13,
    }
