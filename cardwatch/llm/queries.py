"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import (alignment, class_lm, decontaminate, language_id, line_dedup, mixing, ngram_join, personal_data,
               quality, secrets, sharding, simhash, vector_codes)

QUERIES = {f.__name__: f for f in (
    ngram_join.op1_ngram_jaccard_join,
    quality.op2_quality_rules,
    language_id.op3_language_id,
    sharding.op4_extendible_sharding,
    mixing.op5_mixing,
    class_lm.op6_class_lm_scoring,
    secrets.op7_secret_scan,
    line_dedup.op8_line_dedup,
    decontaminate.op9_benchmark_decontamination,
    personal_data.op10_personal_data,
    vector_codes.op11_vector_codes,
    simhash.op12_simhash_dedup,
    alignment.op13_token_alignment,
)}
ORACLE = {
    "op4_extendible_sharding": sharding.ORACLE,
    "op8_line_dedup": line_dedup.ORACLE,
    "op11_vector_codes": vector_codes.ORACLE,
}
