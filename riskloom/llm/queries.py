"""The corpus operators as named queries over the given tables."""

from __future__ import annotations

import corpus_pipeline
from riskloom.llm import (
    byte_bpe,
    class_lm,
    cotraining,
    decontamination,
    html_text,
    language,
    lexical,
    licenses,
    negatives,
    oracles,
    packing,
    quality_rules,
    simhash,
    toxicity,
)

QUERIES = {
    "op1_best_fit_packing": packing.op1_best_fit_packing,
    "op2_class_lm": class_lm.op2_class_lm,
    "op3_quality_rules": quality_rules.op3_quality_rules,
    "op4_decontamination": decontamination.op4_decontamination,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_html_text": html_text.op6_html_text,
    "op7_license_scan": licenses.op7_license_scan,
    "op8_language_id": language.op8_language_id,
    "op9_quality_cotraining": cotraining.op9_quality_cotraining,
    "op10_simhash_near_dedup": simhash.op10_simhash_near_dedup,
    "op11_hard_negatives": negatives.op11_hard_negatives,
    "op12_byte_bpe": byte_bpe.op12_byte_bpe,
    "op13_lexical_search": lexical.op13_lexical_search,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {
    "op3_quality_rules": oracles.quality_sql(),
    "op4_decontamination": oracles.leak_sql(),
    "op7_license_scan": oracles.license_sql(),
    "op11_hard_negatives": oracles.negatives_sql(),
    "op13_lexical_search": oracles.search_sql(),
}
