"""The dealt queries and their SQL, by name."""

from __future__ import annotations

from corpusflow.llm import band_join, id_store, impact_index, jaccard_join, language_id, license_scan, media, packing, quality_classifier, quality_rules, secret_scan, sentence_pieces, token_counts

QUERIES = {
    "op1_quality_rules": quality_rules.op1_quality_rules,
    "op2_quality_classifier": quality_classifier.op2_quality_classifier,
    "op3_jaccard_join": jaccard_join.op3_jaccard_join,
    "op4_license_scan": license_scan.op4_license_scan,
    "op5_language_id": language_id.op5_language_id,
    "op6_packing": packing.op6_packing,
    "op7_sentence_pieces": sentence_pieces.op7_sentence_pieces,
    "op8_media_columns": media.op8_media_columns,
    "op9_token_counts": token_counts.op9_token_counts,
    "op10_secret_scan": secret_scan.op10_secret_scan,
    "op11_id_store": id_store.op11_id_store,
    "op12_impact_search": impact_index.op12_impact_search,
    "op13_band_join": band_join.op13_band_join,
    "rule_ablation": quality_rules.rule_ablation,
}
ORACLES = {
    "op1_quality_rules": quality_rules.ORACLE,
    "op3_jaccard_join": jaccard_join.ORACLE,
    "op4_license_scan": license_scan.ORACLE,
    "op10_secret_scan": secret_scan.ORACLE,
    "op12_impact_search": impact_index.ORACLE,
    "op13_band_join": band_join.ORACLE,
    "rule_ablation": quality_rules.ABLATION_ORACLE,
}
