"""The registered queries of the text operators and their SQL."""

from __future__ import annotations

from stockwright.llm import (
    chat_format,
    decontaminate,
    jaccard_join,
    license_scan,
    merkle_manifest,
    neighbour_quality,
    oracles,
    packing,
    personal_data,
    quality_rules,
    ranked_search,
    secrets,
    substring_dedup,
    suffix_tree_lm,
)

QUERIES = {
    "op1_license_scan": license_scan.op1_license_scan,
    "op2_secrets": secrets.op2_secrets,
    "op3_substring_dedup": substring_dedup.op3_substring_dedup,
    "op4_suffix_tree_lm": suffix_tree_lm.op4_suffix_tree_lm,
    "op5_neighbour_quality": neighbour_quality.op5_neighbour_quality,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op8_jaccard_join": jaccard_join.op8_jaccard_join,
    "op9_packing": packing.op9_packing,
    "op10_chat_format": chat_format.op10_chat_format,
    "op11_merkle_manifest": merkle_manifest.op11_merkle_manifest,
    "op12_personal_data": personal_data.op12_personal_data,
    "op13_ranked_search": ranked_search.op13_ranked_search,
}

ORACLES = {
    "op3_substring_dedup": oracles.SUBSTRINGS,
    "op6_decontaminate": oracles.OVERLAPS,
    "op8_jaccard_join": oracles.LINKS,
    "op10_chat_format": chat_format.ORACLE,
    "op11_merkle_manifest": oracles.MANIFEST,
    "op13_ranked_search": oracles.RANKED,
}
