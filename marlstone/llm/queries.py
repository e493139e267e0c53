"""The queries of this subpackage and their SQL, for registration."""

from __future__ import annotations

from marlstone.llm import (
    conversation_repair,
    decontamination,
    language_id,
    license_scan,
    near_duplicates,
    packing,
    quality_rules,
    simhash,
    spelling,
    suffix_dedup,
    token_counts,
    toxicity,
    url_filter,
)
from marlstone.llm import oracles as sql

QUERIES = {
    "op1_language_id": language_id.op1_language_id,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_packing": packing.op3_packing,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_decontamination": decontamination.op5_decontamination,
    "op6_jaccard_join": near_duplicates.op6_jaccard_join,
    "op7_url_rules": url_filter.op7_url_rules,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_suffix_dedup": suffix_dedup.op9_suffix_dedup,
    "op10_license_scan": license_scan.op10_license_scan,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_conversation_repair": conversation_repair.op12_conversation_repair,
    "op13_simhash_groups": simhash.op13_simhash_groups,
}


def oracles() -> dict[str, str]:
    return {
        "op7_url_rules": url_filter.oracle(),
        "op9_suffix_dedup": sql.suffix_dedup(),
        "op11_spelling_variants": sql.spelling_variants(),
        "op12_conversation_repair": sql.conversation_repair(),
    }
