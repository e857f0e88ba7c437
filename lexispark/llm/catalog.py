"""The registered queries of the subpackage and, where SQL can express one, its DuckDB form."""

from __future__ import annotations

from lexispark.llm import chat, classifier, fim, lmscore, merkle, mixing, packing, rules, secretscan, sharding, simhash, toxicity

QUERIES = {
    "op1_lm_scoring": lmscore.op1_lm_scoring,
    "op2_mixing": mixing.op2_mixing,
    "op3_sharding": sharding.op3_sharding,
    "op4_packing": packing.op4_packing,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_quality_classifier": classifier.op6_quality_classifier,
    "op7_fingerprints": merkle.op7_fingerprints,
    "op8_simhash_dedup": simhash.op8_simhash_dedup,
    "op9_chat_format": chat.op9_chat_format,
    "op10_quality_rules": rules.op10_quality_rules,
    "op11_fill_in_middle": fim.op11_fill_in_middle,
    "op12_secret_scan": secretscan.op12_secret_scan,
}
ORACLES = {"op1_lm_scoring": lmscore.OP1_SQL, "op2_mixing": mixing.OP2_SQL, "op9_chat_format": chat.OP9_SQL, "op11_fill_in_middle": fim.OP11_SQL, "op12_secret_scan": secretscan.OP12_SQL}
