"""Queries of the subpackage and, where SQL can express them, their DuckDB SQL."""

from . import decontam, divergence, linededup, lm, neardup, packing, pieces, quality, secrets, tokencounts, toxicity, warc, whitening

QUERIES = {
    "op1_token_counts": tokencounts.op1_token_counts,
    "op2_line_dedup": linededup.op2_line_dedup,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_warc_normaliser": warc.op4_warc_normaliser,
    "op5_lm_scoring": lm.op5_lm_scoring,
    "op6_benchmark_decontamination": decontam.op6_benchmark_decontamination,
    "op7_best_fit_packing": packing.op7_best_fit_packing,
    "op8_quality_rules": quality.op8_quality_rules,
    "op9_secret_scans": secrets.op9_secret_scans,
    "op10_minhash_near_dedup": neardup.op10_minhash_near_dedup,
    "op11_source_divergence": divergence.op11_source_divergence,
    "op12_sentencepiece": pieces.op12_sentencepiece,
    "op13_embedding_whitening": whitening.op13_embedding_whitening,
}
ORACLES: dict[str, str] = {
    "op4_warc_normaliser": warc.OP4_SQL,
    "op6_benchmark_decontamination": decontam.OP6_SQL,
    "op8_quality_rules": quality.OP8_SQL,
    "op10_minhash_near_dedup": neardup.OP10_SQL,
    "op11_source_divergence": divergence.OP11_SQL,
}
