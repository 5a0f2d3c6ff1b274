"""The subpackage's queries and their DuckDB SQL, by name."""

from __future__ import annotations

from credlake.llm import (
    op1_bpe,
    op2_quality,
    op3_quality_classifier,
    op4_warc,
    op5_suffix_dedup,
    op6_sharding,
    op7_decontaminate,
    op8_simhash,
    op9_token_counts,
    op10_pii,
    op11_centroids,
    op12_merkle,
    op13_windows,
)

QUERIES = {
    "op1_byte_bpe": op1_bpe.op1_byte_bpe,
    "op2_quality_rules": op2_quality.op2_quality_rules,
    "op3_pu_classifier": op3_quality_classifier.op3_pu_classifier,
    "op4_warc_round_trip": op4_warc.op4_warc_round_trip,
    "op5_suffix_dedup": op5_suffix_dedup.op5_suffix_dedup,
    "op6_rendezvous_shards": op6_sharding.op6_rendezvous_shards,
    "op7_winnowing": op7_decontaminate.op7_winnowing,
    "op8_simhash_components": op8_simhash.op8_simhash_components,
    "op9_token_counts": op9_token_counts.op9_token_counts,
    "op10_pii_surrogates": op10_pii.op10_pii_surrogates,
    "op11_centroid_clusters": op11_centroids.op11_centroid_clusters,
    "op12_merkle_manifest": op12_merkle.op12_merkle_manifest,
    "op13_window_dedup": op13_windows.op13_window_dedup,
}
ORACLES = {
    "op2_quality_rules": op2_quality.ORACLE,
    "op4_warc_round_trip": op4_warc.ORACLE,
    "op6_rendezvous_shards": op6_sharding.ORACLE,
    "op7_winnowing": op7_decontaminate.ORACLE,
    "op11_centroid_clusters": op11_centroids.ORACLE,
    "op12_merkle_manifest": op12_merkle.ORACLE,
    "op13_window_dedup": op13_windows.ORACLE,
}
