"""The operators bound to the given tables, each with its SQL twin where SQL can express it."""

from __future__ import annotations

from lamina.llm import (
    bottom_k,
    bpe,
    centroids,
    licenses,
    line_dedup,
    nearest,
    packing,
    pii,
    quality,
    simhash,
    spotsigs,
    token_files,
    turns,
)

QUERIES = {
    "op1_multi_index_hashing": nearest.query,
    "op2_bpe_rank_array": bpe.query,
    "op3_spot_signatures": spotsigs.query,
    "op4_exact_line_join": line_dedup.query,
    "op5_directly_addressable_codes": token_files.query,
    "op6_attention_mil": quality.query,
    "op7_simhash_anchors": simhash.query,
    "op8_signature_rules": licenses.query,
    "op9_candidate_boosting": pii.query,
    "op10_linear_grouping": packing.query,
    "op11_heap_bounds": centroids.query,
    "op12_auction_repair": turns.query,
    "op13_bottom_k": bottom_k.query,
}

SQL: dict[str, str] = {
    "op4_exact_line_join": line_dedup.SQL,
    "op11_heap_bounds": centroids.SQL,
    "op12_auction_repair": turns.SQL,
    "op13_bottom_k": bottom_k.SQL,
}
