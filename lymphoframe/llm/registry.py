"""Queries of the training-data operators and their DuckDB counterparts."""

from __future__ import annotations

from lymphoframe.llm import bpe, codes, fingerprints, lines, minhash, negatives, packing, pages, quality, secrets, sharding, substrings, vectors

QUERIES = {
    "op1_substring_dedup": substrings.op1_substring_dedup,
    "op2_byte_bpe": bpe.op2_byte_bpe,
    "op3_minhash": minhash.op3_minhash,
    "op4_quality": quality.op4_quality,
    "op5_line_dedup": lines.op5_line_dedup,
    "op6_embedding_dedup": vectors.op6_embedding_dedup,
    "op7_fingerprints": fingerprints.op7_fingerprints,
    "op8_packing": packing.op8_packing,
    "op9_secret_scan": secrets.op9_secret_scan,
    "op10_html_text": pages.op10_html_text,
    "op11_hard_negatives": negatives.op11_hard_negatives,
    "op12_vector_codes": codes.op12_vector_codes,
    "op13_sharding": sharding.op13_sharding,
}

#: Operators that SQL can't express have none; tests/llm holds their brute-force versions.
ORACLES: dict[str, str] = {}
