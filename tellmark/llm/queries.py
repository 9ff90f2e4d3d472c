"""The registered queries of this package and the SQL they are checked with."""
from __future__ import annotations

from tellmark.llm import exact_dedup, fingerprint, licenses, line_dedup, mixing, ngram_join, personal_data, pieces, prefix_trie, ranked_search, sharding, token_counts, toxicity

QUERIES = {
    "op1_toxicity": toxicity.query,
    "op2_sharding": sharding.query,
    "op3_ngram_join": ngram_join.query,
    "op4_licenses": licenses.query,
    "op5_mixing": mixing.query,
    "op6_line_dedup": line_dedup.query,
    "op7_personal_data": personal_data.query,
    "op8_pieces": pieces.query,
    "op9_fingerprint": fingerprint.query,
    "op10_exact_dedup": exact_dedup.query,
    "op11_token_counts": token_counts.query,
    "op12_prefix_trie": prefix_trie.query,
    "op13_ranked_search": ranked_search.query,
}
ORACLES = {
    "op5_mixing": mixing.ORACLE,
    "op10_exact_dedup": exact_dedup.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
    "op13_ranked_search": ranked_search.ORACLE,
}
