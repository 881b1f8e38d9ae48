"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from foliograph.llm.alignment import op12_token_alignment
from foliograph.llm.bpe_dp import op10_bpe_codec
from foliograph.llm.decision_list import op8_quality_rules
from foliograph.llm.html_text import op5_html_extraction
from foliograph.llm.language_id import op3_language_id
from foliograph.llm.order_minhash import op7_near_duplicates
from foliograph.llm.packing import op2_best_fit_packing
from foliograph.llm.pii import op6_pii_surrogates
from foliograph.llm.prefix_trie import op13_conversation_trie
from foliograph.llm.rp_forest import op1_embedding_neardup
from foliograph.llm.rule_ensemble import op9_quality_scores
from foliograph.llm.token_count import op4_token_counts
from foliograph.llm.url_rules import SQL as OP11_SQL
from foliograph.llm.url_rules import op11_url_filters

QUERIES = {
    "op1_embedding_neardup": op1_embedding_neardup,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_language_id": op3_language_id,
    "op4_token_counts": op4_token_counts,
    "op5_html_extraction": op5_html_extraction,
    "op6_pii_surrogates": op6_pii_surrogates,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_quality_rules": op8_quality_rules,
    "op9_quality_scores": op9_quality_scores,
    "op10_bpe_codec": op10_bpe_codec,
    "op11_url_filters": op11_url_filters,
    "op12_token_alignment": op12_token_alignment,
    "op13_conversation_trie": op13_conversation_trie,
}

ORACLES: dict[str, str] = {"op11_url_filters": OP11_SQL}
