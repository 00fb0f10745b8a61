"""Named queries of this subpackage and the SQL that must give the same rows."""

from __future__ import annotations

from wattshed.llm.bpe import op6_bpe_prefixes
from wattshed.llm.chat import op2_prefix_targets
from wattshed.llm.hamming import op4_multi_index_hashing
from wattshed.llm.jaccard import op5_jaccard_join, op5_jaccard_links
from wattshed.llm.negatives import op11_hard_negatives
from wattshed.llm.oracles import ORACLES
from wattshed.llm.packing import op9_min_slack_packing
from wattshed.llm.pages import op8_recurrent_html
from wattshed.llm.patterns import op12_pattern_packing
from wattshed.llm.quality import op7_adaptive_quality
from wattshed.llm.secrets import op10_owned_secrets
from wattshed.llm.substrings import op1_substring_dedup
from wattshed.llm.toxicity import op3_weak_supervision
from wattshed.llm.turns import op13_structure_repair

__all__ = ["ORACLES", "QUERIES"]

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_prefix_targets": op2_prefix_targets,
    "op3_weak_supervision": op3_weak_supervision,
    "op4_multi_index_hashing": op4_multi_index_hashing,
    "op5_jaccard_join": op5_jaccard_join,
    "op5_jaccard_links": op5_jaccard_links,
    "op6_bpe_prefixes": op6_bpe_prefixes,
    "op7_adaptive_quality": op7_adaptive_quality,
    "op8_recurrent_html": op8_recurrent_html,
    "op9_min_slack_packing": op9_min_slack_packing,
    "op10_owned_secrets": op10_owned_secrets,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_pattern_packing": op12_pattern_packing,
    "op13_structure_repair": op13_structure_repair,
}
