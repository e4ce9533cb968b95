"""The queries that the entry module registers, and their SQL where SQL can express them."""

from __future__ import annotations

from .ann import op13_nearest_neighbours
from .bpe import op7_bpe
from .decontaminate import op8_decontaminate
from .hard_negatives import OP11_SQL, op11_hard_negatives
from .html_text import op10_html_text
from .licenses import OP6_SQL, op6_licenses
from .near_duplicates import op9_near_duplicates
from .prefix_trie import OP12_SQL, op12_prefix_trie
from .quality import op4_quality_rules
from .repeats import op1_suffix_dedup
from .token_counts import op3_token_counts
from .tool_calls import OP5_SQL, op5_tool_calls
from .toxicity import op2_toxicity

QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_token_counts": op3_token_counts,
    "op4_quality_rules": op4_quality_rules,
    "op5_tool_calls": op5_tool_calls,
    "op6_licenses": op6_licenses,
    "op7_bpe": op7_bpe,
    "op8_decontaminate": op8_decontaminate,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_html_text": op10_html_text,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}
ORACLES: dict[str, str] = {"op5_tool_calls": OP5_SQL, "op6_licenses": OP6_SQL, "op11_hard_negatives": OP11_SQL, "op12_prefix_trie": OP12_SQL}
