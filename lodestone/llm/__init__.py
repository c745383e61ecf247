"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage."""

from __future__ import annotations

from .dialogue_repair import OP12_SQL, op12_repair_conversations
from .hard_negatives import OP11_SQL, op11_hard_negatives
from .katz import op5_katz_scores
from .language_id import op13_language_id
from .line_dedup import op9_line_dedup
from .mixing import op7_mix_documents
from .near_dup import op10_near_duplicates
from .packing import op2_pack_documents
from .quality import op1_quality_rules
from .rollups import op8_token_rollup
from .secrets import op6_find_secrets
from .suffix_dedup import op3_remove_repeats
from .topk import OP4_SQL, op4_top_k


def queries() -> dict:
    found = [op1_quality_rules, op2_pack_documents, op3_remove_repeats, op4_top_k, op5_katz_scores, op6_find_secrets, op7_mix_documents, op8_token_rollup, op9_line_dedup, op10_near_duplicates, op11_hard_negatives, op12_repair_conversations, op13_language_id]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op4_top_k": OP4_SQL, "op11_hard_negatives": OP11_SQL, "op12_repair_conversations": OP12_SQL}
