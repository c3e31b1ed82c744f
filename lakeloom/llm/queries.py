"""Queries of the operators, and their check SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm.alignment import op13_alignment
from lakeloom.llm.chat import OP6_SQL, op6_chat_rotation
from lakeloom.llm.circulant import op9_minhash
from lakeloom.llm.decision_list import op5_quality_rules
from lakeloom.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from lakeloom.llm.hmm import op2_hmm
from lakeloom.llm.lattice import op4_sentencepiece
from lakeloom.llm.mixing import OP3_SQL, op3_mixing
from lakeloom.llm.pivots import op7_pivots
from lakeloom.llm.sharding import op1_sharding, op1_sql
from lakeloom.llm.template_html import op8_template_html
from lakeloom.llm.toxicity import op11_toxicity
from lakeloom.llm.wordpiece import op10_token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_hmm": op2_hmm,
    "op3_mixing": op3_mixing,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_quality_rules": op5_quality_rules,
    "op6_chat_rotation": op6_chat_rotation,
    "op7_pivots": op7_pivots,
    "op8_template_html": op8_template_html,
    "op9_minhash": op9_minhash,
    "op10_token_counts": op10_token_counts,
    "op11_toxicity": op11_toxicity,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_alignment": op13_alignment,
}


def check_sql() -> dict[str, str]:
    return {"op1_sharding": op1_sql(), "op3_mixing": OP3_SQL, "op6_chat_rotation": OP6_SQL,
            "op12_hard_negatives": OP12_SQL}
