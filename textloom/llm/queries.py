"""Registered queries of this subpackage, and their SQL."""

from __future__ import annotations

from .chat import OP7_SQL, op7_chat
from .debruijn import OP10_SQL, op10_debruijn
from .decontaminate import OP3_SQL, op3_decontaminate
from .line_dedup import OP1_SQL, op1_line_dedup
from .mixing import op2_mixing
from .quality_rules import op5_quality_rules
from .sharding import OP9_SQL, op9_sharding
from .simhash import op8_simhash
from .suffix_array import OP6_SQL, op6_suffix_array
from .token_counts import op4_token_counts


def queries() -> dict:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_mixing": op2_mixing,
        "op3_decontaminate": op3_decontaminate,
        "op4_token_counts": op4_token_counts,
        "op5_quality_rules": op5_quality_rules,
        "op6_suffix_array": op6_suffix_array,
        "op7_chat": op7_chat,
        "op8_simhash": op8_simhash,
        "op9_sharding": op9_sharding,
        "op10_debruijn": op10_debruijn,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": OP1_SQL,
        "op3_decontaminate": OP3_SQL,
        "op6_suffix_array": OP6_SQL,
        "op7_chat": OP7_SQL,
        "op9_sharding": OP9_SQL,
        "op10_debruijn": OP10_SQL,
    }
