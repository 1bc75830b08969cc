"""The queries of this subpackage: (spark, sf_dir) -> DataFrame, and DuckDB SQL where it can
state the same rows."""

from __future__ import annotations

from . import oracle
from .bpe import op10_bpe
from .chat import op5_chat
from .hard_negatives import op11_hard_negatives
from .license_scan import op1_license
from .lm_score import op4_lm
from .mixing import op6_mixing
from .near_dedup import op8_near_dedup
from .prefix_trie import op12_prefix_trie
from .quality_clf import op7_quality
from .quality_rules import op3_quality_rules
from .sharding import op9_sharding
from .simhash import op13_simhash
from .topk import op2_topk

QUERIES = {
    "op1_license": op1_license,
    "op2_topk": op2_topk,
    "op3_quality_rules": op3_quality_rules,
    "op4_lm": op4_lm,
    "op5_chat": op5_chat,
    "op6_mixing": op6_mixing,
    "op7_quality": op7_quality,
    "op8_near_dedup": op8_near_dedup,
    "op9_sharding": op9_sharding,
    "op10_bpe": op10_bpe,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_simhash": op13_simhash,
}

ORACLE = {
    "op1_license": oracle.LICENSE,
    "op2_topk": oracle.TOPK,
    "op3_quality_rules": oracle.QUALITY_RULES,
    "op5_chat": oracle.CHAT,
    "op6_mixing": oracle.MIXING,
    "op9_sharding": oracle.SHARDING,
    "op11_hard_negatives": oracle.HARD_NEGATIVES,
    "op12_prefix_trie": oracle.PREFIX_TRIE,
}
