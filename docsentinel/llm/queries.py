"""Registered queries of the subpackage and their SQL."""

from __future__ import annotations

from docsentinel.llm.divergence_rules import op11_divergence_rules
from docsentinel.llm.dual_tree import op12_dual_tree
from docsentinel.llm.fm_index import op10_fm_decontaminate
from docsentinel.llm.licences import op8_licences
from docsentinel.llm.lz_fingerprint import op1_lz_fingerprint
from docsentinel.llm.packing import op6_pack
from docsentinel.llm.quality_gam import op5_quality
from docsentinel.llm.sharding import op9_rendezvous
from docsentinel.llm.simhash import op4_simhash
from docsentinel.llm.sql import DECONTAMINATION, DIVERGENCE_RULES, RANKED_SEARCH, REPEATS
from docsentinel.llm.suffix_dedup import op2_suffix_dedup
from docsentinel.llm.suffix_tree_lm import op3_suffix_tree
from docsentinel.llm.token_alignment import op13_align
from docsentinel.llm.toxicity import op7_toxicity

QUERIES = {
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_suffix_tree": op3_suffix_tree,
    "op7_toxicity": op7_toxicity,
    "op5_quality": op5_quality,
    "op6_pack": op6_pack,
    "op10_fm_decontaminate": op10_fm_decontaminate,
    "op4_simhash": op4_simhash,
    "op1_lz_fingerprint": op1_lz_fingerprint,
    "op8_licences": op8_licences,
    "op9_rendezvous": op9_rendezvous,
    "op11_divergence_rules": op11_divergence_rules,
    "op12_dual_tree": op12_dual_tree,
    "op13_align": op13_align,
}

ORACLE_SQL: dict[str, str] = {
    "op11_divergence_rules": DIVERGENCE_RULES,
    "op12_dual_tree": RANKED_SEARCH,
    "op2_suffix_dedup": REPEATS,
    "op10_fm_decontaminate": DECONTAMINATION,
}
