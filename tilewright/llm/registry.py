"""Queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from .chunks import op1_substring_dedup
from .fim import OP11_SQL, op11_fill_in_middle
from .hpylm import op12_lm_scoring
from .langid import op7_language_id
from .mixing import OP3_SQL, op3_mix_sources
from .ngramjoin import OP5_SQL, op5_ngram_jaccard_join
from .packing import op2_best_fit_packing
from .phrases import OP13_SQL, op13_phrase_mining
from .quality import op8_quality_rules
from .secrets import OP6_SQL, op6_secret_scan
from .suffixes import OP4_SQL, op4_suffix_dedup
from .topk import OP10_SQL, op10_exact_topk
from .urls import OP9_SQL, op9_url_filters

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_mix_sources": op3_mix_sources,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_secret_scan": op6_secret_scan,
    "op7_language_id": op7_language_id,
    "op8_quality_rules": op8_quality_rules,
    "op9_url_filters": op9_url_filters,
    "op10_exact_topk": op10_exact_topk,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_lm_scoring": op12_lm_scoring,
    "op13_phrase_mining": op13_phrase_mining,
}
SQL = {
    "op3_mix_sources": OP3_SQL,
    "op4_suffix_dedup": OP4_SQL,
    "op5_ngram_jaccard_join": OP5_SQL,
    "op6_secret_scan": OP6_SQL,
    "op9_url_filters": OP9_SQL,
    "op10_exact_topk": OP10_SQL,
    "op11_fill_in_middle": OP11_SQL,
    "op13_phrase_mining": OP13_SQL,
}
