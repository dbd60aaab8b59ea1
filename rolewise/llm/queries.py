"""The registered queries of the subpackage, with their SQL twins where SQL can express them."""

from __future__ import annotations

from . import (op1_substring_dedup, op2_ngram_jaccard_join, op3_url_filters, op4_decontamination, op5_lm_scoring, op6_suffix_array_dedup,
               op7_language_id, op8_source_mix, op9_toxicity, op10_exact_top_k, op11_embedding_whitening, op12_secret_scan, op13_merkle_manifest)

_MODULES = (op1_substring_dedup, op2_ngram_jaccard_join, op3_url_filters, op4_decontamination, op5_lm_scoring, op6_suffix_array_dedup,
            op7_language_id, op8_source_mix, op9_toxicity, op10_exact_top_k, op11_embedding_whitening, op12_secret_scan, op13_merkle_manifest)

QUERIES = {m.__name__.rpartition(".")[2]: m.query for m in _MODULES}
SQL = {m.__name__.rpartition(".")[2]: m.SQL for m in _MODULES if hasattr(m, "SQL")}
