"""Queries of the training-data operators, and the SQL of those that have any."""

from __future__ import annotations

from .collocations import OP11_SQL, op11_collocations
from .decontaminate import op10_decontaminate
from .hard_negatives import OP13_SQL, op13_hard_negatives
from .language_id import op3_language_id
from .line_dedup import OP2_SQL, op2_line_dedup
from .lm_scoring import op12_lm_scoring
from .minhash_dedup import OP6_SQL, op6_minhash_dedup
from .source_mix import op4_source_mix
from .substring_dedup import OP5_SQL, op5_substring_dedup
from .token_counts import op8_token_counts
from .topk_search import OP1_SQL, op1_topk_search
from .toxicity import op9_toxicity
from .warc import op7_warc

QUERIES = {f.__name__: f for f in (
    op1_topk_search, op2_line_dedup, op3_language_id, op4_source_mix, op5_substring_dedup, op6_minhash_dedup,
    op7_warc, op8_token_counts, op9_toxicity, op10_decontaminate,
    op11_collocations, op12_lm_scoring, op13_hard_negatives)}

SQL = {"op1_topk_search": OP1_SQL, "op2_line_dedup": OP2_SQL, "op5_substring_dedup": OP5_SQL, "op6_minhash_dedup": OP6_SQL,
       "op11_collocations": OP11_SQL, "op13_hard_negatives": OP13_SQL}
