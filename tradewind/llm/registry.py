"""The corpus queries by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from tradewind.llm import sql
from tradewind.llm.ann import op9_collision_ann
from tradewind.llm.language import op6_crf_language
from tradewind.llm.line_dedup import op2_winnowing_lines
from tradewind.llm.merkle import op13_merkle_manifest
from tradewind.llm.mixing import op3_temperature_mixing
from tradewind.llm.mixing_lm import op4_context_mixing
from tradewind.llm.packing import op10_vector_packing
from tradewind.llm.quality import op1_nnpu_quality
from tradewind.llm.sharding import op5_jump_sharding
from tradewind.llm.simhash import op8_golay_simhash
from tradewind.llm.spelling import op11_spelling_groups
from tradewind.llm.suffix_dedup import op12_bwt_dedup
from tradewind.llm.topk import op7_columnar_topk

QUERIES = {
    f.__name__: f
    for f in (
        op1_nnpu_quality, op2_winnowing_lines, op3_temperature_mixing, op4_context_mixing, op5_jump_sharding,
        op6_crf_language, op7_columnar_topk, op8_golay_simhash, op9_collision_ann, op10_vector_packing,
        op11_spelling_groups, op12_bwt_dedup, op13_merkle_manifest,
    )
}

ORACLE = {
    "op7_columnar_topk": sql.TOP_K,
    "op11_spelling_groups": sql.SPELLING,
    "op12_bwt_dedup": sql.REPEATS,
    "op13_merkle_manifest": sql.MANIFEST,
}
