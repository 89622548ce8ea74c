"""The corpus queries by name, with the SQL of those that SQL can express."""

from __future__ import annotations

from lakeloom.llm import alignment, gam, itq, jaccard, licenses, lm, packing, periods, pieces, repeats, tiling, toxicity, wrappers

QUERIES = {f.__name__: f for f in (
    jaccard.op1_ngram_jaccard,
    tiling.op2_benchmark_tiling,
    itq.op3_itq_near_duplicates,
    toxicity.op4_toxic_neighbours,
    repeats.op5_suffix_array_dedup,
    packing.op6_packed_tokens,
    gam.op7_quality_gam,
    wrappers.op8_wrapper_extraction,
    pieces.op9_sampled_pieces,
    lm.op10_attention_scores,
    licenses.op11_license_scan,
    periods.op12_periodic_runs,
    alignment.op13_token_alignment,
)}
SQL = {**jaccard.ORACLE, **itq.ORACLE, **repeats.ORACLE}
