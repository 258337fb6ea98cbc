"""The queries of this subpackage by name, and their SQL where there is one."""

from __future__ import annotations

from freshet.llm import (
    backoff_model,
    byte_bpe,
    decision_lists,
    epsilon_grid,
    hard_negatives,
    html_blocks,
    licences,
    minhash_forest,
    mixing,
    packing,
    toxicity,
    url_filters,
    whitening,
)

LLM_QUERIES = {
    f.__name__: f
    for f in (
        html_blocks.op1_html_extraction,
        packing.op2_best_fit_packing,
        epsilon_grid.op3_epsilon_grid,
        licences.op4_license_scan,
        url_filters.op5_url_filters,
        decision_lists.op6_quality_rules,
        minhash_forest.op7_minhash_forest,
        backoff_model.op8_backoff_model,
        mixing.op9_mixing,
        toxicity.op10_toxicity,
        whitening.op11_whitening,
        hard_negatives.op12_hard_negatives,
        byte_bpe.op13_byte_bpe,
    )
}

LLM_ORACLE_SQL: dict[str, str] = {"op12_hard_negatives": hard_negatives.ORACLE_SQL}
