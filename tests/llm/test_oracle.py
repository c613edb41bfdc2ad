from __future__ import annotations

from clickloom.llm.queries import ORACLES, QUERIES

BY_BRUTE_FORCE = {"op1_toxicity", "op2_simhash", "op6_packing", "op7_quality", "op9_token_counts", "op10_katz"}


def test_every_query_has_a_counterpart_or_a_brute_force_test():
    assert set(QUERIES) - BY_BRUTE_FORCE == set(ORACLES)
