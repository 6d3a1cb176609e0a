"""Queries named after an operator do the whole job of the model or report made of it."""

import pytest

from racelake import contract

WHOLE = {
    "topk_semi": "rep_points_progression",
    "match_status": "mart_fact_qualifying",
    "positions_gained": "rep_positions_gained",
    "lookup_update": "mart_dim_circuits",
}


@pytest.mark.parametrize("name", sorted(WHOLE))
def test_whole_job(name):
    assert contract.ORACLE[name] == contract.ORACLE[WHOLE[name]]
    assert contract.QUERIES[name] is contract.QUERIES[WHOLE[name]]


@pytest.mark.parametrize("name", ["topk_semi_orders", "match_status_counts", "positions_gained_all", "lookup_update_suppliers"])
def test_operator_alone_stays(name):
    assert name in contract.QUERIES and name in contract.ORACLE
