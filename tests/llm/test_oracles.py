"""Oracles of the training-data operators: which have one."""

import __spark_entry__ as E
from reelstar.llm import queries


def test_every_query_of_the_entry_has_an_oracle_or_a_reason():
    without = set(E.queries()) - set(E.oracle_sql())
    assert without == set(E.NO_ORACLE) | set(queries.NO_ORACLE)
    assert all(queries.NO_ORACLE.values())
    assert {"op6_ball_tree_search", "op9_rule_ledger", "op12_prefix_trie"} <= set(E.oracle_sql())
