"""Queries that SQL can express against DuckDB."""

import pytest

from loomspark.llm import queries as Q

from ..oracle import differ

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_matches_sql(spark, name):
    assert differ(Q.queries()[name](spark, SF), SF, Q.oracle_sql()[name])[:600] == ""


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in Q.queries() if n.startswith("op")) == list(range(1, 14))
