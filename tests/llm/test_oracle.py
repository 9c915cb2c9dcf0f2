"""Registration, and the queries that have SQL."""

import pytest

import __spark_entry__ as entry_points
from check import ROOT, difference, oracle
from roadspeed.llm.oracle import ORACLE
from roadspeed.llm.queries import QUERIES

SF = ROOT / "sf0.001"


def test_one_query_for_each_operator():
    assert [int(name.split("_")[0][2:]) for name in QUERIES] == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries()) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, name):
    got = QUERIES[name](spark, str(SF)).toPandas()
    assert len(got) and difference(got, oracle(SF, ORACLE[name])) is None
