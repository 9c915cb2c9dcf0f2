"""Every registered query against its DuckDB SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from check import ROOT, difference, oracle
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF = ROOT / "sf0.001"
NO_SQL = {"forecast_eval"}  # tests/test_consensus.py checks it
LARGER = {"sequences_channels": ROOT / "sf0.01"}  # one of its channels has too many gaps in the smallest tables


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) - NO_SQL == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", ORACLE)
def test_query(spark, name):
    sf = LARGER.get(name, SF)
    got = QUERIES[name](spark, str(sf)).toPandas()
    assert len(got)
    assert difference(got, oracle(sf, ORACLE[name])) is None


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["datetime", "date", "linkid", "self_mean"]
