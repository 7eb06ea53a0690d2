import duckdb
import pytest

import __spark_entry__ as entry_mod
from lodestar.registry import all_queries
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["cid", "dim", "value"]


def test_every_clustering_query_has_an_oracle():
    assert set(all_queries()) <= set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_oracle(spark, name):
    con = duck(SF)
    res = compare(spark, con, name, entry_mod.queries()[name], entry_mod.oracle_sql()[name], SF)
    assert res["ok"], res
