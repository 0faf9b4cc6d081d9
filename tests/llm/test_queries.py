"""The registered queries on the smallest sample: against SQL where there is some, else by what must hold."""

from __future__ import annotations

import importlib
import os

import pytest

from compare import connect, difference

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no sample tables")


@pytest.fixture(scope="module")
def entry():
    return importlib.import_module("__spark_entry__")


def test_each_operator_has_one_query(entry):
    names = [name for name in entry.queries() if name.startswith("op")]
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", ["op2_link_trust", "op6_host_quality", "op12_bag_ranking", "op13_sharded_lloyd"])
def test_query_agrees_with_sql(spark, entry, name):
    con = connect(FOLDER)
    for table in ("documents", "pages", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    assert difference(spark, con, entry.queries()[name], entry.oracle_sql()[name], FOLDER) is None
