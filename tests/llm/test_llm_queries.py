"""Every query against its DuckDB oracle, and what holds of all of them."""

from __future__ import annotations

import re
from collections import Counter

import duckdb
import pytest

from tidemark.llm.oracles import ORACLES
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark labels conversations"
NATIVE = ["op3_line_dedup", "op4_mix", "op9_url_filter", "op13_pii"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = QUERIES[name](spark, SF)
    names = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(names)} FROM ({ORACLES[name]})").fetchall()
    assert want and Counter(want) == Counter(map(tuple, got.select(names).collect()))


def test_all_numbers_are_there():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairs_of_all_rows(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoop", plan)
