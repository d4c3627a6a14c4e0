"""Every registered query against its SQL at the smallest scale, and properties of the plans."""

import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from checks.compare import rows_of

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    frame = QUERIES[name](spark, SF)
    found = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if name in ORACLE:
        result = db.execute(ORACLE[name])
        columns = [c[0] for c in result.description]
        assert sorted(columns) == sorted(frame.columns)
        assert found == rows_of(columns, result.fetchall())


@pytest.mark.parametrize("name", ["weekly_tech_trends", "overview_counts", "cooccurrence", "jaccard", "tech_growth", "network_degree"])
def test_no_cross_join(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and not re.search(r"BroadcastNestedLoopJoin", plan)


def test_scans_read_only_the_columns_they_need(spark):
    plan = QUERIES["weekly_mentions_full"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all("l_tax" not in s and "o_totalprice" not in s and "l_discount" not in s for s in schemas)


def test_operators_do_not_collect():
    allowed = {"sources/dictionaries.py": 1}
    for path in glob.glob(f"{ROOT}/threadloom/**/*.py", recursive=True):
        if path.startswith(f"{ROOT}/threadloom/llm/"):  # has its own tests
            continue
        with open(path) as handle:
            hits = len(re.findall(r"\.(collect|toPandas|localCheckpoint)\(\)", handle.read()))
        assert hits <= allowed.get(os.path.relpath(path, f"{ROOT}/threadloom"), 0), path
