"""Registered queries against SQL on the same tables, and properties of their plans."""

from __future__ import annotations

import glob
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from check_queries import compare
from tidefold.queries import ORACLES, QUERIES, flows

# Whole flows run many jobs each; tests/test_flow.py covers them on small pages.
SLOW = {name for name, function in QUERIES.items() if function.__module__ == flows.__name__}
FAST = sorted(set(QUERIES) - SLOW)
SELECTED = sorted(QUERIES) if os.environ.get("TEST_ALL_QUERIES") else FAST


@pytest.fixture(scope="module")
def connection(sf_dir):
    opened = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        opened.execute(f"create view {name} as select * from read_parquet('{path}')")
    yield opened
    opened.close()


@pytest.mark.parametrize("name", SELECTED)
def test_query_equals_its_sql(spark, connection, sf_dir, name):
    _, outcome = compare(spark, connection, name, QUERIES[name], ORACLES.get(name), sf_dir)
    assert outcome.startswith("ok") and "TYPES" not in outcome, outcome


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("absent", ["corpus_pipeline", "tidefold.llm", "xxhash", "tokenizers"])
def test_entry_works_without_the_optional_parts(absent):
    code = f"import sys; sys.modules[{absent!r}] = None; import __spark_entry__ as e; print(sorted(e.queries()))"
    root = os.path.dirname(os.path.abspath(entry.__file__))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout
    assert out.strip() == str(sorted(QUERIES))


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", [n for n in FAST if n[:2] in ("ag", "jn", "mo", "pr", "wi", "st")])
def test_no_query_compares_every_row_with_every_row(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_documents_are_parsed_once(spark, sf_dir):
    plan = QUERIES["prj1_normalise_events"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    # Three alternatives of one CASE: quick wrapping, careful wrapping, no wrapping.
    assert plan.count("parseJson") == 3
    projected = QUERIES["prj8_typed_projection"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert projected.count("from_json") == 1


def test_only_needed_columns_are_read(spark, sf_dir):
    plan = QUERIES["agg8_checkpoint_writes"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_custkey:bigint>" in plan
