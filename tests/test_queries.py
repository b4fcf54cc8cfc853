"""Every registered query against its SQL twin in DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from partwise.plans.oracle import ORACLE
from partwise.plans.queries import QUERIES, layout_timing

SF_DIR = "/root/testdata/sf0.001"
TWINS = ORACLE


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def values(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([row[i] for i in order]) for row in rows)


def test_twins_belong_to_queries():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = entry_points.queries()[name](spark, SF_DIR)
    rows = found.collect()
    assert rows
    if name in TWINS:
        twin = duck.sql(TWINS[name])
        assert sorted(twin.columns) == sorted(found.columns)
        assert values(found.columns, rows) == values(twin.columns, twin.fetchall())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_partitioned_layouts_are_pruned(spark):
    for name in ("census_layout_count", "utility_layout_count", "machine_layout_count"):
        found = entry_points.queries()[name](spark, SF_DIR)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: []" in plan and "ReadSchema: struct<>" in plan


def test_compaction_merges_without_loss(spark):
    found = {r.stage: r for r in entry_points.queries()["compacted_size"](spark, SF_DIR).collect()}
    assert found["before"].files > found["after"].files == 1
    assert found["before"].bytes == found["after"].bytes


def test_partitioned_count_reads_less(spark):
    found = {r.layout: r for r in layout_timing(spark, SF_DIR).collect()}
    assert found["partitioned"].bytes < found["flat"].bytes < found["csv"].bytes
    assert len({r.n for r in found.values()}) == 1


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
