"""Every registered query against its SQL, on the smallest of the given scales."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as driver
from demandlake.plans.registry import all_oracles, all_queries
from oracle import differences

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="test tables not present")


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(driver.queries())
    assert set(all_oracles()) <= set(driver.oracle_sql())


# Reports that count whole tables end in one row, and so in one partition.
COUNTS = ["gold_fanout_counts", "gold_row_counts", "preview_counts", "stream_available_now"]


@pytest.mark.parametrize("name", list(all_queries()))
def test_query_matches_sql(spark, name):
    frame = driver.queries()[name](spark, SF_DIR)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
    assert "SinglePartition" not in plan or name in COUNTS
    assert differences(frame, SF_DIR, driver.oracle_sql()[name]) == []


def test_entry_returns_facts(spark):
    facts = driver.entry(spark)
    assert facts.columns[:2] == ["DemandID", "MaterialNumberCustomer"]
    assert facts.count() > 0
