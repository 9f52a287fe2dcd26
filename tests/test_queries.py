"""Every query of the pipeline's operators against its SQL."""

from __future__ import annotations

import pytest
from duck import compare

from folio.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    compare(spark, SF, QUERIES[name], ORACLES[name])


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_pairs_of_words_need_no_window(spark):
    plan = QUERIES["split_joined_caps"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Exchange hashpartitioning") == 1
