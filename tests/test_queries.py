"""Every registered query against its SQL on the smallest tables, and the plans that matter."""

import os

import pytest

import compare
from __spark_entry__ import entry, oracle_sql, queries as all_queries
from marlstone.workload.oracles import ORACLES
from marlstone.workload.queries import QUERIES
from tests.conftest import plan_of

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not there")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def queries():
    """Those of the library itself; the training-data queries have tests of their own."""
    return QUERIES


def settings(spark) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql("SET").collect()}


@pytest.mark.parametrize("name", sorted(queries()))
def test_matches_sql(spark, con, name):
    before = settings(spark)
    count, problems = compare.differences(spark, con, name, SF_DIR)
    assert not problems
    assert count > 0
    assert settings(spark) == before


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(oracle_sql()) <= set(all_queries())
    assert set(QUERIES) <= set(all_queries())


def test_entry(spark):
    assert entry(spark).count() > 0


LAZY = sorted(set(queries()) - {
    "published_table", "versioned_table", "registered_table", "stream_ingest",
    "read_catalogue", "inferred_json", "lake_two_days", "file_sizes", "manifest_job",
    "append_to_stored_reviews", "summed_up_signals", "growing_types", "promoted_fields",
    "waiting_fields_by_name", "rescued_by_day", "live_silver", "bucketed_signals", "clustered_top",
    "inventory_difference", "bronze_row_delta", "monitored_feeds", "file_inventory", "day_report",
})


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_cross_join(spark, name):
    plan = plan_of(queries()[name](spark, SF_DIR))
    for slow in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert slow not in plan


@pytest.mark.parametrize("name", ["dedupe_reviews", "latest_interactions", "clean_books"])
def test_ranking_is_cut_on_both_sides_of_the_shuffle(spark, name):
    plan = plan_of(queries()[name](spark, SF_DIR))
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange hashpartitioning") == 1


def test_features_read_only_their_columns(spark):
    plan = plan_of(queries()["reviews_agg"](spark, SF_DIR))
    assert plan.count("FileScan") == 1 and "l_extendedprice" not in plan


def test_top_lists_do_not_sort_everything(spark):
    for name in ("top_shelves", "top_priority"):
        assert "TakeOrderedAndProject" in plan_of(queries()[name](spark, SF_DIR))
