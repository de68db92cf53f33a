"""Every registered query against its SQL, over whole tables.

Queries that write thousands of date folders, or return millions of values, run at the smallest
scale unless TIDEMARK_ALL_SCALES is set.
"""

import os

import pytest

import __spark_entry__ as registered
from comparison import TESTDATA, assert_same

QUERIES = registered.table_queries()
ORACLE = registered.oracle_sql()


SLOW = {
    "expand_copies",
    "arrival_delta",
    "full_load",
    "append_insert",
    "update_in_place",
    "advance_boundary",
    "advance_boundary_moved",
    "validation_widened",
    "rebuild_window",
    "rebuild_missed_night",
    "rebuild_one_date",
    "rebuild_empty_date",
    "rebuild_summary",
    "rebuild_by_date",
    "rebuild_with_bad_date",
    "rebuild_around_bad_date",
    "repair_cycle",
    "repair_cycle_dates",
    "frozen_guard_changed",
    "frozen_guard_unrecorded",
    "nightly_arrivals_month",
    "full_load_resumed",
    "full_load_progress",
    "rebuild_with_failing_read",
    "rebuild_around_failing_read",
    "frozen_guard",
    "table_overview_states",
    "status_breakdown_states",
    "carrier_profile_states",
    "recent_dates_top10_states",
    "version_counts_states",
    "band_violations_states",
}


def cases():
    for name in QUERIES:
        yield name, "sf0.001"
        if name not in SLOW or os.environ.get("TIDEMARK_ALL_SCALES"):
            yield name, "sf0.01"


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE) <= set(registered.queries())


@pytest.mark.parametrize("name, scale", list(cases()))
def test_query_matches_oracle(spark, name, scale):
    folder = TESTDATA / scale
    rows = assert_same(QUERIES[name](spark, str(folder)), folder, ORACLE[name])
    assert rows > 0


def test_entry_is_the_report(spark):
    df = registered.entry(spark)
    assert df.columns[0] == "shipment_date"
    assert df.count() == 27
