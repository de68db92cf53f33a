"""Physical plans that must not get worse: what is read, sorted, multiplied or joined."""

import pytest

import __spark_entry__ as registered
from comparison import TESTDATA
from tidemark.operators.reconcile import row_differences

FOLDER = str(TESTDATA / "sf0.001")


def plan(spark, name):
    return registered.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return [line for line in text.splitlines() if "FileScan" in line]


WINDOWED = ["window_scan", "per_date_profile", "date_version_status_70d", "window_status", "reconcile_report"]


@pytest.mark.parametrize("name", [*WINDOWED, "deep_reconcile", "partition_row_diff", "partition_scan_one_date"])
def test_date_bounds_reach_the_scan(spark, name):
    for scan in scans(plan(spark, name)):
        assert "GreaterThanOrEqual(o_orderdate" in scan or "(o_orderdate" in scan.split("DataFilters")[1]


@pytest.mark.parametrize(
    "name, columns",
    [
        ("table_overview", "o_custkey:bigint,o_orderdate:timestamp_ntz"),
        ("recent_dates_top10", "o_orderdate:timestamp_ntz"),
        ("seed_date", "o_orderdate:timestamp_ntz"),
        ("status_breakdown", "o_totalprice:double,o_orderdate:timestamp_ntz"),
    ],
)
def test_only_needed_columns_are_read(spark, name, columns):
    assert all(f"ReadSchema: struct<{columns}>" in scan for scan in scans(plan(spark, name)))


@pytest.mark.parametrize("name", ["recent_dates_top10", "per_date_profile", "reconcile_report", "deep_reconcile"])
def test_rows_are_combined_by_hash_before_any_sort(spark, name):
    """The aggregation next to each scan must be a hash aggregation."""
    lines = plan(spark, name).splitlines()
    for i, line in enumerate(lines):
        if "FileScan" in line:
            nearest = next(l for l in reversed(lines[:i]) if "Aggregate(" in l)
            assert "HashAggregate" in nearest


@pytest.mark.parametrize("name", ["expand_copies", "expand_profile", "strategy_comparison"])
def test_no_join_where_rows_are_many(spark, name):
    assert "Join" not in plan(spark, name)


def test_full_row_differences_take_one_shuffle_and_no_join(spark):
    rows = registered._order_lines(spark, FOLDER)
    full = row_differences(rows, rows.filter("shipment_id % 7 <> 0"))
    physical = full._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in physical and physical.count("Exchange") == 1


def test_sparse_row_differences_join_rows_with_differing_ids_only(spark):
    """Rows of the two sides never meet in a join: each side keeps those of the ids found, before it is shuffled."""
    joins = [line for line in plan(spark, "partition_row_diff").splitlines() if "Join" in line]
    assert len(joins) == 2 and all("LeftSemi" in line for line in joins)
