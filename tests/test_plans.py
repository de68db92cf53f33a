import uuid
from collections import Counter
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from fixtures_small import TODAY, as_set, at_age, by_age
from tidemark.functions.dates import in_window, lookback_window
from tidemark.operators.profile import per_date_profile
from tidemark.operators.reconcile import reconcile
from tidemark.operators.settle import settle
from tidemark.operators.sink import full_load
from tidemark.plans.rebuild import frozen_changes, frozen_checksums, rebuild, rebuild_dates, repair
from tidemark.plans.strategies import compare_strategies
from tidemark.plans.validate import validation
from tidemark.schema import drop_table
from tidemark.sources.tables import shipments

WINDOW = lookback_window(TODAY)


@pytest.fixture
def table(spark):
    name = f"plan_{uuid.uuid4().hex}"
    yield name
    drop_table(spark, name)


@pytest.fixture
def rows(spark):
    return by_age(spark, {0: 1, 1: 3, 30: 1, 31: 2, 59: 1, 60: 2, 61: 2, 70: 1, 90: 1})


def versions(spark, table):
    return {
        (TODAY - r.shipment_date).days: r.v
        for r in spark.table(table).groupBy("shipment_date").agg(F.max("record_version").alias("v")).collect()
    }


def test_rebuild_makes_the_window_equal_and_leaves_the_rest(spark, table, rows):
    full_load(settle(rows, at_age(1)), table)
    source = settle(rows, TODAY)
    result = rebuild(source, table, TODAY)
    old = settle(rows, at_age(1))
    assert as_set(spark.table(table)) == sorted(
        as_set(source.filter(in_window(WINDOW))) + as_set(old.filter(~in_window(WINDOW)))
    )
    summary = result.summary(spark).first()
    assert (summary.dates_rebuilt, summary.rows_written, summary.dates_replaced) == (60, 9, 5)
    assert (summary.oldest_date, summary.newest_date) == (at_age(60), at_age(1))


def test_rebuild_twice_is_rebuild_once(spark, table, rows):
    full_load(settle(rows, at_age(1)), table)
    rebuild(settle(rows, TODAY), table, TODAY)
    once = as_set(spark.table(table))
    rebuild(settle(rows, TODAY), table, TODAY)
    assert as_set(spark.table(table)) == once


@pytest.mark.parametrize("missed, stale_ages", [(0, {61, 70}), (9, {70}), (10, set())])
def test_missed_nights_leave_frozen_dates_stale_unless_made_up_for(spark, table, rows, missed, stale_ages):
    full_load(settle(rows, at_age(11)), table)
    rebuild(settle(rows, TODAY), table, TODAY, missed_nights=missed)
    found = versions(spark, table)
    assert {age for age in (61, 70, 90) if found[age] != 4} == stale_ages


def test_the_age_sixty_date_is_read_settled(spark, table, rows):
    full_load(settle(rows, at_age(1)), table)
    assert versions(spark, table)[60] == 3
    rebuild(settle(rows, TODAY), table, TODAY)
    assert versions(spark, table)[60] == 4


def test_a_shorter_window_would_lose_it(spark, table, rows):
    full_load(settle(rows, at_age(1)), table)
    rebuild(settle(rows, TODAY), table, TODAY, lookback_days=59)
    assert versions(spark, table)[60] == 3


def test_single_date(spark, table, rows):
    full_load(settle(rows, at_age(1)), table)
    rebuild_dates(settle(rows, TODAY), table, [at_age(31)])
    found = versions(spark, table)
    assert (found[31], found[60]) == (3, 3)


def test_repair_rebuilds_failing_dates_only(spark, table, rows):
    source = settle(rows, TODAY)
    damaged = source.filter(~F.col("shipment_date").isin(at_age(30))).filter("shipment_id <> 2").unionByName(
        by_age(spark, {7: 1}).withColumn("shipment_id", F.lit(99).cast("bigint"))
    )
    full_load(damaged, table)

    def report():
        sink = shipments(spark, table)
        return reconcile(per_date_profile(source, WINDOW), per_date_profile(sink, WINDOW))

    result = repair(source, table, report())
    assert {(TODAY - o.shipment_date).days: o.action for o in result.outcomes} == {
        1: "REPLACED",
        7: "CLEARED",
        30: "REPLACED",
    }
    assert {r.validation_result for r in report().collect()} == {"PASS"}
    assert repair(source, table, report()).outcomes == []


def test_frozen_dates_do_not_change(spark, table, rows, tmp_path):
    full_load(settle(rows, at_age(1)), table)
    kept = str(tmp_path / "before")
    frozen_checksums(shipments(spark, table), WINDOW).write.parquet(kept)
    rebuild(settle(rows, TODAY), table, TODAY)
    before = spark.read.parquet(kept)
    assert frozen_changes(before, frozen_checksums(shipments(spark, table), WINDOW)).count() == 0
    rebuild_dates(settle(rows, TODAY).filter("false"), table, [at_age(90)])
    changed = frozen_changes(before, frozen_checksums(shipments(spark, table), WINDOW)).collect()
    assert [(r.shipment_date, r.rows_before, r.rows_after) for r in changed] == [(at_age(90), 1, None)]


def test_night_after_night(spark, table):
    """Ten nights of arrivals and settlement, each followed by a rebuild and a deep comparison."""
    everything = by_age(spark, {age: 1 for age in range(1, 75, 3)})
    start = at_age(10)
    full_load(settle(everything.filter(F.col("shipment_date") < F.lit(start)), start), table)
    for night in range(9, -1, -3):
        tonight = at_age(night)
        source = settle(everything.filter(F.col("shipment_date") < F.lit(tonight)), tonight)
        rebuild(source, table, tonight, missed_nights=2)
        with validation(source, shipments(spark, table), tonight, deep=True) as check:
            assert check.verdict.first().verdict == "ALL_PASSED"
        assert as_set(spark.table(table)) == as_set(source)


def brute_force(old, new, window):
    """Every strategy carried out row by row."""
    inside = lambda r: window.first <= r.shipment_date <= window.last
    mark = max(r.shipment_date for r in old)
    current = {r.shipment_id: r.record_version for r in new}
    plans = {
        "append_only": (old, [r for r in new if inside(r)]),
        "watermark": (old, [r for r in new if r.shipment_date > mark]),
        "full_reload": ([], new),
        "delete_append": ([r for r in old if not inside(r)], [r for r in new if inside(r)]),
        "delete_append_interrupted": ([r for r in old if not inside(r)], []),
        "partition_replace": ([r for r in old if not inside(r)], [r for r in new if inside(r)]),
    }
    for name, (kept, written) in plans.items():
        sink = Counter(r.shipment_id for r in kept + written)
        yield (
            name,
            len(written),
            len(kept) + len(written),
            sum(n - 1 for n in sink.values()),
            sum(r.shipment_id in current and current[r.shipment_id] != r.record_version for r in kept),
            sum(i not in sink for i in current),
            sum(r.shipment_id not in current for r in kept),
        )


def test_strategies_match_brute_force(spark, rows):
    old = settle(rows.filter("shipment_id not in (2, 11)"), at_age(1)).filter(
        F.col("shipment_date") < F.lit(TODAY - timedelta(days=1))
    )
    new = settle(rows.filter("shipment_id not in (5, 12)"), TODAY)
    actual = [tuple(r) for r in compare_strategies(old, new, WINDOW).collect()]
    assert actual == list(brute_force(old.collect(), new.collect(), WINDOW))
