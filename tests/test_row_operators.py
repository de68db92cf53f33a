from collections import Counter
from datetime import timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fixtures_small import TODAY, as_set, at_age, by_age, pending
from tidemark.operators.arrivals import nightly_arrivals, smallest_ids
from tidemark.operators.expand import base_rows_only, copies_of, expand
from tidemark.operators.numbering import dense_ids
from tidemark.operators.profile import band_violations
from tidemark.operators.settle import advance_boundary, settle

# Age, version, status and rate on both sides of every band edge.
EDGES = [
    (-1, 1, "Pending", None),
    (0, 2, "Settling", "0.97"),
    (30, 2, "Settling", "0.97"),
    (31, 3, "Settling", "0.95"),
    (59, 3, "Settling", "0.95"),
    (60, 4, "Settled", "0.94"),
    (61, 4, "Settled", "0.94"),
]


def test_settle_at_the_band_edges(spark):
    rows = settle(by_age(spark, {age: 1 for age, *_ in EDGES}), TODAY).collect()
    found = {(TODAY - r.shipment_date).days: r for r in rows}
    for age, version, status, rate in EDGES:
        row = found[age]
        assert (row.record_version, row.settlement_status) == (version, status)
        if rate is None:
            assert row.actual_cost is None
        else:
            exact = row.estimated_cost * Decimal(rate)
            assert row.actual_cost == exact.quantize(Decimal("0.01"), rounding="ROUND_HALF_UP")


def test_settle_rounds_half_up(spark):
    half = by_age(spark, {1: 1}).withColumn("estimated_cost", F.expr("CAST(0.50 AS DECIMAL(18,2))"))
    assert settle(half, TODAY).first().actual_cost == Decimal("0.49")


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ages=st.dictionaries(st.integers(-3, 90), st.integers(1, 3), min_size=1, max_size=8))
def test_settling_twice_changes_nothing(spark, ages):
    once = settle(by_age(spark, ages), TODAY)
    assert as_set(settle(once, TODAY)) == as_set(once)
    assert band_violations(once, TODAY).count() == 0


def test_only_the_boundary_date_advances(spark):
    last_night = settle(by_age(spark, {30: 2, 31: 3, 32: 1, 60: 1}), TODAY - timedelta(days=1))
    moved = advance_boundary(last_night, TODAY)
    assert Counter((r.shipment_date, r.record_version) for r in moved.collect()) == {
        (at_age(30), 2): 2,
        (at_age(31), 3): 3,
        (at_age(32), 3): 1,
        (at_age(60), 3): 1,
    }


def test_expansion_matches_a_loop_over_copies(spark):
    base = by_age(spark, {0: 2, 100: 1})
    expected = [(r.shipment_id, r.shipment_date, r.payload) for r in base.collect()]
    for i in range(1, 201):
        for r in base.collect():
            expected.append(
                (r.shipment_id + 10 * i, r.shipment_date - timedelta(days=2 * i % 365), f"SHIPMENT-BATCH-{i}")
            )
    actual = expand(base, copies=200, id_offset=10)
    assert Counter(map(tuple, actual.select("shipment_id", "shipment_date", "payload").collect())) == Counter(expected)
    assert "Join" not in actual._jdf.queryExecution().toString()


def test_copies_come_from_base_rows_only(spark):
    base = by_age(spark, {0: 3})
    partly = base.unionByName(copies_of(base, 1, 10, 1_000))
    finished = partly.unionByName(copies_of(base_rows_only(partly, 3), 11, 40, 1_000))
    assert as_set(finished) == as_set(expand(base, 40, 1_000))


def test_arrivals_come_from_the_latest_day_not_after_today(spark):
    known = by_age(spark, {-1: 5, 2: 3, 3: 4})
    new = nightly_arrivals(known, TODAY, rows=2).collect()
    assert [r.shipment_id for r in new] == [900_000_006, 900_000_007]
    assert {(r.shipment_date, r.record_version, r.settlement_status, r.actual_cost) for r in new} == {
        (at_age(-1), 1, "Pending", None)
    }


def test_arrivals_of_an_empty_table(spark):
    assert nightly_arrivals(pending(spark, []), TODAY).count() == 0


@pytest.mark.parametrize("rows", [1, 7, 100, 4_000])
def test_smallest_ids_with_crowded_keys(spark, rows):
    """A third of the ids lie close together far from the rest."""
    ids = [10**12 + i for i in range(1_000)] + [i * 7_919_333 for i in range(2_000)] + [5, 6, 10**15]
    frame = spark.createDataFrame([(i,) for i in ids], "shipment_id bigint")
    found = [r[0] for r in smallest_ids(frame, rows).collect()]
    assert found == sorted(ids)[:rows]


def test_dense_ids_with_a_hot_leading_value(spark):
    keys = [(1 if i % 3 else i, i) for i in range(3_000)]
    frame = spark.createDataFrame(keys, "day int, shipment_id bigint").repartition(7)
    numbered = dense_ids(frame, "day", "shipment_id").collect()
    assert [(r.day, r.shipment_id) for r in sorted(numbered, key=lambda r: r.surrogate_id)] == sorted(keys)
    assert sorted(r.surrogate_id for r in numbered) == list(range(1, 3_001))


def test_dense_ids_of_nothing(spark):
    frame = spark.createDataFrame([], "shipment_id bigint")
    assert dense_ids(frame, "shipment_id").count() == 0


@pytest.mark.parametrize("rows, nulls", [(40, 0), (400, 350), (2_000, 1_000)])
def test_smallest_ids_take_null_keys_last(spark, rows, nulls):
    frame = spark.createDataFrame([(i,) for i in range(50)] + [(None,)] * 1_000, "shipment_id bigint")
    found = [r[0] for r in smallest_ids(frame, rows).collect()]
    assert len(found) == min(rows, 1_050)
    assert [i for i in found if i is not None] == list(range(min(rows, 50))) and found.count(None) == nulls


def test_arrivals_take_all_rows_and_ids_of_their_own(spark):
    known = by_age(spark, {1: 4, 2: 3}).withColumn("shipment_id", F.col("shipment_id") + 900_000_000)
    new = nightly_arrivals(known, TODAY)
    assert new.count() == 4
    assert new.join(known, "shipment_id").count() == 0
    assert new.select("shipment_id").distinct().count() == 4


def test_copies_of_large_ids_keep_ids_of_their_own(spark):
    base = by_age(spark, {1: 3}).withColumn("shipment_id", F.col("shipment_id") * 5_000_000)
    for rows in (expand(base, 3), base.unionByName(copies_of(base, 1, 3))):
        assert rows.count() == rows.select("shipment_id").distinct().count() == 12
