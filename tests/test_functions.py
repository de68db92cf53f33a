from datetime import date, timedelta

import pytest

from fixtures_small import TODAY
from tidemark.functions.dates import Window, lookback_window, on_dates, window_spine
from tidemark.functions.fingerprint import checksum_aggregates
from tidemark.sources.generated import generated_shipments


def test_window_ends_yesterday_and_has_sixty_dates():
    window = lookback_window(TODAY)
    assert (window.first, window.last, window.days) == (date(2024, 1, 15), date(2024, 3, 14), 60)
    assert window.iso_dates()[0] == "2024-03-14"
    assert window.iso_dates()[-1] == "2024-01-15"


def test_missed_nights_widen_the_window_backwards():
    assert lookback_window(TODAY, 60, missed_nights=10).first == TODAY - timedelta(days=70)


@pytest.mark.parametrize("arguments", [(0, 0), (60, -1)])
def test_window_rejects_bad_sizes(arguments):
    with pytest.raises(ValueError):
        lookback_window(TODAY, *arguments)


def test_spine_has_every_date_once(spark):
    window = Window(date(2024, 2, 27), date(2024, 3, 2))
    rows = [row[0] for row in window_spine(spark, window).collect()]
    assert sorted(rows, reverse=True) == window.dates()


def test_on_dates(spark):
    spine = window_spine(spark, Window(date(2024, 1, 1), date(2024, 1, 10)))
    for picked in ([], [3], [3, 4, 5], [2, 5, 9]):
        dates = [date(2024, 1, d) for d in picked]
        assert sorted(r[0] for r in spine.filter(on_dates(dates)).collect()) == dates


def test_checksum_sees_repeated_rows_and_moved_nulls(spark):
    def checksum(rows):
        frame = spark.createDataFrame(rows, "a int, b int, estimated_cost decimal(18,2), actual_cost decimal(18,2)")
        return tuple(frame.agg(*checksum_aggregates(["a", "b"])).first())

    one, two = (1, 2, None, None), (3, 4, None, None)
    assert checksum([one, two]) == checksum([two, one])
    assert checksum([one]) != checksum([one, two, two])
    assert checksum([(1, None, None, None)]) != checksum([(None, 1, None, None)])


def test_generated_rows_repeat_and_stay_in_their_domains(spark):
    first = generated_shipments(spark, 2_000, TODAY)
    again = generated_shipments(spark, 2_000, TODAY).repartition(3)
    rows = first.collect()
    assert sorted(map(tuple, rows), key=lambda r: r[0]) == sorted(map(tuple, again.collect()), key=lambda r: r[0])
    assert {r.carrier_code for r in rows} == {f"CAR-{c}" for c in "ABCDE"}
    assert {r.origin_region for r in rows} == {"North", "South", "East", "West", "Central"}
    assert min(r.shipment_date for r in rows) >= TODAY - timedelta(days=365)
    assert max(r.shipment_date for r in rows) <= TODAY - timedelta(days=1)
    assert all(500 <= r.estimated_cost <= 2499 and 100 <= r.weight_lbs <= 999 for r in rows)
    assert [r.shipment_id for r in sorted(rows)] == list(range(1, 2_001))
