from pyspark.sql import functions as F

from fixtures_small import TODAY, at_age, by_age
from tidemark.functions.dates import lookback_window
from tidemark.operators import reconcile as rc
from tidemark.operators.profile import band_violations, per_date_profile
from tidemark.operators.settle import settle
from tidemark.plans.validate import validation

WINDOW = lookback_window(TODAY)


def results(report):
    return {r.shipment_date: (r.validation_result, r.row_diff) for r in report.collect()}


def compare(source, sink, deep=False):
    profiles = [per_date_profile(side, WINDOW, checksums=deep) for side in (source, sink)]
    return (rc.deep_reconcile if deep else rc.reconcile)(*profiles)


def test_every_result(spark):
    source = settle(by_age(spark, {1: 3, 2: 2, 3: 2, 60: 1, 61: 9}), TODAY)
    sink = settle(by_age(spark, {1: 3, 2: 1, 4: 4, 60: 2}), TODAY)
    assert results(compare(source, sink)) == {
        at_age(1).isoformat(): ("PASS", 0),
        at_age(2).isoformat(): ("MISMATCH", -1),
        at_age(3).isoformat(): ("MISSING_IN_SINK", -2),
        at_age(4).isoformat(): ("MISSING_IN_SOURCE", 4),
        at_age(60).isoformat(): ("MISMATCH", 1),
    }


def test_report_is_newest_first(spark):
    frame = by_age(spark, {5: 1, 1: 1, 3: 1})
    dates = [r.shipment_date for r in compare(frame, frame).collect()]
    assert dates == sorted(dates, reverse=True)


def test_stale_rows_pass_on_counts_and_fail_on_content(spark):
    rows = by_age(spark, {1: 2, 31: 2, 60: 2})
    source, sink = settle(rows, TODAY), settle(rows, at_age(1))
    assert {r for r, _ in results(compare(source, sink)).values()} == {"PASS"}
    assert {d: r for d, (r, _) in results(compare(source, sink, deep=True)).items()} == {
        at_age(1).isoformat(): "PASS",
        at_age(31).isoformat(): "STALE",
        at_age(60).isoformat(): "STALE",
    }


def test_one_changed_value_is_found_by_the_checksum_and_by_the_row_comparison(spark):
    source = settle(by_age(spark, {1: 4}), TODAY)
    sink = source.withColumn("payload", F.when(F.col("shipment_id") == 3, "q").otherwise(F.col("payload")))
    assert [r for r, _ in results(compare(source, sink, deep=True)).values()] == ["STALE"]
    assert [(r.shipment_id, r.difference) for r in rc.row_differences(source, sink).collect()] == [(3, "CHANGED")]


def test_a_row_stored_twice_instead_of_another_is_found(spark):
    source = settle(by_age(spark, {1: 3}), TODAY)
    sink = source.filter("shipment_id <> 3").unionByName(source.filter("shipment_id = 2"))
    assert [r for r, _ in results(compare(source, sink)).values()] == ["PASS"]
    assert [r for r, _ in results(compare(source, sink, deep=True)).values()] == ["STALE"]


def test_row_differences_name_the_side(spark):
    source = settle(by_age(spark, {1: 3}), TODAY)
    found = rc.row_differences(source.filter("shipment_id < 3"), source.filter("shipment_id > 1"))
    assert {(r.shipment_id, r.difference) for r in found.collect()} == {
        (1, "ONLY_IN_SOURCE"),
        (3, "ONLY_IN_SINK"),
    }


def test_absent_dates_appear_on_the_spine(spark):
    frame = by_age(spark, {1: 1})
    spine = rc.with_absent_dates(compare(frame, frame), WINDOW).collect()
    assert len(spine) == 60
    assert [r.validation_result for r in spine] == ["PASS"] + ["ABSENT"] * 59
    assert rc.failing_dates(rc.with_absent_dates(compare(frame, frame), WINDOW)).count() == 0


def test_verdict_names_every_finding(spark):
    source = by_age(spark, {1: 3, 2: 2, 3: 2})
    assert rc.verdict(compare(source, source)).first().verdict == "ALL_PASSED"
    broken = by_age(spark, {1: 1, 2: 2, 4: 1})
    row = rc.verdict(compare(source, broken)).first()
    assert row.verdict == "MISMATCHES,MISSING_DATES,EXTRA_DATES"
    assert (row.total_dates, row.pass_dates, row.mismatch_dates) == (4, 1, 1)


def test_verdict_of_nothing(spark):
    nothing = by_age(spark, {200: 1})
    row = rc.verdict(compare(nothing, nothing)).first()
    assert (row.total_dates, row.verdict) == (0, "ALL_PASSED")


def test_validation_keeps_the_report_only_inside_the_block(spark):
    frame = settle(by_age(spark, {1: 2, 5: 1}), TODAY)
    with validation(frame, frame, TODAY, deep=True, show_absent=True) as check:
        assert check.verdict.first().verdict == "ALL_PASSED"
        assert {r.validation_result: r.date_count for r in check.summary.collect()} == {"PASS": 2, "ABSENT": 58}
        assert check.report.storageLevel.useMemory
    assert not check.report.storageLevel.useMemory


def test_band_violations_show_what_is_expected(spark):
    stale = settle(by_age(spark, {1: 2, 31: 3, 60: 1}), at_age(1))
    found = {r.shipment_date: (r.record_version, r.expected_version, r.row_count) for r in band_violations(stale, TODAY).collect()}
    assert found == {at_age(31): (2, 3, 3), at_age(60): (3, 4, 1)}
    uncosted = settle(by_age(spark, {1: 2}), TODAY).withColumn("actual_cost", F.expr("CAST(NULL AS DECIMAL(18,2))"))
    assert [r.uncosted_rows for r in band_violations(uncosted, TODAY).collect()] == [2]


def test_row_differences_stay_linear_for_a_repeated_id(spark):
    source = settle(by_age(spark, {1: 1}), TODAY)
    repeated = source.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(50_000)))).drop("copy")
    assert rc.row_differences(repeated, repeated).count() == 0
    found = rc.row_differences(repeated, repeated.limit(49_999)).collect()
    assert [(r.difference, r.rows_source, r.rows_sink) for r in found] == [("CHANGED", 50_000, 49_999)]


def test_row_differences_show_both_dates(spark):
    source = settle(by_age(spark, {1: 1}), TODAY)
    sink = source.withColumn("shipment_date", F.lit(at_age(2)))
    found = rc.row_differences(source, sink).first()
    assert (found.date_source, found.date_sink, found.difference) == (at_age(1), at_age(2), "CHANGED")


def test_reports_join_nothing(spark):
    frame = settle(by_age(spark, {1: 2, 5: 1}), TODAY)
    for deep in (False, True):
        plan = compare(frame, frame, deep=deep)._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan


def test_a_widened_window_is_validated_and_shown_whole(spark, capsys):
    source = settle(by_age(spark, {age: 1 for age in range(1, 71)}), TODAY)
    sink = source.filter(F.col("shipment_date") != F.lit(at_age(65)))
    with validation(source, sink, TODAY) as check:
        assert check.report.count() == 60 and check.verdict.first().verdict == "ALL_PASSED"
    with validation(source, sink, TODAY, missed_nights=10) as check:
        assert check.report.count() == 70 and check.verdict.first().verdict == "MISSING_DATES"
        check.show()
    assert capsys.readouterr().out.count("MISSING_IN_SINK") == 2
