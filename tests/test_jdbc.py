"""The texts sent to a relational source. No database is started: the texts themselves are run."""

import duckdb
from pyspark.sql import functions as F

from fixtures_small import TODAY, at_age, by_age
from tidemark.functions.dates import lookback_window
from tidemark.operators.profile import per_date_profile
from tidemark.operators.settle import settle
from tidemark.sources.jdbc import date_predicates, extent_query, profile_query

WINDOW = lookback_window(TODAY)


def test_profile_text_gives_the_profile_in_two_engines(spark):
    frame = settle(by_age(spark, {0: 1, 1: 3, 40: 2, 60: 1, 61: 4}), TODAY)
    frame.createOrReplaceTempView("jdbc_rows")
    expected = sorted(map(tuple, per_date_profile(frame, WINDOW).collect()))
    text = f"SELECT * FROM {profile_query('jdbc_rows', WINDOW)}"
    assert sorted(map(tuple, spark.sql(text).collect())) == expected
    with duckdb.connect() as connection:
        jdbc_rows = frame.toPandas()
        jdbc_rows["shipment_date"] = jdbc_rows["shipment_date"].astype("datetime64[s]")
        connection.register("pandas_rows", jdbc_rows)
        connection.execute(
            "CREATE VIEW jdbc_rows AS SELECT * REPLACE (CAST(shipment_date AS DATE) AS shipment_date) FROM pandas_rows"
        )
        assert sorted(connection.execute(text).fetchall()) == expected
        extents = connection.execute(f"SELECT * FROM {extent_query('jdbc_rows', WINDOW)}").fetchall()
    assert (at_age(1), 3, 2, 4) in extents and len(extents) == 3


def test_one_predicate_per_date():
    predicates = date_predicates(WINDOW.dates())
    assert len(predicates) == 60
    assert predicates[0] == "shipment_date = '2024-03-14'"


def test_large_date_is_cut_into_ranges_that_cover_it_once(spark):
    frame = by_age(spark, {1: 1_000, 2: 5})
    extents = {at_age(1): (1_000, 1, 1_000), at_age(2): (5, 1_001, 1_005)}
    predicates = date_predicates([at_age(1), at_age(2)], extents, rows_per_reader=300)
    assert len(predicates) == 5
    pieces = [frame.filter(p).count() for p in predicates]
    assert pieces == [250, 250, 250, 250, 5]


def test_rows_outside_the_measured_range_are_still_read(spark):
    frame = by_age(spark, {1: 1_000})
    predicates = date_predicates([at_age(1)], {at_age(1): (800, 100, 899)}, rows_per_reader=200)
    assert sum(frame.filter(p).count() for p in predicates) == 1_000


def test_many_rows_on_one_id():
    assert date_predicates([at_age(1)], {at_age(1): (10**9, 7, 7)}) == ["shipment_date = '2024-03-14'"]


def test_rows_without_id_are_read_whole_or_cut(spark):
    frame = by_age(spark, {1: 10})
    frame = frame.unionByName(frame.limit(1).withColumn("shipment_id", F.lit(None).cast("bigint")))
    predicates = date_predicates([at_age(1)], {at_age(1): (10, 1, 10)}, rows_per_reader=4)
    assert len(predicates) == 3
    assert sum(frame.filter(p).count() for p in predicates) == frame.count() == 11
