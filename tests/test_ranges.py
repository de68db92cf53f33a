"""Dense numbers by ranges against plain sorting."""

from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators.ranges import dense_ids_by_ranges, rows_in_ranges

LEAST = -(1 << 63)


def _key(values):
    return tuple((v is not None, v if v is not None else 0) for v in values)


def _check(spark, rows, schema, order, rows_per_range=100):
    frame = spark.createDataFrame(rows, schema).repartition(5)
    numbered = dense_ids_by_ranges(frame, *order, rows_per_range=rows_per_range).collect()
    assert sorted(r.surrogate_id for r in numbered) == list(range(1, len(rows) + 1))
    found = [tuple(r)[:-1] for r in sorted(numbered, key=lambda r: r.surrogate_id)]
    places = [_key([r[frame.columns.index(c)] for c in order]) for r in found]
    assert places == sorted(places)
    assert sorted(map(str, found)) == sorted(map(str, rows))
    ranged = rows_in_ranges(frame, *order, rows_per_range=rows_per_range)
    return [n for _, n in sorted(ranged.groupBy("range").count().collect())]


def test_one_key_with_half_of_the_rows_is_cut_by_the_next_column(spark):
    rows = [(date(2024, 1, 1) + timedelta(days=i if i % 2 else 50), i * 7_919 % 10_007) for i in range(4_000)]
    sizes = _check(spark, rows, "day date, id bigint", ("day", "id"))
    assert len(sizes) >= 40 and max(sizes) <= 250


def test_two_hot_levels_nulls_and_the_least_longs(spark):
    rows = [(None if i % 3 == 0 else 5, 1 if i % 4 else None, i) for i in range(3_000)]
    rows += [(LEAST, 9, 1), (LEAST, 1, 2), (LEAST + 1, 0, 3), (LEAST + 1, 7, 0)] * 100
    sizes = _check(spark, rows, "a bigint, b int, c bigint", ("a", "b", "c"))
    assert max(sizes) <= 650


@pytest.mark.parametrize("kind", ["string", "decimal(12,2)", "timestamp", "boolean"])
def test_types_of_leading_columns(spark, kind):
    if kind == "string":
        values = [f"a common start {i}{'x' * (i % 30)}" for i in range(900)] + [None, "", "a", "a\0", "é", "\U00020000"]
    elif kind == "boolean":
        values = [bool(i % 3) for i in range(900)] + [None]
    else:
        values = [Decimal(i * 37 % 901 - 400).scaleb(-2) for i in range(900)] + [None]
    rows = [(v, i) for i, v in enumerate(values)]
    if kind != "timestamp":
        assert len(_check(spark, rows, f"v {kind}, id bigint", ("v", "id"))) > 4
        return
    frame = spark.range(2_000).select(F.timestamp_seconds(F.col("id") * 997 % 2_003).alias("at"), "id")
    numbered = dense_ids_by_ranges(frame, "at", rows_per_range=100).orderBy("surrogate_id").collect()
    assert [r["at"] for r in numbered] == sorted(r["at"] for r in numbered)


def test_nothing_one_range_and_clashing_names(spark):
    schema = "range string, row string, within int, `off.set` int, surrogate_id bigint"
    for rows in ([], [("b", "x", 1, 2, 9), ("a", "y", 3, 4, 8), ("a", "y", 3, 4, 8)]):
        frame = spark.createDataFrame(rows, schema)
        numbered = dense_ids_by_ranges(frame, "range", "within", rows_per_range=1)
        assert numbered.columns == frame.columns
        assert sorted(r.surrogate_id for r in numbered.collect()) == list(range(1, len(rows) + 1))


def test_a_leading_column_without_integer_form_is_refused(spark):
    with pytest.raises(TypeError, match="amount"):
        dense_ids_by_ranges(spark.createDataFrame([(1.5,)], "amount double"), "amount")
