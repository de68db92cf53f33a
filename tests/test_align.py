import pytest
from pyspark.sql import functions as F

from fixtures_small import as_set, by_age
from tidemark.operators.align import align
from tidemark.schema import SHIPMENT_SPECS


@pytest.fixture
def rows(spark):
    return by_age(spark, {1: 2, 40: 1})


def test_types_names_and_order(rows):
    shuffled = rows.select(*reversed(rows.columns), F.lit(1).alias("extra"))
    aligned = align(shuffled)
    assert [(f.name, f.dataType) for f in aligned.schema] == [(s.name, s.data_type) for s in SHIPMENT_SPECS]
    assert as_set(aligned) == as_set(rows)


def test_missing_columns_take_defaults(rows):
    aligned = align(rows.drop("record_version", "settlement_status", "actual_cost"))
    assert as_set(aligned) == as_set(rows)


def test_missing_required_column_fails(rows):
    with pytest.raises(ValueError, match="carrier_code"):
        align(rows.drop("carrier_code"))


def test_lossless_conversions(rows):
    converted = rows.withColumns(
        {
            "shipment_id": F.col("shipment_id").cast("string"),
            "shipment_date": F.col("shipment_date").cast("string"),
            "record_version": F.col("record_version").cast("bigint"),
            "estimated_cost": F.col("estimated_cost").cast("double"),
            "weight_lbs": F.col("weight_lbs").cast("string"),
        }
    )
    assert as_set(align(converted)) == as_set(rows)


@pytest.mark.parametrize(
    "column, value, problem",
    [
        ("estimated_cost", "CAST(1.239 AS DECIMAL(18,3))", "estimated_cost does not fit"),
        ("estimated_cost", "CAST(1.239 AS DOUBLE)", "estimated_cost does not fit"),
        ("weight_lbs", "CAST(123456789.00 AS DECIMAL(18,2))", "weight_lbs does not fit"),
        ("record_version", "3000000000L", "record_version does not fit"),
        ("shipment_id", "'12.5'", "shipment_id does not fit"),
        ("shipment_id", "'twelve'", "shipment_id does not fit"),
        ("shipment_date", "TIMESTAMP_NTZ'2024-01-01 10:00:00'", "shipment_date does not fit"),
        ("shipment_date", "'2024-01-01 10:00:00'", "shipment_date does not fit"),
        ("payload", "repeat('x', 101)", "payload is too long"),
        ("carrier_code", "'CAR-ABCDEFG'", "carrier_code is too long"),
        ("payload", "CAST(NULL AS STRING)", "payload is null"),
        ("shipment_id", "CAST(NULL AS BIGINT)", "shipment_id is null"),
    ],
)
def test_lossy_or_invalid_values_fail(rows, column, value, problem):
    with pytest.raises(Exception, match=problem):
        align(rows.withColumn(column, F.expr(value))).collect()


@pytest.mark.parametrize(
    "column, value", [("record_version", "true"), ("shipment_id", "DATE'2024-01-01'"), ("shipment_date", "1")]
)
def test_meaningless_conversions_are_rejected_up_front(rows, column, value):
    with pytest.raises(TypeError, match=column):
        align(rows.withColumn(column, F.expr(value)))


def test_longest_values_pass(rows):
    assert align(rows.withColumn("payload", F.expr("repeat('x', 100)"))).count() == 3
