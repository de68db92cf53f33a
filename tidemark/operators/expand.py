"""Row expansion: shifted copies of the base rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.bands import PENDING_STATUS, PENDING_VERSION
from tidemark.schema import SHIPMENT_COLUMNS

# Number of copies, id distance, days per copy and the wrap of the date shift.
COPIES = 40
ID_OFFSET = 5_000_000
DAYS_PER_COPY = 2
DATE_CYCLE = 365


def copies_of(
    base: DataFrame,
    first: int = 1,
    last: int = COPIES,
    id_offset: int | Column | None = None,
) -> DataFrame:
    """Copies ``first`` .. ``last`` of every row, pending again and dated back.

    An explode of a literal sequence multiplies rows inside the task that read them, without a
    join or a shuffle. ``id_offset`` must exceed the span of the base ids, as its default does.
    """
    id_offset = id_distance(base) if id_offset is None else id_offset
    return _shifted(base.withColumn("copy_no", F.explode(F.sequence(F.lit(first), F.lit(last)))), id_offset)


def id_distance(base: DataFrame) -> Column:
    """The usual distance of the ids of copies, or more where the base ids reach beyond it."""
    return F.greatest(F.lit(ID_OFFSET).cast("bigint"), base.agg(F.max("shipment_id")).scalar() + 1)


def expand(base: DataFrame, copies: int = COPIES, id_offset: int | Column | None = None) -> DataFrame:
    """The base rows and all their copies, from one scan of all columns: copy 0 is the row itself."""
    id_offset = id_distance(base) if id_offset is None else id_offset
    numbered = base.withColumn("copy_no", F.explode(F.sequence(F.lit(0), F.lit(copies))))
    is_base = F.col("copy_no") == 0
    shifted = _shifted_columns(id_offset)
    return numbered.select(
        *[
            F.when(is_base, F.col(name)).otherwise(shifted[name]).alias(name) if name in shifted else F.col(name)
            for name in SHIPMENT_COLUMNS
        ]
    )


def base_rows_only(df: DataFrame, largest_base_id: int | Column = ID_OFFSET) -> DataFrame:
    """Rows of a partly expanded table that are not copies themselves."""
    return df.filter(F.col("shipment_id") <= largest_base_id)


def _shifted(numbered: DataFrame, id_offset: int | Column) -> DataFrame:
    shifted = _shifted_columns(id_offset)
    return numbered.select(
        *[shifted[name].alias(name) if name in shifted else F.col(name) for name in SHIPMENT_COLUMNS]
    )


def _shifted_columns(id_offset: int | Column) -> dict[str, Column]:
    offset = id_offset if isinstance(id_offset, Column) else F.lit(id_offset)
    copy_no = F.col("copy_no")
    return {
        "shipment_id": F.col("shipment_id") + copy_no.cast("bigint") * offset.cast("bigint"),
        "shipment_date": F.date_sub("shipment_date", (copy_no * DAYS_PER_COPY) % DATE_CYCLE),
        "record_version": F.lit(PENDING_VERSION),
        "settlement_status": F.lit(PENDING_STATUS),
        "actual_cost": F.lit(None).cast("decimal(18,2)"),
        "payload": F.concat(F.lit("SHIPMENT-BATCH-"), copy_no.cast("string")),
    }
