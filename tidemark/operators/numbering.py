"""Dense row numbers over a global order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path

# monotonically_increasing_id() keeps the partition above this bit and the row below it.
_PARTITION_BIT = 33


def dense_ids(df: DataFrame, *order: str, name: str = "surrogate_id") -> DataFrame:
    """``row_number()`` over the whole frame, counted from 1, with no task seeing all rows.

    The frame is range-partitioned and sorted by ``order``, which must be a total order, and
    written once, so both passes below see the same partitions even if executors are lost. The
    first counts rows per partition (one small row each), the second adds those offsets. Include
    a unique column in ``order``: it also lets a hot leading value spread over many partitions.
    """
    spark = df.sparkSession
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "numbering")
    sorted_rows = (
        df.repartitionByRange(slots, *order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    sorted_rows.write.parquet(path)
    placed = (
        spark.read.schema(sorted_rows.schema)
        .parquet(path)
        .withColumn("_part", F.shiftrightunsigned("_slot", _PARTITION_BIT))
        .withColumn("_row", F.col("_slot") - F.shiftleft("_part", _PARTITION_BIT))
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # At most one row per shuffle partition, so the window and the broadcast are both small.
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_row") + 1)
        .drop("_slot", "_part", "_row", "_offset")
    )
