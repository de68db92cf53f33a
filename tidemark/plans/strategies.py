"""What each ingestion strategy leaves in the sink after one more night.

All strategies are judged in one pass: the sink as it was and the source as it is are stacked and
grouped by id, and the row counts of an id inside and outside the window decide what every
strategy does with it. Rows are combined before the shuffle, so repeated ids cost no more.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.bands import BANDS, PENDING_VERSION
from tidemark.functions.dates import Window, in_window
from tidemark.schema import KEY_COLUMN, PARTITION_COLUMN

# The strategies compared, with the interrupted form of the one that can be.
APPEND_ONLY = "append_only"
WATERMARK = "watermark"
FULL_RELOAD = "full_reload"
DELETE_APPEND = "delete_append"
DELETE_APPEND_INTERRUPTED = "delete_append_interrupted"
PARTITION_REPLACE = "partition_replace"


VERSIONS = (PENDING_VERSION, *(band.version for band in BANDS))


def compare_strategies(old_sink: DataFrame, source: DataFrame, window: Window) -> DataFrame:
    """Rows written and the errors left behind, for each strategy.

    duplicate_rows: rows beyond the first of an id. stale_rows: kept rows of an id that the source has, in
    a version that it no longer has of it. missing_rows: source ids with no stored row. surplus_rows: kept rows whose id
    the source has not.
    """
    # One value, taken before so that it reaches the aggregation as a literal.
    watermark = old_sink.agg(F.max(PARTITION_COLUMN)).first()[0]
    is_new, inside = F.col("is_new"), in_window(window)
    past_mark = F.lit(True) if watermark is None else F.col(PARTITION_COLUMN) > F.lit(watermark)

    def side(df: DataFrame, new: bool) -> DataFrame:
        return df.select(KEY_COLUMN, PARTITION_COLUMN, "record_version", F.lit(new).alias("is_new"))

    # The place of a row's version, with one more for any other; so versions are told apart in one grouping.
    slot = F.coalesce(F.nullif(F.array_position(F.lit(list(VERSIONS)), F.col("record_version")), F.lit(0)) - 1, F.lit(len(VERSIONS)))

    def stale(kept: str) -> Column:
        """Kept rows of an id in versions that the source does not have of it."""
        lost = [F.when(F.col(f"new_all_{v}") == 0, F.col(f"{kept}_{v}")).otherwise(0) for v in range(len(VERSIONS) + 1)]
        return reduce(Column.__add__, lost)

    per_id = (
        side(old_sink, False)
        .unionByName(side(source, True))
        .groupBy(KEY_COLUMN)
        .agg(
            F.count_if(~is_new).alias("old_all"),
            F.count_if(~is_new & ~inside).alias("old_outside"),
            F.count_if(is_new).alias("new_all"),
            F.count_if(is_new & inside).alias("new_inside"),
            F.count_if(is_new & past_mark).alias("new_past_mark"),
            *[
                F.count_if(member & (slot == v)).alias(f"{name}_{v}")
                for v in range(len(VERSIONS) + 1)
                for name, member in (("old_all", ~is_new), ("old_outside", ~is_new & ~inside), ("new_all", is_new))
            ],
        )
        .withColumns({f"stale_{kept}": stale(kept) for kept in ("old_all", "old_outside")})
    )
    nothing = F.lit(0).cast("bigint")
    everything = F.col("old_all"), F.col("stale_old_all")
    outside = F.col("old_outside"), F.col("stale_old_outside")
    # Per strategy: how many old rows of an id stay, how many of them stale, how many source rows are written.
    strategies: dict[str, tuple[Column, Column, Column]] = {
        APPEND_ONLY: (*everything, F.col("new_inside")),
        WATERMARK: (*everything, F.col("new_past_mark")),
        FULL_RELOAD: (nothing, nothing, F.col("new_all")),
        DELETE_APPEND: (*outside, F.col("new_inside")),
        DELETE_APPEND_INTERRUPTED: (*outside, nothing),
        PARTITION_REPLACE: (*outside, F.col("new_inside")),
    }
    at_source = F.col("new_all") > 0

    def total(rows: Column, where: Column | None = None) -> Column:
        counted = rows if where is None else F.when(where, rows)
        return F.coalesce(F.sum(counted), nothing)

    measures = [
        F.struct(
            F.lit(name).alias("strategy"),
            total(written).alias("rows_written"),
            total(kept + written).alias("rows_after"),
            total(kept + written - 1, kept + written > 1).alias("duplicate_rows"),
            total(outdated, at_source).alias("stale_rows"),
            F.count_if(at_source & (kept + written == 0)).alias("missing_rows"),
            total(kept, ~at_source).alias("surplus_rows"),
        )
        for name, (kept, outdated, written) in strategies.items()
    ]
    return per_id.agg(F.array(*measures).alias("measures")).selectExpr("inline(measures)")
