"""Dense row numbers by ranges cut from quantile sketches, without a stored copy of the rows.

Cuts come from mergeable quantile sketches of the leading column, sized by the number of rows. A value that holds
several cuts is hot and cut again by the next column, and so on. A row's range follows from its own values, so
counting the ranges and numbering the rows within them can each read the rows anew.
"""

from __future__ import annotations

import json
from collections import Counter
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_RANGE = 1_000_000
#: Beyond this many ranges they grow instead; cuts and counts of ranges are all that reaches the driver.
MOST_RANGES = 4096
#: Sketches of this many tasks' groups are merged side by side before the last merge.
MERGERS = 256
_LEAST = -(1 << 63)
#: Leading bytes of a string that take part, seven a code.
_STRING_CODES = 3


def dense_ids_by_ranges(
    df: DataFrame, *order: str, name: str = "surrogate_id", rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """``row_number()`` over the whole frame, counted from 1, with no task seeing all rows; nulls come first.

    The rows are read once for each level of cuts, once for counts and once for the numbers, so their order columns must
    have the same values each time: numbers by task or chance do not. Rows equal in every order column stay together.
    A column called like ``name`` is replaced, all others stay.
    """
    ranged = rows_in_ranges(df, *order, rows_per_range=rows_per_range)
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One row a range, so the window and the broadcast are both small.
    offsets = (
        ranged.groupBy("range")
        .agg(F.count("*").alias("rows"))
        .select("range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    within = F.row_number().over(Window.partitionBy("range").orderBy(*[_of_row(column) for column in order]))
    numbered = ranged.withColumn("within", within).join(F.broadcast(offsets), "range")
    kept = [_of_row(column).alias(column) for column in df.columns if column.lower() != name.lower()]
    return numbered.select(*kept, (F.col("offset") + F.col("within")).alias(name))


def rows_in_ranges(df: DataFrame, *order: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Every row as ``row`` and the number of its ``range``; ranges follow one another in the order."""
    codes = _codes(df, order)
    names = [f"c{i}" for i in range(len(codes))]
    coded = df.select(*[code.alias(name) for name, code in zip(names, codes)])
    cuts = _cuts(coded, min(MOST_RANGES, ceil(df.count() / rows_per_range)))
    place = F.struct(*[code.alias(name) for name, code in zip(names, codes)])
    row = F.struct(*[F.col(f"`{column}`") for column in df.columns])
    return df.select(row.alias("row"), _cuts_up_to(place, cuts, names).alias("range"))


def _of_row(column: str) -> Column:
    return F.col("row").getField(column)


def _codes(df: DataFrame, order: tuple[str, ...]) -> list[Column]:
    """Integers that compare, one after the other, like the order columns; as many as have an integer form.

    The codes end behind a string, of which only leading bytes are compared, and before a type without a form.
    """
    codes: list[Column] = []
    exact = F.lit(True)
    for name in order:
        column, kind = F.col(f"`{name}`"), df.schema[name].dataType
        if kind in (T.StringType(), T.BinaryType()):
            raw = column.cast("binary")
            for i in range(_STRING_CODES):
                digits = F.rpad(F.hex(F.substring(raw, 7 * i + 1, 7)), 14, "0")
                code = F.coalesce(F.conv(digits, 16, 10).cast("bigint"), F.lit(_LEAST))
                codes.append(F.when(exact, code).otherwise(F.lit(_LEAST)))
            break
        value = _integer(column, kind)
        if value is None:
            break
        # Null is the least code, which the least long may not share; behind these two longs nothing is told apart.
        code = F.when(column.isNull(), F.lit(_LEAST)).otherwise(F.greatest(value, F.lit(_LEAST + 1)))
        codes.append(F.when(exact, code).otherwise(F.lit(_LEAST)))
        exact = exact & (column.isNull() | (value > F.lit(_LEAST + 1)))
    if not codes:
        raise TypeError(f"rows cannot be cut into ranges by {order[0]}")
    return codes


def _integer(column: Column, kind: T.DataType) -> Column | None:
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return column.cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (column * F.lit(10**kind.scale)).cast("bigint")
    return None


def _cuts(coded: DataFrame, ranges: int) -> list[tuple[int, ...]]:
    """The first place of each range but the first, sorted; places are padded with the least code."""
    spark, names = coded.sparkSession, coded.columns
    found: set[tuple[int, ...]] = set()
    # Values to be cut and into how many ranges; at first all rows are.
    hot: list[tuple[tuple[int, ...], int]] = [((), ranges)]
    for level, name in enumerate(names):
        hot = [(prefix, pieces) for prefix, pieces in hot if pieces > 1]
        if not hot:
            break
        above = names[:level]
        schema = ", ".join(f"{column} bigint" for column in ("part", "pieces", *above))
        wanted = spark.createDataFrame([(i, pieces, *prefix) for i, (prefix, pieces) in enumerate(hot)], schema)
        rows = coded.join(F.broadcast(wanted), above) if above else coded.withColumns(
            {"part": F.lit(0).cast("bigint"), "pieces": F.lit(ranges).cast("bigint")}
        )
        size = min(65_535, max(200, 8 * max(pieces for _, pieces in hot)))
        # The wanted ranks must be constants, so there is a case for each number of pieces.
        quantiles_of = F.coalesce(
            *[
                F.when(F.col("pieces") == n, F.kll_sketch_get_quantile_bigint("sketch", _ranks(n)))
                for n in sorted({pieces for _, pieces in hot})
            ]
        )
        quantiles = (
            rows.withColumn("merger", F.spark_partition_id() % MERGERS)
            .groupBy("part", "pieces", "merger")
            .agg(F.kll_sketch_agg_bigint(name, size).alias("sketch"))
            .groupBy("part", "pieces")
            .agg(F.kll_merge_agg_bigint("sketch", size).alias("sketch"))
            .select("part", quantiles_of.alias("cuts"))
            .collect()
        )
        deeper = []
        for part, cuts in quantiles:
            for value, times in Counter(cuts).items():
                prefix = (*hot[part][0], value)
                found.add(prefix + (_LEAST,) * (len(names) - len(prefix)))
                if times > 1:
                    deeper.append((prefix, times + 1))
        hot = deeper
    return sorted(found)


def _ranks(pieces: int) -> Column:
    return F.split(F.lit(",".join(str(i / pieces) for i in range(1, pieces))), ",").cast("array<double>")


def _cuts_up_to(place: Column, cuts: list[tuple[int, ...]], names: list[str]) -> Column:
    """How many cuts are not beyond the place, by binary search in a constant array."""
    fields = ", ".join(f"{name}: bigint" for name in names)
    listed = F.from_json(F.lit(json.dumps([dict(zip(names, cut)) for cut in cuts])), f"array<struct<{fields}>>")

    def halve(between: Column, _: Column) -> Column:
        low, high = between.getField("low"), between.getField("high")
        middle = F.shiftright(low + high, 1)
        reached = F.get(listed, middle) <= place
        open_ = low < high
        return F.struct(
            F.when(open_ & reached, middle + 1).otherwise(low).alias("low"),
            F.when(open_ & ~reached, middle).otherwise(high).alias("high"),
        )

    steps = F.sequence(F.lit(0), F.lit(len(cuts).bit_length()))
    start = F.struct(F.lit(0).alias("low"), F.lit(len(cuts)).alias("high"))
    return F.reduce(steps, start, halve).getField("low")
