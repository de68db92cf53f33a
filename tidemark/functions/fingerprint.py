"""Order-insensitive checksums of groups of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schema import SHIPMENT_COLUMNS


def row_hash(columns: Sequence[str] = SHIPMENT_COLUMNS) -> Column:
    """Hash of a row's values. xxhash64 skips nulls, so nullness is hashed as a value of its own."""
    return F.xxhash64(*[part for c in columns for part in (F.col(c), F.col(c).isNull())])


def bag_hash(hashes: Column) -> tuple[Column, Column]:
    """Two aggregates over row hashes that together are equal for equal bags of rows.

    XOR alone cannot see a row that is stored twice, so a sum of the hashes' upper 24 bits goes
    with it; that sum stays within BIGINT for 5e11 rows in a group.
    """
    return F.bit_xor(hashes), F.sum(F.shiftrightunsigned(hashes, 40))


def checksum_aggregates(columns: Sequence[str] = SHIPMENT_COLUMNS) -> list[Column]:
    """Content checksum of a group of shipments: its rows' hashes and its cost totals."""
    hash_xor, hash_sum = bag_hash(row_hash(columns))
    return [
        hash_xor.alias("hash_xor"),
        hash_sum.alias("hash_sum"),
        F.sum("estimated_cost").alias("estimated_total"),
        F.sum("actual_cost").alias("actual_total"),
    ]


CHECKSUM_COLUMNS = ("hash_xor", "hash_sum", "estimated_total", "actual_total")


def combined_checksums() -> list[Column]:
    """The checksum of a group from the checksums of its parts."""
    return [
        F.bit_xor("hash_xor").alias("hash_xor"),
        *[F.sum(name).alias(name) for name in CHECKSUM_COLUMNS[1:]],
    ]
