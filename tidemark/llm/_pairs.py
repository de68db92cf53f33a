"""Pairs within buckets of any size, and connected components, both without a group in one task.

A bucket is cut into blocks by a hash of its members, and each pair of blocks is a group of its own.
A task compares the members of its groups and hands on sums and a spanning forest, never pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._tables import checkpointed

GROUP = ["key", "low", "high"]
#: Pairs compared at once.
PAIRS_AT_ONCE = 1 << 15


def blocks(members: DataFrame, block: int) -> DataFrame:
    """key, low, high, side and node: members of buckets (key, node) of two or more, once for each pair of blocks.

    A member of one of g blocks goes to g groups, so a group has two blocks at most.
    """
    sizes = members.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    number = F.ceil(F.col("n") / block).cast("int")
    return (
        members.join(sizes, "key")
        .withColumn("number", number)
        .withColumn("side", F.pmod(F.xxhash64("node"), F.col("number")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("number") - 1)))
        .select("key", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "node")
    )


def in_groups(rows: DataFrame) -> DataFrame:
    """Rows of a group in one task, one after the other."""
    return rows.repartition(*GROUP).sortWithinPartitions(*GROUP)


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups with the first row of each group and the end."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        starts = _starts(table)
        if len(starts) > 1:
            yield table.slice(0, int(starts[-1])), starts
            table = table.slice(int(starts[-1]))
        held = table
    if held is not None:
        yield held, np.array([0, held.num_rows])


def _starts(table: pa.Table) -> np.ndarray:
    change = np.zeros(table.num_rows, dtype=bool)
    change[0] = True
    for name in GROUP:
        values = table[name].to_numpy()
        change[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(change)


def pairs_of(table: pa.Table, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of all pairs to compare in whole groups, PAIRS_AT_ONCE or one row's at a time.

    In a group of two blocks only pairs of different blocks count.
    """
    n = table.num_rows
    ends = np.repeat(starts[1:], np.diff(starts))
    rest = ends - np.arange(n) - 1
    one_block = table["low"].to_numpy() == table["high"].to_numpy()
    side = table["side"].to_numpy()
    total = np.concatenate([[0], np.cumsum(rest)])
    row = 0
    while row < n:
        last = max(row + 1, int(np.searchsorted(total, total[row] + PAIRS_AT_ONCE, "right")) - 1)
        count = rest[row:last]
        a = np.repeat(np.arange(row, last), count)
        b = a + 1 + np.arange(len(a)) - np.repeat(total[row:last] - total[row], count)
        kept = one_block[a] | (side[a] != side[b])
        if kept.any():
            yield a[kept], b[kept]
        row = last


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row number that each of n rows is linked with, directly or not."""
    label = np.arange(n)
    while len(a):
        new = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        # A label takes over the label of its row until nothing moves.
        np.minimum.at(new, label, new[np.arange(n)])
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def linked(
    compare: Callable[[pa.Table, np.ndarray], Iterator[tuple[np.ndarray, np.ndarray]]], weighted: bool = True
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow on in_groups(): node, root and links of every row that has a link in its group.

    compare: gives the linked pairs of rows of whole groups. links sums column ``weight`` of the partners.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches):
            n, found = table.num_rows, list(compare(table, starts))
            if not found:
                continue
            a, b = (np.concatenate(x) for x in zip(*found))
            node = table["node"].to_numpy()
            weight = table["weight"].to_numpy() if weighted else np.ones(n)
            links = np.bincount(a, weights=weight[b], minlength=n) + np.bincount(b, weights=weight[a], minlength=n)
            root = node[forest(n, a, b)]
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[some]), pa.array(root[some]), pa.array(links[some].astype(np.int64))],
                ["node", "root", "links"],
            )

    return run


LINKED = "node long, root long, links long"


def connected_components(edges: DataFrame) -> DataFrame:
    """node and component, the smallest node reachable, for all nodes of edges (a, b).

    Every node hands its larger neighbours to its smallest one, then its smaller neighbours, in turn, until
    all edges point to the smallest node of their component. The number of rounds grows with the logarithm
    of the longest path. A node with many neighbours is split by the join, and minima are combined
    before they are shuffled.
    """

    def mark(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = checkpointed(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Minima are stored before they are joined: only then can the join split a node with many neighbours.
        larger = both.filter("b > a").join(checkpointed(lowest), "a")
        large = checkpointed(larger.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        lowest = checkpointed(large.groupBy("a").agg(F.min("b").alias("m")))
        smaller = large.join(lowest, "a").filter("b <> m")
        handed = smaller.select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = checkpointed(handed.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct())
        after = mark(edges)
        if after == before:
            break
        before = after
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
