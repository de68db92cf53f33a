"""Approximate nearest neighbours by inner product, through stable projections and kd-trees.

A vector gets one more component so that all have the length of the longest; then the largest inner product is
the smallest distance. Gaussian projections to a few dimensions are indexed by kd-trees, one per
block of rows. A query visits leaves in the order of projected distance and verifies their vectors, until a
chi-square test says that a nearer one is unlikely to be still unseen.
"""

from __future__ import annotations

from functools import lru_cache
from math import exp

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.vectors import matrix, usable

PROJECTED = 10
#: Chance that a true neighbour is projected within the radius at which its search stops.
CONFIDENCE = 0.985
LEAF = 128
#: Rows of an index block, and queries that search it together.
BLOCK_ROWS, QUERY_ROWS = 8192, 1024
SEED = 20240104


@lru_cache(maxsize=4)
def chi_square_quantile(confidence: float, freedom: int = PROJECTED) -> float:
    """The value below which a chi-square variable of an even number of degrees stays with this probability."""

    def below(x: float) -> float:
        term = total = 1.0
        for i in range(1, freedom // 2):
            term *= x / 2 / i
            total += term
        return 1 - exp(-x / 2) * total

    low, high = 0.0, 1000.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < confidence else (low, middle)
    return high


class Tree:
    """A kd-tree over projected rows: leaves of at most LEAF rows with their boxes."""

    def __init__(self, points: np.ndarray):
        leaves, work = [], [np.arange(len(points))]
        while work:
            rows = work.pop()
            if len(rows) <= LEAF:
                leaves.append(rows)
                continue
            spread = points[rows]
            axis = int((spread.max(0) - spread.min(0)).argmax())
            # Halves by rank, so that equal points are split as well.
            half = np.argpartition(spread[:, axis], len(rows) // 2)
            work += [rows[half[: len(rows) // 2]], rows[half[len(rows) // 2 :]]]
        self.leaves = leaves
        self.low = np.array([points[rows].min(0) for rows in leaves])
        self.high = np.array([points[rows].max(0) for rows in leaves])

    def by_distance(self, point: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaves in the order of the squared distance of their boxes, and these distances."""
        outside = np.maximum(0, np.maximum(self.low - point, point - self.high))
        distance = (outside * outside).sum(1)
        order = np.argsort(distance, kind="stable")
        return order, distance[order]


def search(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, longest: float, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query, up to k rows of one block with the largest inner products: place of the query, vec_id, score."""
    dims = vectors.shape[1]
    planes = np.random.default_rng([SEED, dims]).normal(size=(dims + 1, PROJECTED))
    added = np.sqrt(np.maximum(0, longest - (vectors * vectors).sum(1)))
    tree = Tree(vectors @ planes[:-1] + added[:, None] * planes[-1])
    ordered = [(rows, ids[rows], np.ascontiguousarray(vectors[rows])) for rows in tree.leaves]
    stop = chi_square_quantile(CONFIDENCE)
    found_query, found_row, found_score = [], [], []
    for place, (query_id, query) in enumerate(zip(query_ids, queries)):
        order, distance = tree.by_distance(query @ planes[:-1])
        least = longest + float(query @ query)
        rows, scores, worst = np.empty(0, dtype=np.int64), np.empty(0), -np.inf
        for leaf, away in zip(order.tolist(), distance.tolist()):
            # The k-th best distance so far, by which an unseen row must be nearer.
            if worst > -np.inf and away >= stop * max(0.0, least - 2 * worst):
                break
            own, own_ids, block = ordered[leaf]
            products = block @ query
            # Rows with the query's own id are no candidates, however often it stands.
            better = own_ids != query_id
            if worst > -np.inf:
                better &= products >= worst - 1e-9
            if not better.any():
                continue
            rows, scores = np.concatenate([rows, own[better]]), np.concatenate([scores, products[better]])
            if len(rows) >= k:
                # Those level with the last stay.
                worst = float(np.partition(scores, len(scores) - k)[len(scores) - k])
                kept = scores >= worst - 1e-9
                rows, scores = rows[kept], scores[kept]
        # The products again, in one order of summation for all rows, so that equal vectors tie exactly.
        scores = (vectors[rows] * query).sum(1)
        best = np.lexsort((ids[rows], -scores))[:k]
        found_query.append(np.full(len(best), place))
        found_row.append(ids[rows][best])
        found_score.append(scores[best])
    empty = np.empty(0, dtype=np.int64)
    return (
        np.concatenate([empty, *found_query]),
        np.concatenate([empty, *found_row]),
        np.concatenate([np.empty(0), *found_score]),
    )


def nearest(embeddings: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, ``rank`` (from 1), ``vec_id`` and ``score``: up to k neighbours of each query row.

    Candidates are all rows but those with the query's own vec_id; the score is the inner product in double precision, the largest
    first, ties to the smaller vec_id. Vectors that are null, empty, zero or not finite, and rows without
    vec_id, take no part; vectors are compared with those of as many components. Rows that share a
    vec_id are candidates each, and queries each, with ranks from 1 for each vector; a query that stands twice
    with one vector answers once.
    """
    rows = (
        embeddings.filter(usable("embedding") & F.col("vec_id").isNotNull())
        .select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), is_query.alias("is_query"))
        .withColumn("dims", F.size("embedding"))
    )
    squared = F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x * x)
    # A row for each number of components.
    facts = rows.groupBy("dims").agg(
        F.count("*").alias("n"), F.count_if("is_query").alias("n_queries"), F.max(squared).alias("longest")
    )
    blocks = F.ceil(F.col("n") / BLOCK_ROWS).cast("int")
    query_blocks = F.ceil(F.col("n_queries") / QUERY_ROWS).cast("int")
    placed = rows.join(
        facts.filter("n_queries > 0").select("dims", "longest", blocks.alias("blocks"), query_blocks.alias("query_blocks")), "dims"
    )
    index = placed.select(
        "dims",
        "vec_id",
        "embedding",
        "longest",
        F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)).alias("query_block"),
    )
    queries = (
        placed.filter("is_query")
        .dropDuplicates(["vec_id", "embedding"])
        .select(
            "dims",
            F.col("vec_id").alias("query_id"),
            # Tells the vectors of one id apart.
            F.xxhash64("embedding").alias("query_hash"),
            "embedding",
            F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("query_blocks")).cast("int").alias("query_block"),
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        )
        .toDF("query_dims", "query_id", "query_hash", "query", "of_query_block", "of_block")
    )

    names, kinds = ("query_id", "query_hash", "vec_id", "score"), (*[pa.int64()] * 3, pa.float64())

    def one(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({name: pa.array([], kind) for name, kind in zip(names, kinds)})
        place, vec_id, score = search(
            left["vec_id"].to_numpy(),
            matrix(left["embedding"]),
            right["query_id"].to_numpy(),
            matrix(right["query"]),
            float(left["longest"][0].as_py()),
            k,
        )
        of_query = [right[name].to_numpy()[place] for name in names[:2]]
        return pa.table(dict(zip(names, [*of_query, vec_id, score])))

    found = (
        index.groupBy("dims", "block", "query_block")
        .cogroup(queries.groupBy("query_dims", "of_block", "of_query_block"))
        .applyInArrow(one, "query_id long, query_hash long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
