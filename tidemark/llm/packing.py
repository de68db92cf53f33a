"""Packing documents into batches by optimal length buckets.

One global histogram of lengths goes to the driver, where dynamic programming chooses the bucket bounds
that need the least padding. Inside each bucket rows form batches within a token budget. Lengths alone
are shuffled, never texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm._tables import checkpointed
from tidemark.llm.mixing import id_hash, word_count

BUCKETS = 16
BATCH_TOKENS = 65_536
#: Lengths below two to this power have a cell each; above, cells widen so that their number grows with the
#: logarithm of the longest length only.
EXACT_BITS = 9
#: Rows of one bucket that a task numbers.
SHARD_ROWS = 2048


def length_cell(n: Column) -> Column:
    """The cell of a length: itself up to 2**EXACT_BITS, then EXACT_BITS leading digits."""
    shift = F.greatest(F.lit(0), F.length(F.bin(n)) - EXACT_BITS).cast("int")
    return F.shiftleft(F.call_function("shiftright", n, shift), 0) + shift.cast("long") * (1 << EXACT_BITS)


def optimal_bounds(lengths: np.ndarray, counts: np.ndarray, sums: np.ndarray, buckets: int) -> tuple[list[int], int]:
    """Upper bounds of at most so many buckets over ascending cells, and the least padding.

    lengths: the longest of each cell. A bucket pads its rows to its longest. Cost of cells i to j grows
    by the quadrangle inequality, so the best cut moves one way and each layer is solved by halving.
    """
    m = len(lengths)
    if not m:
        return [], 0
    rows = np.concatenate([[0], np.cumsum(counts)])
    words = np.concatenate([[0], np.cumsum(sums)])
    best = [lengths * rows[1:] - words[1:]]
    cuts = []
    for _ in range(min(buckets, m) - 1):
        # previous[i]: least padding of the first i cells, cut before cell i.
        previous = np.concatenate([[0], best[-1]])
        now, where = np.empty(m, dtype=np.int64), np.empty(m, dtype=np.int64)
        work = [(0, m - 1, 0, m - 1)]
        while work:
            low, high, first, last = work.pop()
            if low > high:
                continue
            j = (low + high) // 2
            i = np.arange(first, min(last, j) + 1)
            cost = previous[i] + lengths[j] * (rows[j + 1] - rows[i]) - (words[j + 1] - words[i])
            k = int(cost.argmin())
            now[j], where[j] = cost[k], first + k
            work += [(low, j - 1, first, first + k), (j + 1, high, first + k, last)]
        best.append(now)
        cuts.append(where)
    bounds, j = [], m - 1
    for where in reversed(cuts):
        bounds.append(int(lengths[j]))
        j = int(where[j]) - 1
        if j < 0:
            break
    else:
        bounds.append(int(lengths[j]))
    return bounds[::-1], int(best[-1][m - 1])


@dataclass
class Buckets:
    bounds: list[int]
    padding: int


def choose_buckets(lengths: DataFrame, buckets: int = BUCKETS) -> Buckets:
    """Bounds for column n_tokens; the histogram has at most about 2**EXACT_BITS cells for each doubling."""
    cells = (
        lengths.filter(F.col("n_tokens") > 0)
        .groupBy(length_cell(F.col("n_tokens")).alias("cell"))
        .agg(F.max("n_tokens").alias("longest"), F.count("*").alias("rows"), F.sum("n_tokens").alias("words"))
        .toPandas()
        .sort_values("longest")
    )
    columns = (cells[c].to_numpy(dtype=np.int64) for c in ("longest", "rows", "words"))
    return Buckets(*optimal_bounds(*columns, buckets))


def pack(
    documents: DataFrame, n_tokens: Column | None = None, buckets: int = BUCKETS, batch_tokens: int = BATCH_TOKENS
) -> DataFrame:
    """Every row of documents as doc_id, ``n_tokens``, ``bucket``, ``bucket_tokens``, ``batch`` and ``slot``.

    n_tokens: the length, by default the number of words; null counts as 0. A row stands in the first
    bucket whose bound reaches its length and is padded to bucket_tokens; rows of length 0 form bucket 0, which needs no
    tokens. A batch of a bucket holds as many rows as fit into batch_tokens, and at least one; batches are numbered from 0
    in each bucket, and all but its last are full. Rows come in the order of a hash of doc_id, rows
    of equal doc_id in any order, so equal rows may trade places between runs.
    """
    count = word_count("text") if n_tokens is None else F.coalesce(n_tokens, F.lit(0)).cast("long")
    lengths = checkpointed(documents.select("doc_id", count.alias("n_tokens"), id_hash("doc_id").alias("hash")))
    bounds = choose_buckets(lengths, buckets).bounds
    bucket = F.lit(len(bounds))
    for i in range(len(bounds) - 1, 0, -1):
        bucket = F.when(F.col("n_tokens") <= bounds[i - 1], F.lit(i)).otherwise(bucket)
    placed = lengths.withColumn("bucket", F.when(F.col("n_tokens") == 0, F.lit(0)).otherwise(bucket))
    # At most one row for each bucket.
    sizes = {r.bucket: r["count"] for r in placed.groupBy("bucket").count().collect()}
    shards = F.create_map(*(F.lit(x) for b, n in sizes.items() for x in (b, -(-n // SHARD_ROWS)))) if sizes else F.create_map(F.lit(0), F.lit(1))
    # Shards are ranges of the hash, so numbering within shards and adding up whole shards numbers the bucket.
    fraction = F.col("hash") / float(16**15)
    placed = placed.withColumn("shard", F.floor(fraction * F.element_at(shards, F.col("bucket"))).cast("int"))
    before = F.sum("rows").over(Window.partitionBy("bucket").orderBy("shard")) - F.col("rows")
    offsets = placed.groupBy("bucket", "shard").agg(F.count("*").alias("rows")).withColumn("before", before)
    within = Window.partitionBy("bucket", "shard").orderBy("hash", "doc_id", "n_tokens")
    numbered = placed.withColumn("place", F.row_number().over(within)).join(
        offsets.select("bucket", "shard", "before"), ["bucket", "shard"]
    )
    tokens = F.element_at(F.array(*map(F.lit, [0, *bounds])), F.col("bucket") + 1).cast("long")
    rows = F.greatest(F.lit(1), F.floor(F.lit(batch_tokens) / F.greatest(F.col("bucket_tokens"), F.lit(1))))
    number = F.col("before") + F.col("place") - 1
    return (
        numbered.withColumn("bucket_tokens", tokens)
        .withColumns({"batch": F.floor(number / rows).cast("long"), "slot": (number % rows).cast("long")})
        .select("doc_id", "n_tokens", "bucket", "bucket_tokens", "batch", "slot")
    )
