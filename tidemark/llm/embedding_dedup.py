"""Near-duplicate vectors by random-hyperplane signs, exact cosines and connected components.

In each of several tables a vector is filed under the signs of its products with random vectors. Vectors
that share a place in any table are compared exactly. Equal vectors are one node from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._pairs import LINKED, blocks, connected_components, in_groups, linked, pairs_of
from tidemark.llm._tables import checkpointed
from tidemark.llm._text import mixed
from tidemark.llm.vectors import matrix, usable

#: A pair with cosine 0.93 agrees in one sign with probability 0.88, in the 10 of a table with 0.28, and is missed by all 40 tables
#: once in 500 000 times.
TABLES, SIGNS = 40, 10
THRESHOLD = 0.93
BLOCK = 256
SEED = 20240103


def sign_codes(vectors: np.ndarray) -> np.ndarray:
    """The place of each vector in each table; vectors in rows, tables in columns."""
    planes = np.random.default_rng([SEED, vectors.shape[1]]).normal(size=(vectors.shape[1], TABLES * SIGNS))
    signs = (vectors @ planes > 0).reshape(len(vectors), TABLES, SIGNS)
    return signs @ (1 << np.arange(SIGNS))


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths = batch.column("dims").to_numpy()
        for dims in np.unique(lengths):
            part = batch.filter(pa.array(lengths == dims))
            codes = sign_codes(matrix(part.column("embedding"))).astype(np.uint64)
            label = part.column("label_key").to_numpy().astype(np.uint64)
            tables = np.arange(TABLES, dtype=np.uint64)
            key = mixed(mixed(mixed(label + np.uint64(dims))[:, None] ^ tables) + codes)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.view(np.int64).ravel()),
                    pa.array(np.repeat(part.column("node").to_numpy(), TABLES)),
                    pa.array(np.tile(tables.astype(np.int32), len(part))),
                ],
                ["key", "node", "place"],
            )


def _compare(threshold: float):
    def compare(table: pa.Table, starts: np.ndarray):
        lengths = table["dims"].to_numpy()
        rows_of = [np.flatnonzero(lengths == d) for d in np.unique(lengths)]
        place, label = table["place"].to_numpy(), table["label_key"].to_numpy()
        known = []
        for rows in rows_of:
            vectors = matrix(table["embedding"].take(pa.array(rows)))
            known.append((vectors, np.sqrt((vectors * vectors).sum(1)), sign_codes(vectors)))
        at, kind = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
        for k, rows in enumerate(rows_of):
            at[rows], kind[rows] = np.arange(len(rows)), k
        for a, b in pairs_of(table, starts):
            for k, (vectors, norms, codes) in enumerate(known):
                own = (kind[a] == k) & (kind[b] == k) & (label[a] == label[b])
                x, y = a[own], b[own]
                i, j = at[x], at[y]
                # A pair counts in the first table in which it meets, so it counts once.
                first = (codes[i] == codes[j]).argmax(1) == place[x]
                x, y, i, j = x[first], y[first], i[first], j[first]
                cosine = (vectors[i] * vectors[j]).sum(1) / (norms[i] * norms[j])
                near = cosine >= threshold
                if near.any():
                    yield x[near], y[near]

    return compare


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: vec_id, ``n_links``, ``component_id`` and ``kept``.

    Rows link when their labels are equal and not null, their vectors have as many components and the
    cosine in double precision reaches the threshold; n_links counts linked rows besides the row itself, equal
    vectors included, component_id is the smallest vec_id reachable and kept marks its row. Vectors that are
    null, empty, zero or not finite link with nothing. A row with null vec_id is linked and counted
    like others but cannot name a component; alone, its component_id is null and kept is false.
    """
    rows = embeddings.select("vec_id", "label", "embedding")
    able = usable("embedding") & F.col("label").isNotNull()
    nodes = checkpointed(
        rows.filter(able)
        .groupBy("label", "embedding")
        .agg(F.count("*").alias("weight"), F.min("vec_id").alias("first_id"))
        .withColumn("label_key", F.xxhash64("label"))
        .withColumn("dims", F.size("embedding"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    keys = nodes.select("node", "label_key", "dims", "embedding").mapInArrow(_keys, "key long, node long, place int")
    filed = checkpointed(keys)
    place = filed.select("key", "place").distinct()
    groups = blocks(filed.select("key", "node"), BLOCK).join(place, "key")
    members = groups.join(nodes.select("node", "label_key", "dims", "weight", "embedding"), "node")
    found = checkpointed(in_groups(members).mapInArrow(linked(_compare(threshold)), LINKED))
    component = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    smallest = (
        nodes.select("node", "first_id").join(component, "node").groupBy("component").agg(F.min("first_id").alias("component_id"))
    )
    known = (
        nodes.join(links, "node", "left")
        .join(component.join(smallest, "component"), "node", "left")
        .select(
            "label",
            "embedding",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component_id", "first_id").alias("component_id"),
        )
    )
    linked_rows = rows.filter(able).join(known, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    others = rows.filter(~able).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return linked_rows.unionByName(others).withColumn("kept", kept)
