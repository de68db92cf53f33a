"""Similarity join of texts on word shingles, with Bayesian pruning of candidates.

Texts with equal shingle sets are one class. Classes that agree in a band of MinHash values are candidates.
Their MinHash values are compared a few at a time, and a pair is dropped once the probability that its
similarity reaches the threshold, given the matches so far, is below a tolerance. What is left is
verified on the shingle sets themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._pairs import LINKED, blocks, connected_components, in_groups, linked, pairs_of
from tidemark.llm._tables import checkpointed
from tidemark.llm._text import mixed, shingle_sets, text_slices

WORDS = 5
THRESHOLD = 0.8
#: A pair of similarity 0.8 agrees in a band of 3 with probability 0.51 and is missed by 21 bands three times in ten million.
BANDS, BAND = 21, 3
#: MinHash values compared before each look at the posterior.
STEP = 9
TOLERANCE = 1e-6
#: Members of a block while MinHash values, or shingle sets, are compared.
VALUE_BLOCK, SET_BLOCK = 256, 128


@lru_cache(maxsize=1)
def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    seeds = mixed(np.arange(1, 2 * BANDS * BAND + 1, dtype=np.uint64))
    return seeds[: BANDS * BAND] | np.uint64(1), seeds[BANDS * BAND :]


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    """The MinHash values of one set, 32 bits each."""
    factor, shift = _multipliers()
    least = np.full(len(factor), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 4096):
        values = shingles[None, at : at + 4096] * factor[:, None] + shift[:, None]
        np.minimum(least, values.min(1), out=least)
    return (least >> np.uint64(32)).astype("<u4")


@lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float = TOLERANCE) -> tuple[tuple[int, int], ...]:
    """For each look, the values compared so far and the fewest matches with which a pair stays.

    With a uniform prior, m matches of n leave a Beta(m + 1, n - m + 1) posterior; the probability that
    it exceeds t is that of at most m successes in n + 1 trials with chance t.
    """
    looks = []
    for n in range(STEP, BANDS * BAND + 1, STEP):
        above = 0.0
        for m in range(n + 1):
            above += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if above >= tolerance:
                looks.append((n, m))
                break
    return tuple(looks)


def likely(values: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether each pair of rows a, b of MinHash values outlasts all looks."""
    alive = np.arange(len(a))
    matches, before = np.zeros(len(a), dtype=np.int32), 0
    for n, fewest in least_matches(threshold):
        matches[alive] += (values[a[alive], before:n] == values[b[alive], before:n]).sum(1, dtype=np.int32)
        alive = alive[matches[alive] >= fewest]
        before = n
    kept = np.zeros(len(a), dtype=bool)
    kept[alive] = True
    return kept


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in text_slices(batches, "text"):
        sets = shingle_sets(texts, WORDS)
        digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
        values = [min_hashes(s).tobytes() if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(digests, pa.binary()), pa.array(values, pa.binary())],
            ["doc_id", "digest", "hashes"],
        )


def _values(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u4").reshape(-1, BANDS * BAND)


def _candidates(threshold: float):
    def compare(table: pa.Table, starts: np.ndarray):
        values = _values(table["hashes"])
        for a, b in pairs_of(table, starts):
            kept = likely(values, a, b, threshold)
            if kept.any():
                yield a[kept], b[kept]

    return compare


def _verify(threshold: float):
    def compare(table: pa.Table, starts: np.ndarray):
        values = _values(table["hashes"])
        sets = [np.frombuffer(s, dtype=np.uint64) for s in table["shingles"].to_pylist()]
        sizes = np.array([len(s) for s in sets])
        group_of = np.searchsorted(starts, np.arange(len(sets)), "right") - 1
        known = (-1,)
        for a, b in pairs_of(table, starts):
            # A set of less than the threshold's share of the other's size cannot be similar.
            near = np.minimum(sizes[a], sizes[b]) >= threshold * np.maximum(sizes[a], sizes[b])
            a, b = a[near], b[near]
            kept = likely(values, a, b, threshold)
            a, b = a[kept], b[kept]
            linked_pairs = np.zeros(len(a), dtype=bool)
            for row in np.unique(a):
                own = np.flatnonzero(a == row) if len(a) < 64 else np.arange(*np.searchsorted(a, [row, row + 1]))
                group = group_of[row]
                if known[0] != group:
                    members = sets[starts[group] : starts[group + 1]]
                    shingles, number = np.unique(np.concatenate(members), return_inverse=True)
                    known = (group, number, np.cumsum([0] + [len(m) for m in members]), len(shingles))
                _, number, bounds, distinct = known
                first = starts[group]
                mark = np.zeros(distinct + 1, dtype=np.int64)
                mark[number[bounds[row - first] : bounds[row - first + 1]]] = 1
                shared = np.array(
                    [mark[number[bounds[j - first] : bounds[j - first + 1]]].sum() for j in b[own]]
                )
                joined = sizes[row] + sizes[b[own]] - shared
                linked_pairs[own] = shared >= threshold * joined
            if linked_pairs.any():
                yield a[linked_pairs], b[linked_pairs]

    return compare


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in text_slices(batches, "text"):
        sets = shingle_sets(texts, WORDS)
        digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
        right = np.array([d == e for d, e in zip(digests, batch.column("digest").to_pylist())], dtype=bool)
        part = batch.filter(pa.array(right))
        yield pa.RecordBatch.from_arrays(
            [
                part.column("node"),
                part.column("component"),
                part.column("hashes"),
                pa.array([s.tobytes() for s, ok in zip(sets, right) if ok], pa.binary()),
            ],
            ["node", "component", "hashes", "shingles"],
        )


def similarity_classes(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, ``class_id``, ``n_links`` and ``kept``.

    Texts are lower-cased and cut into words; two documents link if the Jaccard similarity of
    their sets of five-word shingles reaches the threshold. A text of one to four words is one shingle. n_links counts
    the linked rows besides the row itself, copies included; class_id is the smallest doc_id reachable by
    links and kept marks its rows. A null text, or one
    without a word, links with nothing: class_id is its doc_id, and it is kept. A row with null doc_id takes part in no
    comparison; its class_id is null, and it is kept.
    """
    rows = documents.select("doc_id", "text")
    profiles = checkpointed(rows.mapInArrow(_profiles, "doc_id long, digest binary, hashes binary"))
    able = F.col("digest").isNotNull() & F.col("doc_id").isNotNull()
    nodes = checkpointed(
        profiles.filter(able)
        .groupBy("digest")
        .agg(F.min("doc_id").alias("first_id"), F.count("*").alias("weight"), F.first("hashes").alias("hashes"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.xxhash64(i, F.expr("hashes").substr(i * (4 * BAND) + 1, F.lit(4 * BAND))),
    )
    members = blocks(nodes.select("node", F.explode(bands).alias("key")), VALUE_BLOCK)
    # Candidates that outlast all looks, as a forest for each group; its components hold every likely pair.
    likely_pairs = in_groups(members.join(nodes.select("node", "hashes"), "node")).mapInArrow(
        linked(_candidates(threshold), weighted=False), LINKED
    )
    candidate = connected_components(likely_pairs.select(F.col("node").alias("a"), F.col("root").alias("b")))
    candidate = checkpointed(candidate.join(nodes.drop("weight"), "node"))
    # Only the texts of candidates are cut into shingles again.
    texts = rows.join(candidate.withColumnRenamed("first_id", "doc_id"), "doc_id")
    sets = checkpointed(
        texts.select("text", "digest", "node", "component", "hashes")
        .mapInArrow(_sets, "node long, component long, hashes binary, shingles binary")
        .dropDuplicates(["node"])
    )
    groups = blocks(sets.select(F.col("component").alias("key"), "node"), SET_BLOCK)
    compared = in_groups(
        groups.join(sets.drop("component"), "node").join(nodes.select("node", "weight"), "node")
    ).mapInArrow(linked(_verify(threshold)), LINKED)
    found = checkpointed(compared)
    component = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    smallest = (
        nodes.select("node", "first_id").join(component, "node").groupBy("component").agg(F.min("first_id").alias("class_id"))
    )
    known = (
        nodes.join(links, "node", "left")
        .join(component.join(smallest, "component"), "node", "left")
        .select(
            "digest",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("class_id", "first_id").alias("class_id"),
        )
    )
    joined = profiles.filter(able).drop("hashes").join(known, "digest").select("doc_id", "class_id", "n_links")
    others = profiles.filter(~able).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    kept = F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True))
    return joined.unionByName(others).withColumn("kept", kept)
