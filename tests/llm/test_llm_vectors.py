"""Neighbour search and vector deduplication against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from comparison import TESTDATA, assert_same
from tidemark.llm import _pairs, embedding_dedup, nearest
from tidemark.llm.queries import op4_nearest, op6_embedding_dedup
from tidemark.llm.sql import ORACLE_SQL

SCHEMA = "vec_id long, embedding array<float>, label int, extra string, node string"
NAN, INF = float("nan"), float("inf")
UNUSABLE = [None, [], [0.0, 0.0], [1.0, None], [NAN, 1.0], [INF, 0.0]]


def brute_neighbours(rows, k):
    found = {}
    good = [(i, np.array(v, dtype=np.float64)) for i, v in rows]
    for q, x in good:
        if q % 20 == 0:
            others = [(-float((v * x).sum()), i) for i, v in good if i != q and len(v) == len(x)]
            found[q] = [(i, -s) for s, i in sorted(others)[:k]]
    return found


def test_search_finds_the_nearest(spark):
    folder = str(TESTDATA / "sf0.01")
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    expected, hits = brute_neighbours(rows, 20), 0
    found = {}
    for r in sorted(op4_nearest(spark, folder).collect(), key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(found) == set(expected)
    for q, neighbours in found.items():
        assert len(neighbours) == 20
        hits += len({i for i, _ in neighbours} & {i for i, _ in expected[q]})
    assert hits / (20 * len(expected)) >= 0.9


def test_search_by_blocks_with_varied_lengths(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK_ROWS", 100)
    monkeypatch.setattr(nearest, "QUERY_ROWS", 7)
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=16) * rng.uniform(0.1, 3)).astype(np.float32).tolist()) for i in range(500)]
    df = spark.createDataFrame([(i, v, 0, "", "") for i, v in rows], SCHEMA)
    expected, hits = brute_neighbours(rows, 10), 0
    for r in nearest.nearest(df, F.col("vec_id") % 20 == 0, 10).collect():
        wanted = dict(expected[r.query_id])
        hits += r.vec_id in wanted
        if r.vec_id in wanted:
            assert r.score == pytest.approx(wanted[r.vec_id], abs=1e-12)
    assert hits / sum(map(len, expected.values())) >= 0.9


def test_search_of_odd_vectors(spark):
    rows = [(20 + i, v, 0, "", "") for i, v in enumerate(UNUSABLE)]
    # Equal vectors tie to the smaller id; a vector of other length is no candidate; no id, no part.
    rows += [(40, [1.0, 0.0], 0, "", ""), (43, [1.0, 1.0], 0, "", ""), (42, [1.0, 1.0], None, "", ""), (41, [0.5, 9.0], 0, "", "")]
    rows += [(60, [1.0, 2.0, 3.0], 0, "", ""), (None, [1.0, 0.0], 0, "", ""), (43, [1.0, 1.0], 0, "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    found = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in nearest.nearest(df, F.col("vec_id") % 20 == 0, 3).collect())
    assert found == [(40, 1, 42, 1.0), (40, 2, 43, 1.0), (40, 3, 43, 1.0)]
    assert nearest.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("copies", [2, 25])
def test_search_with_repeated_query_rows(spark, copies):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(101, 16))
    vectors = (vectors / np.linalg.norm(vectors, axis=1)[:, None]).astype(np.float32).tolist()
    rows = [(20 if i == 0 else 1000 + 20 * i + 1, v) for i, v in enumerate(vectors)]
    df = spark.createDataFrame([(i, v, 0, "", "") for i, v in rows + [rows[0]] * (copies - 1)], SCHEMA)
    found = sorted((r["rank"], r.vec_id) for r in nearest.nearest(df, F.col("vec_id") == 20).collect())
    assert found == [(n + 1, i) for n, (i, _) in enumerate(brute_neighbours(rows, 20)[20])]


def test_search_with_two_vectors_of_one_query_id(spark):
    rng = np.random.default_rng(6)
    rows = [(20, v) for v in rng.normal(size=(2, 16)).astype(np.float32).tolist()]
    rows += [(1001 + 20 * i, v) for i, v in enumerate(rng.normal(size=(100, 16)).astype(np.float32).tolist())]
    df = spark.createDataFrame([(i, v, 0, "", "") for i, v in rows], SCHEMA)
    found = sorted((r["rank"], r.vec_id) for r in nearest.nearest(df, F.col("vec_id") == 20).collect())
    each = [brute_neighbours([query, *rows[2:]], 20)[20] for query in rows[:2]]
    assert found == sorted((n + 1, i) for one in each for n, (i, _) in enumerate(one))


def test_chi_square_quantile():
    # Two degrees of freedom have a closed form.
    assert nearest.chi_square_quantile(0.95, 2) == pytest.approx(-2 * np.log(0.05))


def brute_links(rows, threshold=0.93):
    ids = [r[0] for r in rows]
    linked = {n: set() for n in range(len(rows))}
    for a in range(len(rows)):
        for b in range(a):
            (_, x, m), (_, y, n) = rows[a][:3], rows[b][:3]
            if m is None or m != n or len(x) != len(y):
                continue
            x, y = np.array(x), np.array(y)
            if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                linked[a].add(b)
                linked[b].add(a)
    smallest = {n: ids[n] for n in linked}
    moved = True
    while moved:
        moved = False
        for a, partners in linked.items():
            low = min([smallest[a], *(smallest[b] for b in partners)])
            moved |= low < smallest[a]
            smallest[a] = low
    return sorted((ids[n], len(linked[n]), smallest[n], ids[n] == smallest[n]) for n in linked)


@pytest.mark.parametrize("block", [256, 6])
def test_dedup_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rng = np.random.default_rng(3)
    rows = []
    for group in range(6):
        centre = rng.normal(size=16)
        for _ in range(30):
            v = centre + rng.normal(size=16) * rng.choice([0.02, 0.2, 0.35])
            rows.append((len(rows), v.astype(np.float32).tolist(), group % 3))
    rows += [(1000, rows[0][1], rows[0][2]), (1001, rows[0][1], None), (1002, rows[0][1], 7)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    found = sorted(tuple(r) for r in embedding_dedup.near_duplicates(df).collect())
    assert found == brute_links(rows)


def test_dedup_of_odd_vectors(spark):
    rows = [(i, v, 1, "", "") for i, v in enumerate(UNUSABLE)]
    rows += [(30, [1.0, 0.0], 1, "", ""), (30, [1.0, 0.0], 1, "", ""), (None, [1.0, 0.01], 1, "", ""), (None, None, 1, "", ""), (31, [1.0, 0.0, 0.0], 1, "", "")]
    found = sorted((tuple(r) for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    expected = [(i, 0, i, True) for i in range(6)] + [(30, 2, 30, True)] * 2 + [(None, 2, 30, False), (None, 0, None, False), (31, 0, 31, True)]
    assert found == sorted(expected, key=str)
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_dedup_equals_sql(spark, scale):
    folder = TESTDATA / scale
    assert assert_same(op6_embedding_dedup(spark, str(folder)), folder, ORACLE_SQL["op6_embedding_dedup"]) > 0


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 90)], [(i * i % 71, i * 7 % 71) for i in range(60)]])
def test_components(spark, edges):
    parent = {x: x for e in edges for x in e if e[0] != e[1]}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    found = _pairs.connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in found.collect()} == {x: root(x) for x in parent}
