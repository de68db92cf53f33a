"""A Merkle manifest of a dataset, built and proved by time-forward processing.

Rows are the leaves of one binary tree per group; the roots of these trees are the leaves of the tree above. A
node is labelled by the last leaf below it and its level, so every label comes after those of its children. Nodes
are visited in the order of labels, and a node's digest is sent forward in time to its parent through a priority
queue. The queue is external: leaves are sorted by Spark in blocks that lie in any task, a
task keeps only the messages to nodes of its block, at most one for each level, and the digest of a block's
top is a row of the next round, sorted again. A reversed sweep then sends every node the digests beside its way to the
root, from the tops down to the leaves.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import partial
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm._tables import checkpointed
from tidemark.operators.numbering import dense_ids

#: Levels of a block, which has 4096 nodes at its bottom.
LEVELS = 12
#: Tops of blocks that a task hands on at once.
TOPS_AT_ONCE = 4096
#: What a step of a proof begins with: the side of the other digest, or none beside it.
LEFT, RIGHT, ALONE = "<", ">", "="

_NODE = ["tree", "n", "pos", "digest"]


def digest_of(*values: Column) -> Column:
    """Hex SHA-256 of values, each as its length in bytes, a colon and its text, or as - if null."""
    texts = [value.cast("string") for value in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def manifest(rows: DataFrame, leaf: str, group: str, order: list[str], levels: int = LEVELS) -> DataFrame:
    """The rows with their group's ``subroot``, the ``root`` of all, and ``proof``, the steps from leaf to root.

    leaf: a column with the hex digest of the row. Leaves of a group, null being a group too, stand in the order of
    ``order``, nulls first, rows equal there in the order of their digests; groups stand in the order of
    their value, null first. Every two nodes in a row become the digest of both, a last single one the digest of itself,
    until one is left. A row's columns of these three names are replaced. Without rows there is no root.

    Equal rows are leaves of their own; which of them comes first does not matter to any digest. Proofs are as long
    as the tree is high. Select the columns to carry before: all of them are shuffled. levels: height of the blocks
    that one task works on at a time.
    """
    added = ("subroot", "root", "proof")
    kept = [name for name in rows.columns if name not in added]
    picked = rows.select(
        F.struct(*[F.col(f"`{name}`") for name in kept]).alias("row"),
        F.col(group).alias("tree_key"),
        F.struct(*order).alias("place"),
        F.col(leaf).alias("digest"),
        # Equal rows are parted by it, so that no task has to take them all.
        F.monotonically_increasing_id().alias("spread"),
    )
    placed = dense_ids(picked, "tree_key", "place", "digest", "spread", name="number")
    trees = placed.groupBy("tree_key").agg(F.min("number").alias("tree"), F.count("*").alias("n"))
    trees = checkpointed(trees)
    same = F.col("p.tree_key").eqNullSafe(F.col("t.tree_key"))
    nodes = placed.alias("p").join(trees.alias("t"), same).select(
        "tree", "n", (F.col("number") - F.col("tree")).alias("pos"), "digest", "row"
    )
    nodes = checkpointed(nodes)
    rounds = [nodes, *_rounds(nodes, levels)]
    subroots = rounds[-1].select("tree", F.col("digest").alias("subroot"))
    tops = dense_ids(subroots, "tree", name="number").select(
        F.lit(0).cast("long").alias("tree"),
        F.lit(trees.count()).cast("long").alias("n"),
        (F.col("number") - 1).alias("pos"),
        F.col("subroot").alias("digest"),
        F.struct(F.col("tree").alias("subtree")).alias("row"),
    )
    tops = checkpointed(tops)
    above = [tops, *_rounds(tops, levels)]
    root = above[-1].select("digest").first()
    start = above[-1].select("tree", "pos", F.array().cast("array<string>").alias("proof"))
    # From the root to the subroots, then from each of these to its leaves.
    suffixes = _reversed(above, start, levels).select(
        F.col("row.subtree").alias("tree"), F.lit(0).cast("long").alias("pos"), "proof"
    )
    proved = _reversed(rounds, suffixes, levels)
    return proved.join(subroots, "tree").select(
        *[F.col("row").getField(name).alias(name) for name in kept],
        "subroot",
        F.lit(root[0] if root else None).cast("string").alias("root"),
        "proof",
    )


def proof_digest(proof: Column | str) -> Column:
    """Hex SHA-256 of the digests of a proof, from leaf to root."""
    proof = F.col(proof) if isinstance(proof, str) else proof
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.substring(step, 2, 64)), "").cast("binary"), 256)


def folded(leaf: Column, proof: Column | str) -> Column:
    """The root that a leaf and its proof lead to."""
    proof = F.col(proof) if isinstance(proof, str) else proof

    def up(digest: Column, step: Column) -> Column:
        side, other = F.substring(step, 1, 1), F.substring(step, 2, 64)
        pair = F.when(side == LEFT, F.concat(other, digest)).otherwise(F.concat(digest, other))
        return F.sha2(pair.cast("binary"), 256)

    return F.aggregate(proof, leaf, up)


def _rounds(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The tops of blocks, the tops of blocks of these and so on, until each tree is one node."""
    found = [nodes]
    while len(found) == 1 or largest > 1:
        bottom = found[-1].select(*_NODE)
        tops = checkpointed(
            _in_blocks(bottom, levels).mapInArrow(
                partial(_sweep, levels=levels), "tree long, n long, pos long, digest string"
            )
        )
        found.append(tops)
        largest = tops.agg(F.max("n")).first()[0] or 0
    return found[1:]


def _reversed(rounds: list[DataFrame], proofs: DataFrame, levels: int) -> DataFrame:
    """Rows of the first round with the steps from each to the root; proofs: those of the tops."""
    for below in reversed(rounds[:-1]):
        carried = below if "row" in below.columns else below.withColumn("row", F.struct(F.lit(0).alias("none")))
        none = F.lit(None)
        messages = proofs.select(
            "tree",
            none.cast("long").alias("n"),
            F.shiftleft("pos", levels).alias("pos"),
            none.cast("string").alias("digest"),
            none.cast(carried.schema["row"].dataType).alias("row"),
            "proof",
        )
        sent = carried.select(*_NODE, "row", none.cast("array<string>").alias("proof")).unionByName(messages)
        row_type = carried.schema["row"].dataType
        schema = T.StructType(
            [
                T.StructField("tree", T.LongType()),
                T.StructField("pos", T.LongType()),
                T.StructField("row", row_type),
                T.StructField("proof", T.ArrayType(T.StringType())),
            ]
        )
        # The message to the top of a block comes before its nodes.
        sent = _in_blocks(sent, levels, F.col("proof").isNull())
        proofs = sent.mapInArrow(partial(_sweep_back, levels=levels), schema)
    return proofs


def _in_blocks(nodes: DataFrame, levels: int, *before: Column) -> DataFrame:
    """Nodes of a block in one task, in the order of labels."""
    block = F.shiftright("pos", levels)
    return nodes.repartition("tree", block).sortWithinPartitions("tree", block, *before, "pos")


def _blocks(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[pa.Table]:
    """The rows of one block after the other."""
    held, key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        trees, places = batch.column("tree").to_pylist(), batch.column("pos").to_pylist()
        start = 0
        for i in range(batch.num_rows + 1):
            at = (trees[i], places[i] >> levels) if i < batch.num_rows else None
            if at == key:
                continue
            if i > start:
                held.append(batch.slice(start, i - start))
            if at is not None:
                if held:
                    yield pa.Table.from_batches(held)
                held, start, key = [], i, at
            else:
                start = i
    if held:
        yield pa.Table.from_batches(held)


def _label(level: int, index: int, leaves: int) -> tuple[int, int]:
    """The last of a block's leaves below a node, and its level."""
    return min((index + 1) << level, leaves) - 1, level


def _height(n: int, levels: int) -> int:
    """The level of a block's top in a tree of n nodes."""
    return min((n - 1).bit_length(), levels)


def forward(leaves: list[str], height: int) -> dict[tuple[int, int], str]:
    """Digests of all nodes of a block by level and index, each visited when its label is due."""
    digests: dict[tuple[int, int], str] = {}
    queue: list[tuple[tuple[int, int], int, str]] = []

    def send(level: int, index: int, digest: str) -> None:
        digests[level, index] = digest
        if level < height:
            heapq.heappush(queue, (_label(level + 1, index >> 1, len(leaves)), index, digest))

    for place, leaf in enumerate(leaves):
        send(0, place, leaf)
        while queue and queue[0][0][0] == place:
            (_, level), index, digest = heapq.heappop(queue)
            if queue and queue[0][0] == (place, level) and queue[0][1] >> 1 == index >> 1:
                digest += heapq.heappop(queue)[2]
            send(level, index >> 1, sha256(digest.encode()).hexdigest())
    return digests


def backward(digests: dict[tuple[int, int], str], leaves: int, height: int, proof: list[str]) -> list[list[str]]:
    """The steps from each leaf of a block to the root; proof: those from its top."""
    steps: list[list[str]] = [proof] * leaves
    last, level = _label(height, 0, leaves)
    queue = [((-last, -level), 0, proof)]
    while queue:
        (_, level), index, proof = heapq.heappop(queue)
        level = -level
        if level == 0:
            steps[index] = proof
            continue
        left, right = 2 * index, 2 * index + 1
        beside = digests.get((level - 1, right))
        own = [ALONE if beside is None else RIGHT + beside, *proof]
        children = [(left, own)]
        if beside is not None:
            children.append((right, [LEFT + digests[level - 1, left], *proof]))
        for child, message in children:
            last, _ = _label(level - 1, child, leaves)
            heapq.heappush(queue, ((-last, 1 - level), child, message))
    return steps


def _sweep(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[pa.RecordBatch]:
    tops = []
    for block in _blocks(batches, levels):
        n, leaves = block["n"][0].as_py(), block["digest"].to_pylist()
        height = _height(n, levels)
        place = block["pos"][0].as_py() >> levels
        tops.append((block["tree"][0].as_py(), -(-n >> levels), place, forward(leaves, height)[height, 0]))
        if len(tops) == TOPS_AT_ONCE:
            yield _tops(tops)
            tops = []
    yield _tops(tops)


def _tops(tops: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    columns = [pa.array([top[i] for top in tops], kind) for i, kind in enumerate(types)]
    return pa.RecordBatch.from_arrays(columns, names=_NODE)


def _sweep_back(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[pa.RecordBatch]:
    for block in _blocks(batches, levels):
        proof = block["proof"][0].as_py()
        nodes = block.slice(1)
        height, leaves = _height(nodes["n"][0].as_py(), levels), nodes["digest"].to_pylist()
        steps = backward(forward(leaves, height), len(leaves), height, proof)
        out = pa.table(
            {
                "tree": nodes["tree"],
                "pos": nodes["pos"],
                "row": nodes["row"],
                "proof": pa.array(steps, pa.list_(pa.string())),
            }
        )
        yield from out.combine_chunks().to_batches()
