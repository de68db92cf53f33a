"""Quality of documents from supervised subword embeddings.

Words, pairs of neighbouring words and character n-grams are hashed to rows of a table of learned
vectors. A document is the average of its rows, a softmax over the average gives the class, and
both tables are fitted by stochastic gradient descent in numpy on a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm._text import (
    GRAM_BASE,
    code_points,
    letter_table,
    lower_table,
    mixed,
    text_slices,
    with_columns,
    word_hashes,
)

BUCKET_BITS = 15
DIMENSIONS = 16
GRAMS = (3, 4)
EPOCHS = 12
RATE = 0.5
THRESHOLD = 0.3
SEED = 20240101


def _buckets(h: np.ndarray, kind: int) -> np.ndarray:
    return (mixed(h ^ np.uint64(kind * 0x632BE59BD9B4E019 & (1 << 64) - 1)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def hashed_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of the features of all texts, and the first feature of each text and the end.

    The pair of a word and its neighbour is hashed by the exclusive or of the two, so all doubled words
    share one row. Character n-grams run over the text as written, white space included.
    """
    codes, bounds = code_points(texts)
    n = len(codes)
    # Digits are alike; letters keep their case, for shouting is a mark of quality.
    symbols = np.where((codes >= 48) & (codes <= 57), 48, codes).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    found, owners = [], []
    for size in GRAMS:
        if n < size:
            continue
        rolled = np.zeros(n - size + 1, dtype=np.uint64)
        for k in range(size):
            rolled = rolled * GRAM_BASE + symbols[k : n - size + 1 + k]
        inside = owner[: n - size + 1] == owner[size - 1 :]
        found.append(_buckets(rolled[inside], size))
        owners.append(owner[: n - size + 1][inside])
    hashes, first = word_hashes(texts)
    word_owner = np.repeat(np.arange(len(texts)), np.diff(first))
    found.append(_buckets(hashes, 1))
    owners.append(word_owner)
    if len(hashes) > 1:
        together = word_owner[1:] == word_owner[:-1]
        found.append(_buckets((hashes[1:] ^ hashes[:-1])[together], 2))
        owners.append(word_owner[1:][together])
    # The shape of the text as a whole: its share of capitals and of symbols, in tenths.
    letters = letter_table()[codes]
    capital = letters & (lower_table()[codes] != codes)
    for kind, mask in ((7, capital), (8, ~letters & (codes > 32))):
        share = np.add.reduceat(mask, bounds[:-1]) / np.maximum(1, np.diff(bounds) - 1)
        found.append(_buckets(np.minimum(9, share * 10).astype(np.uint64), kind))
        owners.append(np.arange(len(texts)))
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return np.concatenate(found)[order], np.searchsorted(owners[order], np.arange(len(texts) + 1))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in text_slices(batches, "text"):
        rows, first = hashed_features(texts)
        ids, counts = [], []
        for i in range(len(texts)):
            bag, times = np.unique(rows[first[i] : first[i + 1]], return_counts=True)
            ids.append(bag.astype(np.uint16).tobytes())
            counts.append(times.astype(np.uint16 if times.max(initial=0) < 65536 else np.uint32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.binary()), pa.array(counts, pa.binary()), batch.column("label").cast(pa.int32())],
            ["ids", "counts", "label"],
        )


@dataclass
class QualityModel:
    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray


def train(sample: DataFrame) -> QualityModel:
    """Fit both tables by gradient descent, one document at a time.

    sample: text and label (0 or 1) of a bounded number of documents, whose hashed features come to
    the driver. The same sample gives the same model. Without rows, every document scores one half.
    """
    rows = sample.mapInArrow(_bags, "ids binary, counts binary, label int").collect()
    rng = np.random.default_rng(SEED)
    vectors = rng.normal(0, 1 / DIMENSIONS, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32)
    output = np.zeros((DIMENSIONS, 2), dtype=np.float32)
    output[:, 1] = rng.normal(0, 0.1, DIMENSIONS)
    bias = np.zeros(2, dtype=np.float32)
    bags = []
    for r in sorted(rows, key=lambda r: (r.ids, r.counts, r.label)):
        ids = np.frombuffer(r.ids, np.uint16)
        times = np.frombuffer(r.counts, np.uint16 if len(r.counts) == len(r.ids) else np.uint32)
        share = (times / times.sum()).astype(np.float32) if len(times) else times.astype(np.float32)
        bags.append((ids.astype(np.int64), share, r.label))
    del rows
    if not bags:
        output[:] = 0
    steps = EPOCHS * max(1, len(bags))
    done = 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(bags)):
            ids, share, label = bags[i]
            rate = RATE * (1 - done / steps)
            done += 1
            mean = share @ vectors[ids]
            logits = mean @ output + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            back = output @ p
            output -= rate * np.outer(mean, p)
            bias -= rate * 0.1 * p
            # Averaging makes each row's gradient small; its rate is scaled by the usual bag size.
            vectors[ids] -= np.outer(share * (rate * 20), back)
    return QualityModel(vectors, output, bias)


def score(documents: DataFrame, model: QualityModel) -> DataFrame:
    """Every row with ``score``: the probability of label 1, from 0 to 1.

    The softmax of an average of vectors is linear up to the exponential, so each table row is reduced
    to its pull towards label 1 once and a document averages those. Null reads as an empty text, of
    which the model sees its shape only. A column named ``score`` is replaced, all others stay.
    """
    pull = (model.vectors.astype(np.float64) @ (model.output[:, 1] - model.output[:, 0])).astype(np.float32)
    shared = documents.sparkSession.sparkContext.broadcast((pull, float(model.bias[1] - model.bias[0])))
    schema = T.StructType(
        [f for f in documents.schema.fields if f.name != "score"] + [T.StructField("score", T.DoubleType())]
    )

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pull, bias = shared.value
        for batch, texts in text_slices(batches, "text"):
            rows, first = hashed_features(texts)
            sums = np.concatenate([[0.0], np.cumsum(pull[rows], dtype=np.float64)])
            logit = (sums[first[1:]] - sums[first[:-1]]) / np.maximum(1, np.diff(first)) + bias
            yield with_columns(batch, {"score": pa.array(1 / (1 + np.exp(-np.clip(logit, -30, 30))), pa.float64())})

    return documents.mapInArrow(scored, schema)
