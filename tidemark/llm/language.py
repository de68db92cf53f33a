"""Language of documents by hyperdimensional profiles.

Every letter has a random vector of signs. An n-gram binds the vectors of its letters, each permuted by
its place, by multiplying them; a document bundles its n-grams by adding them. Documents of a
known language bundle to its prototype, and a new document gets the language whose prototype has the
largest cosine with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm._text import code_points, letter_table, lower_table, text_slices, with_columns

DIMENSIONS = 1024
#: Letters share this many vectors: a to z have their own, all others theirs by code point.
LETTERS = 256
GRAM = 3
SEED = 20240102
#: Texts bundled in one matrix product.
TOGETHER = 48
UNDETERMINED = "und"


def letter_vectors() -> np.ndarray:
    return np.random.default_rng(SEED).choice(np.array([-1, 1], dtype=np.int8), (LETTERS, DIMENSIONS))


def gram_vectors(grams: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Vectors of n-grams given as numbers in base LETTERS: permute by place, then bind."""
    bound = np.ones((len(grams), DIMENSIONS), dtype=np.int8)
    for place in range(GRAM):
        # The last letter stands as it is, the one before it is rotated once, and so on.
        bound *= np.roll(letters, place, axis=1)[grams // LETTERS**place % LETTERS]
    return bound


def text_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-grams of all texts, the text of each, and whether each text has a letter.

    Runs of other characters count as one blank, which also stands before and after a text.
    """
    codes, bounds = code_points(texts)
    low = lower_table()[codes].astype(np.int64)
    letter = letter_table()[codes]
    symbol = np.where(letter, np.where(low < 128, low - 96, 27 + low % (LETTERS - 27)), 0)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    kept = letter | np.concatenate([[True], letter[:-1]])
    symbol, owner = np.concatenate([[0], symbol[kept]]), np.concatenate([[0], owner[kept]])
    grams = np.zeros(max(0, len(symbol) - GRAM + 1), dtype=np.int64)
    for k in range(GRAM):
        grams = grams * LETTERS + symbol[k : k + len(grams)]
    # A gram belongs to the text of its middle; those that join two texts or hold no two letters say little.
    owner = owner[1 : 1 + len(grams)]
    inside = grams // LETTERS % LETTERS != 0
    return grams[inside], owner[inside], np.bincount(owner, weights=inside, minlength=len(texts)) > 0


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-gram counts by language of one task; handed on whenever many have gathered."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def handed():
        for lang, (grams, times) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.int64()), pa.array(times, pa.int64())],
                ["lang", "gram", "n"],
            )
        held.clear()

    for batch, texts in text_slices(batches, "text"):
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        grams, owner, _ = text_grams(texts)
        for lang in set(langs):
            new = np.unique(grams[(langs == lang)[owner]], return_counts=True)
            if lang in held:
                both, place = np.unique(np.concatenate([held[lang][0], new[0]]), return_inverse=True)
                new = both, np.bincount(place, weights=np.concatenate([held[lang][1], new[1]])).astype(np.int64)
            held[lang] = new
        if sum(len(g) for g, _ in held.values()) > 1_000_000:
            yield from handed()
    yield from handed()


@dataclass
class LanguageModel:
    languages: list[str]
    #: One row of unit length for each language.
    prototypes: np.ndarray
    mean: np.ndarray


def _bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letters, sums = letter_vectors(), {}
    for batch in batches:
        grams, times = batch.column("gram").to_numpy(), batch.column("n").to_numpy().astype(np.float64)
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for lang in set(langs):
            own = np.flatnonzero(langs == lang)
            for at in range(0, len(own), 4096):
                part = own[at : at + 4096]
                total = times[part] @ gram_vectors(grams[part], letters).astype(np.float64)
                sums[lang] = sums.get(lang, 0) + total
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.string()), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.float64()))],
        ["lang", "bundle"],
    )


def train(labelled: DataFrame) -> LanguageModel:
    """Prototypes from text and lang of all given rows; rows without lang teach nothing.

    Only one bundle for each language and task reaches the driver.
    """
    counted = (
        labelled.select("text", F.col("lang").cast("string").alias("lang"))
        .filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
        .mapInArrow(_counts, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    sums: dict[str, np.ndarray] = {}
    for row in counted.mapInArrow(_bundles, "lang string, bundle array<double>").collect():
        sums[row.lang] = sums.get(row.lang, 0) + np.array(row.bundle)
    languages = sorted(sums)
    unit = np.array([sums[x] / max(1.0, np.linalg.norm(sums[x])) for x in languages]).reshape(-1, DIMENSIONS)
    # What all languages share says nothing of any; it is taken off before directions are compared.
    mean = unit.mean(0) if len(languages) > 1 else np.zeros(DIMENSIONS)
    centred = unit - mean
    norms = np.linalg.norm(centred, axis=1, keepdims=True)
    return LanguageModel(languages, (centred / np.where(norms > 0, norms, 1)).astype(np.float32), mean.astype(np.float32))


def predict(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """Every row with ``lang_pred`` and ``score``.

    The score is the winning cosine brought to 0 to 1. A null text, or one without a letter, is
    ``und`` with score 0, as is every text if no language was learned. Ties go to the language
    that sorts first. Columns of these names are replaced, all others stay.
    """
    schema = T.StructType(
        [f for f in documents.schema.fields if f.name not in ("lang_pred", "score")]
        + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    shared = documents.sparkSession.sparkContext.broadcast(model)  # bounded: DIMENSIONS numbers a language

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, letters = shared.value, letter_vectors()
        for batch, texts in text_slices(batches, "text"):
            langs, scores = [], []
            for at in range(0, len(texts), TOGETHER):
                part = texts[at : at + TOGETHER]
                grams, owner, lettered = text_grams(part)
                seen, place = np.unique(grams, return_inverse=True)
                counts = np.bincount(owner * len(seen) + place, minlength=len(part) * len(seen))
                counts = counts.reshape(len(part), len(seen)).astype(np.float32)
                bundle = np.zeros((len(part), DIMENSIONS), dtype=np.float32)
                for k in range(0, len(seen), 4096):
                    bundle += counts[:, k : k + 4096] @ gram_vectors(seen[k : k + 4096], letters).astype(np.float32)
                bundle /= np.maximum(1, np.linalg.norm(bundle, axis=1, keepdims=True))
                bundle -= model.mean
                bundle /= np.maximum(1e-9, np.linalg.norm(bundle, axis=1, keepdims=True))
                cosines = bundle @ model.prototypes.T
                for row, known in zip(cosines, lettered):
                    best = int(row.argmax()) if known and len(row) else -1
                    langs.append(model.languages[best] if best >= 0 else UNDETERMINED)
                    scores.append(float(min(1.0, max(0.0, (1 + row[best]) / 2))) if best >= 0 else 0.0)
            yield with_columns(batch, {"lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores, pa.float64())})

    return documents.mapInArrow(predicted, schema)
