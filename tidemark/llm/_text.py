"""Texts as numpy arrays: code points, words and rolling hashes of a slice of documents.

Everything here runs inside a task on one bounded slice of a record batch.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Characters of one slice, a single longer text excepted.
SLICE_CHARS = 1 << 19
#: Tables of character properties hold every code point, rare letters beyond U+1FFFF too.
TABLE_END = sys.maxunicode + 1
WORD_BASE = np.uint64(0x9E3779B97F4A7C15)
GRAM_BASE = np.uint64(0xC2B2AE3D27D4EB4F)


def text_slices(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Record batches cut to about SLICE_CHARS of text, with their texts; null reads as empty."""
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        start = 0
        while start < batch.num_rows:
            texts, chars = [], 0
            while start + len(texts) < batch.num_rows and chars < SLICE_CHARS:
                texts.append(values[start + len(texts)].as_py() or "")
                chars += len(texts[-1])
            yield batch.slice(start, len(texts)), texts
            start += len(texts)


def with_columns(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch with columns added; a column of the same name is replaced."""
    kept = [i for i, name in enumerate(batch.schema.names) if name not in columns]
    arrays = [batch.column(i) for i in kept] + list(columns.values())
    return pa.RecordBatch.from_arrays(arrays, names=[batch.schema.names[i] for i in kept] + list(columns))


@lru_cache(maxsize=1)
def lower_table() -> np.ndarray:
    """Lower-case code point of each code point, itself where lower case takes more than one."""
    table = np.arange(TABLE_END, dtype=np.uint32)
    for code in range(TABLE_END):
        low = chr(code).lower()
        if len(low) == 1:
            table[code] = ord(low)
    return table


@lru_cache(maxsize=1)
def word_table() -> np.ndarray:
    """Whether a code point belongs to a word: letters, digits and marks that stand within words."""
    return np.array([chr(c).isalnum() or unicodedata.category(chr(c)) in ("Mn", "Mc") for c in range(TABLE_END)])


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(TABLE_END)])


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts one after the other, each followed by a zero, and the first place of each and the end."""
    joined = "\0".join(texts) + "\0"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    bounds = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=bounds[1:])
    return codes, bounds


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of WORD_BASE and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, SLICE_CHARS + (SLICE_CHARS >> 2))
        inverse = np.uint64(pow(int(WORD_BASE), -1, 1 << 64))
        _POWERS[:] = [
            np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)]))
            for base in (WORD_BASE, inverse)
        ]
    return _POWERS[0][:n], _POWERS[1][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every lower-cased word, and the first word of each text and the end."""
    codes, bounds = code_points(texts)
    inside = np.concatenate([[False], word_table()[codes]])
    change = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = change[0::2], change[1::2]
    forward, backward = _powers(len(codes))
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum((lower_table()[codes].astype(np.uint64) + np.uint64(1)) * forward, out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * backward[starts])
    return hashes, np.searchsorted(starts, bounds)


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """The sorted distinct hashes of all runs of so many words; a shorter text is one run, an empty one none."""
    hashes, first = word_hashes(texts)
    runs = max(0, len(hashes) - words + 1)
    rolled = np.zeros(runs, dtype=np.uint64)
    for k in range(words):
        rolled = rolled * GRAM_BASE + hashes[k : k + runs]
    rolled = mixed(rolled)
    found = []
    for i in range(len(texts)):
        start, end = int(first[i]), int(first[i + 1])
        if end - start >= words:
            found.append(np.unique(rolled[start : end - words + 1]))
        else:
            short = np.zeros(1 if end > start else 0, dtype=np.uint64)
            for h in hashes[start:end]:
                short = short * GRAM_BASE + h
            found.append(mixed(short))
    return found
