"""Exact token counts at every prefix of a text, by dynamic programming over prefixes.

A byte-pair encoding splits a text into pieces and merges within each. For a piece, the last token of
every prefix follows from the last tokens of shorter ones: exactly one token ends the prefix and goes
together with the token before it. So one pass stores the number of tokens of each prefix, and
questions of truncation and budget are read from the stored counts without encoding again.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidemark.llm._text import text_slices, with_columns

# Fixed value: the published pattern by which byte-level encodings split a text.
PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# End of fixed value.

#: Pieces, twice so many, and token pairs remembered by a task.
KEPT_PIECES, KEPT_PAIRS = 300_000, 250_000
#: Texts of these characters alone are split here; the tokenizer itself splits the others, so that its
#: tables of letters and spaces hold.
_PLAIN = regex.compile(r"[\t\n\r -~¡-ɏ‐-‧€]*")
_RUNS = regex.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{2,}(?=[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000])")
_CONTRACTIONS = ("'re", "'ve", "'ll")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class PrefixCounter:
    """Token counts of prefixes for one vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        letters = byte_alphabet()
        as_bytes = lambda token: bytes(letters[c] for c in token)
        special = {t["content"] for t in spec["added_tokens"]}
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.tokens = {as_bytes(t) for t in spec["model"]["vocab"] if t not in special}
        self.longest = max(map(len, self.tokens))
        merges = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.ranks = {(as_bytes(a), as_bytes(b)): i for i, (a, b) in enumerate(merges)}
        self.parts: dict[bytes, tuple[bytes, bytes]] = {}
        for a, b in self.ranks:
            self.parts.setdefault(a + b, (a, b))
        self.right: dict[bytes, list] = {}
        self.left: dict[bytes, list] = {}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _spine(self, token: bytes, side: int) -> list[tuple[bytes, float]]:
        """The parts that lie at one end of a token while it is merged, and the rank at which each ends."""
        found, ends = [(token, float("inf"))], 0
        while token in self.parts:
            ends = self.ranks[self.parts[token]]
            token = self.parts[token][side]
            found.append((token, ends))
        return found

    def _apart(self, first: bytes, second: bytes) -> bool:
        """Whether no merge crosses from one token into the next, so that both stand in an encoding.

        Parts a and b at the boundary merge if their rank comes before the merges that take either
        up; of equal ranks the left one comes first.
        """
        rank = self.ranks.get
        ahead = self.left.get(second) or self.left.setdefault(second, self._spine(second, 0))
        for a, a_ends in self.right.get(first) or self.right.setdefault(first, self._spine(first, 1)):
            for b, b_ends in ahead:
                crossing = rank((a, b))
                if crossing is not None and crossing < a_ends and crossing <= b_ends:
                    return False
        return True

    def byte_prefixes(self, piece: bytes) -> list[int]:
        """Token counts of all byte prefixes of a piece, the empty one first.

        One token alone can end a prefix, so the order of trials is free: first the last token grown
        by a byte, then the byte on its own, then all others.
        """
        tokens, pairs, longest = self.tokens, self.pairs, self.longest
        last, starts, counts = [b""], [0], [0]
        for end in range(1, len(piece) + 1):
            grown = starts[-1]
            for start in chain((grown, end - 1), range(end - longest if end > longest else 0, end)):
                token = piece[start:end]
                if token in tokens:
                    if start:
                        pair = (last[start], token)
                        apart = pairs.get(pair)
                        if apart is None:
                            if len(pairs) >= KEPT_PAIRS:
                                pairs.clear()
                            apart = pairs[pair] = self._apart(*pair)
                        if not apart:
                            continue
                    last.append(token)
                    starts.append(start)
                    counts.append(counts[start] + 1)
                    break
            else:
                raise ValueError("the vocabulary does not hold every byte")
        return counts

    def _piece(self, piece: str) -> bytes:
        """Counts at the character prefixes of a piece, as 32-bit integers."""
        if len(self.pieces) >= KEPT_PIECES:
            # Pieces that are still used come back from the older half.
            self.older, self.pieces = self.pieces, {}
        known = self.older.get(piece)
        if known is not None:
            self.pieces[piece] = known
            return known
        data = piece.encode("utf-8", "surrogatepass")
        counts = self.byte_prefixes(data)
        if len(data) == len(piece):
            del counts[0]
            found = counts
        else:
            found, at = [], 0
            for char in piece:
                at += len(char.encode("utf-8", "surrogatepass"))
                found.append(counts[at])
        if piece in _CONTRACTIONS:
            # Cut short, the apostrophe and its letter are two pieces.
            found[1] = 2
        known = self.pieces[piece] = array("i", found).tobytes()
        return known

    def split(self, text: str) -> list[str]:
        if _PLAIN.fullmatch(text):
            return PIECES.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def _segment(self, text: str) -> np.ndarray:
        known, made = self.pieces.get, self._piece
        pieces = self.split(text)
        if not pieces:
            return np.zeros(0, dtype=np.int32)
        stored = [known(p) or made(p) for p in pieces]
        lengths = np.fromiter(map(len, stored), dtype=np.int64, count=len(stored)) >> 2
        counts = np.frombuffer(b"".join(stored), dtype="<i4")
        ends = np.cumsum(lengths)
        totals = counts[ends - 1]
        counts = counts + np.repeat(np.cumsum(totals) - totals, lengths).astype(np.int32)
        # The last character of white space before a word is split from it; a prefix that ends there
        # holds all of the white space as one piece.
        for run in _RUNS.finditer(text):
            start, blank = run.start(), run.group()
            before = int(counts[start - 1]) if start else 0
            counts[start : start + len(blank)] = before + np.frombuffer(known(blank) or made(blank), dtype="<i4")
        return counts

    def counts(self, text: str) -> np.ndarray:
        """Tokens of each prefix of 1, 2, ... characters.

        Special tokens inside the text are one token each, as is the default of the library; a
        prefix that ends within one counts its characters as ordinary text.
        """
        parts, base, at = [], 0, 0
        for m in self.special.finditer(text) if self.special else ():
            cut = base + self._segment(text[at : m.end() - 1])
            base = (int(cut[m.start() - at - 1]) if m.start() > at else base) + 1
            parts += [cut, np.array([base])]
            at = m.end()
        parts.append(base + self._segment(text[at:]))
        return np.concatenate(parts).astype(np.int32)


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def count_tokens(documents: DataFrame, vocabulary: str, limit: int, store: bool = False) -> DataFrame:
    """Every row with ``n_bytes``, ``n_tokens``, ``over_limit`` and ``fitting_chars``.

    n_bytes counts UTF-8; n_tokens is what the library gives for the whole text without added special
    tokens; fitting_chars is the length in characters of the longest prefix of at most ``limit``
    tokens. With ``store`` the counts of all prefixes are kept as ``prefix_tokens`` (array of int),
    which prefix_tokens() and longest_prefix() read. Null reads as an empty text: 0 and false.
    Columns of these names are replaced, all others stay. ``vocabulary`` is a path each executor has.
    """
    added = [
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("over_limit", T.BooleanType()),
        T.StructField("fitting_chars", T.LongType()),
    ] + ([T.StructField("prefix_tokens", T.ArrayType(T.IntegerType()))] if store else [])
    names = {f.name for f in added}
    schema = T.StructType([f for f in documents.schema.fields if f.name not in names] + added)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes = counter(vocabulary)
        for batch, texts in text_slices(batches, "text"):
            n_bytes, n_tokens, fitting, stored = [], [], [], []
            for text in texts:
                counts = prefixes.counts(text)
                n_bytes.append(len(text) if text.isascii() else len(text.encode("utf-8", "surrogatepass")))
                n_tokens.append(int(counts[-1]) if len(counts) else 0)
                within = len(counts)
                if n_tokens[-1] > limit:
                    fits = np.flatnonzero(counts <= limit)
                    within = int(fits[-1]) + 1 if len(fits) else 0
                fitting.append(within)
                if store:
                    stored.append(counts)
            columns = {
                "n_bytes": pa.array(n_bytes, pa.int64()),
                "n_tokens": pa.array(n_tokens, pa.int64()),
                "over_limit": pa.array([n > limit for n in n_tokens], pa.bool_()),
                "fitting_chars": pa.array(fitting, pa.int64()),
            }
            if store:
                columns["prefix_tokens"] = pa.array(stored, pa.list_(pa.int32()))
            yield with_columns(batch, columns)

    return documents.mapInArrow(counted, schema)


def prefix_tokens(stored: Column | str, chars: Column | int) -> Column:
    """Tokens of the first so many characters, from stored counts; null beyond the text."""
    chars = F.lit(chars) if isinstance(chars, int) else chars
    return F.when(chars == 0, F.lit(0)).otherwise(F.try_element_at(stored, chars.cast("int")))


def longest_prefix(stored: Column | str, budget: Column | int) -> Column:
    """Characters of the longest prefix of at most ``budget`` tokens, from stored counts."""
    budget = F.lit(budget) if isinstance(budget, int) else budget
    stored = F.col(stored) if isinstance(stored, str) else stored
    fits = F.transform(stored, lambda n, i: F.when(n <= budget, i + 1).otherwise(0))
    return F.coalesce(F.array_max(fits), F.lit(0)).cast("long")
