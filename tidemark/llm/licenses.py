"""License notices in texts, exact phrases and short notices with a few edits.

If a text holds a notice with at most k edits, one of k + 1 pieces of the notice stands in it
unchanged. Such seeds are searched for first; around each, the regex library matches the notice
with a bounded number of errors and gives its span.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm._text import text_slices, with_columns

# Phrases whose places are counted, and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Usual wordings of short notices, lower case, words joined by one blank.
NOTICES = {
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license version 2 0": "apache",
    "you may not use this file except in compliance with the license": "apache",
    "under the terms of the gnu general public license": "gpl",
    "licensed under the gnu general public license": "gpl",
    "under the terms of the gnu lesser general public license": "lgpl",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "released under the bsd license": "bsd",
    "licensed under the bsd license": "bsd",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "subject to the terms of the mozilla public license": "mpl",
    "licensed under the creative commons attribution": "cc",
    "licensed under cc by": "cc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "reserved",
}
# Words in notices that tell one licence from another.
NAMES = (
    "mit",
    "apache",
    "general public",
    "lesser",
    "bsd",
    "mozilla",
    "creative commons",
    "cc by",
)
# End of fixed values.

#: A name of so many letters may have one edit, a shorter one none.
LONG_NAME = 6
#: One edit is allowed for so many characters of a notice.
CHARS_PER_EDIT = 10
#: Length of a searched piece in lengths of the notice.
PIECE = 3

_LETTERS = bytes(
    b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)
_WORD = re.compile(rb"[^ ]+")


@dataclass(frozen=True)
class Notice:
    text: str
    label: str
    edits: int
    seeds: tuple[bytes, ...]
    #: Matches begin with a whole word, and end with one and the blank after it.
    pattern: regex.Pattern
    #: Where a licence's name stands in the notice, its length, and what finds it as whole words.
    names: tuple[tuple[int, int, regex.Pattern], ...]

    def named(self, span: str) -> bool:
        """Whether all names of the notice stand in a span, given with a blank on either side."""
        return all(name.search(span) for _, _, name in self.names)

    def named_near(self, flat: bytes, place: int) -> bool:
        """Whether the names stand where they would if the notice began here, give or take the edits."""
        room = self.edits + 2
        for offset, length, name in self.names:
            at = place + offset
            if not name.search(flat[max(0, at - room) : max(0, at + length + room)].decode("latin-1")):
                return False
        return True


def _name(text: str) -> regex.Pattern:
    fuzzy = "{e<=1}" if len(text) >= LONG_NAME else ""
    return regex.compile(rf"(?<= )(?:{regex.escape(text + ' ')}){fuzzy}(?<= )")


def notice(text: str, label: str) -> Notice:
    """A notice cut into one more seed than edits are allowed."""
    edits = len(text) // CHARS_PER_EDIT
    cuts = [round(len(text) * i / (edits + 1)) for i in range(edits + 2)]
    seeds = tuple(text[a:b].encode() for a, b in zip(cuts, cuts[1:]))
    # The blank after it is matched too: before a lookahead the library leaves out matches that lack their last letters.
    pattern = regex.compile(rf"(?<= )(?:{regex.escape(text + ' ')}){{e<={edits}}}(?<= )", regex.BESTMATCH)
    names = tuple((f" {text} ".index(f" {x} "), len(x), _name(x)) for x in NAMES if f" {x} " in f" {text} ")
    return Notice(text, label, edits, seeds, pattern, names)


@dataclass(frozen=True)
class Match:
    label: str
    #: Words from the start of the text, the last one not included.
    first_word: int
    end_word: int
    edits: int
    similarity: float


class Scanner:
    def __init__(self, notices: Iterable[tuple[str, str]] = tuple(NOTICES.items())):
        self.notices = [notice(text, label) for text, label in notices]
        users: dict[bytes, list[tuple[Notice, int]]] = {}
        for n in self.notices:
            offset = 0
            for seed in n.seeds:
                users.setdefault(seed, []).append((n, offset))
                offset += len(seed)
        self.seeds = list(users.items())
        self.phrases = [(re.compile(rb"(?<= )" + p.encode() + rb"(?= )"), label) for p, label in PHRASES.items()]

    @staticmethod
    def normalised(text: str) -> tuple[bytes, int]:
        """Words of a text with a blank around each, and their number."""
        words = text.encode("utf-8", "surrogatepass").translate(_LETTERS).split(b" ")
        words = [w for w in words if w]
        return b" " + b" ".join(words) + b" ", len(words)

    def places(self, flat: bytes) -> list[tuple[int, str]]:
        """First word and label of every place where a phrase stands."""
        if b" license " not in flat:
            return []
        before = word_counter(flat)
        return sorted((before(m.start()) - 1, label) for p, label in self.phrases for m in p.finditer(flat))

    def fuzzy(self, flat: bytes) -> list[Match]:
        """Places of notices with bounded edits, of those that overlap the one with fewest.

        A match is made of whole words and holds the names that its notice holds, long ones with at most one edit.
        """
        starts: dict[Notice, set[int]] = {}
        for seed, users in self.seeds:
            at = flat.find(seed)
            while at >= 0:
                for n, offset in users:
                    starts.setdefault(n, set()).add(at - offset)
                at = flat.find(seed, at + 1)
        found = []
        before = word_counter(flat) if starts else None
        for n, places in starts.items():
            near = sorted(place for place in places if n.named_near(flat, place))
            for a, b, edits in disjoint(self._near(flat, n, near)):
                found.append(Match(n.label, before(a) - 1, before(b), edits, 1 - edits / len(n.text)))
        return unrivalled(sorted(set(found), key=lambda x: (x.first_word, x.end_word, x.label, x.edits)))

    def _near(self, flat: bytes, n: Notice, places: list[int]) -> Iterator[tuple[int, int, int]]:
        """Start, end and edits of matches around the places where seeds say that a notice begins.

        Stretches of near places are searched in pieces of a few notices' length, each reaching so far into the next
        that no match is cut; so the time grows with the length of the text, however often seeds repeat.
        """
        # The blanks around a match are read too.
        reach = len(n.text) + 2 * n.edits + 1
        i = 0
        while i < len(places):
            j = i
            while j + 1 < len(places) and places[j + 1] - places[j] <= reach + n.edits:
                j += 1
            end = min(len(flat), places[j] + reach + 1)
            begin = max(0, places[i] - n.edits - 1)
            for start in range(begin, max(begin + 1, end - reach), PIECE * reach):
                # Latin-1 gives each byte a character of its own, so places stay those of the bytes.
                piece = flat[start : min(end, start + (PIECE + 1) * reach)].decode("latin-1")
                for a, b, edits in self._best(n, piece, 0, len(piece)):
                    yield start + a, start + b, edits
            i = j + 1

    def _best(self, n: Notice, piece: str, low: int, high: int) -> Iterator[tuple[int, int, int]]:
        """The match with the fewest edits, and the best ones on either side of it; after one without the names,
        those that begin later than it."""
        parts = [(low, high)]
        while parts:
            low, high = parts.pop()
            m = n.pattern.search(piece, low, high) if high - low >= len(n.text) - n.edits else None
            if not m:
                continue
            if n.named(piece[m.start() - 1 : m.end()]):
                yield m.start(), m.end() - 1, sum(m.fuzzy_counts)
                parts += [(low, m.start()), (m.end() - 1, high)]
            else:
                parts += [(low, m.start()), (m.start() + 1, high)]


def word_counter(flat: bytes) -> Callable[[int], int]:
    """Number of blanks before a byte of normalised text."""
    blanks = np.flatnonzero(np.frombuffer(flat, dtype=np.uint8) == 32)
    return lambda at: int(np.searchsorted(blanks, at))


def disjoint(matches: Iterable[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of matches (start, end, edits) that overlap the one kept before them, the one with fewer edits."""
    kept: list[tuple[int, int, int]] = []
    for match in sorted(set(matches)):
        if not kept or match[0] >= kept[-1][1]:
            kept.append(match)
        elif match[2] < kept[-1][2]:
            kept[-1] = match
    return kept


def unrivalled(matches: list[Match]) -> list[Match]:
    """Matches in the order of their first words, but those that overlap one of another label with fewer edits."""
    beaten = set()
    for i, a in enumerate(matches):
        for j in range(i + 1, len(matches)):
            b = matches[j]
            if b.first_word >= a.end_word:
                break
            if a.label != b.label and a.edits != b.edits:
                beaten.add(i if a.edits > b.edits else j)
    return [match for i, match in enumerate(matches) if i not in beaten]


def scan(documents: DataFrame, notices: Iterable[tuple[str, str]] = tuple(NOTICES.items())) -> DataFrame:
    """Every row with its exact phrases and fuzzy notices.

    Words are runs of digits, letters and characters outside ASCII, A-Z lowered. ``n_words``; ``n_base``,
    ``first_word`` and ``last_word`` count the places of PHRASES and give the smallest and largest
    (null if none); ``base_labels`` and ``labels`` join distinct sorted labels with commas, the latter
    with those of fuzzy notices; ``score`` is 1 with an exact phrase, else the largest similarity of
    a notice, else 0; ``spans`` lists the fuzzy matches. Null reads as an empty text. Columns of these
    names are replaced, all others stay.
    """
    span = T.StructType(
        [
            T.StructField("label", T.StringType()),
            T.StructField("first_word", T.LongType()),
            T.StructField("end_word", T.LongType()),
            T.StructField("edits", T.LongType()),
        ]
    )
    added = [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_base", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.StringType()),
        T.StructField("labels", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("spans", T.ArrayType(span)),
    ]
    names = {f.name for f in added}
    schema = T.StructType([f for f in documents.schema.fields if f.name not in names] + added)
    wordings = tuple(notices)
    span_type = pa.list_(
        pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("edits", pa.int64())])
    )

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(wordings)
        types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), span_type]
        for batch, texts in text_slices(batches, "text"):
            rows = []
            for text in texts:
                flat, words = scanner.normalised(text)
                places, matches = scanner.places(flat), scanner.fuzzy(flat)
                base = {label for _, label in places}
                rows.append(
                    (
                        words,
                        len(places),
                        places[0][0] if places else None,
                        places[-1][0] if places else None,
                        ",".join(sorted(base)),
                        ",".join(sorted(base | {m.label for m in matches})),
                        1.0 if places else max((m.similarity for m in matches), default=0.0),
                        [
                            {"label": m.label, "first_word": m.first_word, "end_word": m.end_word, "edits": m.edits}
                            for m in matches
                        ],
                    )
                )
            columns = list(zip(*rows)) or [[]] * len(added)
            yield with_columns(
                batch, {f.name: pa.array(c, t) for f, c, t in zip(added, columns, types)}
            )

    return documents.mapInArrow(scanned, schema)
