"""Toxicity of documents, seen through the disguises of their words.

A word written with look-alike symbols, spaced out or stretched is a noisy channel's output. The
characters it may stand for form a lattice; Viterbi decoding picks the likeliest reading under a
character trigram model counted over all documents. A lexicon learned from labelled documents
then scores the restored text.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm._tables import checkpointed
from tidemark.llm._text import TABLE_END, code_points, mixed, shingle_sets, text_slices, with_columns

#: Symbols of the character model: 0 is no letter, 1 to 26 are a to z, the rest other letters.
SYMBOLS = 40

# The letters that a look-alike symbol may stand for.
LOOKALIKES = {
    "0": "o",
    "1": "il",
    "2": "z",
    "3": "e",
    "4": "a",
    "5": "s",
    "6": "g",
    "7": "t",
    "8": "b",
    "9": "g",
    "@": "a",
    "$": "s",
    "!": "i",
    "|": "il",
    "+": "t",
    "(": "c",
    "€": "e",
    "£": "l",
}
# End of fixed values.

#: Log-probabilities of the channel.
SUBSTITUTED, STRETCHED, SEPARATED, KEPT_APART, LEFT_AS_SYMBOL = -1.0, -0.5, -0.2, -2.5, -7.0
BEAM = 24
#: Readings of longer spans are not kept for the next time.
LONGEST_KEPT = 400
SEPARATORS = " .-_*~,/\\'"
#: Separators between letters that stand in different tokens.
_GAPS = " .-_*"

#: Words, prefixes of these lengths and their numbers in training.
PREFIXES = (4, 5, 6)
LEAST_DOCUMENTS = 5
CONFIDENCE = 3.2
CANDIDATES = 20_000
LEXICON_SIZE = 5000
SKETCH = 24
LEAST_BOUND = 0.3
THRESHOLD = 0.3
#: Score of a text without a word of the lexicon.
BASE_SCORE = 0.02

# No unit is a separator, so that a text has one match at most from each place; letters and digits end it, marks do not.
_SPACED = re.compile(r"(?<![^\W_])(?:[^\s.\-_*][ .\-_*]+){2,}[^\s.\-_*](?![^\W_])")
_STRETCHED = re.compile(r"(.)\1\1")
_DOUBLED = re.compile(r"(.)\1")
_LOOKS = "".join(map(re.escape, LOOKALIKES))
_DISGUISED = re.compile(rf"[^\W\d_][{_LOOKS}.\-_*~,/\\']+[^\W\d_]|[{_LOOKS}][^\W\d_]|[^\W\d_][{_LOOKS}]")
#: Look-alikes that are punctuation at the end of a word.
_MARKS = "@$!|+("
_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in _MARKS)


@lru_cache(maxsize=1)
def symbol_table() -> np.ndarray:
    """Symbol of each code point: letters without their accents and case, others by a rule."""
    table = np.zeros(TABLE_END, dtype=np.int64)
    for code in range(TABLE_END):
        if chr(code).isalpha():
            base = unicodedata.normalize("NFKD", chr(code).lower())[:1]
            table[code] = ord(base) - 96 if "a" <= base <= "z" else 27 + code % (SYMBOLS - 27)
    return table


@lru_cache(maxsize=200_000)
def _symbol(char: str) -> int:
    code = ord(char)
    return int(symbol_table()[code])


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(SYMBOLS**3, dtype=np.int64)
    for _, texts in text_slices(batches, "text"):
        codes, _ = code_points(texts)
        s = np.concatenate([[0], symbol_table()[codes]])
        # A run of characters that are no letters counts once.
        s = s[np.concatenate([[True], (s[1:] != 0) | (s[:-1] != 0)])]
        if len(s) > 2:
            counts += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3)
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(counts[seen])], ["gram", "n"])


def character_model(documents: DataFrame) -> np.ndarray:
    """Trigram log-probabilities counted over every whole text; at most SYMBOLS cubed rows reach the driver."""
    rows = (
        documents.select("text")
        .mapInArrow(_count_trigrams, "gram int, n long")
        .groupBy("gram")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    counts = np.zeros(SYMBOLS**3)
    counts[rows["gram"].to_numpy(dtype=np.int64)] = rows["n"]
    tri = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    bi = tri.sum(0)
    uni = (bi.sum(0) + 1) / (bi.sum() + SYMBOLS)
    # Each order leans on the one below where it has seen little.
    p2 = (bi + 20 * uni) / (bi.sum(1, keepdims=True) + 20)
    p3 = (tri + 20 * p2) / (tri.sum(2, keepdims=True) + 20)
    return np.log(p3).astype(np.float32)


def restore(span: str, model: list) -> str:
    """The likeliest reading of a disguised span: letters, with spaces between words.

    model: character_model() as nested lists. The state of the search is the last two symbols; each points back
    along its reading, so that time grows with the length of the span and paths no state leads to are freed.
    """
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    before = ""
    for char in span:
        choices: list[tuple[str, float]] = []
        if char.isalpha():
            choices.append((char, 0.0))
        for letter in LOOKALIKES.get(char, ""):
            choices.append((letter, SUBSTITUTED))
        if char in SEPARATORS:
            # A second separator in a row rather ends a word.
            again = before in SEPARATORS and before
            choices += [("", KEPT_APART), (" ", SEPARATED)] if again else [("", SEPARATED), (" ", KEPT_APART)]
        elif not char.isalpha():
            choices.append((" ", LEFT_AS_SYMBOL if char in LOOKALIKES else KEPT_APART))
        if char == before and char not in SEPARATORS:
            choices.append(("", STRETCHED))
        reached: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (cost, path) in states.items():
            row = model[a][b]
            for letter, channel in choices:
                if not letter or (letter == " " and b == 0):
                    state, total = (a, b), cost + channel
                else:
                    s = _symbol(letter)
                    state, total = (b, s), cost + channel + row[s]
                if state not in reached or total > reached[state][0]:
                    reached[state] = (total, (path, letter) if letter else path)
        if len(reached) > BEAM:
            reached = dict(sorted(reached.items(), key=lambda item: -item[1][0])[:BEAM])
        states = reached
        before = char
    ends = [(cost + model[a][b][0], path) for (a, b), (cost, path) in states.items()]
    best = max(total for total, _ in ends)
    return max(_spelled(path) for total, path in ends if total == best)


def _spelled(path: tuple | None) -> str:
    letters = []
    while path:
        path, letter = path
        letters.append(letter)
    return "".join(reversed(letters))


class Restorer:
    """Finds disguised spans and restores them; readings of frequent spans are kept, within a bound."""

    KEPT = 50_000

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()
        self.known: dict[str, list[str]] = {}

    def _read(self, span: str) -> list[str]:
        found = self.known.get(span)
        if found is None:
            found = restore(span, self.model).split()
            if len(span) > LONGEST_KEPT:
                return found
            if len(self.known) >= self.KEPT:
                self.known.clear()
            self.known[span] = found
        return found

    def words(self, text: str) -> tuple[set[str], set[str]]:
        """The plain words of a text and those read from disguised spans, in lower case."""
        text = text.lower()
        plain, read = set(), set()
        for token in set(text.split()):
            if not token.isalpha():
                bare = token.strip(_EDGES)
                token = bare.strip(_MARKS)
                # A mark at either end may be a letter or punctuation.
                forms = {bare, bare.rstrip(_MARKS), bare.lstrip(_MARKS), token}
                if not token.isalpha():
                    for form in forms:
                        if form and _DISGUISED.search(form):
                            read.update(self._read(form))
                    plain.update(re.findall(r"[^\W\d_]+", token))
                    continue
                for form in forms - {token}:
                    read.update(self._read(form))
            plain.add(token)
            if _STRETCHED.search(token) or len(_DOUBLED.findall(token)) > 2:
                read.update(self._read(token))
        for match in _SPACED.finditer(text):
            for span in _spaced_spans(text, match.start(), match.end()):
                read.update(self._read(span))
        return plain, read


def _spaced_spans(text: str, start: int, end: int) -> set[str]:
    """The spaced letters of text[start:end]; where marks touch them, also without the letter that touches.

    So the t of "don't" and the i of "i'm" are no letters of the word beside them.
    """
    starts, ends = [start], [end]
    if start and not text[start - 1].isspace():
        starts.append(end - len(text[start + 1 : end].lstrip(_GAPS)))
    if end < len(text) and not text[end].isspace():
        ends.append(start + len(text[start : end - 1].rstrip(_GAPS)))
    return {text[a:b] for a in starts for b in ends}


def features(words: set[str]) -> set[str]:
    """Whole words and their beginnings."""
    found = set(words)
    for n in PREFIXES:
        found.update(w[:n] + "*" for w in words if len(w) > n)
    return found


@dataclass
class ToxicityModel:
    characters: np.ndarray
    #: Weight of a feature: the share of toxic documents among those with it, times the share's lower bound.
    lexicon: dict[str, float]
    base_rate: float


def _feature_counter(characters: np.ndarray):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(characters)
        seen, toxic = Counter(), Counter()
        for batch, texts in text_slices(batches, "text"):
            for text, label in zip(texts, batch.column("label").to_pylist()):
                found = features(set().union(*restorer.words(text)))
                seen.update(found)
                if label:
                    toxic.update(found)
        names = list(seen)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.string()),
                pa.array([seen[x] for x in names], pa.int64()),
                pa.array([toxic[x] for x in names], pa.int64()),
            ],
            ["feature", "n", "n_toxic"],
        )

    return count


def _evidence(candidates: dict[str, float], characters: np.ndarray):
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(characters)
        seeds = mixed(np.arange(1, SKETCH + 1, dtype=np.uint64)) | np.uint64(1)
        for _, texts in text_slices(batches, "text"):
            sketches, found = [], []
            for text, shingles in zip(texts, shingle_sets(texts, 3)):
                values = [0] * SKETCH if not len(shingles) else [int((shingles * s).min()) >> 1 for s in seeds]
                sketches.append(values)
                found.append(sorted(features(set().union(*restorer.words(text))) & candidates.keys()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(sketches, pa.list_(pa.int64())), pa.array(found, pa.list_(pa.string()))],
                ["sketch", "features"],
            )

    return collect


def _lower_bound(share, n):
    """Lower end of the score interval of a share among n."""
    z = CONFIDENCE
    return (share + z * z / (2 * n) - z * np.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def _near_copies(sketches: np.ndarray) -> np.ndarray:
    """A group number for each sketch; sketches that agree in half of their places share one."""
    group = np.arange(len(sketches))
    for i in range(len(sketches)):
        alike = np.flatnonzero((sketches[:i] == sketches[i]).mean(1) >= 0.5) if i else []
        for g in np.unique(group[alike]):
            group[group == g] = i
        # Earlier members joined through i carry its number already.
    return group


def train(documents: DataFrame, sample: DataFrame) -> ToxicityModel:
    """Character model over all documents, lexicon from labelled ones.

    sample: text and label (0 or 1) of a bounded number of documents; copies of a text count once,
    and near copies count once as toxic evidence, or every word of a copied text would look toxic.
    A feature enters the lexicon with LEAST_DOCUMENTS toxic documents and if the lower bound of its
    share of toxic documents reaches LEAST_BOUND; the LEXICON_SIZE with the highest bounds are kept.
    Without toxic examples the lexicon is empty and every document gets the base rate.
    """
    characters = character_model(documents)
    sample = checkpointed(
        sample.filter(F.col("text").isNotNull())
        .withColumn("copy_of", F.md5("text"))
        .groupBy("copy_of")
        .agg(F.min("text").alias("text"), F.max("label").alias("label"))
        .select("text", "label")
    )
    p, n, z = F.col("n_toxic") / F.col("n"), F.col("n"), CONFIDENCE
    bound = (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    rows = (
        sample.mapInArrow(_feature_counter(characters), "feature string, n long, n_toxic long")
        .groupBy("feature")
        .agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic"))
        .filter(F.col("n_toxic") >= LEAST_DOCUMENTS)
        .withColumn("bound", bound)
        .filter(F.col("bound") >= LEAST_BOUND)
        .orderBy(F.desc("bound"), "feature")
        .limit(CANDIDATES)
        .collect()
    )
    candidates = {r.feature: r.n - r.n_toxic for r in rows}
    toxic = (
        sample.filter(F.col("label") == 1)
        .select("text")
        .mapInArrow(_evidence(candidates, characters), "sketch array<long>, features array<string>")
        .collect()
    )
    lexicon = {}
    if toxic:
        groups = _near_copies(np.array([r.sketch for r in toxic], dtype=np.int64))
        distinct = Counter(f for f, _ in {(f, g) for r, g in zip(toxic, groups.tolist()) for f in r.features})
        for name, times in distinct.items():
            share = times / (times + candidates[name])
            bound = float(_lower_bound(share, times + candidates[name]))
            if times >= LEAST_DOCUMENTS and bound >= LEAST_BOUND:
                # A word that clean documents use as well needs company.
                lexicon[name] = bound * share
        # A prefix that stands for one whole word only says nothing about other words.
        for word in [w for w in lexicon if not w.endswith("*")]:
            for n in PREFIXES:
                if distinct.get(word[:n] + "*", 0) * 0.9 <= distinct[word]:
                    lexicon.pop(word[:n] + "*", None)
    kept = sorted(lexicon, key=lambda f: (-lexicon[f], f))[:LEXICON_SIZE]
    return ToxicityModel(characters, {f: lexicon[f] for f in kept}, BASE_SCORE)


class Scorer:
    def __init__(self, model: ToxicityModel):
        self.restorer = Restorer(model.characters)
        self.lexicon = model.lexicon
        self.base = model.base_rate
        # Stretching also hides which letters were double, so restored words are compared without doubles too.
        self.squeezed: dict[str, float] = {}
        for name, weight in model.lexicon.items():
            short = _DOUBLED.sub(r"\1", name)
            self.squeezed[short] = max(weight, self.squeezed.get(short, 0.0))
        self.lengths = sorted({len(x) - 1 for x in model.lexicon if x.endswith("*")})

    def _weight(self, word: str, lexicon: dict[str, float]) -> float:
        best = lexicon.get(word, 0.0)
        for n in self.lengths:
            if len(word) > n:
                best = max(best, lexicon.get(word[:n] + "*", 0.0))
        return best

    def score(self, text: str) -> tuple[float, list[str]]:
        """A number from 0 to 1, and the words that made it, largest first."""
        plain, read = self.restorer.words(text)
        found = {}
        lexicon = self.lexicon
        hits = plain & lexicon.keys()
        for n in self.lengths:
            hits.update(w for w in plain if w[:n] + "*" in lexicon)
        for word in hits:
            found[word] = self._weight(word, lexicon)
        for word in read:
            weight = max(self._weight(word, lexicon), self._weight(_DOUBLED.sub(r"\1", word), self.squeezed))
            if weight:
                found[word] = max(weight, found.get(word, 0.0))
        order = sorted(found, key=lambda w: (-found[w], w))
        if not order:
            return self.base, []
        # Each word leaves a doubt; together they leave the product.
        return 1 - math.prod(1 - found[w] for w in order), order[:5]


def score(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """Every row with ``score`` (double, 0 to 1) and ``toxic_words`` (up to five restored words).

    Null and empty texts get the base rate. Columns of these names are replaced, all others stay.
    """
    columns = [f for f in documents.schema.fields if f.name not in ("score", "toxic_words")]
    schema = T.StructType(
        columns
        + [T.StructField("score", T.DoubleType()), T.StructField("toxic_words", T.ArrayType(T.StringType()))]
    )
    shared = documents.sparkSession.sparkContext.broadcast(model)  # bounded: SYMBOLS cubed and LEXICON_SIZE entries

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch, texts in text_slices(batches, "text"):
            results = [scorer.score(t) for t in texts]
            yield with_columns(
                batch,
                {
                    "score": pa.array([r[0] for r in results], pa.float64()),
                    "toxic_words": pa.array([r[1] for r in results], pa.list_(pa.string())),
                },
            )

    return documents.mapInArrow(scored, schema)
