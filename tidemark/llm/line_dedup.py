"""Lines that stand in several documents, dropped everywhere but in the first, by two Bloom filters.

A line goes into the filter of lines seen once, and into that of lines seen twice if it was there before. Tasks fill
filters of their own rows; where two tasks have set the same bit of the first filter, the merged second one
gets it, so no repeated line is missed. The filters are cut into cells of 8 KB, as many as the lines of the
corpus need, and all bits of a line lie in one cell. Only lines whose bits are all set in the second filter go on: they
are grouped by their exact text, which also finds the document that keeps them.

Lines are found, trimmed, lowered and hashed as spans of the bytes of an Arrow batch, without a string for each of them. A line's hash
is a sum of its bytes' values times powers of a number; running sums give it for all lines at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._tables import checkpointed

#: Blanks that do not count at the ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
_BLANK_BYTES = BLANKS.encode()
#: Shorter lines stay, however often they stand.
LEAST_CHARS = 10
#: Bits of a filter for each line, of which a line sets SPOTS. An unrepeated line is suspected about once in 600 times.
BITS_PER_LINE, SPOTS = 24, 3
CELL_BITS = 1 << 16
#: The second filter is sent to all tasks up to this size; beyond it hashes of lines are shuffled to its cells.
BROADCAST_BYTES = 64 << 20
#: Lines that a task files at once.
LINES_AT_ONCE = 1 << 20

#: Bytes whose running sums are taken at once, and blanks that are stepped over at an end of all lines at once.
PIECE, BLANK_STEPS = 1 << 18, 32

_ONCE_SCHEMA = "cell long, once binary, twice binary"
_LINE_SCHEMA = "doc_id long, text_hash long, key string, hash long, spots long"
_WORD = 1 << 64
_STEP = 0x9E3779B97F4A7C15


def _mixed(values: np.ndarray) -> np.ndarray:
    """Values of which every bit depends on every bit of the given ones."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        values = (values ^ (values >> np.uint64(shift))) * np.uint64(factor)
    return values ^ (values >> np.uint64(31))


# By byte: A-Z lowered, blank or not, first of a code point or not, value in a hash.
_LOWERED = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_IS_BLANK = np.isin(np.arange(256), list(_BLANK_BYTES))
_IS_FIRST = (np.arange(256) & 0xC0) != 0x80
_VALUES = _mixed((_LOWERED.astype(np.uint64) + np.uint64(1)) * np.uint64(_STEP))
_POWERS, _INVERSES = (
    np.multiply.accumulate(np.array([1] + [step] * PIECE, np.uint64)) for step in (_STEP, pow(_STEP, -1, _WORD))
)


def key_of(line: str) -> str:
    """A line without blanks at its ends, A-Z lowered."""
    return line.strip(BLANKS).encode().lower().decode()


def dedup_lines(documents: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """doc_id, n_lines, n_dropped and text without dropped lines, one row for each row of documents.

    A document is a doc_id: its rows keep and lose lines alike, and a line that only they hold stays. Rows with null doc_id
    count as one document, the last of all. Null text is one empty line. A text that loses all its lines is empty.
    Other columns of documents are left out.
    """
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cells = _cells(texts)
    bits = repeated_bits(texts.select("text"), cells, partial(_hashed, least_chars=least_chars))
    suspects = _suspects(_lines(texts, least_chars), bits, cells)
    drops = _drops(checkpointed(suspects))
    rows = texts.withColumn("text_hash", F.xxhash64("text")).alias("t")
    found = drops.alias("d")
    joined = rows.join(
        found, F.col("t.doc_id").eqNullSafe(F.col("d.doc_id")) & (F.col("t.text_hash") == F.col("d.text_hash")), "left"
    )
    return joined.select("t.doc_id", "t.text", "d.keys").mapInArrow(
        _without, "doc_id long, n_lines long, n_dropped long, text string"
    )


def _lines(texts: DataFrame, least_chars: int) -> DataFrame:
    """doc_id, text_hash, key, hash and spots of every line long enough."""
    rows = texts.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(partial(_keyed, least_chars=least_chars), _LINE_SCHEMA)


def _keyed(batches: Iterator[pa.RecordBatch], least_chars: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        data, rows, starts, ends = _spans(texts, least_chars)
        if not len(rows):
            continue
        # The lines and what lies between them, of which the lines are taken.
        bounds = np.column_stack([starts, ends]).ravel().astype(_offset_type(texts))
        spans = pa.Array.from_buffers(
            texts.type, len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(_LOWERED[data])]
        )
        keys = spans.take(pa.array(np.arange(0, len(bounds), 2)))
        hashes, spots = _hashes(data, starts, ends)
        places = pa.array(rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(places), batch.column("text_hash").take(places), keys, pa.array(hashes), pa.array(spots)],
            names=["doc_id", "text_hash", "key", "hash", "spots"],
        )


def _hashed(batches: Iterator[pa.RecordBatch], least_chars: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, _, starts, ends = _spans(batch.column("text"), least_chars)
        if len(starts):
            yield pa.RecordBatch.from_arrays([pa.array(h) for h in _hashes(data, starts, ends)], names=["hash", "spots"])


def _offset_type(texts: pa.Array) -> type:
    return np.int64 if pa.types.is_large_string(texts.type) else np.int32


def _spans(texts: pa.Array, least_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of texts, and of each line long enough its text, its first byte that is not blank and the one after its last."""
    if not len(texts):
        return (np.empty(0, np.uint8), *[np.empty(0, np.int64)] * 3)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, _offset_type(texts))[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data or b"", np.uint8)
    breaks = np.flatnonzero(data[bounds[0] : bounds[-1]] == ord("\n")) + bounds[0]
    rows = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(breaks, bounds)) + 1)
    # Lines follow each other, so that the n-th start and the n-th end are those of the n-th line.
    starts = np.sort(np.concatenate([bounds[:-1], breaks + 1]))
    ends = np.sort(np.concatenate([bounds[1:], breaks]))
    long = ends - starts >= least_chars
    rows, starts, ends = rows[long], starts[long], ends[long]
    _trim(data, starts, ends)
    sizes = ends - starts
    long = sizes >= least_chars
    # A code point has at most four bytes.
    unsure = np.flatnonzero(long & (sizes < 4 * least_chars))
    if len(unsure):
        cuts = np.cumsum(sizes[unsure])
        places = np.repeat(ends[unsure] - cuts, sizes[unsure]) + np.arange(cuts[-1])
        chars = np.add.reduceat(_IS_FIRST[data[places]], cuts - sizes[unsure], dtype=np.int64)
        long[unsure] = chars >= least_chars
    return data, rows[long], starts[long], ends[long]


def _trim(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
    for edges, before, step in ((starts, 0, 1), (ends, 1, -1)):
        blank = np.flatnonzero(starts < ends)
        for _ in range(BLANK_STEPS):
            blank = blank[_IS_BLANK[data[edges[blank] - before]]]
            edges[blank] += step
            blank = blank[starts[blank] < ends[blank]]
        for i in blank.tolist():
            line = data[starts[i] : ends[i]].tobytes()
            edges[i] += step * (len(line) - len(line.lstrip(_BLANK_BYTES) if step > 0 else line.rstrip(_BLANK_BYTES)))


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """hash and spots of the lines at ascending places."""
    sums = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        origin = starts[first]
        last = int(np.searchsorted(ends, origin + PIECE, "right"))
        if last <= first:
            sums[first] = _long_sum(data[origin : ends[first]])
            first += 1
            continue
        values = _VALUES[data[origin : ends[last - 1]]]
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _POWERS[: len(values)])])
        here, there = starts[first:last] - origin, ends[first:last] - origin
        sums[first:last] = (running[there] - running[here]) * _INVERSES[here]
        first = last
    hashes = _mixed(sums + (ends - starts).astype(np.uint64) * np.uint64(_STEP))
    return hashes.view(np.int64), _mixed(hashes + np.uint64(_STEP)).view(np.int64)


def _long_sum(line: np.ndarray) -> int:
    """The sum of a line longer than a piece."""
    total = 0
    for at in range(0, len(line), PIECE):
        values = _VALUES[line[at : at + PIECE]]
        total += int((values * _POWERS[: len(values)]).sum()) * pow(_STEP, at, _WORD)
    return total % _WORD


def _cells(texts: DataFrame) -> int:
    """Cells that give every line of the corpus its bits."""
    breaks = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    lines = texts.agg(F.sum((breaks + 1).cast("long"))).first()[0] or 1
    return -(-lines * BITS_PER_LINE // CELL_BITS)


def repeated_bits(
    lines: DataFrame, cells: int, hashed: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None
) -> DataFrame:
    """cell and words: the second filter, CELL_BITS bits a cell as 64-bit words; cells without a set bit are left out.

    It is filled by hash and spots, which lines hold or ``hashed`` makes of their batches.
    """

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in hashed(batches) if hashed else batches:
            held.append((batch.column("hash").to_numpy(), batch.column("spots").to_numpy()))
            count += batch.num_rows
            if count >= LINES_AT_ONCE:
                yield _filed(held, cells)
                held, count = [], 0
        if count:
            yield _filed(held, cells)

    parts = (lines if hashed else lines.select("hash", "spots")).mapInArrow(file, _ONCE_SCHEMA)
    merged = parts.repartition("cell").sortWithinPartitions("cell").mapInArrow(_merged, "cell long, words array<long>")
    return checkpointed(merged)


def _filed(held: list[tuple[np.ndarray, np.ndarray]], cells: int) -> pa.RecordBatch:
    """For each cell the bits set by lines seen, and by lines seen twice, as 16-bit places."""
    hashes, spots = (np.concatenate(part) for part in zip(*held))
    _, first, counts = np.unique(hashes, return_index=True, return_counts=True)
    once = _places(hashes[first], spots[first], cells)
    again = first[counts > 1]
    twice = _places(hashes[again], spots[again], cells)
    used = np.unique(once >> 16)
    return pa.RecordBatch.from_arrays(
        [pa.array(used), _by_cell(once, used), _by_cell(twice, used)], names=["cell", "once", "twice"]
    )


def _places(hashes: np.ndarray, spots: np.ndarray, cells: int) -> np.ndarray:
    """Sorted distinct places, the cell above the 16 bits of the place in it."""
    cell = np.mod(hashes, cells)[:, None] << 16
    shifts = np.arange(SPOTS, dtype=np.int64) * 16
    return np.unique(cell | ((spots[:, None] >> shifts) & 0xFFFF))


def _by_cell(places: np.ndarray, used: np.ndarray) -> pa.Array:
    bounds = np.searchsorted(places, np.append(used, used[-1] + 1) << 16) * 2
    data = (places & 0xFFFF).astype(np.uint16)
    return pa.Array.from_buffers(
        pa.binary(), len(used), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)]
    )


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cell, once, twice = None, None, None

    def done() -> pa.RecordBatch:
        words = np.packbits(twice, bitorder="little").view(np.int64)
        column = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(words))
        return pa.RecordBatch.from_arrays([pa.array([cell]), column], names=["cell", "words"])

    for batch in batches:
        for at, ones, twos in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if at != cell:
                if cell is not None and twice.any():
                    yield done()
                cell, once, twice = at, np.zeros(CELL_BITS, bool), np.zeros(CELL_BITS, bool)
            places = np.frombuffer(ones, np.uint16)
            twice[places] |= once[places]
            once[places] = True
            twice[np.frombuffer(twos, np.uint16)] = True
    if cell is not None and twice.any():
        yield done()


def _suspects(lines: DataFrame, bits: DataFrame, cells: int) -> DataFrame:
    """Lines all whose bits are set in the second filter: doc_id, text_hash and key, once each."""
    small = cells * CELL_BITS // 8 <= BROADCAST_BYTES
    places = [F.shiftright("spots", 16 * i).bitwiseAND(0xFFFF) for i in range(SPOTS)]
    tested = lines.withColumn("cell", F.pmod("hash", F.lit(cells))).join(F.broadcast(bits) if small else bits, "cell")
    for place in places:
        word = F.get("words", F.shiftright(place, 6).cast("int"))
        tested = tested.filter(F.expr("1L") == F.call_function("getbit", word, place.bitwiseAND(63).cast("int")))
    return tested.select("doc_id", "text_hash", "key").distinct()


def _drops(suspects: DataFrame) -> DataFrame:
    """doc_id, text_hash and the keys of the lines that its rows lose."""
    some_null, some_id = F.max(F.col("doc_id").isNull()), F.max(F.col("doc_id").isNotNull())
    kept = (
        suspects.groupBy("key")
        .agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last"), (some_null & some_id).alias("mixed"))
        .filter((F.col("keeper") != F.col("last")) | F.col("mixed"))
        .select("key", "keeper")
    )
    # Written first, so that the join reads two shuffles and Spark can split the rows of a hot line.
    return (
        suspects.join(checkpointed(kept), "key")
        .filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_list("key").alias("keys"))
    )


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, dropped, texts = [], [], []
        column = batch.column("text")
        keys = batch.column("keys").to_pylist()
        # Bytes, whose lower() leaves all but A-Z as it is.
        for gone, text in zip(keys, column.cast(pa.binary()).to_pylist()):
            counts.append(text.count(b"\n") + 1)
            left = None
            if gone is not None:
                gone = {key.encode() for key in gone}
                left = [line for line in text.split(b"\n") if line.strip(_BLANK_BYTES).lower() not in gone]
            dropped.append(counts[-1] - len(left) if gone is not None else 0)
            texts.append(b"\n".join(left) if gone is not None else text)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(counts, pa.int64()),
                pa.array(dropped, pa.int64()),
                pa.array(texts, pa.binary()).cast(pa.string()),
            ],
            names=["doc_id", "n_lines", "n_dropped", "text"],
        )
