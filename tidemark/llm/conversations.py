"""Repair of the structure of conversations at least cost, with an audit of the edits.

A dynamic program over the messages of a conversation keeps the cheapest edits that lead to each of four states:
nothing yet, after a system message, after the user, after the assistant. The edits up to a message are nodes
that point at what came before, so sequences share their prefixes. A node knows its ancestors at all powers of two and
a rolling hash of its letters; of two equally cheap sequences the smaller one is found by a search for their
longest common prefix, and equal hashes are verified by walking back to the node that both share.

Messages are dealt to tasks by ranges of their order, so a conversation of any length is cut into blocks.
Each block is solved for every state it may be entered in; the solutions of a conversation's blocks are joined in
order. Only the joining, and the hash of the repaired text, which is sequential, take place in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm._tables import checkpointed

#: Blanks that do not make a message.
BLANKS = " \t\n\x0b\x0c\r"
#: Marks that end a complete message.
ENDS = ".!?"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
#: Messages of a block at most, copies counted.
BLOCK = 4096
#: Characters of the messages a block holds, a single longer message excepted.
BLOCK_CHARS = 1 << 22

_EMPTY, _SYSTEM, _USER, _ASSISTANT = range(4)
#: The state an initial leads to, and the states it may follow.
_AFTER = {"s": (_SYSTEM, (_EMPTY,)), "u": (_USER, (_EMPTY, _SYSTEM, _ASSISTANT)), "a": (_ASSISTANT, (_USER,))}
_ROLES = {_USER: "user", _ASSISTANT: "assistant"}
_LEGAL_PAIRS = {"su", "ua", "au"}
_BASE, _PRIME = 1_000_003, (1 << 61) - 1

COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
_RESULT = f"conv_id long, {COUNTS}, audit string, repaired_sha256 string"
_MESSAGES = "conv_id long, place long, edit string, role string, text string"
_BLOCK = (
    "conv_id long, part int, block int, counts array<long>, turns array<long>, initials array<string>, "
    "paths array<struct<entry:int, exit:int, cost:long, audit:string>>, lines array<struct<role:string, text:string>>"
)


class Edits:
    """Sequences of edits as nodes that share prefixes; node 0 is the empty one."""

    def __init__(self) -> None:
        self._letter, self._depth, self._hash, self._up = [""], [0], [0], [[]]

    def add(self, parent: int, letter: str) -> int:
        node = len(self._letter)
        up = [parent]
        for k in range(self._depth[parent].bit_length()):
            if k >= len(self._up[up[k]]):
                break
            up.append(self._up[up[k]][k])
        self._letter.append(letter)
        self._depth.append(self._depth[parent] + 1)
        self._hash.append((self._hash[parent] * _BASE + ord(letter)) % _PRIME)
        self._up.append(up)
        return node

    def text(self, node: int) -> str:
        letters = []
        while node:
            letters.append(self._letter[node])
            node = self._up[node][0]
        return "".join(reversed(letters))

    def smaller(self, a: int, b: int) -> bool:
        """Whether the sequence of a comes before that of b in ASCII order."""
        x, y = self._lifted(a, self._depth[b]), self._lifted(b, self._depth[a])
        if self._hash[x] == self._hash[y]:
            if self._same(x, y):
                return self._depth[a] < self._depth[b]
            return self.text(a) < self.text(b)
        # The highest ancestors that differ; the prefix before them is common.
        for k in reversed(range(self._depth[x].bit_length())):
            if k < len(self._up[x]) and self._hash[self._up[x][k]] != self._hash[self._up[y][k]]:
                x, y = self._up[x][k], self._up[y][k]
        if not self._same(self._up[x][0], self._up[y][0]):
            return self.text(a) < self.text(b)
        return self._letter[x] < self._letter[y]

    def _lifted(self, node: int, depth: int) -> int:
        """The ancestor at a depth, the node itself where it is not deeper."""
        while self._depth[node] > depth:
            node = self._up[node][(self._depth[node] - depth).bit_length() - 1]
        return node

    def _same(self, x: int, y: int) -> bool:
        """Whether sequences of equal hash and length are equal."""
        while x != y:
            if self._letter[x] != self._letter[y]:
                return False
            x, y = self._up[x][0], self._up[y][0]
        return True


@dataclass
class _Block:
    """What one run of messages of a conversation comes to."""

    counts: list[int] = field(default_factory=lambda: [0, 0, 0, 0, 0])  # rows, blank, duplicate, truncated, illegal
    turns: list[int] = field(default_factory=list)  # first, last and number of distinct turns
    initials: list[str] = field(default_factory=list)  # of the first and the last message
    lines: list[dict | None] = field(default_factory=list)
    steps: list[tuple[str, bool, bool]] = field(default_factory=list)  # initial, must go, is cut short
    chars: int = 0

    def add(self, turn: int | None, role: str, text: str, blank: bool, cut: bool, seen: bool) -> None:
        initial = role[:1]
        if self.initials:
            self.counts[4] += self.initials[1] + initial not in _LEGAL_PAIRS
        self.initials = [self.initials[0] if self.initials else initial, initial]
        if turn is not None:
            if not self.turns:
                self.turns = [turn, turn, 1]
            elif turn != self.turns[1]:
                self.turns[1:] = [turn, self.turns[2] + 1]
        self.counts[0] += 1
        if blank or seen or cut:
            self.counts[1 if blank else 2 if seen else 3] += 1
        gone = blank or seen
        self.lines.append(None if gone else {"role": role, "text": text})
        self.steps.append((initial, gone, cut))
        self.chars += 0 if gone else len(text)

    @property
    def full(self) -> bool:
        return len(self.steps) >= BLOCK or self.chars >= BLOCK_CHARS

    def paths(self, entries: tuple[int, ...]) -> list[dict]:
        """The cheapest audit from every entry state to every state it can leave the block in."""
        found = []
        for entry in entries:
            edits = Edits()
            best = {entry: (0, 0)}
            for initial, gone, cut in self.steps:
                best = _step(edits, _inserted(edits, best), initial, gone, cut)
            found += [
                {"entry": entry, "exit": state, "cost": cost, "audit": edits.text(node)}
                for state, (cost, node) in best.items()
            ]
        return found


def _step(
    edits: Edits, best: dict[int, tuple[int, int]], initial: str, gone: bool, cut: bool
) -> dict[int, tuple[int, int]]:
    """The cheapest edits after one more message."""
    more = TRUNCATED_COST if cut else 0
    ways: dict[int, list[tuple[int, int, str]]] = {}
    for state, (cost, node) in best.items():
        ways.setdefault(state, []).append((cost + DELETE_COST, node, DELETE))
        if gone:
            continue
        target, follows = _AFTER.get(initial, (None, ()))
        if state in follows:
            ways.setdefault(target, []).append((cost + more, node, KEEP))
        turned = _ASSISTANT if state == _USER else _USER
        ways.setdefault(turned, []).append((cost + REROLE_COST + more, node, REROLE))
    return {state: _cheapest(edits, found) for state, found in ways.items()}


def _cheapest(edits: Edits, ways: list[tuple[int, int, str]]) -> tuple[int, int]:
    least = min(cost for cost, _, _ in ways)
    best = None
    for cost, parent, letter in ways:
        if cost == least:
            node = edits.add(parent, letter)
            if best is None or edits.smaller(node, best):
                best = node
    return least, best


def _inserted(edits: Edits, best: dict[int, tuple[int, int]]) -> dict[int, tuple[int, int]]:
    """The same with messages inserted before the next one, where that leads to a state cheaper."""
    best = dict(best)
    # Two in a row can be of use after nothing or the system only; every further one costs more.
    for _ in range(2):
        for state, (cost, node) in sorted(best.items(), key=lambda item: item[1][0]):
            target = _ASSISTANT if state == _USER else _USER
            known = best.get(target)
            if known is not None and known[0] < cost + INSERT_COST:
                continue
            added = edits.add(node, INSERT)
            if known is None or known[0] > cost + INSERT_COST or edits.smaller(added, known[1]):
                best[target] = (cost + INSERT_COST, added)
    return best


class _Joined:
    """The audit of a conversation from the paths of its blocks, and then its repaired messages.

    Each block adds one link to a way, so ways are compared from the link on that they share.
    """

    def __init__(self) -> None:
        self._best: dict[int, tuple[int, tuple | None]] = {_EMPTY: (0, None)}
        self._counts, self._initial = [0, 0, 0, 0, 0], None
        self._turns: list[int] = []

    def add(self, counts: list[int], turns: list[int], initials: list[str], paths: list[dict]) -> None:
        if not counts[0]:
            return
        if self._initial is not None:
            self._counts[4] += self._initial + initials[0] not in _LEGAL_PAIRS
        self._initial = initials[1]
        self._counts = [a + b for a, b in zip(self._counts, counts)]
        if turns and self._turns:
            self._turns = [self._turns[0], turns[1], self._turns[2] + turns[2] - (self._turns[1] == turns[0])]
        elif turns:
            self._turns = list(turns)
        best: dict[int, tuple[int, tuple]] = {}
        for path in paths:
            before = self._best.get(path["entry"])
            if before is None:
                continue
            cost, link = before[0] + path["cost"], (before[1], path["entry"], path["audit"])
            known = best.get(path["exit"])
            if known is None or cost < known[0] or cost == known[0] and _earlier(link, known[1]):
                best[path["exit"]] = (cost, link)
        self._best = best

    def finish(self) -> tuple[list[int], list[tuple[int, str]], str]:
        """gaps, faults and cost; entry state and audit of every block; letters inserted at the end."""
        ends = []
        for state, (cost, link) in self._best.items():
            # What is left open is closed by the messages still missing.
            missing = {_EMPTY: 0, _SYSTEM: 2, _USER: 1, _ASSISTANT: 0}[state]
            ends.append((cost + missing * INSERT_COST, INSERT * missing, link))
        least = min(cost for cost, _, _ in ends)
        tail, link = None, None
        for cost, letters, way in ends:
            if cost == least and (tail is None or _earlier((way, 0, letters), (link, 0, tail))):
                tail, link = letters, way
        blocks = []
        while link is not None:
            link, entry, audit = link
            blocks.append((entry, audit))
        first, last, distinct = self._turns or [0, 0, 1]
        gaps = last - first + 1 - distinct
        return [gaps, *self._counts[1:], least], blocks[::-1], tail


def _earlier(a: tuple | None, b: tuple | None) -> bool:
    """Whether the letters of one way come before those of another of as many blocks."""
    left, right = [], []
    while a is not b and a is not None and b is not None:
        left.append(a[2])
        right.append(b[2])
        a, b = a[0], b[0]
    return "".join(reversed(left)) < "".join(reversed(right))


class _Writer:
    """Repaired messages of a conversation in order."""

    def __init__(self) -> None:
        self.state = _EMPTY

    def write(self, audit: str, lines: list[dict | None]) -> Iterator[tuple[str, str, str]]:
        """Edit, role and text of every message that the audit leaves; lines that must go may be None."""
        place = 0
        for letter in audit:
            line = None
            if letter != INSERT:
                line, place = lines[place], place + 1
            if letter == DELETE:
                continue
            if letter == KEEP:
                self.state = _AFTER[line["role"][0]][0]
                yield letter, line["role"], line["text"]
            else:
                self.state = _ASSISTANT if self.state == _USER else _USER
                yield letter, _ROLES[self.state], line["text"] if line else ""


def audit(messages: DataFrame) -> DataFrame:
    """One row per conversation: its faults, the least cost of a repair, the audit and a hash of the repaired text.

    messages: conv_id, turn, role, text and optionally copies, how often a row stands (a conversation all whose rows stand
    no time still has its row). Null role and text read as one space. Rows stand in the order of turn, null first, then
    of role and text; equal rows follow one another. Faults: blank, duplicate (the role and text of an earlier row),
    truncated (without a mark at its end); a row counts with the first that holds. A role whose initial is not s, u or a
    cannot be kept. Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. Rows with null
    conv_id are one conversation. Without rows: zeros, an empty audit, the hash of an empty text. Other columns are left out.
    """
    return _rejoined(_solved(messages), "audit")


def repaired(messages: DataFrame) -> DataFrame:
    """The messages of repaired conversations: conv_id, place from 0, edit (K, R or I), role and text."""
    return _rejoined(_solved(messages), "messages")


def damage_code(conv_id: str, turn: str, codes: int) -> Column:
    """crc32 of conv_id:turn modulo codes; a null reads as one space."""
    parts = [F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in (conv_id, turn)]
    return F.crc32(F.concat(parts[0], F.lit(":"), parts[1]).cast("binary")) % codes


def _solved(messages: DataFrame) -> DataFrame:
    """Blocks of conversations with the cheapest edits between any states they are entered and left in."""
    copies = F.col("copies") if "copies" in messages.columns else F.lit(1)
    read = messages.select(
        "conv_id",
        "turn",
        *[F.coalesce(name, F.lit(" ")).alias(name) for name in ("role", "text")],
        copies.cast("long").alias("copies"),
    )
    order = F.struct(F.col("turn").isNotNull(), "turn")
    full = F.length(F.btrim("text", F.lit(BLANKS))) > 0
    # Texts said in more than one turn, known by a digest; other repeats are copies of one row.
    said = (
        read.filter((F.col("copies") > 0) & full)
        .groupBy("conv_id", "role", F.sha2(F.col("text").cast("binary"), 256).alias("said"))
        .agg(F.min(order).alias("first"), F.max(order).alias("last"))
        .filter(F.col("first") != F.col("last"))
    )
    rows = read.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    rows = rows.withColumn("said", F.sha2(F.col("text").cast("binary"), 256))
    same = (
        F.col("r.conv_id").eqNullSafe(F.col("s.conv_id"))
        & (F.col("r.role") == F.col("s.role"))
        & (F.col("r.said") == F.col("s.said"))
    )
    body = F.btrim("text", F.lit(BLANKS))
    marked = rows.alias("r").join(said.alias("s"), same, "left").select(
        "r.conv_id",
        "turn",
        "r.role",
        "text",
        "copies",
        (F.length(body) == 0).alias("blank"),
        (~F.right(body, F.lit(1)).isin(*ENDS)).alias("cut"),
        F.coalesce(order > F.col("first"), F.lit(False)).alias("later"),
    )
    keys = ("conv_id", "turn", "role", "text")
    return checkpointed(marked.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(_solve, _BLOCK))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of one range of messages.

    Only the first conversation of a range can have begun before it, so only its blocks, and the later blocks of one that is
    cut, are solved for every entry.
    """
    part = TaskContext.get().partitionId()
    schema = _arrow_schema()
    out: list[dict] = []
    conv, block, number, first_conv = None, None, 0, True

    def put() -> None:
        entries = (_EMPTY, _SYSTEM, _USER, _ASSISTANT) if first_conv or number else (_EMPTY,)
        out.append(
            {
                "conv_id": conv,
                "part": part,
                "block": number,
                "counts": block.counts,
                "turns": block.turns,
                "initials": block.initials,
                "paths": block.paths(entries),
                "lines": block.lines,
            }
        )

    held = 0
    for conv_id, turn, role, text, copies, blank, cut, later in _rows(batches):
        if block is None or conv_id != conv:
            if block is not None:
                put()
                held += block.chars + 64 * len(block.steps)
                first_conv = False
            conv, block, number = conv_id, _Block(), 0
        for copy in range(copies):
            if block.full:
                put()
                held += block.chars + 64 * len(block.steps)
                block, number = _Block(), number + 1
            block.add(turn, role, text, blank, cut, later or copy > 0)
        if held > BLOCK_CHARS:
            yield pa.RecordBatch.from_pylist(out, schema)
            out.clear()
            held = 0
    if block is not None:
        put()
    yield pa.RecordBatch.from_pylist(out, schema)


def _arrow_schema() -> pa.Schema:
    path = pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    line = pa.struct([("role", pa.string()), ("text", pa.string())])
    return pa.schema(
        [
            ("conv_id", pa.int64()),
            ("part", pa.int32()),
            ("block", pa.int32()),
            ("counts", pa.list_(pa.int64())),
            ("turns", pa.list_(pa.int64())),
            ("initials", pa.list_(pa.string())),
            ("paths", pa.list_(path)),
            ("lines", pa.list_(line)),
        ]
    )


def _rejoined(blocks: DataFrame, what: str) -> DataFrame:
    """All blocks of a conversation in order, first without their messages to choose the ways, then with them."""
    names = blocks.columns
    none = F.lit(None)
    ways = blocks.select(F.lit(0).alias("kind"), *names[:-1], none.cast(blocks.schema["lines"].dataType).alias("lines"))
    lines = blocks.select(
        F.lit(1).alias("kind"),
        *names[:3],
        *[none.cast(blocks.schema[name].dataType).alias(name) for name in names[3:-1]],
        "lines",
    )
    order = ("conv_id", "kind", "part", "block")
    streamed = ways.unionByName(lines).repartition("conv_id").sortWithinPartitions(*order)
    if what == "audit":
        return streamed.mapInArrow(_audits, _RESULT)
    return streamed.mapInArrow(_repaired, _MESSAGES)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """conv_id, counts, audit of each block with its entry, tail and an iterator over blocks' messages."""
    rows = _rows(batches)
    row = next(rows, None)
    while row is not None:
        conv, joined = row[1], _Joined()
        while row is not None and row[1] == conv and row[0] == 0:
            joined.add(*row[4:8])
            row = next(rows, None)
        counts, chosen, tail = joined.finish()

        def blocks():
            nonlocal row
            place = 0
            while row is not None and row[1] == conv and row[0] == 1:
                if row[8]:
                    yield chosen[place][1], row[8]
                    place += 1
                row = next(rows, None)
            yield tail, []

        left = blocks()
        yield conv, counts, chosen, tail, left
        for _ in left:
            pass


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64()] * 7 + [pa.string()] * 2
    names = [part.split()[0] for part in _RESULT.split(", ")]
    out = []

    def batch() -> pa.RecordBatch:
        columns = [pa.array([row[i] for row in out], kind) for i, kind in enumerate(types)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    for conv, counts, chosen, tail, blocks in _conversations(batches):
        digest, writer, started = sha256(), _Writer(), False
        for letters, lines in blocks:
            for _, role, text in writer.write(letters, lines):
                digest.update(f"{chr(10) * started}{role}:{text}".encode())
                started = True
        letters = "".join(audit for _, audit in chosen) + tail
        out.append((conv, *counts, letters, digest.hexdigest()))
        if len(out) == BLOCK:
            yield batch()
            out.clear()
    yield batch()


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for conv, _, _, _, blocks in _conversations(batches):
        writer, place = _Writer(), 0
        for letters, lines in blocks:
            written = list(writer.write(letters, lines))
            columns = {
                "conv_id": pa.array([conv] * len(written), pa.int64()),
                "place": pa.array(range(place, place + len(written)), pa.int64()),
                **{name: pa.array([w[i] for w in written], pa.string()) for i, name in enumerate(("edit", "role", "text"))},
            }
            place += len(written)
            yield pa.RecordBatch.from_pydict(columns)
