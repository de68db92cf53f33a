"""Manifests, repaired conversations and line dedup against plain versions on small and odd tables."""

import hashlib
import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from comparison import TESTDATA, assert_same
from llm_cases import SCHEMA, no_documents, odd_documents
from tidemark.llm import conversations, line_dedup, merkle
from tidemark.llm.queries import QUERIES
from tidemark.llm.sql import ORACLE_SQL


@pytest.mark.parametrize("name", ["op11_merkle", "op12_conversation_repair", "op13_line_dedup"])
@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, name, scale):
    folder = TESTDATA / scale
    assert assert_same(QUERIES[name](spark, str(folder)), folder, ORACLE_SQL[name]) > 0


# Manifest


def _h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def _plain_tree(nodes):
    """Levels of a tree, leaves first."""
    levels = [list(nodes)]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([_h(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def _plain_path(levels, place):
    steps = []
    for level in levels[:-1]:
        beside = place ^ 1
        if beside >= len(level):
            steps.append("=")
        else:
            steps.append(("<" if place & 1 else ">") + level[beside])
        place >>= 1
    return steps


def _plain_manifest(rows):
    """(group, leaf) to the sorted proofs of its rows, and the root."""
    groups = defaultdict(list)
    for group, key, leaf in rows:
        groups[group].append((key is not None, key or 0, leaf))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: _plain_tree([leaf for *_, leaf in sorted(groups[g])]) for g in names}
    top = _plain_tree([trees[g][-1][0] for g in names])
    found = []
    for place, g in enumerate(names):
        above = _plain_path(top, place)
        for i, (_, _, leaf) in enumerate(sorted(groups[g])):
            found.append((g, leaf, trees[g][-1][0], top[-1][0], tuple(_plain_path(trees[g], i) + above)))
    return sorted(found, key=repr)


@pytest.mark.parametrize("small_blocks", [False, True])
def test_manifest_equals_a_plain_tree(spark, small_blocks):
    sizes = {"en": 37, None: 1, "de": 8, "": 2, "zz": 5, "é": 33, "a": 64}
    rows = [(g, i // 2 if g == "en" else i, _h(str(g), str(i // 3))) for g, n in sizes.items() for i in range(n)]
    rows += [("en", None, _h("x")), ("en", None, _h("x"))]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, k long, leaf string")
    # Tasks see the sizes of blocks only through what is sent to them.
    made = merkle.manifest(df, "leaf", "g", ["k"], levels=2 if small_blocks else merkle.LEVELS)
    got = sorted(((r.g, r.leaf, r.subroot, r.root, tuple(r.proof)) for r in made.collect()), key=repr)
    assert got == _plain_manifest(rows)
    folded = made.select(merkle.folded(F.col("leaf"), "proof").alias("f"), "root", merkle.proof_digest("proof").alias("p"), "proof")
    for r in folded.collect():
        assert r.f == r.root and r.p == _h(*[step[1:] for step in r.proof])


def test_manifest_of_odd_rows(spark):
    odd = odd_documents(spark).withColumn("proof", F.lit("clash")).withColumn("tree", F.lit(1)).withColumn("row", F.lit(2))
    leaf = merkle.digest_of(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.col("text"))
    made = merkle.manifest(odd.withColumn("leaf", leaf), "leaf", "lang", ["doc_id"])
    rows = made.collect()
    assert len(rows) == odd.count() and set(odd.columns) <= set(made.columns)
    assert len({r.root for r in rows}) == 1
    nothing = next(r for r in rows if r.doc_id is None and r.text is None)
    assert nothing.leaf == _h("-----")
    four = [r for r in rows if r.doc_id == 4]
    text = "One small text with seven words in."
    assert {r.leaf for r in four} == {_h("1:4", "1:b", "2:en", "-", f"{len(text)}:{text}")} and len(four) == 2
    empty = no_documents(spark).withColumn("leaf", leaf)
    assert merkle.manifest(empty, "leaf", "lang", ["doc_id"]).count() == 0


def test_altered_leaf_is_found(spark):
    rows = QUERIES["op11_merkle"](spark, str(TESTDATA / "sf0.001")).collect()
    assert {r.doc_id for r in rows if not r.verified} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 7 == 0}


# Conversations


def _plain_repair(rows):
    """All sequences of edits, by brute force over rows (role, text) in order: least cost, least audit, messages."""
    seen, faults = set(), []
    for role, text in rows:
        body = text.strip(conversations.BLANKS)
        faults.append("blank" if not body else "dup" if (role, text) in seen else "cut" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    best = None

    def legal(roles):
        rest = roles[1:] if roles[:1] == "s" else roles
        return not roles or (len(rest) > 0 and rest == "ua" * (len(rest) // 2))

    def search(i, cost, letters, out):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(rows):
            if legal("".join(role[:1] for role, _ in out)):
                candidate = (cost, letters, out)
                best = candidate if best is None or candidate[:2] < best[:2] else best
        roles = "".join(role[:1] for role, _ in out)
        # Only beginnings of legal sequences are followed.
        if out and not any(legal(roles + tail) for tail in ("", "a", "ua")):
            return
        if len(out) < len(rows) + 3:
            for role in ("user", "assistant"):
                search(i, cost + 3, letters + "I", [*out, (role, "")]) if letters[-2:] != "II" else None
        if i < len(rows):
            role, text = rows[i]
            search(i + 1, cost + 4, letters + "D", out)
            if faults[i] not in ("blank", "dup"):
                more = 3 if faults[i] == "cut" else 0
                if role[:1] in ("s", "u", "a"):
                    search(i + 1, cost + more, letters + "K", [*out, (role, text)])
                for other in ("user", "assistant"):
                    search(i + 1, cost + 3 + more, letters + "R", [*out, (other, text)])

    best = (4 * len(rows) + 1, "~", [])
    search(0, 0, "", [])
    return best, faults


def test_repairs_are_the_cheapest(spark):
    random.seed(5)
    roles = ["user", "assistant", "system", "tool", "", "user"]
    texts = ["Yes.", "No", "Well then!", "", "  ", "Is it?", "Fine."]
    tables = {c: [(random.choice(roles), random.choice(texts)) for _ in range(random.randint(1, 5))] for c in range(120)}
    rows = [(c, t, *row) for c, found in tables.items() for t, row in enumerate(found)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in conversations.audit(df).collect()}
    messages = defaultdict(list)
    for r in conversations.repaired(df).orderBy("conv_id", "place").collect():
        messages[r.conv_id].append((r.role, r.text))
    for c, found in tables.items():
        (cost, audit, out), faults = _plain_repair(found)
        r = got[c]
        assert (r.cost, r.audit) == (cost, audit), (found, r)
        assert messages[c] == out
        assert r.repaired_sha256 == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in out).encode()).hexdigest()
        assert (r.blank, r.duplicate, r.truncated) == tuple(faults.count(f) for f in ("blank", "dup", "cut"))
        pairs = [a[0][:1] + b[0][:1] for a, b in itertools.pairwise(found)]
        assert r.illegal == sum(p not in ("su", "ua", "au") for p in pairs) and r.gaps == 0


def test_long_conversation_is_solved_in_blocks(spark):
    """A conversation of many blocks, dealt over many tasks, gives what one block gives."""
    rng = random.Random(9)
    roles = ["user", "assistant", "assistant", "user", "system", "x"]
    long = [(7, t if t % 50 else None, rng.choice(roles), rng.choice(["", f"Text {t}.", f"open {t}", "Again."])) for t in range(9000)]
    rows = [(c, t, rng.choice(roles), f"Say {t}.") for c in range(40) for t in range(3) if c != 7] + long
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    r = conversations.audit(df).filter("conv_id = 7").first()
    block, best, edits = conversations._Block(), {0: (0, 0)}, conversations.Edits()
    seen = set()
    for _, turn, role, text in sorted(long, key=lambda x: (x[1] is not None, x[1] or 0, x[2], x[3])):
        blank = not text.strip()
        block.add(turn, role, text, blank, not blank and text[-1] != ".", (role, text) in seen)
        seen.add((role, text))
    for step in block.steps:
        best = conversations._step(edits, conversations._inserted(edits, best), *step)
    ends = [(cost + 3 * n, edits.text(node) + "I" * n) for s, (cost, node) in best.items() for n in [[0, 2, 1, 0][s]]]
    assert (r.cost, r.audit) == min(ends)
    writer, out = conversations._Writer(), []
    for _, role, text in writer.write(r.audit, block.lines):
        out.append(f"{role}:{text}")
    assert r.repaired_sha256 == hashlib.sha256("\n".join(out).encode()).hexdigest()
    assert [r.blank, r.duplicate, r.truncated, r.illegal] == block.counts[1:]
    turns = {t for _, t, *_ in long if t is not None}
    assert r.gaps == max(turns) - min(turns) + 1 - len(turns)


def test_order_of_edits_does_not_rest_on_hashes(monkeypatch):
    rng = random.Random(2)
    for base in (conversations._BASE, 0):
        monkeypatch.setattr(conversations, "_BASE", base)
        if not base:
            monkeypatch.setattr(conversations, "_PRIME", 2)
        edits, nodes = conversations.Edits(), [0]
        for _ in range(400):
            nodes.append(edits.add(rng.choice(nodes[-30:]), rng.choice("DIKR")))
        for _ in range(2000):
            a, b = rng.choice(nodes), rng.choice(nodes)
            assert edits.smaller(a, b) == (edits.text(a) < edits.text(b))


def test_odd_conversations(spark):
    rows = [
        (None, None, None, None, "c"),
        (None, 1, "user", "Hello there.", "c"),
        (1, None, "system", "Be kind.", "c"),
        (1, 5, "user", "Long. " * 100_000, "c"),
        (1, 5, "user", "Long. " * 100_000, "c"),
        (1, 9, "assistant", "x" * 70_000 + ".", None),
        (2, 1, "", "No role.", "c"),
    ]
    schema = "conv_id long, turn long, role string, text string, cost string"
    df = spark.createDataFrame(rows, schema)
    got = {r.conv_id: r for r in conversations.audit(df).collect()}
    assert got[None].blank == 1 and got[None].audit == "DKI" and got[None].gaps == 0
    assert got[1].audit == "KKDK" and got[1].duplicate == 1 and got[1].gaps == 3 and got[1].cost == 4
    assert got[2].audit == "D" and got[2].repaired_sha256 == hashlib.sha256(b"").hexdigest()
    assert conversations.audit(spark.createDataFrame([], schema)).count() == 0
    none = df.filter("conv_id = 2").withColumn("copies", F.lit(0))
    r = conversations.audit(none).first()
    assert tuple(r)[:9] == (2, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


# Lines


def _plain_lines(rows):
    holders = defaultdict(set)
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            key = line_dedup.key_of(line)
            if len(key) >= 10:
                holders[key].add(doc_id)
    out = []
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        left = []
        for line in lines:
            ids = holders.get(line_dedup.key_of(line), ())
            first = min(ids, key=lambda d: (d is None, d)) if len(ids) > 1 else doc_id
            if first == doc_id:
                left.append(line)
        out.append((doc_id, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=repr)


def test_lines_of_odd_rows(spark):
    more = [
        (10, "A common line here\nown line of ten\nA COMMON line here \t\n", "en", "a", 0, *[None] * 5),
        (11, "\ta common line here\nshort\nshort\n\n", "en", "a", 0, *[None] * 5),
        (11, "a second row of eleven\na common line here", "en", "a", 0, *[None] * 5),
        (None, "A common line here\nonly rows without id", "en", "a", 0, *[None] * 5),
        (None, "only rows without id\nÄhnliche Zeile ÄÖ", "en", "a", 0, *[None] * 5),
        (12, "ähnliche Zeile ÄÖ\nÄhnliche zeile ÄÖ\x0b", "en", "a", 0, *[None] * 5),
        (13, "\n".join(["the same line again"] * 50_000), "en", "a", 0, *[None] * 5),
        (14, "the same line again\r\nfin", "en", "a", 0, *[None] * 5),
    ]
    df = odd_documents(spark).unionByName(spark.createDataFrame(more, SCHEMA)).withColumn("keys", F.lit("clash"))
    rows = [tuple(r) for r in df.collect()]
    got = sorted((tuple(r) for r in line_dedup.dedup_lines(df).collect()), key=repr)
    assert got == _plain_lines(rows)
    assert line_dedup.dedup_lines(no_documents(spark)).count() == 0


def _odd_texts():
    rng = random.Random(5)
    odd = ["", " " * 100, "\t" * 40 + "Many blanks around" + " " * 50, "123456789", "1234567890\r", "ÄÖÜäöüßéè", "日本語" * 3 + "日"]
    odd += ["\U0001f600" * 9, "\U0001f600" * 10, "\x0b\x0cform feeds \x85\u2028"]
    made = ["".join(rng.choice("abcXYZ äÖ\r日") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    texts = ["\n".join(rng.choice(odd + made) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    return ["", *texts, "\n\n", ("Long" * line_dedup.PIECE + " \n") * 2, "long" * line_dedup.PIECE]


@pytest.mark.parametrize("least_chars", [10, 1, 0])
def test_lines_found_in_bytes_are_the_plain_ones(least_chars):
    texts = pa.array(["Sliced off\nthe batch", *_odd_texts()])[1:]
    ids = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, texts], names=["doc_id", "text_hash", "text"])
    found = [tuple(r.values()) for b in line_dedup._keyed([batch], least_chars) for r in b.to_pylist()]
    lines = [(i, line_dedup.key_of(line)) for i, text in enumerate(texts.to_pylist()) for line in text.split("\n")]
    assert [(r[0], r[2]) for r in found] == [line for line in lines if len(line[1]) >= least_chars]
    # Equal keys have equal hashes, others do not, and those filed are the same.
    assert len({r[2] for r in found}) == len({r[2:] for r in found}) == len({r[3] for r in found}) == len({r[4] for r in found})
    filed = [tuple(r.values()) for b in line_dedup._hashed([batch], least_chars) for r in b.to_pylist()]
    assert filed == [r[3:] for r in found]


def test_lines_are_not_made_by_expressions(spark):
    """Spark computed the key of a line once to filter it and once more to pass it on, after a row for each line."""
    lines = line_dedup._lines(spark.createDataFrame([(1, "a line of some text")], "doc_id long, text string"), 10)
    physical = lines._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in physical and "Generate" not in physical and "trim" not in physical


def test_no_repeated_line_escapes_the_filters(spark):
    """Lines filed by many tasks: every repeated one is suspected, and few others."""
    rng = np.random.default_rng(3)
    hashes = rng.integers(-(2**63), 2**63 - 1, 40_000)
    hashes = np.concatenate([hashes, hashes[:4000]])
    rng.shuffle(hashes)
    lines = spark.createDataFrame([(int(h),) for h in hashes], "hash long").withColumn("spots", F.xxhash64("hash"))
    lines = lines.repartition(7).withColumn("key", F.col("hash").cast("string"))
    lines = lines.withColumn("doc_id", F.lit(1)).withColumn("text_hash", F.lit(2))
    cells = -(-len(hashes) * line_dedup.BITS_PER_LINE // line_dedup.CELL_BITS)
    found = line_dedup._suspects(lines, line_dedup.repeated_bits(lines, cells), cells)
    suspected = {int(r.key) for r in found.select("key").collect()}
    values, counts = np.unique(hashes, return_counts=True)
    repeated = set(values[counts > 1].tolist())
    assert repeated <= suspected and len(suspected - repeated) < 400


def test_hashes_are_shuffled_where_the_filter_is_large(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", 0)
    rows = [(i, f"line number {i % 5} of all\nline of its own {i}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in line_dedup.dedup_lines(df).collect()), key=repr)
    assert got == _plain_lines(rows)
