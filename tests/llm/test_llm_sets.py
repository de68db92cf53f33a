"""Similarity join, mixing, packing and license scans against brute force and SQL."""

import itertools
import re
from collections import defaultdict
from hashlib import md5
from math import floor

import numpy as np
import pytest

from comparison import TESTDATA, assert_same
from llm_cases import LONG, ODD, SCHEMA, no_documents, odd_documents, rows_of
from tidemark.llm import jaccard_join, licenses, mixing, packing
from tidemark.llm._tables import table
from tidemark.llm.queries import op3_packing, op8_mixing, op9_jaccard_join, op10_license_scan
from tidemark.llm.sql import ORACLE_SQL


def documents(spark, texts, source="s"):
    rows = [(i, t, "en", source, 0, "", "", "", "", "") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


# Similarity join


def shingles(text):
    words = re.findall(r"\w+", (text or "").lower().replace("_", " "))
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_classes(rows):
    """doc_id, class_id, n_links and kept of rows (doc_id, text), by comparing all pairs."""
    sets = [shingles(t) if i is not None else set() for i, t in rows]
    links = defaultdict(set)
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            links[a].add(b)
            links[b].add(a)
    low = {n: i for n, (i, _) in enumerate(rows)}
    moved = True
    while moved:
        moved = False
        for n, partners in links.items():
            least = min([low[n], *(low[m] for m in partners)])
            moved |= least < low[n]
            low[n] = least
    return [(i, low[n], len(links[n]), i is None or i == low[n]) for n, (i, _) in enumerate(rows)]


def near_copies(rng):
    """Groups of texts with a few words changed, some of them far enough apart not to link."""
    texts = []
    for group in range(4):
        base = [f"w{x}" for x in rng.integers(0, 500, 60)]
        for _ in range(40):
            words = list(base)
            for at in rng.integers(0, 60, rng.integers(0, 3)):
                words[at] = f"x{rng.integers(0, 9)}"
            texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("block", [256, 5])
def test_classes_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "VALUE_BLOCK", block)
    monkeypatch.setattr(jaccard_join, "SET_BLOCK", block)
    texts = near_copies(np.random.default_rng(8))
    found = sorted(tuple(r) for r in jaccard_join.similarity_classes(documents(spark, texts)).collect())
    assert found == sorted(brute_classes(list(enumerate(texts))))


def test_classes_of_odd_rows(spark):
    rows = [(r[0], r[1]) for r in ODD if r[1] != LONG]
    df = odd_documents(spark)
    found = [tuple(r) for r in jaccard_join.similarity_classes(df).collect()]
    assert (3, 3, 0, True) in found
    found.remove((3, 3, 0, True))
    assert sorted(found, key=str) == sorted(brute_classes(rows), key=str)
    assert jaccard_join.similarity_classes(no_documents(spark)).count() == 0


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_classes_equal_sql(spark, scale):
    folder = TESTDATA / scale
    assert assert_same(op9_jaccard_join(spark, str(folder)), folder, ORACLE_SQL["op9_jaccard_join"]) > 0


def test_pruning_keeps_similar_pairs_and_drops_others():
    rng = np.random.default_rng(4)
    n = jaccard_join.BANDS * jaccard_join.BAND
    for similarity, least, most in ((0.8, 0.9999, 1), (0.9, 0.9999, 1), (0.3, 0, 0.01)):
        base = rng.integers(0, 1 << 30, (20_000, n))
        other = np.where(rng.random((20_000, n)) < similarity, base, -1)
        kept = jaccard_join.likely(np.concatenate([base, other]), np.arange(20_000), np.arange(20_000, 40_000), 0.8)
        assert least <= kept.mean() <= most


# Mixing


def brute_mix(rows):
    """taken, source_size and target of rows (doc_id, text, source) by sorting."""
    sizes = [len(re.findall("[^\\x20\\x09-\\x0D]+", t or "")) for _, t, _ in rows]
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(n for n, r in zip(sizes, rows) if r[2] == s) for s in sources}
    weight = {s: 1 + i % 3 for i, s in enumerate(sources)}
    full, stopped = sum(total.values()), set()
    while True:
        left = full - sum(3 * total[s] for s in stopped)
        shares = sum(weight[s] for s in sources if s not in stopped)
        over = {s for s in sources if s not in stopped and left * weight[s] >= 3 * total[s] * shares}
        if not over:
            break
        stopped |= over
    target = {s: 3.0 * total[s] if s in stopped else float(left) * weight[s] / shares for s in sources}
    result = {}
    for s in sources:
        repeats = floor(target[s] / total[s]) if total[s] else 0
        wanted = floor(target[s]) - repeats * total[s]
        by_hash = defaultdict(list)
        for n, (i, _, source) in enumerate(rows):
            if source == s:
                by_hash[int(md5(str("null" if i is None else i).encode()).hexdigest()[:15], 16)].append(n)
        for h in sorted(by_hash):
            group = sum(sizes[n] for n in by_hash[h])
            for n in by_hash[h]:
                part = sizes[n] if group <= wanted else floor(sizes[n] * max(0, wanted) / group) if group else 0
                result[n] = (rows[n][0], sizes[n], total[s], target[s], repeats * sizes[n] + part)
            wanted = wanted - group if group <= wanted else 0
    return [result[n] for n in range(len(rows))]


COLUMNS = ("doc_id", "size", "source_size", "target", "taken")


def test_mix_equals_sorting(spark):
    rng = np.random.default_rng(6)
    rows = [(i, "w " * int(n), f"s{s}") for i, (n, s) in enumerate(zip(rng.integers(0, 90, 400), rng.choice(7, 400, p=[0.4, 0.3, 0.2, 0.05, 0.03, 0.01, 0.01])))]
    df = spark.createDataFrame([(i, t, "", s, 0, "", "x", "", "", "") for i, t, s in rows], SCHEMA)
    found = sorted(rows_of(mixing.mix(df), *COLUMNS))
    assert found == sorted(brute_mix(rows))
    assert sorted(rows_of(mixing.mix_ids(df), *COLUMNS)) == found
    for s in {r[2] for r in rows}:
        own = [x for r, x in zip(rows, brute_mix(rows)) if r[2] == s]
        assert abs(sum(x[4] for x in own) - own[0][3]) < 1


def test_mix_of_odd_rows(spark):
    rows = [(r[0], r[1], r[3]) for r in ODD]
    found = sorted(rows_of(mixing.mix(odd_documents(spark)), *COLUMNS), key=str)
    assert found == sorted(brute_mix(rows), key=str)
    assert mixing.mix(no_documents(spark)).count() == 0
    assert mixing.mix_ids(documents(spark, ["", None])).count() == 2


def test_mix_with_many_sources_is_joined_by_shuffle(spark, monkeypatch):
    df = documents(spark, ["a b", "c", "d e f"])
    expected = sorted(rows_of(mixing.mix(df), *COLUMNS))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(rows_of(mixing.mix(df), *COLUMNS)) == expected


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_mix_equals_sql(spark, scale):
    folder = TESTDATA / scale
    assert assert_same(op8_mixing(spark, str(folder)), folder, ORACLE_SQL["op8_mixing"]) > 0


# Packing


def test_bounds_need_the_least_padding():
    rng = np.random.default_rng(0)
    for _ in range(40):
        lengths = np.unique(rng.integers(1, 60, 9))
        counts = rng.integers(1, 9, len(lengths))
        bounds, padding = packing.optimal_bounds(lengths, counts, lengths * counts, 4)
        best = min(
            sum(lengths[b - 1] * counts[a:b].sum() - (lengths * counts)[a:b].sum() for a, b in zip((0, *cut), (*cut, len(lengths))))
            for k in range(min(4, len(lengths)))
            for cut in itertools.combinations(range(1, len(lengths)), k)
        )
        assert padding == best
        assert sum((min(x for x in bounds if x >= n) - n) * c for n, c in zip(lengths, counts)) == best


def check_packed(rows, budget):
    batches = defaultdict(list)
    for _, n, bucket, tokens, batch, slot in rows:
        assert n <= tokens
        batches[bucket, batch].append(slot)
        fits = max(1, budget // max(tokens, 1))
        assert slot < fits
    for (bucket, batch), slots in batches.items():
        assert sorted(slots) == list(range(len(slots)))
        if (bucket, batch + 1) in batches:
            tokens = next(r[3] for r in rows if r[2] == bucket)
            assert len(slots) == max(1, budget // max(tokens, 1))
    for bucket in {b for b, _ in batches}:
        assert sorted(x for b, x in batches if b == bucket) == list(range(sum(b == bucket for b, _ in batches)))


PACKED = ("doc_id", "n_tokens", "bucket", "bucket_tokens", "batch", "slot")


def test_packed_table(spark):
    rows = rows_of(op3_packing(spark, str(TESTDATA / "sf0.1")), *PACKED)
    expected = {r.doc_id: len(r.text.split()) for r in table(spark, str(TESTDATA / "sf0.1"), "documents").collect()}
    assert {r[0]: r[1] for r in rows} == expected and len(rows) == len(expected)
    assert {r[2] for r in rows} == set(range(1, packing.BUCKETS + 1))
    check_packed(rows, packing.BATCH_TOKENS)
    lengths, counts = np.unique(list(expected.values()), return_counts=True)
    exact = packing.optimal_bounds(lengths, counts, lengths * counts, packing.BUCKETS)[1]
    # Cells above 512 words are ranges; their bounds cost next to nothing.
    assert sum(r[3] - r[1] for r in rows) <= 1.01 * exact


def test_packing_by_shards_with_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 2)
    rows = rows_of(packing.pack(odd_documents(spark), buckets=3, batch_tokens=16), *PACKED)
    assert sorted((str(r[0]), r[1]) for r in rows) == sorted((str(r[0]), len((r[1] or "").split())) for r in ODD)
    check_packed(rows, 16)
    assert {r[2] for r in rows if r[1] == 0} == {0}
    assert packing.pack(no_documents(spark)).count() == 0


def test_cells_are_few(spark):
    df = spark.range(1, 200_000, 7).withColumn("cell", packing.length_cell(mixing.F.col("id")))
    assert df.filter("id < 512").filter("cell <> id").count() == 0
    assert df.select("cell").distinct().count() < 512 * 10
    # Cells keep the order of lengths.
    ordered = [r.cell for r in df.orderBy("id").collect()]
    assert ordered == sorted(ordered)


# Licenses


def brute_places(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    found = []
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    return len(words), sorted(found)


def test_scanned_table(spark):
    folder = str(TESTDATA / "sf0.01")
    texts = {r.doc_id: r.text for r in table(spark, folder, "documents").collect()}
    rows = op10_license_scan(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        words, places = brute_places(texts[r.doc_id])
        labels = sorted({label for _, label in places})
        assert (r.n_words, r.n_base, r.base_labels) == (words, len(places), ",".join(labels))
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert set(labels) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert sum(r.n_base for r in rows) > 0


@pytest.mark.parametrize(
    "text, labels",
    [
        ("x MIT-License, mit\nlicense y", {"mit"}),
        ("Relesed under the MIT lisence, all of it", {"mit"}),
        ("This is free and unencumberd software relesed into the public domain now", {"unlicense"}),
        ("licencsed under creative comons atribution is not enough", set()),
        ("licensed undr the creative comons atribution", {"cc"}),
        ("licensed by nobody under the sun", set()),
        ("General Public  License é", {"gpl"}),
        ("released under the BSD license", {"bsd"}),
        ("licensed under the bsd license", {"bsd"}),
        ("Licensed under the ISC license", set()),
        ("licensed under the gpl license", set()),
        ("Licensed under the W3C license", set()),
        ("released under the new license", set()),
        ("released under the Zlib license", set()),
        ("we are licensed under a by-law", set()),
        ("we are licensed under CC-BY", {"cc"}),
        ("under the terms of the GNU Lesser General Public License", {"gpl", "lgpl"}),
        ("under the terms of the Mozila Public License", set()),
        ("subject to the terms of the Mozila Public License", {"mpl"}),
        ("licensed under the bsd licensed undr teh mit license", {"mit", "bsd"}),
        ("licensed under the Apach License, Version 2.0", {"apache"}),
    ],
)
def test_notices_with_edits(text, labels):
    scanner = licenses.Scanner()
    flat, _ = scanner.normalised(text)
    found = {m.label for m in scanner.fuzzy(flat)} | {label for _, label in scanner.places(flat)}
    assert found == labels


def test_fuzzy_places_equal_search_without_seeds():
    rng = np.random.default_rng(5)
    scanner = licenses.Scanner()
    for n in scanner.notices:
        for _ in range(5):
            chars = list(n.text)
            for at in rng.choice(len(chars), rng.integers(0, n.edits + 2), replace=False):
                chars[at] = "q"
            flat, _ = scanner.normalised("the one " + "".join(chars) + " and more")
            plain = n.pattern.search(flat.decode("latin-1"))
            plain = plain and n.named(f" {plain.group()} ")
            found = [m for m in scanner.fuzzy(flat) if m.label == n.label and m.edits <= n.edits]
            assert bool(found) >= bool(plain)
            if plain:
                assert min(m.first_word for m in found) <= 2


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left = [i]
        for j, y in enumerate(b, 1):
            left.append(min(row[j] + 1, left[-1] + 1, row[j - 1] + (x != y)))
        row = left
    return row[-1]


def brute_notices(text):
    """Labels of all runs of words that are near a notice and hold its names, without seeds or patterns."""
    words = text.lower().split()
    hits = []
    for notice, label in licenses.NOTICES.items():
        names = [x for x in licenses.NAMES if f" {x} " in f" {notice} "]
        bound = len(notice) // licenses.CHARS_PER_EDIT
        for i in range(len(words)):
            for j in range(i + 1, len(words) + 1):
                run = " ".join(words[i:j])
                if abs(len(run) - len(notice)) > bound:
                    continue
                edits = edit_distance(run, notice)
                if edits <= bound and all(near_name(words[i:j], x) for x in names):
                    hits.append((i, j, edits, label))
    return {a[3] for a in hits if not any(b[3] != a[3] and b[2] < a[2] and b[0] < a[1] and a[0] < b[1] for b in hits)}


def near_name(words, name):
    bound = 1 if len(name) >= licenses.LONG_NAME else 0
    runs = (" ".join(words[i:j]) for i in range(len(words)) for j in range(i + 1, len(words) + 1))
    return any(abs(len(run) - len(name)) <= bound and edit_distance(run, name) <= bound for run in runs)


def test_notices_equal_brute_force():
    rng = np.random.default_rng(11)
    scanner = licenses.Scanner()
    others = ["isc", "zlib", "w3c", "new", "mit", "bsd", "gpl", "apache", "mozilla", "by", "cc"]
    marked = 0
    for notice in [*licenses.NOTICES] * 3:
        words = notice.split()
        if rng.random() < 0.6:
            words[rng.integers(len(words))] = str(rng.choice(others))
        chars = list(" ".join(words))
        for at in rng.choice(len(chars), rng.integers(0, 3), replace=False):
            chars[at] = str(rng.choice(["", "x", "e"])) if chars[at] != " " else " "
        text = "some words " + "".join(chars) + " and more"
        found = {m.label for m in scanner.fuzzy(scanner.normalised(text)[0])}
        assert found == brute_notices(text), text
        marked += bool(found)
    assert marked > 10


def test_licenses_of_odd_rows(spark):
    rows = rows_of(licenses.scan(odd_documents(spark)), "doc_id", "text", "n_words", "n_base", "labels", "score", "node")
    assert len(rows) == len(ODD)
    assert all(r[2] == brute_places(r[1])[0] and r[3:6] == (0, "", 0.0) and r[6] in ("clash", None) for r in rows)
    assert licenses.scan(no_documents(spark)).count() == 0


def test_every_place_of_a_notice_that_repeats():
    """Long stretches are searched in pieces: no place is lost at their borders, none is found twice."""
    scanner = licenses.Scanner([("licensed under the bsd license", "bsd")])
    for unit, edits in (("licensed under the bsd license", 0), ("licensd under the bsd licence", 2)):
        for gap in ("", " then other words stand here"):
            words = len((unit + gap).split())
            flat, _ = scanner.normalised(f"{unit}{gap} " * 60)
            found = scanner.fuzzy(flat)
            assert [m.first_word for m in found] == [words * i for i in range(60)]
            assert {m.edits for m in found} == {edits}


def test_best_of_overlapping_matches():
    assert licenses.disjoint([(0, 10, 2), (1, 9, 0), (9, 20, 1), (9, 20, 1)]) == [(1, 9, 0), (9, 20, 1)]


def test_texts_of_rare_letters_link_with_their_copies_alone(spark):
    one, two = ("".join(chr(first + 41 * i) for i in range(30)) for first in (0x20000, 0x20100))
    rows = [(1, one), (2, one), (3, two)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = rows_of(jaccard_join.similarity_classes(frame), "doc_id", "class_id", "n_links", "kept")
    assert sorted(found) == [(1, 1, 1, True), (2, 1, 1, False), (3, 3, 0, True)]
