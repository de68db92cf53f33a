"""The pipeline against the same steps taken plainly on collected rows."""

from collections import Counter

import pytest

import corpus_pipeline
from comparison import TESTDATA
from llm_cases import ODD, no_documents, odd_documents, rows_of
from test_llm_sets import PACKED, brute_classes, brute_mix, check_packed
from tidemark.llm import quality, toxicity
from tidemark.llm._tables import table
from tidemark.llm.queries import quality_model, toxicity_model

STEPS = dict(corpus_pipeline.STAGES)
SF = str(TESTDATA / "sf0.01")
NAMES = ["doc_id", "text", "lang", "source", "n_chars"]


def plainly(spark, stage, docs):
    """The ids that a stage should keep, as often as it should."""
    rows = docs.collect()
    marks = table(spark, SF, "labels")
    if stage == "toxicity":
        scorer = toxicity.Scorer(toxicity_model(docs, marks))
        return Counter(r.doc_id for r in rows if scorer.score(r.text or "")[0] < toxicity.THRESHOLD)
    if stage == "quality":
        model = quality_model(docs, marks)
        kept = Counter()
        for r in rows:
            ids, _ = quality.hashed_features([r.text or ""])
            logits = model.vectors[ids].astype(float).mean(0) @ model.output + model.bias
            kept[r.doc_id] += 1 / (1 + 2.718281828459045 ** (logits[0] - logits[1])) >= quality.THRESHOLD
        return +kept
    if stage == "jaccard_join":
        return Counter(i for i, _, _, kept in brute_classes([(r.doc_id, r.text) for r in rows]) if kept)
    taken = brute_mix([(r.doc_id, r.text, r.source) for r in rows])
    times = Counter()
    for i, size, _, _, n in taken:
        times[i] += int(n / size + 0.5) if size else 0
    return +times


def test_stages_one_by_one_and_in_one_run(spark, tmp_path):
    docs = table(spark, SF, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "jaccard_join", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        assert after.columns == NAMES
        assert Counter(r[0] for r in rows_of(after, "doc_id")) == plainly(spark, name, docs)
        assert 0 < after.select("doc_id").distinct().count() < docs.count()
        docs = after
    rows = rows_of(STEPS["packing"](spark, docs, SF), *PACKED)
    assert Counter(r[0] for r in rows) == Counter(r[0] for r in rows_of(docs, "doc_id"))
    check_packed(rows, 65_536)
    run = rows_of(corpus_pipeline.run(spark, SF), *PACKED)
    assert sorted(run) == sorted(rows)


@pytest.mark.parametrize("name", STEPS)
def test_stages_bear_odd_rows(spark, name):
    after = STEPS[name](spark, odd_documents(spark), SF)
    if name != "packing":
        assert after.columns == odd_documents(spark).columns
        texts = {r[:2] for r in ODD}
        assert all((r[0], r[1]) in texts for r in rows_of(after, "doc_id", "text"))
    assert after.count() <= 3 * len(ODD)
    if name in ("toxicity", "packing"):
        assert after.count() == len(ODD)
    empty = STEPS[name](spark, no_documents(spark), SF)
    assert empty.count() == 0


def test_one_row_of_a_group_stays_also_where_ids_repeat_or_are_missing(spark):
    text = "one passage of rather more than five words that stands in several rows of the table"
    other = "another passage with words of its own which nothing else in the table resembles at all"
    near = text + " today"
    rows = [(None, text), (None, text), (7, text), (7, text), (8, text), (8, other), (9, near), (None, ""), (None, "")]
    docs = spark.createDataFrame([(i, t, f"s{n}") for n, (i, t) in enumerate(rows)], "doc_id long, text string, number string")
    after = STEPS["jaccard_join"](spark, docs, SF)
    assert after.columns == docs.columns
    kept = rows_of(after, "doc_id", "text")
    assert sorted(kept, key=str) == sorted([(7, text), (8, other), (None, ""), (None, "")], key=str)


def test_mixing_stage_keeps_columns_named_like_its_own(spark):
    names = ["of_source", "hash", "mix_cut", "mix_part", "row", "SIZE", "copy"]
    rows = [(i, "four words are here", "ab"[i % 2], *[f"{n}{i}" for n in names]) for i in range(40)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "source", *names])
    after = STEPS["mixing"](spark, docs, SF)
    assert after.columns == docs.columns
    assert {tuple(r) for r in after.collect()} <= set(rows) and after.count() > 0


def test_folders_of_earlier_stages_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "scratch_path", lambda spark, label: str(tmp_path / label))
    assert corpus_pipeline.run(spark, str(TESTDATA / "sf0.001")).count() > 0
    assert [p.name for p in tmp_path.iterdir()] == ["pipeline_mixing"]
