"""Toxicity, quality and language: held-out accuracy, brute force where there is one, odd rows."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from comparison import TESTDATA
from llm_cases import ODD, labels, no_documents, odd_documents, rows_of
from tidemark.llm import language, quality, toxicity
from tidemark.llm._tables import labelled_sample, table
from tidemark.llm.queries import op1_toxicity, op5_quality, op7_language

SF = str(TESTDATA / "sf0.1")


@pytest.fixture(scope="module")
def toxic_model(spark):
    documents, marks = table(spark, SF, "documents"), table(spark, SF, "labels")
    return toxicity.train(documents, labelled_sample(documents, marks, "toxic", F.lit(True), 6000))


def held_out(spark, df, label):
    found = df.join(table(spark, SF, "labels"), "doc_id").filter("held_out").select(label, "predicted").toPandas()
    return [(found.predicted[found[label] == x] == 1).mean() for x in (0, 1)]


def test_toxicity_held_out(spark):
    df = op1_toxicity(spark, SF)
    clean, toxic = held_out(spark, df, "toxic")
    assert toxic > 0.85 and clean < 0.03
    assert df.count() == 10_000


def test_quality_held_out(spark):
    bad, good = held_out(spark, op5_quality(spark, SF), "quality")
    assert good > 0.97 and bad < 0.03


def test_language_held_out(spark):
    df = op7_language(spark, SF).join(table(spark, SF, "documents"), "doc_id").filter("held_out")
    assert df.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


@pytest.mark.parametrize("span", ["1d10t", "w0rm", "s.t.u", "looose", "a  b", "$c u m", "x1", "4"])
def test_restoring_equals_trying_all_paths(toxic_model, span):
    model = toxic_model.characters.tolist()

    def cost(text, channel):
        state, total = (0, 0), channel
        for char in text:
            s = toxicity._symbol(char) if char != " " else 0
            if char == " " and state[1] == 0:
                continue
            total += model[state[0]][state[1]][s]
            state = (state[1], s)
        return total + model[state[0]][state[1]][0]

    options, before = [], ""
    for char in span:
        own = [(char, 0.0)] if char.isalpha() else []
        own += [(x, toxicity.SUBSTITUTED) for x in toxicity.LOOKALIKES.get(char, "")]
        if char in toxicity.SEPARATORS:
            again = bool(before) and before in toxicity.SEPARATORS
            drop, keep = (toxicity.KEPT_APART, toxicity.SEPARATED) if again else (toxicity.SEPARATED, toxicity.KEPT_APART)
            own += [("", drop), (" ", keep)]
        elif not char.isalpha():
            own.append((" ", toxicity.LEFT_AS_SYMBOL if char in toxicity.LOOKALIKES else toxicity.KEPT_APART))
        if char == before and char not in toxicity.SEPARATORS:
            own.append(("", toxicity.STRETCHED))
        options.append(own)
        before = char
    best = max(cost("".join(t for t, _ in path), sum(c for _, c in path)) for path in itertools.product(*options))
    reached = [
        cost("".join(t for t, _ in p), sum(c for _, c in p))
        for p in itertools.product(*options)
        if "".join(t for t, _ in p).split() == toxicity.restore(span, model).split()
    ]
    assert max(reached) == pytest.approx(best, abs=1e-4)


@pytest.mark.parametrize(
    "disguised", ["1d10t", "i d i o t", "w0rthl3ss", "mooooron", "p@thet1c", "s.t.u.p.i.d", "$tup1d!", "CL0WN"]
)
def test_disguised_words_are_found(toxic_model, disguised):
    scorer = toxicity.Scorer(toxic_model)
    assert scorer.score(f"Of the thing {disguised} in the end.")[0] >= toxicity.THRESHOLD
    assert scorer.score("Of the thing in the end, 10 of 2024, a b.")[0] < toxicity.THRESHOLD


LONG_PASSAGE = "it was the end of the thing and so " * 150 + "you are the idiot of the end"


@pytest.mark.parametrize(
    "text",
    [
        "  ".join(" ".join(w) for w in LONG_PASSAGE.split()),
        "..".join(".".join(w) for w in LONG_PASSAGE.split()),
        " ".join("youaretheclownoftheend" * 100),
        "i" + "d" * 3000 + "iot",
    ],
)
def test_long_disguised_spans_are_read(toxic_model, text):
    scorer = toxicity.Scorer(toxic_model)
    assert scorer.score(text)[0] >= toxicity.THRESHOLD
    assert not any(len(span) > toxicity.LONGEST_KEPT for span in scorer.restorer.known)


@pytest.mark.parametrize(
    "text",
    [
        "You are an i d i o t.",
        "You are an i d i o t. Go home.",
        "An i d i o t, i d i o t! Go",
        'They said "i d i o t" to me.',
        "They said \u201ci d i o t\u201d to me.",
        "They said (i-d-i-o-t) to me.",
        "I don't i d i o t i'm sure",
        "*i d i o t* he said",
    ],
)
def test_spaced_words_beside_marks_are_found(toxic_model, text):
    assert "idiot" in toxicity.Scorer(toxic_model).score(text)[1]


def test_spaced_letters_beside_a_long_rule(toxic_model):
    text = "-" * 5000 + "text and " + "." * 5000 + "xy " + "a" + " " * 5000 + "bc"
    assert toxicity.Scorer(toxic_model).score(text)[0] == toxicity.BASE_SCORE


def test_near_copies_are_one_piece_of_evidence():
    rng = np.random.default_rng(0)
    one, other = rng.integers(0, 1 << 40, (2, 24))
    near = one.copy()
    near[:6] = 0
    groups = toxicity._near_copies(np.array([one, other, near]))
    assert groups[0] == groups[2] != groups[1]


def test_toxicity_of_odd_rows(spark, toxic_model):
    df = toxicity.score(odd_documents(spark), toxic_model)
    rows = rows_of(df, "doc_id", "text", "score", "size")
    assert sorted(map(str, ((r[0], r[1]) for r in rows))) == sorted(map(str, ((r[0], r[1]) for r in ODD)))
    assert all(r[2] == toxicity.BASE_SCORE for r in rows if not r[1])
    assert all(0 <= r[2] <= 1 for r in rows) and {r[3] for r in rows} == {"clash", None}


def test_models_without_rows(spark):
    none = no_documents(spark)
    sample = labelled_sample(none, labels(spark), "toxic", F.lit(True), 10)
    model = toxicity.train(none, sample)
    assert model.lexicon == {}
    assert toxicity.score(none, model).count() == 0
    assert {r[0] for r in rows_of(toxicity.score(odd_documents(spark), model), "score")} == {toxicity.BASE_SCORE}
    scores = rows_of(quality.score(odd_documents(spark), quality.train(sample)), "score")
    assert len(scores) == len(ODD) and {r[0] for r in scores} == {0.5}
    langs = rows_of(language.predict(odd_documents(spark), language.train(none)), "lang_pred", "score")
    assert set(langs) == {("und", 0.0)}


def test_quality_of_odd_rows(spark):
    documents = odd_documents(spark)
    marks = labels(spark, [(3, 1, 0), (4, 1, 0), (4, 0, 0), (5, 0, 0), (7, 0, 0), (1, 0, None), (9, None, None)])
    sample = labelled_sample(documents, marks, "quality", F.lit(True), 10)
    # Label 1 wins for the id that is labelled twice; of its repeated rows one teaches.
    assert sorted(r[0] for r in rows_of(sample, "label")) == [0, 0, 0, 1, 1]
    first, second = quality.train(sample), quality.train(sample)
    assert (first.vectors == second.vectors).all()
    rows = rows_of(quality.score(documents, first), "doc_id", "text", "score")
    assert len(rows) == len(ODD) and all(0 <= r[2] <= 1 for r in rows)


def test_quality_pull_equals_softmax_of_averages():
    rng = np.random.default_rng(1)
    model = quality.QualityModel(
        rng.normal(size=(1 << quality.BUCKET_BITS, quality.DIMENSIONS)), rng.normal(size=(quality.DIMENSIONS, 2)), rng.normal(size=2)
    )
    rows, first = quality.hashed_features(["Some words here.", "", "other WORDS there there"])
    pull = model.vectors @ (model.output[:, 1] - model.output[:, 0])
    for i in range(3):
        own = rows[first[i] : first[i + 1]]
        logits = model.vectors[own].mean(0) @ model.output + model.bias
        expected = np.exp(logits[1]) / np.exp(logits).sum()
        assert 1 / (1 + np.exp(-(pull[own].mean() + model.bias[1] - model.bias[0]))) == pytest.approx(expected)


def test_language_of_odd_rows(spark):
    documents = odd_documents(spark)
    model = language.train(documents)
    assert set(model.languages) == {"en", "es"} | ({"fr", "de"} & set(model.languages))
    rows = {(r[0], r[1]): r[2:] for r in rows_of(language.predict(documents, model), "doc_id", "text", "lang_pred", "score")}
    assert all(found == ("und", 0.0) for (_, text), found in rows.items() if not text or not any(map(str.isalpha, text)))
    assert rows[(8, "two words")][0] == "es"


def test_gram_vectors_bind_permuted_letters():
    letters = language.letter_vectors()
    gram = (3 * language.LETTERS + 7) * language.LETTERS + 200
    expected = np.roll(letters[3], 2) * np.roll(letters[7], 1) * letters[200]
    assert (language.gram_vectors(np.array([gram]), letters)[0] == expected).all()


def test_an_id_with_many_rows_does_not_break_the_bound_of_a_sample(spark):
    rows = [(1, f"text {i % 50}") for i in range(600)] + [(2, None), (2, None), (3, "three"), (4, "four")]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    marks = labels(spark, [(i, i % 2, 0) for i in range(1, 5)])
    taken = rows_of(labelled_sample(documents, marks, "quality", F.lit(True), 4), "text", "label")
    assert sorted(taken, key=str) == sorted([("text 0", 1), (None, 0), ("three", 1), ("four", 0)], key=str)
    assert labelled_sample(documents, marks, "quality", F.lit(True), 2).count() == 2


def test_letters_beyond_the_first_planes_are_letters(spark):
    rare = "".join(chr(0x20000 + 37 * i) for i in range(60))
    rows = [(1, rare, "zh"), (2, "plain words of a text", "en"), (3, "\U000E0001\U0001F600", "en")]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = dict(rows_of(language.predict(documents, language.train(documents)), "doc_id", "lang_pred"))
    assert found == {1: "zh", 2: "en", 3: "und"}
