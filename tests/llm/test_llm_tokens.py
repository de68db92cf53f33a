import random

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from comparison import TESTDATA
from llm_cases import ODD, no_documents, odd_documents, rows_of
from tidemark.llm import token_counts as tc

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def counter():
    return tc.PrefixCounter(PATH)


def encoded(counter, text):
    return len(counter.tokenizer.encode(text, add_special_tokens=False).ids)


CASES = [
    "", "a", "  ", " a\n\nb\n", "x're we'll 'r 've", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "ab<|endof",
    "ñü ß é 　x", "\x1c\x1fa\x85b", "日本語 テキスト", "é 🙂👍🏽", "====== ======", "a" * 300, "12345 6789.0", "\t\t x\n \n y",
]


def random_texts():
    rng = random.Random(5)
    return ["".join(rng.choice(" \n\t'srevlld.aé1!<|>_ñ") for _ in range(40)) for _ in range(60)]


@pytest.mark.parametrize("text", CASES + random_texts())
def test_every_prefix_counts_as_encoded(counter, text):
    assert counter.counts(text).tolist() == [encoded(counter, text[:i]) for i in range(1, len(text) + 1)]


def test_whole_texts(counter):
    texts = pq.read_table(TESTDATA / "sf0.01" / "documents.parquet", columns=["text"])["text"].to_pylist()
    assert [int(counter.counts(t)[-1]) for t in texts] == [encoded(counter, t) for t in texts]


def test_forgotten_pieces_count_the_same(counter, monkeypatch):
    monkeypatch.setattr(tc, "KEPT_PIECES", 3)
    monkeypatch.setattr(tc, "KEPT_PAIRS", 3)
    small = tc.PrefixCounter(PATH)
    for text in CASES:
        assert small.counts(text).tolist() == counter.counts(text).tolist()


def test_odd_rows_and_stored_prefixes(spark, counter):
    df = tc.count_tokens(odd_documents(spark), PATH, 5, store=True)
    df = df.withColumns(
        {"at_three": tc.prefix_tokens("prefix_tokens", 3), "fits": tc.longest_prefix("prefix_tokens", 5)}
    )
    rows = rows_of(df, "doc_id", "text", "n_bytes", "n_tokens", "over_limit", "fitting_chars", "at_three", "fits", "node")
    assert len(rows) == len(ODD)
    for _, text, n_bytes, n_tokens, over, fitting, at_three, fits, node in rows:
        text = text or ""
        assert (n_bytes, n_tokens, over) == (len(text.encode()), encoded(counter, text), encoded(counter, text) > 5)
        assert fitting == fits
        if len(text) < 1000:
            assert fits == max([i for i in range(len(text) + 1) if encoded(counter, text[:i]) <= 5])
        assert at_three == (encoded(counter, text[:3]) if len(text) >= 3 else None)
        assert node in ("clash", None)


def test_no_rows(spark):
    assert tc.count_tokens(no_documents(spark), PATH, 5).count() == 0


def test_query_covers_the_table(spark, counter):
    from tidemark.llm.queries import op2_token_counts

    df = op2_token_counts(spark, str(TESTDATA / "sf0.001"))
    texts = pq.read_table(TESTDATA / "sf0.001" / "documents.parquet", columns=["doc_id", "text"]).to_pylist()
    expected = {r["doc_id"]: encoded(counter, r["text"]) for r in texts}
    assert {r.doc_id: r.n_tokens for r in df.filter(F.col("n_tokens") >= 0).collect()} == expected
