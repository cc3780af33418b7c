import os

import pytest
from tokenizers import Tokenizer, models

from sparkloom.llm import tokens
from sparkloom.llm.queries import TOKENIZERS

MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"
CASES = ["", " ", "  a  b", "日本語 あༀ༁ xༀ", "\n\n\t a\n b", "a▁b", "éé́", "😀😀 😀a", "word." * 50, "²..x", "ༀ▁ༀ ༀ", "a" * 3000, "x,y;z|q"]


def expected(model, text):
    return len(model.encode(tokens.MARK + text.replace(" ", tokens.MARK)).ids) if text else 0


@pytest.mark.parametrize("fallback", [False])
def test_equals_library(spark, sf_dir, fallback):
    vocabulary = tokens.read_vocabulary(MODEL)
    reference = Tokenizer(models.Unigram([("<unk>", 0.0), *vocabulary], 0, fallback))
    rows = [(i, t) for i, t in enumerate(CASES)] + [(1000 + r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    df = spark.createDataFrame([*rows, (9999, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(df, MODEL).collect()}
    for i, t in rows:
        assert got[i] == expected(reference, t), t[:50]
    assert got[9999] == 0 and tokens.count_tokens(df.limit(0), MODEL).count() == 0


@pytest.mark.parametrize("vocabulary", [
    [("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -2.0), ("▁ab", -3.0), ("ba", -2.0)],  # every cut ties
    [("a", -1.0), ("b", -5.0), ("ab", -1.5), ("b.", -1.0)],  # no mark: it is unknown itself
    [("▁", -1.0), ("a▁b", -0.5), ("a", -1.0), ("b", -1.0)],  # a piece over the mark
])
def test_ties_and_unknowns(vocabulary):
    import itertools

    reference = Tokenizer(models.Unigram([("<unk>", 0.0), *vocabulary], 0, False))
    counter = tokens.Counter(vocabulary)
    for n in range(1, 6):
        for chars in itertools.product("ab .x", repeat=n):
            t = "".join(chars)
            assert counter.count(t) == expected(reference, t), t


def test_vocabulary_is_there():
    assert os.path.exists(MODEL)
