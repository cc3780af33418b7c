import zlib

import numpy as np
import pytest

from sparkloom.llm import langid
from sparkloom.llm.queries import op4_language_id


@pytest.fixture(scope="module")
def scored(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    return op4_language_id(spark, sf_dir).join(docs, "doc_id").collect()


def test_held_out_accuracy(scored):
    for r in scored:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
    held = [r for r in scored if r["held_out"] and r["lang_pred"] != "und"]
    assert sum(r["lang_pred"] == r["lang"] for r in held) / len(held) > 0.93
    assert sum(r["rejected"] for r in scored) / len(scored) < 0.05


def test_odd_rows(spark):
    rows = [(i, "the cat and the dog", "en", "s") for i in range(30)] + [(100 + i, "der Hund und die Katze", "de", "s") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    model = langid.train(df)
    odd = spark.createDataFrame([(1, None, None, "x"), (2, "", None, "x"), (3, "123 !?", None, "x"), (4, "und die Katze", None, "x"), (4, "und die Katze", None, "x"), (None, "the dog " * 20000, None, "x"), (6, "é", None, "x")], df.schema)
    out = langid.identify(odd, model).collect()
    assert [r["lang_pred"] for r in out[:3]] == ["und"] * 3 and all(r["score"] == 0 and r["rejected"] for r in out[:3])
    assert out[3]["lang_pred"] == out[4]["lang_pred"] == "de" and out[5]["lang_pred"] == "en" and out[6]["lang_pred"] in ("de", "en")
    assert langid.identify(odd.limit(0), model).count() == 0
    none = langid.train(df.where("false"))
    assert none is None and {r["lang_pred"] for r in langid.identify(odd, none).collect()} == {"und"}


def test_labels_are_no_input(spark):
    df = spark.createDataFrame([(i, "the cat" if i % 2 else "die Katze", "en" if i % 2 else "de") for i in range(60)], "doc_id long, text string, lang string")
    model = langid.train(df)
    a = langid.identify(df, model).select("lang_pred", "score").collect()
    b = langid.identify(df.selectExpr("doc_id + 7 as doc_id", "text", "'zz' as lang"), model).select("lang_pred", "score").collect()
    assert a == b


def predicted(model, text):
    raw = np.frombuffer(text.encode(), np.uint8)
    return tuple(x[0] for x in langid.judged(model, *langid.row_logits(model, raw, np.array([0, len(raw)]))))


def test_scores_equal_a_naive_sum(spark, sf_dir):
    """Gram by gram in plain Python; 300 documents, and one that is longer than a slice."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang").collect()
    model = langid.fit([r["text"] for r in rows], [r["lang"] for r in rows], epochs=1)
    for text in [*(r["text"][:500] for r in rows[:40]), "der Hund und die Katze " * 60_000]:
        raw = text.encode().lower()
        counts = {}
        for size in langid.GRAMS if len(raw) < 10_000 else ():
            for i in range(len(raw) - size + 1):
                h = 2166136261
                for b in raw[i : i + size]:
                    h = ((h ^ b) * 16777619) & 0xFFFFFFFF
                h = (((h ^ (h >> 15)) * 2654435761) & 0xFFFFFFFF) >> 16
                counts[h] = counts.get(h, 0) + 1
        got = langid.row_logits(model, np.frombuffer(text.encode(), np.uint8), np.array([0, len(raw)]))[0][0]
        if counts:
            want = sum(n * model.table[h].astype(float) for h, n in counts.items()) / sum(counts.values()) + model.bias
        else:
            want = langid.row_logits(model, np.frombuffer(text[: 23 * 600].encode(), np.uint8), np.array([0, 23 * 600]))[0][0]
        assert np.allclose(got, want, atol=1e-2 if not counts else 1e-5)


def test_rejects_what_is_in_no_known_language(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id % 3 = 0 and lang is not null and text is not null").select("text", "lang").collect()
    learnt, fresh = rows[:2300], rows[2300:]
    for out in sorted({r["lang"] for r in rows}):
        use = [r for r in learnt if r["lang"] != out]
        model = langid.fit([r["text"] for r in use], [r["lang"] for r in use])
        unseen = [predicted(model, r["text"])[2] for r in fresh if r["lang"] == out]
        known = [predicted(model, r["text"])[2] for r in fresh if r["lang"] != out]
        assert sum(unseen) / len(unseen) >= 0.9 and sum(known) / len(known) <= 0.01, out
    rng = np.random.default_rng(1)
    noise = [" ".join("".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(30)) for _ in range(100)]
    assert sum(predicted(model, t)[2] for t in ["xqzt vvkk pprr zzzz", "asdfgh jkl qwerty zxcvbn", *noise]) >= 100


def test_no_cap_on_languages_and_clashing_columns(spark):
    rows = [(None, f"{chr(97 + i % 26) * 3}{chr(97 + i // 26) * 3} words of language number {chr(97 + i % 26)}", f"l{i}") for i in range(80) for _ in range(6)]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, lang string, _letters int")
    model = langid.train(df, sample_rows=400)
    assert len(model.languages) > 64
    assert {r["_letters"] for r in langid.identify(df, model).collect()} == {7}
