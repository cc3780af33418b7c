import hashlib
import random

import numpy as np
import pytest

from sparkloom.llm import queries
from sparkloom.llm import suffix_dedup as sd


def brute(rows, length, keep="none"):
    places = {}
    for n, (_, t) in enumerate(rows):
        raw = (t or "").encode()
        for i in range(len(raw) - length + 1):
            places.setdefault(raw[i : i + length], []).append((n, i))
    out = []
    for n, (d, t) in enumerate(rows):
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            found = places[raw[i : i + length]]
            if len(found) > 1 and (keep == "none" or min(found) != (n, i)):
                gone[i : i + length] = True
        edges = np.diff(np.concatenate([[0], gone.astype(int)]))
        out.append((d, len(raw), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed=1):
    r = random.Random(seed)
    base = ["".join(r.choice("ab ") for _ in range(300)) for _ in range(4)]
    docs = ["".join(r.choice(base)[r.randint(0, 200) : r.randint(100, 300)] + r.choice(["", "x", "yé"]) for _ in range(r.randint(0, 5))) for _ in range(90)]
    return [*enumerate(docs), (900, None), (901, ""), (902, "z" * 300), (903, "z" * 60), (904, "ab" * 200), (905, docs[3]), (906, docs[3])]


@pytest.mark.parametrize(("length", "gram", "crowd", "keep"), [(40, 8, 512, "none"), (40, 8, 2, "none"), (43, 20, 512, "first"), (40, 8, 2, "first")])
def test_equals_brute_force(spark, length, gram, crowd, keep):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sd.remove_repeats(df, length=length, gram=gram, crowd=crowd, keep=keep)
    assert sorted([tuple(r)[:5] for r in out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()], key=repr) == brute(rows, length, keep)


def test_null_and_repeated_ids_empty_table(spark):
    text = "abcdefghij" * 12
    rows = [(None, text), (None, text), (7, text), (7, "other")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sd.remove_repeats(df, length=40, gram=8, with_text=True).collect()
    assert len(out) == 4 and sum(r["n_removed"] == len(text) for r in out) == 3
    assert sorted((r["kept"] for r in out)) == ["", "", "", "other"]
    assert sd.remove_repeats(df.limit(0), length=40, gram=8).count() == 0


def test_long_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(sd, "STARTS", 100)
    raw = np.random.default_rng(0).integers(97, 123, 700).astype(np.uint8)
    whole = sd.runs_of(raw, np.array([0, 700]), 40, 8)
    starts = {(int(p), s) for p, a, b in zip(whole[1], whole[2], whole[3]) for s in range(a, b + 1)}
    parts = set()
    for _, moved, part, bounds in sd.pieces(raw, np.array([0, 700]), 40):
        _, pos, lo, hi, _, _ = sd.runs_of(part, bounds, 40, 8)
        parts |= {(int(p) + moved, s + moved) for p, a, b in zip(pos, lo, hi) for s in range(a, b + 1)}
    assert parts == starts and {s for _, s in starts} == set(range(661))


def test_longest_previous_factors():
    text = b"banana bandana banana"
    starts = np.arange(len(text) - 8 + 1)
    order = sd.SuffixOrder(np.frombuffer(text, np.uint8), np.full(len(text), len(text)), starts, 8)
    assert [text[s : s + 8] for s in starts[order.order]] == sorted(text[s : s + 8] for s in starts)

    def common(a, b):
        n = next((k for k in range(8) if text[a + k] != text[b + k]), 8)
        return n if n == 8 else n - n % sd.FIRST

    for later in (False, True):
        got = order.previous_factors(later)
        for i in starts:
            others = [j for j in starts if (j > i if later else j < i)]
            assert got[i] == max((common(i, j) for j in others), default=0)


def test_planted_passages_by_the_query(spark, tmp_path):
    """Passages of over 50 words that two documents share: n_removed and the text left show them, n_bytes is the whole text's length."""
    r = random.Random(5)

    def prose(n, letters):
        return " ".join("".join(r.choice("abcdeé") for _ in range(letters)) for _ in range(n))

    long, short = [prose(60, 8) for _ in range(6)], [prose(55, 4) for _ in range(6)]
    planted = [f"{prose(40, 7)} {p} {prose(30, 7)}" for p in long + short for _ in range(2)]
    rows = [*enumerate(planted + [prose(120, 7) for _ in range(12)]), (99, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op1_suffix_dedup(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert sorted((tuple(x)[:5] for x in found), key=repr) == brute(rows, 400)
    assert all(len(p.encode()) > 400 for p in long) and all(len(p.encode()) < 400 for p in short)
    assert [x["doc_id"] for x in found if x["n_removed"]] == list(range(12))
    assert not any(p in x["text"] for p in long for x in found) and [x["text"] for x in found[12:]] == [t or "" for _, t in rows[12:]]
