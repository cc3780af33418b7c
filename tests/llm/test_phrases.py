import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import phrases


def brute(rows, least=10, top=2000, longest=3, held=50):
    """The contract, word by word."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    cands = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = {}
    for (lang, p), a in cands.items():
        if any(g == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) and 100 * b >= held * a for (g, q), b in cands.items()):
            continue
        s, _, x, y = min((10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-s, -a, " ".join(p).encode(), x, y))
    rows = []
    for lang, found in out.items():
        rows += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(found)[:top])]
    return sorted(rows)


def some_rows(n=120, seed=5):
    r = random.Random(seed)
    words = "the The cat, sat on. a mat\nand é Éa #x ran on off; the the \t if".split(" ")
    return [(" ".join(r.choices(words, k=r.randint(0, 40))), r.choice(["en", "en", "de", None, "und"])) for _ in range(n)]


def mined(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x") for r in rows], "text string, lang string, phrase string")
    return sorted(tuple(r) for r in phrases.mine(df, **options).collect())


@pytest.mark.parametrize("options", [{}, {"top": 3}, {"least": 4, "shard": 50}, {"longest": 2, "least": 5}, {"width": 9, "least": 3, "shard": 20}, {"held_percent": 90}])
def test_equals_brute_force(spark, options):
    rows = some_rows()
    want = brute(rows, **{{"held_percent": "held"}.get(k, k): v for k, v in options.items() if k in ("top", "least", "longest", "held_percent")})
    got = mined(spark, rows, **options)
    assert want and got == want


def test_words_that_clash_are_told_apart(spark):
    """With ids of 8 bits, of which 7 are free, most of 120 words clash."""
    r = random.Random(1)
    rows = [(" ".join(f"w{r.randint(0, 119) // r.choice([1, 1, 2, 30])}" for _ in range(50)), "en") for _ in range(60)]
    assert mined(spark, rows, width=8, least=3) == brute(rows, least=3)


def test_parts_and_flushes_keep_all(spark, monkeypatch):
    monkeypatch.setattr(phrases, "PART_BYTES", 7)
    rows = some_rows(30, seed=9)
    for text, _ in rows:
        parts = [x for p in phrases.tokens(text.encode()) for x in p]
        whole = text.encode().lower().translate(phrases.BREAKS).replace(b"\xff", b" \xff ").split()
        assert parts == whole


def test_blocks_count_each_ngram_once():
    packing = phrases.Packing(20, 3)
    ids = np.array(random.Random(2).choices([0, 1 << 19, (1 << 19) + 5, 7], k=500), np.uint64)
    want = phrases.summed(*phrases.ngram_keys(ids, 0, packing))
    parts, seen, at = [], 0, 0
    for end in (100, 101, 250, 500):
        parts.append(phrases.summed(*phrases.ngram_keys(ids[at:end], seen, packing)))
        at, seen = end - 2, 2
    got = phrases.merged(parts)
    assert all((a == b).all() for a, b in zip(got, want))


@pytest.mark.parametrize("width, longest", [(8, 2), (9, 3), (16, 3), (21, 3), (22, 3), (28, 3), (42, 3), (63, 2)])
def test_permutation_and_filters_are_lossless(width, longest):
    r = np.random.default_rng(3)
    packing = phrases.Packing(width, longest)
    ids = [r.integers(0, 1 << width, 5000, dtype=np.uint64) for _ in range(longest)]
    high, low = packing.permute(*packing.pack(ids))
    assert all((a == b).all() for a, b in zip(packing.unpack(*packing.restore(high, low)), ids))
    n = np.where(r.random(5000) < 0.01, r.integers(255, 1 << 40, 5000), r.integers(1, 300, 5000))
    entries = phrases.summed(high, low, n)
    assert int(entries[2].sum()) == int(n.sum())
    for bits in (0, 3):
        for shard in range(1 << bits):
            part = entries[0] >> np.uint64(packing.high - bits) == shard if bits else np.ones(len(entries[0]), bool)
            mine = tuple(x[part] for x in entries)
            if part.any():
                back = phrases.decode(phrases.encode(mine, bits, packing), shard, bits, packing)
                assert all((a == b).all() for a, b in zip(back, mine))


def test_counts_beyond_64_bits(spark):
    df = spark.createDataFrame([(3_000_000_000_000, 3_000_000_000_001, 3_000_000_000_007)], "a long, l long, r long")
    row = df.select(phrases.score(F.col("a"), F.col("l"), F.col("r")).alias("s")).first()
    assert row["s"] == 10**6 * 3_000_000_000_000**2 // (3_000_000_000_001 * 3_000_000_000_007)


def test_odd_rows(spark, docs_schema):
    assert phrases.mine(spark.createDataFrame([], docs_schema)).collect() == []
    long = "a b " * 200_000
    rows = [(None, "en"), ("", None), (" \t\n.,", "en"), ("one", "en"), (long, "en"), (long, "en"), ("x" * 300_000 + " b", None)]
    got = mined(spark, rows, least=2)
    assert got == brute(rows, least=2) and [r[2] for r in got] == ["a b a", "b a b"]
