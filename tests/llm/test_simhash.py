import random

import numpy as np
import pytest
import xxhash

from sparkloom.llm import simhash
from sparkloom.llm.components import connected_components


def slow_fingerprint(text, k):
    words = bytes(text or "", "utf-8").lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, seed=42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def classes(fps, bits):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def test_fingerprint():
    for t in ["", "  \t\n", "One", "one TWO", "Ä b c d ä", "a b a b a b a b", "x\x0by\x0cz q w", "w " * 20000]:
        for k in (1, 3, 5):
            assert simhash.fingerprint(t.encode(), k) == slow_fingerprint(t, k)


@pytest.mark.parametrize(("bits", "parts", "dense"), [(2, 3, 64), (2, 3, 2), (2, 4, 64), (1, 2, 1), (3, 3, 64), (3, 4, 3), (0, 1, 64), (4, 3, 2)])
def test_links_connect_like_brute_force(spark, bits, parts, dense):
    r = random.Random(bits * 7 + parts)
    fps = [r.getrandbits(64) for _ in range(30)] + [0, (1 << 64) - 1]
    for _ in range(120):
        x = r.choice(fps)
        for b in r.sample(range(64), r.randint(0, 3)):
            x ^= 1 << b
        fps.append(x)
    fps = sorted(set(fps))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    pairs = simhash.links(df, max_bits=bits, parts=parts, dense=dense)
    for a, b in pairs.collect():
        assert bin((a ^ b) & (1 << 64) - 1).count("1") <= bits
    found = {r["node"]: r["component"] for r in connected_components(pairs).collect()}
    want = classes(fps, bits)
    got = [found.get(x, x) for x in signed]
    assert len({*zip(got, want)}) == len({*got}) == len({*want})


def test_near_duplicates_on_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    fps = [slow_fingerprint(r["text"], 3) for r in rows]
    group = classes(fps, 2)
    least = {}
    for r, g in zip(rows, group):
        least[g] = min(least.get(g, r["doc_id"]), r["doc_id"])
    want = sorted((r["doc_id"], f"{f:016x}", least[g]) for r, f, g in zip(rows, fps, group))
    assert sorted(tuple(r) for r in simhash.near_duplicates(docs).collect()) == want


def test_odd_rows(spark, docs_schema):
    rows = [(1, None, "en", "s", 1), (2, "", None, None, None), (3, " \n", "x", "s", 0), (4, "a b c", "x", "s", 0), (None, "a b c", "x", "s", 0), (4, "a b c", "x", "s", 0), (None, None, None, None, None), (5, "q", "x", "s", 1)]
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], docs_schema + ", fp string, component_id int")
    out = sorted((r["doc_id"] or -1, r["component_id"]) for r in simhash.near_duplicates(df).collect())
    assert out == [(-1, 1), (-1, 4), (1, 1), (2, 1), (3, 1), (4, 4), (4, 4), (5, 5)]
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, -1, 1, 4, 5]
    assert simhash.near_duplicates(df.limit(0)).count() == 0 and simhash.drop_near_duplicates(df.limit(0)).count() == 0


def test_allocation_is_least():
    rng = np.random.default_rng(0)
    within = np.concatenate([np.zeros((20, 3, 1)), rng.random((20, 3, 3)).cumsum(axis=2) * 10], axis=2)
    probes = np.array([[0, 1, 9, 40]] * 3, float)
    radii = simhash.allocate(within, probes, 0)
    cost = lambda x, t: sum(within[x, i, t[i] + 1] + probes[i, t[i] + 1] for i in range(3))
    choices = [(a, b, c) for a in range(-1, 3) for b in range(-1, 3) for c in range(-1, 3) if a + b + c == 0]
    for x in range(20):
        assert sum(radii[x]) == 0 and abs(cost(x, radii[x]) - min(cost(x, t) for t in choices)) < 1e-9
