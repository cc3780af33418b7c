import hashlib
import random
import re

import pytest

from sparkloom.llm import decontaminate as dc

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall((t or "").encode().lower())


def brute(docs, items, window=13):
    out = []
    for d, t in docs:
        w = words(t)
        hit, who = set(), set()
        for item, text in items:
            p = words(text)
            k = min(window, len(p))
            for i in range(len(p) - k + 1 if k else 0):
                for j in range(len(w) - k + 1):
                    if w[j : j + k] == p[i : i + k]:
                        hit |= set(range(j, j + k))
                        who.add(item)
        ids = sorted(str(x) for x in who if x is not None)
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [8 << 20, 600])
def test_equals_brute_force(spark, block):
    r = random.Random(3)
    vocab = ["a", "B", "cé", "d1", "über", "f"]
    items = [(i, " ".join(r.choice(vocab) for _ in range(r.choice([0, 1, 2, 3, 12, 13, 14, 20])))) for i in range(25)] + [(30, None), (31, "?!"), (32, "a B cé d1"), (33, "a, b -- cé d1"), (None, "f f f")]
    docs = []
    for i in range(60):
        parts = [" ".join(r.choice(vocab) for _ in range(r.randint(0, 8)))]
        for _ in range(r.randint(0, 3)):
            parts.append(r.choice(items)[1] or "")
            parts.append(r.choice(["", "zz", "yy, xx"]))
        docs.append((i, r.choice([" ", "; ", "\n"]).join(parts)))
    docs += [(100, None), (101, ""), (102, "zz " * 5000 + "a b cé d1"), (103, docs[5][1]), (103, docs[5][1])]
    df = spark.createDataFrame([(*d, "x", 0, 1, 2, 3) for d in docs], "doc_id long, text string, items string, n_hit int, _row int, _spans int, t int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = dc.hit_words(df, bench, block_bytes=block)
    assert {r["_row"] + r["_spans"] + r["t"] for r in out.select("_row", "_spans", "t").collect()} == {6}
    got = sorted([tuple(r) for r in out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()], key=repr)
    assert got == brute(docs, items)


def test_documents_and_empty_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    got = dc.hit_words(docs, bench)
    rows = [tuple(r) for r in docs.collect() if len(r["text"]) < 3000][:60]
    want = {r[0]: r for r in brute(rows, [tuple(r) for r in bench.select("item_id", "text").collect()])}
    for r in got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect():
        if r["doc_id"] in want:
            assert tuple(r) == want[r["doc_id"]]
    assert got.where("contaminated").count() > 0
    assert dc.hit_words(docs, bench.limit(0)).where("n_hit > 0 or contaminated").count() == 0
    assert dc.hit_words(docs.limit(0), bench).count() == 0
