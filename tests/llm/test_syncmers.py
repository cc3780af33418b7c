import hashlib
import random
import re
import struct
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from sparkloom.llm import syncmers

WORD = re.compile("[⺀-퟿]|[^ \t\n\x0b\f\r⺀-퟿]{1,16}")


def fold(numbers):
    h = 42
    for x in numbers:
        h = xxhash.xxh64_intdigest(struct.pack("<Q", x), h)
    return h


def brute_anchors(text, k=6, s=2):
    """(hash, place) of the anchors."""
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in WORD.findall(text)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    out = []
    for i in range(len(h) - k + 1):
        runs = [signed(fold(h[j : j + s])) for j in range(i, i + k - s + 1)]
        if min(runs) in (runs[0], runs[-1]):
            out.append((fold(h[i : i + k]) >> 36, i))
    return out or ([(fold(h) >> 36, 0)] if h else [])


def brute_fingerprint(found):
    return "".join(f"{h:07x}{(p - (found[j - 1][1] if j else 0)) & 15:x}" for j, (h, p) in enumerate(found))


def brute_likeness(a, b):
    one, two = {}, {}
    for side, found in ((one, a), (two, b)):
        for j, (h, _) in enumerate(found):
            side.setdefault(h, j)
    shared = sorted((one[h], two[h]) for h in one if h in two)
    n = sum(j == 0 or shared[j][1] > shared[j - 1][1] for j in range(len(shared)))
    return 2 * n / (len(one) + len(two)) if one or two else 1.0


def brute(rows, k=6, s=2):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5((r[1] or "").encode()).hexdigest()))
    out = []
    for j, (doc, text) in enumerate(rows):
        text, after = text or "", rows[(j + 1) % len(rows)][1] or ""
        c = len(text) // 3
        edited = text[: len(text) - c] + after[:c]
        a, b, n = (brute_anchors(t, k, s) for t in (text, edited, after))
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), brute_fingerprint(a), brute_fingerprint(b), brute_likeness(a, b), brute_likeness(a, n)))
    return sorted(out, key=repr)


def some_rows(n=80, seed=3):
    r = random.Random(seed)
    words = ["ab", "cde", "f", "été", "漢字語", "x" * 40, "G.", "\U0001f600\U0001f601", "12"]
    return [(i * 7 % 101, "".join(w + r.choice([" ", "\n", "\t "]) for w in r.choices(words, k=r.choice([0, 1, 3, 5, 6, 7, 30, 200])))) for i in range(n)]


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, own string, rows int")
    return sorted((tuple(r) for r in syncmers.edited_report(df, **options).collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"k": 4, "s": 1}, {"k": 3, "s": 2}, {"k": 5, "s": 3}])
def test_equals_brute_force(spark, options):
    rows = some_rows()
    assert found(spark, rows, **options) == brute(rows, **options)


def test_odd_rows(spark, docs_schema):
    assert syncmers.edited_report(spark.createDataFrame([], docs_schema)).collect() == []
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    for rows in ([(1, "one row of some words that is its own successor here")], [(None, None), (None, "a b c d e f g h"), (5, "p q r"), (5, "p q r"), (5, "p q r"), (5, "s t u v w x y z"), (2, ""), (3, long), (0, "y" * 100_000)]):
        assert found(spark, rows) == brute(rows)


def test_an_edit_keeps_the_other_anchors(spark):
    """Anchors don't depend on what stands around them; every few words there is one."""
    r = random.Random(6)
    words = [f"w{r.randrange(10**6)}" for _ in range(400)]
    changed = [*words[:150], "new", *words[150:]]
    df = spark.createDataFrame([(" ".join(words), " ".join(changed))], "a string, b string")
    row = df.select(syncmers.anchors(F.col("a")).alias("a"), syncmers.anchors(F.col("b")).alias("b")).select("a", "b", syncmers.likeness(F.col("a"), F.col("b")).alias("like")).first()
    lost = Counter(x >> 4 for x in row["a"]) - Counter(x >> 4 for x in row["b"])
    assert sum(lost.values()) <= syncmers.K - 1 and 0.95 < row["like"] < 1
    assert max(x & 15 for x in row["a"]) <= syncmers.K - syncmers.S


def test_near_copies_are_told_from_others(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = syncmers.edited_report(docs).where("n_chars > 400").collect()
    likes = sorted(r["near_edited"] for r in rows)
    assert len(rows) > 100 and likes[len(rows) // 20] > 0.45 and all(r["near_next"] <= 1 for r in rows)
    assert sorted(r["near_next"] for r in rows)[len(rows) * 9 // 10] < 0.2


def test_no_python_in_the_plan(spark, sf_dir, capsys):
    syncmers.edited_report(spark.read.parquet(f"{sf_dir}/documents.parquet")).explain()
    assert "Python" not in (plan := capsys.readouterr().out) and "Arrow" not in plan
