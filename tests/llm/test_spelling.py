import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import pytest

from sparkloom.llm import spelling


def brute_words(rows, drop_of=None, min_length=6, min_count=5):
    f = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = crc32(f"{'' if doc is None else doc}:{run}".encode())
            if drop_of and h % drop_of == 0:
                p = h % len(run)
                run = run[:p] + run[p + 1 :]
            f[run] += 1
    return {w: n for w, n in f.items() if len(w) >= min_length and n >= min_count}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, drop_of=None, ratio=5, **options):
    f = brute_words(rows, drop_of, **options)
    near = {w: [v for v in f if one_apart(w, v)] for w in f}
    form = {}
    for w, n in f.items():
        best = min(near[w], key=lambda v: (-f[v], v), default=None)
        form[w] = best if best is not None and f[best] >= ratio * n else None
    out = []
    for w, n in f.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), f[form[w]] if form[w] else None))
    return sorted(out)


def some_rows(n=80, seed=4):
    """Words of few letters, many near each other, with counts that differ much."""
    r = random.Random(seed)
    words = ["".join(r.choices("aabé×", k=r.choice([6, 6, 7, 8]))) for _ in range(20)]
    weights = [2000] * 20
    for _ in range(140):  # edits of edits, rarer and rarer
        i = r.randrange(len(words))
        p = r.randrange(len(words[i]))
        words.append(words[i][:p] + r.choice(["", "a", "é", "b"]) + words[i][p + r.choice([0, 1]) :])
        weights.append(max(2, weights[i] // r.choice([1, 6, 8])))
    words += [w[:3].upper() + w[3:] for w in words[:20]]
    weights += weights[:20]
    return [(i if i % 7 else None, "".join(w + r.choice([" ", "1", ". ", "\n", "Ā"]) for w in r.choices(words, weights, k=400))) for i in range(n)]


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, word string")
    return sorted((tuple(r) for r in spelling.variants(df, **options).collect()))


@pytest.mark.parametrize("options", [{}, {"drop_of": 7}, {"drop_of": 3, "ratio": 2}, {"min_length": 5, "min_count": 2}])
def test_equals_brute_force(spark, options):
    rows = some_rows()
    want = brute(rows, **options)
    assert sum(r[1] is not None for r in want) > 10 and (options or any(r[1] and r[2] != r[1] for r in want))  # some roots are further than the form
    assert found(spark, rows, **options) == want


def test_rounds_of_filters_miss_none(spark, monkeypatch):
    monkeypatch.setattr(spelling, "ROUND", 16)
    monkeypatch.setattr(spelling, "PIECE", 8)
    rows = some_rows(seed=8)
    assert found(spark, rows) == brute(rows)


def test_filters_that_let_all_through_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(spelling, "SET", 0)
    rows = some_rows(10, seed=8)
    assert found(spark, rows) == brute(rows)


def test_edits_have_the_hashes_of_the_words():
    words = ["banana", "éclair×", "aaabbb", "zzzzzzz"]
    w = spelling.Words(words)
    got = defaultdict(set)
    for t, hashes, lengths, letter in w.edits(0, len(w.letters), 6):
        for i, h, k in zip(t, hashes, lengths):
            word, at = words[w.row[i]], w.place[i]
            edited = word[:at] + letter + word[at + 1 :]
            assert len(edited) == k and spelling.Words([edited]).hashes[0] == h and edited not in got[word]
            got[word].add(edited)
    assert {len(x) for x in got["banana"]} == {6} and {"ééclair×"[1:], "clair×", "éclair"} & got["éclair×"] == {"clair×", "éclair"}
    assert len([x for x in got["zzzzzzz"] if len(x) == 6]) == 1


def test_parts_keep_runs_whole(monkeypatch):
    text = "Abc défāGhi,jkl mno×p 一 éé" * 9
    whole = Counter(spelling.RUN.findall(text.encode().lower().decode()))
    monkeypatch.setattr(spelling, "PART_BYTES", 5)
    assert sum((Counter(spelling.RUN.findall(p)) for p in spelling.parts(text.encode())), Counter()) == whole


def test_odd_rows(spark, docs_schema):
    assert spelling.variants(spark.createDataFrame([], docs_schema)).collect() == []
    long = "ab" * 60_000
    rows = [(1, None), (2, ""), (None, "letter letters " * 6), (None, "letter letters " * 6), (3, f"{long} {long}c {long[:-1]}d {'x' * 70} {'x' * 71} {'x' * 70}y " * 5)]
    got = found(spark, rows)
    assert got == brute(rows) and [r[4] for r in got] == [2, 1, 1, 1, 1, 2, 2, 2]
