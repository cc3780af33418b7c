import re

from sparkloom.llm import quality
from sparkloom.llm.queries import OP10_SQL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(t):
    w = WORD.findall(t or "")
    windows = {}
    for i in range(len(w) - 7):
        windows.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(8)}
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered)


CASES = [None, "", " \n\t", "one", "a b c d e f g h a b c d e f g h", "x " * 30, "l\nl\n l\nl ", "#é|<b>\x0bq\x0cr s t", "w1 w2 w3 w4 w5 w6 w7 w8 w9 " * 3, "日本 語\n" * 4, "a\r\nb\r\na\r\n"]


def test_measures(spark, sf_dir):
    rows = [(i, t, "s") for i, t in enumerate(CASES)] + [(1000 + r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    df = spark.createDataFrame([(*r, 1) for r in [*rows, rows[4]]], "doc_id long, text string, source string, kept int")
    out = quality.judge(df).collect()
    assert len(out) == len(rows) + 1
    texts = {r[0]: r[1] for r in rows}
    for r in out:
        want = base(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_common_lines(spark):
    words = " ".join(f"w{i}" for i in range(30))
    rows = [(i, f"Boiler  plate line {i % 10}\n{i} {words.replace('w', 'v' + chr(97 + i))}", "h") for i in range(20)]
    rows += [(100 + i, "\n".join(["Boiler plate line 1"] * 8 + ["some words of its own are here as well today"]), "h") for i in range(2)]
    rows += [(200, "boiler plate LINE 7\n" + words, None), (201, words, "other")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r["doc_id"]: r for r in quality.judge(df, most_documents=10, small_share=0.5).collect()}
    assert all(out[i]["n_common_words"] == 4 and out[i]["kept"] for i in range(20))
    assert out[100]["n_common_words"] == 32 and not out[100]["kept"]
    assert out[200]["n_common_words"] == out[201]["n_common_words"] == 0 and out[200]["kept"]
    assert quality.judge(df.limit(0)).count() == 0


def test_limits_on_small_and_large_hosts(spark):
    """Production parameters: three of at most 29 documents, or more than 20 of any number."""
    own = lambda i: f"only here stands {chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)} " + "of text " * 20
    rows = [(i, ("everyone says this\n" if i < 3 else "two say this\n" if i < 5 else "") + own(i), "small") for i in range(10)]
    rows += [(1000 + i, ("twenty one\n" if i < 21 else "twenty only\n" if i < 41 else "") + own(i), "large") for i in range(1500)]
    out = {r["doc_id"]: r["n_common_words"] for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert {i for i, n in out.items() if n} == {0, 1, 2} | {1000 + i for i in range(21)} and out[0] == 3 and out[1000] == 2


def test_sql(spark, sf_dir):
    from oracle import assert_same, connect

    from sparkloom.llm.queries import op10_quality_rules

    assert_same(op10_quality_rules(spark, sf_dir), connect(sf_dir), OP10_SQL)
