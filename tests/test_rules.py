"""Keyword rules, path rules, checks and folds, on small tables."""

import random
import re

import pytest
from pyspark.sql import functions as F

from sparkloom.operators import checks, keywords, paths, relational, resolve, scoring


def test_patterns_equal_regular_expressions(spark):
    r = random.Random(3)
    text = lambda n: "".join(r.choices("abÄ鲁 ", k=n))
    names = [(text(r.randint(0, 12)), r.choice([None, "x", "Y"])) for _ in range(80)] + [(None, "x")]
    rules = [(r.choice(["", ".*"]) + r.choice([text(2), text(1), text(4), ""]) + ".*" + text(r.randint(0, 2)), r.choice([None, None, "X", "y"])) for _ in range(60)] + [(None, None), ("zz", None)]
    got = keywords.find(spark.createDataFrame(names, "name string, q string"), spark.createDataFrame(rules, "pattern string, q string"), qualifier="q")
    want = set()
    for n, q in names:
        for p, w in rules:
            if n is not None and p is not None and p.replace(".*", "") and re.search(p.lower(), n.lower(), re.S) and (w is None or w.lower() == (q or "").lower()):
                want.add((n, q, p, w))
    found = [tuple(x) for x in got.collect()]
    assert len(want) > 50 and sorted(found, key=repr) == sorted(want, key=repr)


def test_no_rule_is_a_join_of_all_with_all(spark, capsys):
    names, rules = spark.createDataFrame([("a b", 1)], "name string, n int"), spark.createDataFrame([("a", 1)], "pattern string, n int")
    keywords.find(names, rules).explain()
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert keywords.find(names, rules.where("n > 1")).collect() == []


def test_rules_fill_what_the_cascade_leaves(spark):
    catalogue = spark.createDataFrame([(1, "东北大学", "Northeastern University", "US"), (2, "东北大学", "Northeastern University", "CN"), (3, "天主教鲁汶大学", "KU Leuven", "BE"), (4, "鲁汶大学", "UC Leuven", "BE"), (5, "德州-达拉斯", "The University of Texas at Dallas", "US")], "row_id int, name string, english string, country string")
    rules = spark.createDataFrame([("东北大学（美国）", 1, "exact", "northeastern university ", "us"), ("荷语鲁汶", 1, "exact", "Nothing", "BE"), ("荷语鲁汶", 2, "keyword", "鲁汶", None), ("Dallas", 1, "keyword", "Texas Dallas", None), ("Dallas", 2, "regex", "Texas.*Dallas", "US"), ("Else", 1, "regex", "Texas.*Dallas", "BE"), ("Any", 1, "exact", "KU Leuven", None)], "query string, rule_no int, kind string, pattern string, country string")
    targets = keywords.rule_targets(rules, catalogue, names=("name", "english"))
    got = {r["query"]: tuple(r)[1:] for r in targets.collect()}
    assert got == {"东北大学（美国）": ("exact_with_country", 1, "东北大学"), "荷语鲁汶": ("keyword", 2, "天主教鲁汶大学"), "Dallas": ("regex", 1, "德州-达拉斯"), "Any": ("exact", 1, "天主教鲁汶大学")}
    asked = spark.createDataFrame([("东北大学（美国）",), ("鲁汶大学",), ("Dallas",), ("Dallas",), ("unknown",), (None,)], "query string")
    out = keywords.fill_failed(resolve.resolve(asked, catalogue), targets)
    assert sorted((r["query"] or "", r["matched_name"] or "", r["match_type"]) for r in out.collect()) == [("", "", "failed"), ("Dallas", "德州-达拉斯", "regex"), ("Dallas", "德州-达拉斯", "regex"), ("unknown", "", "failed"), ("东北大学（美国）", "东北大学", "exact_with_country"), ("鲁汶大学", "鲁汶大学", "lower")]


def test_paths(spark):
    rules = spark.createDataFrame([("actualités", "deny"), ("a/b", "allow"), ("a/b/c/d", "deny"), ("x", "deny"), ("X", "allow"), ("", "deny"), (None, "deny"), ("q", "other")], "path string, verdict string")
    urls = spark.createDataFrame([(u,) for u in ("https://h/Actualites/1", "https://h/z/actualit%C3%A9s", "http://h/a", "http://h/a/b", "http://h/a//b/c", "http://h/a/b/c/d?x=1", "http://h/x#top", "http://h/q", "http://h", "nothing", None, "https://h/%ZZ/a/b")], "url string")
    got = {r["url"]: (r["verdict"], r["rule"]) for r in paths.judge(urls, rules, default="none").collect()}
    assert got == {
        "https://h/Actualites/1": ("deny", "actualites"), "https://h/z/actualit%C3%A9s": ("deny", "actualites"), "http://h/a": ("none", None), "http://h/a/b": ("allow", "a/b"), "http://h/a//b/c": ("allow", "a/b"),
        "http://h/a/b/c/d?x=1": ("deny", "a/b/c/d"), "http://h/x#top": ("allow", "x"), "http://h/q": ("none", None), "http://h": ("none", None), "nothing": ("none", None), None: ("none", None), "https://h/%ZZ/a/b": ("allow", "a/b"),
    }
    only_first = paths.judge(urls, rules, anywhere=False).where("url = 'https://h/%ZZ/a/b'").first()
    assert (only_first["verdict"], only_first["rule"]) == ("allow", None)
    assert paths.judge(urls, rules.limit(0)).where("rule is not null").count() == 0
    assert paths.judge(spark.createDataFrame([("https://h/programme/tuition",), ("https://h/de/karriere",)], "url string"), paths.default_rules(spark)).select("verdict").collect() == [("allow",), ("deny",)]


def test_rejected_rows_leave_in_one_pass(spark, tmp_path, capsys):
    df = spark.range(100).withColumn("v", F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id")))
    rules = {"known": F.col("v").isNotNull(), "small": F.col("v") < 50}
    counts = checks.write_checked(df, rules, str(tmp_path / "out"))
    assert counts == {"all": 100, "good": 45, "rejected": 55, "rule:known": 10, "rule:small": 55}
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 100 and back.where("state = 'good'").count() == 45
    assert {tuple(r["reasons"]) for r in back.where("state = 'rejected'").collect()} == {("known", "small"), ("small",)}
    assert {r["reason"]: r["n"] for r in checks.reason_counts(df, rules).collect()} == {"known": 10, "small": 55}
    df.write.parquet(str(tmp_path / "in"))
    flagged = checks.rejected(spark.read.parquet(str(tmp_path / "in")), rules)
    flagged.explain()
    assert capsys.readouterr().out.count("FileScan") == 1


@pytest.mark.parametrize("digits", [1, 3])
def test_folds_have_equal_shares_of_each_label(spark, digits):
    rows = [(i, "hot" if i % 3 else None if i % 2 else "b") for i in range(500)] + [(7, "hot")] * 6
    df = spark.createDataFrame(rows, "id int, label string")
    out = scoring.stratified_folds(df, "label", "id", folds=7)
    sizes = {}
    for r in out.collect():
        sizes.setdefault(r["label"], {}).setdefault(r["fold"], []).append(r["id"])
    assert out.columns == ["id", "label", "fold"] and sum(len(x) for s in sizes.values() for x in s.values()) == len(rows)
    assert all(len(s) == 7 and max(map(len, s.values())) - min(map(len, s.values())) <= 1 for s in sizes.values())
    placed = relational.places_within(df, ["label"], F.col("id"), ["id"], digits=digits).collect()
    assert sorted(r["place"] for r in placed if r["label"] == "hot") == list(range(sum(x[1] == "hot" for x in rows)))
