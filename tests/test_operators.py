"""Operators on small tables."""

import json
import math
import zipfile
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkloom.operators import enrich, models, pages, relational, reshape, resolve, scoring, stats
from sparkloom.sources import readers, register_xlsx, writers
from sparkloom.streaming import crawl_progress, ingest_pages


def tuples(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_terms_and_deadlines(spark):
    df = spark.createDataFrame([(1, "秋,春", "12-1,3-1", ""), (2, "秋,春", "12-1", "m"), (3, "秋", "12-1,1-5", "m"), (4, None, None, None)], "id int, terms_start string, deadline string, more_info string")
    out = reshape.explode_terms(df)
    assert tuples(out.select("id", "terms_start", "deadline"), "id", "deadline") == [(1, "秋", "12-1"), (1, "春", "3-1"), (2, "秋", "12-1"), (2, "春", "12-1"), (3, "秋", "12-1,1-5"), (4, None, None)]
    kept = reshape.keep_first_deadline(df.where("id in (1, 3)"))
    assert tuples(kept.select("id", "deadline", "more_info"), "id") == [(1, "12-1", "- Additional deadlines: 3-1"), (3, "12-1", "m\n- Additional deadlines: 1-5")]


def test_columns(spark):
    df = spark.createDataFrame([("a", "b", "c", None)], "x string, y string, z string, completion_rate string")
    assert reshape.drop_twins(df, {"x": "y", "z": "no"}).columns == ["y", "z", "completion_rate"]
    assert reshape.ensure_columns(df, ["x", "new"]).first()["new"] == ""
    assert reshape.columns_through(df, "y").columns == ["x", "y"] and reshape.columns_from(df, "z").columns == ["z", "completion_rate"]
    assert reshape.rename_present(df, {"x": "q", "nope": "r"}).columns[0] == "q"
    assert reshape.drop_sentinels(df).columns == ["x", "y", "z"]
    assert set(reshape.column_files(df, ["x"])) == {"y", "z", "completion_rate"}
    assert reshape.split_targets(df, {"t": {"a": "x", "b": "nope"}})["t"].columns == ["a"]
    with pytest.raises(KeyError, match="nope"):
        reshape.require_columns(df, ["nope"])


def test_resolve_layers(spark):
    names = spark.createDataFrame([(1, "University College London"), (2, "Harvard University"), (3, "Nanyang Technological University"), (4, "harvard university")], "row_id int, name string")
    asked = ["ucl", "UCL", "HARVARD university", "The London College", "nanyang tech", "harvart university", "zzz", None, " "]
    df = spark.createDataFrame([(i, q) for i, q in enumerate(asked)], "i int, query string")
    aliases = spark.createDataFrame([("UCL", "University College London"), ("zzz", "nobody")], "alias string, target string")
    out = resolve.resolve(df, names, aliases=aliases, rules=[(r"\bnanyang\b", "Nanyang Technological University")], fuzzy_threshold=0.85)
    got = {r["i"]: (r["match_type"], r["matched_name"]) for r in out.collect()}
    assert got[0] == got[1] == ("manual", "University College London")
    assert got[2] == ("lower", "harvard university")
    assert got[3] == ("canonical", "University College London")
    assert got[4] == ("rule", "Nanyang Technological University")
    assert got[5][0] == "fuzzy" and got[6] == ("failed", None) and got[7] == got[8] == ("failed", None)
    n = {r["match_type"]: r["n"] for r in resolve.match_counts(out).collect()}
    assert sum(n.values()) == len(asked) and n["failed"] == 3


def test_similarities():
    assert resolve.token_set("new york university", "university new york city") == 100
    assert resolve.token_set("a", "b") == 0


def test_lookup(spark):
    df = spark.createDataFrame([("ma",), ("Massachusetts",), ("Ontario",), (None,)], "state string")
    out = {r["state"]: (r["abbreviation"], r["region_code"]) for r in resolve.normalised_lookup(df, "state", [("Massachusetts", "MA", "US-MA")]).collect()}
    assert out == {"Massachusetts": ("MA", "US-MA"), "Ontario": ("", ""), "": ("", "")}


def test_relational(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, None), (5, None)], "id int, k string")
    assert tuples(relational.first_seen(df, ["k"], "id"), "id") == [(1, "a"), (2, None)]
    assert tuples(relational.last_written(df, ["k"], "id"), "id") == [(3, "a"), (5, None)]
    assert tuples(relational.positions(df, "id").select("id", "position"), "id") == [(1, 0), (2, 1), (3, 2), (5, 3)]
    assert [r[0] for r in relational.group_rows(df, "id", 2).orderBy("id").select("step").collect()] == [1, 1, 2, 2]
    assert [r[0] for r in relational.group_rows(df, "id", 1, ["k"]).orderBy("id").select("step").collect()] == [1, 1, 2, 2]
    assert relational.positions(df.where("false"), "id").count() == 0


def test_steps_and_logs(spark):
    line = "x Lengths=[tensor(741), tensor(9)], Correct=[tensor(0)]"
    got = spark.createDataFrame([(line,), ("nothing",)], "l string").select(stats.tensor_lists("l").alias("t")).collect()
    assert got[0]["t"]["lengths"] == [741, 9] and got[0]["t"]["correct"] == [0] and got[1]["t"]["lengths"] == []
    rows = spark.createDataFrame([(1, [1, 3], 1), (1, [5], 0), (2, [], 1)], "step int, lengths array<int>, c int")
    out = {r["step"]: r for r in stats.step_metrics(rows, "step", "lengths", F.col("c"), responses_per_row=2).collect()}
    assert out[1]["median_length"] == 3 and out[1]["accuracy"] == 0.25 and out[2]["avg_length"] == 0


def test_votes_and_counts(spark):
    rows = spark.createDataFrame([(1, 1, "y"), (1, 2, "x"), (1, 3, "x"), (2, 1, None)], "k int, o int, v string")
    assert [tuple(r) for r in stats.majority(rows, "k", "v", "o").collect()] == [(1, "x", 3, "y")]
    assert tuples(stats.any_positive(rows, "k", F.col("v") == "x"), "k") == [(1, True), (2, False)]
    out = stats.failure_detail(spark.createDataFrame([({"a": "x" * 300}, "y" * 300)], "headers map<string,string>, body string")).first()
    assert len(out["headers"]["a"]) == 200 and len(out["body"]) == 200


def test_thresholds(spark):
    rows = spark.createDataFrame([(0.9, 1), (0.6, 1), (0.5, 0), (0.2, 0), (None, 1)], "score double, label int")
    sweep = {r["threshold"]: r for r in scoring.threshold_sweep(rows, [0.1, 0.55, 0.95]).collect()}
    assert (sweep[0.1]["tp"], sweep[0.1]["fp"]) == (2, 2) and sweep[0.55]["precision"] == 1 and sweep[0.95]["tp"] == 0 and sweep[0.95]["precision"] == 0
    assert scoring.best_threshold(scoring.threshold_sweep(rows, [0.1, 0.55, 0.58]), 0.9).first()["threshold"] == 0.55


def test_curriculum_defaults(spark):
    text = "Degree requirements and course catalog: CSE 101, MATH-201, STAT.301, PHYS 111 (3 credits) prerequisite semester lecture"
    r = scoring.curriculum_score(spark.createDataFrame([(text,), ("",), (None,)], "t string"), "t").collect()
    assert r[0]["is_curriculum"] and r[0]["course_count"] == 4 and r[0]["threshold"] == 50 and r[0]["level"] == "Very High"
    assert r[1]["score"] == r[2]["score"] == 0 and r[2]["level"] == "Very Low"


HTML = """<html><head><title> My  Page </title></head><body><nav><a href="/nav">apply</a></nav><h1>Program Courses</h1><p>short</p><p>a paragraph long enough</p>
<table><tr></tr></table><table><tr><th>Course</th><td>Credit</td></tr></table><ul><li>course one</li><li></li><li>two</li><li>three</li></ul>
<dl><dt>Fee</dt><dd>10</dd></dl><div class="card"><h3>Card</h3><div class="content">body here</div></div><div class="row"><div>first cell</div><div>second cell</div></div>
<a href="apply#x">Apply now</a><a href="apply">apply again</a><a href="mailto:x@y">apply mail</a><a href="/other">other</a><a href="https://x.edu/p/">apply self</a><footer>no</footer></body></html>"""


def test_pages(spark):
    df = spark.createDataFrame([(1, "https://x.edu/p/", HTML), (2, None, None)], "page_id int, url string, html string")
    out = pages.structured(df).withColumn("plain", pages.plain_structure()).orderBy("page_id").collect()
    p = out[0]["page"]
    assert p["title"] == "My Page" and p["headings"][0] == "<H1>Program Courses</H1>" and p["tables"] == ["<table><tr><td>Course</td><td>Credit</td></tr></table>"]
    assert p["paragraphs"] == ["<p>a paragraph long enough</p>"] and p["lists"] == ["<ul><li>course one</li><li>two</li><li>three</li></ul>"]
    assert p["definitions"] == ["Fee: 10"] and p["cards"] == ["Card: body here"] and p["grids"] == ["first cell | second cell"] and p["structure"] >= 18
    assert "[HEADING] Program Courses" in out[0]["plain"] and "• course one" in out[0]["plain"]
    assert out[1]["content"] == ""
    found = pages.links(pages.structured(df), keep=["page_id"])
    assert [(r["link"], r["anchor_text"]) for r in found.collect()] == [("https://x.edu/p/apply", "Apply now")]


def test_source_titles(spark):
    rows = [(1, "<title>a &quot;b&quot;\n &amp;&amp; c &amp</title>"), (2, "<p>none</p>"), (3, None)]
    got = spark.createDataFrame(rows, "page_id int, html string").select("page_id", pages.source_title("html").alias("title"))
    assert tuples(got, "page_id", "title") == [(1, "a &quot;b&quot; && c &amp"), (2, ""), (3, None)]


def test_pages_reach_python_in_slices(spark):
    n = pages.SLICE // 3
    html = [None, "x" * n, "y" * n, "z" * n, "", "w" * 5 * n, "v"]
    assert [len(x) for x in pages._slices(iter([pd.Series(html), pd.Series(["u"])]))] == [5, 1, 1, 1]
    df = spark.range(700).select("id", F.concat(F.lit("<a href='/"), "id", F.lit("'>l</a>")).alias("html")).coalesce(1)
    both = pages.linked(df).select("id", "page.links").join(pages.structured(df).select("id", F.col("page.links").alias("same")), "id")
    assert both.where("links = same and links[0].href = concat('/', id)").count() == 700
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= pages.ROWS


def test_crawl(spark):
    seeds = spark.createDataFrame([("s", "https://x.edu/p/")], "project_id string, url string")
    fetched = spark.createDataFrame([("https://x.edu/p/", HTML), ("https://x.edu/p/apply", '<a href="/course">course</a>')], "url string, html string")
    got = tuples(pages.crawl_frontier(seeds, fetched, depth=2).select("url", "depth"), "depth", "url")
    assert got == [("https://x.edu/p/", 0), ("https://x.edu/p/apply", 1), ("https://x.edu/course", 2)]


def test_enrich(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,), (" ",)], "v string")
    cache = spark.createDataFrame([("a", "cached")], "value string, answer string")

    def call(values, context):
        if len(values) > 1 or values == ["bad"]:
            raise ValueError("no")
        return [v.upper() for v in values]

    out = enrich.enrich_distinct(df, "v", "w", call, cache=cache, pause=0).collect()
    assert sorted((r["v"] or "", r["w"] or "") for r in out) == [("", ""), (" ", ""), ("a", "cached"), ("a", "cached"), ("b", "B")]
    assert enrich.with_retries(call, ["x", "bad"], "", pause=0) == ["X", "Error: no"]
    assert enrich.ask_repeatedly(spark.createDataFrame([("p",)], "prompt string"), "prompt", enrich.echo, votes=3).count() == 3


def test_terms_are_counted_without_grouping_rows(spark):
    rows = [(k % 3, [w for w in ("a b b c" if k % 2 else "b c d").split()]) for k in range(12)] + [(0, []), (1, ["é", "z", "z"]), (2, ["é", "z"])]
    terms = spark.createDataFrame(rows, "_part int, _terms array<string>")
    used = [[0, 1, 2], [1, 2]]
    for features in (2, 3, 50):
        for some, (words, weights) in zip(used, models.vocabularies(terms, 3, used, features, 2, 0.75), strict=True):
            mine = [t for p, t in rows if p in some]
            n, docs = Counter(w for t in mine for w in t), Counter(w for t in mine for w in set(t))
            want = sorted((w for w in n if 2 <= docs[w] <= 0.75 * len(mine)), key=lambda w: (-n[w], w))[:features]
            assert words == want and weights == pytest.approx([math.log((len(mine) + 1) / (docs[w] + 1)) for w in want])


def test_cross_validation_writes_the_text_once(spark, monkeypatch):
    rows = [(i, "course credit program requirement number" if i % 2 else "football match result yesterday evening", float(i % 2)) for i in range(40)]
    called = []
    monkeypatch.setattr(models, "term_stages", lambda real=models.term_stages: called.append(1) or real())
    got = models.cross_validated(spark.createDataFrame(rows, "doc_id int, text string, label double"), "doc_id", "logistic", maxIter=5).collect()
    assert len(called) == 1 and sorted((r["fold"], r["accuracy"]) for r in got) == [(k, 1.0) for k in range(5)]


def test_model(spark, tmp_path):
    rows = [(i, "course credit program requirement number" if i % 2 else "football match result yesterday evening", i % 2) for i in range(40)] + [(99, "short", 1), (98, None, 0)]
    df = models.labelled(spark.createDataFrame(rows, "doc_id int, t string, y int"), "t", "y").select("doc_id", "text", "label")
    assert df.count() == 40
    model = models.fit(df, "gbt", maxIter=2, maxDepth=2, features=50)
    out = models.classify(model, spark.createDataFrame([("course credit program",), ("abc",)], "t string"), "t", 0.5).collect()
    assert out[0]["is_valuable"] and out[1]["method"] == "content_too_short" and not out[1]["is_valuable"]
    assert models.importances(model, spark).count() >= 1
    models.save(model, str(tmp_path / "m"), {"recall": 1.0, "threshold": 0.5}, spark)
    again, metrics = models.load(str(tmp_path / "m"), spark)
    assert metrics["recall"] == 1.0 and len(again.stages) == len(model.stages)
    for kind in ("forest", "svm", "logistic"):
        assert models.scored(models.fit(df, kind, features=50), df).where("score is null").count() == 0


def test_csv_json_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿ id ,name\n1,"x\ny"\n2,\n', encoding="utf-8")
    df = readers.read_text_csv(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["id", "name"] and tuples(df, "id") == [("1", "x\ny"), ("2", "")]
    assert readers.read_seeds(spark, str(tmp_path / "a.csv"), start=2).count() == 1
    (tmp_path / "Math_x.json").write_text(json.dumps([{"completion_rate": "90%"}, {"id": 1, "name": "n"}]))
    out = readers.read_category_json(spark, str(tmp_path / "Math_x.json"), spark.createDataFrame([], "id long, name string").schema)
    assert [tuple(r) for r in out.select("id", "name", "category").collect()] == [(1, "n", "Math_x")]
    (tmp_path / "d.json").write_text(json.dumps({"a": {"p": "x", "q": None}}))
    assert readers.read_dictionary_json(spark, str(tmp_path / "d.json"), "struct<p:string,q:string>").first() == ("a", "x", None)
    (tmp_path / "n.json").write_text(json.dumps({"samples": [{"x": "t", "y": 1}]}))
    schema = spark.createDataFrame([], "samples array<struct<x:string,y:int>>").schema
    assert readers.read_nested_json(spark, str(tmp_path / "n.json"), schema, "samples").first() == ("t", 1)
    (tmp_path / "l.log").write_text("one\ntwo\n")
    assert [r["value"] for r in readers.read_log_lines(spark, str(tmp_path / "l.log")).orderBy("line_no").collect()] == ["one", "two"]
    writers.write_csv(df, str(tmp_path / "o"), bom=True)
    assert next((tmp_path / "o").glob("part*.csv")).read_bytes().startswith(b"\xef\xbb\xbf")
    writers.write_by_entity(df, str(tmp_path / "e"), F.lit("A-B  C!"))
    assert (tmp_path / "e" / "folder=A_B_C").is_dir()
    writers.write_name_list(df, "name", str(tmp_path / "names"))
    writers.write_json(df, str(tmp_path / "j"))
    assert writers.write_csv_per_column(df, ["id"], str(tmp_path / "per")) == ["name"]
    writers.write_markdown_report({"all": df}, str(tmp_path / "md"), "T")
    assert "| id | name |" in next((tmp_path / "md").glob("part*")).read_text()


def test_xlsx(spark, tmp_path):
    path = tmp_path / "b.xlsx"
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    sheet = f'<worksheet xmlns="{main}"><sheetData><row r="1"><c r="A1" t="inlineStr"><is><t>title</t></is></c></row><row r="3"><c r="A3" t="s"><v>0</v></c><c r="C3" t="inlineStr"><is><t>z</t></is></c></row><row r="4"><c r="A4"><v>7</v></c><c r="C4"><v>8</v></c></row></sheetData></worksheet>'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="S1" r:id="r1"/><sheet name="S2" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Target="worksheets/sheet2.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>rank</t></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml", sheet)
        z.writestr("xl/worksheets/sheet2.xml", sheet)
    register_xlsx(spark)
    df = spark.read.format("xlsx").option("headerRow", 3).option("skipSheets", 1).load(str(path))
    assert df.columns == ["_sheet", "rank", "_c1", "z"] and [tuple(r) for r in df.collect()] == [("S2", "7", None, "8")]
    assert spark.read.format("xlsx").option("headerRow", 3).load(str(path)).count() == 2


def test_streams(spark, tmp_path, sf_dir):
    src = spark.read.parquet(f"{sf_dir}/pages.parquet").limit(5)
    src.write.parquet(str(tmp_path / "in"))
    q = ingest_pages(spark, str(tmp_path / "in"), src.schema).select("page_id", "page.title").writeStream.format("memory").queryName("pages_out").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("pages_out").count() == 5
    spark.createDataFrame([("a", 1), ("a", -1), ("b", 1)], "project_id string, delta int").write.parquet(str(tmp_path / "req"))
    stream = spark.readStream.schema("project_id string, delta int").parquet(str(tmp_path / "req"))
    q = crawl_progress(stream).writeStream.format("memory").queryName("done").outputMode("update").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination(120)
    assert [tuple(r) for r in spark.table("done").collect()] == [("a", 1, True)]


def test_first_failures_of_all_rows(spark):
    df = spark.createDataFrame([(k, i, i % 2 == 1) for k in ("a", None) for i in range(200)] + [("b", 1, False)], "k string, i long, bad boolean")
    out = {r["k"]: r for r in stats.first_failures(df, ["k"], F.col("bad"), "i").collect()}
    assert all(out[k]["first_failed"] == [1, 3, 5] and (out[k]["total"], out[k]["failed"], out[k]["completed"]) == (200, 100, 100) for k in ("a", None))
    assert out["b"]["first_failed"] is None and out["b"]["failed"] == 0
    assert stats.failed_rows(df, F.col("bad")).count() == 200


@pytest.mark.parametrize(("measure", "threshold"), [("ratio", 0.85), ("levenshtein", 0.85), ("token_set", 85), ("ratio", 0.7)])
def test_fuzzy_best_misses_none(spark, measure, threshold):
    import random
    from difflib import SequenceMatcher

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            last, row = row, [i + 1]
            for j, y in enumerate(b):
                row.append(min(last[j] + (x != y), last[j + 1] + 1, row[j] + 1))
        return row[-1]

    r = random.Random(4)
    names = sorted({" ".join("".join(r.choice("abcd") for _ in range(r.randint(1, 5))) for _ in range(r.randint(1, 4))) for _ in range(60)})
    asked = []
    for x in names[::2]:
        y = list(x)
        for _ in range(r.randint(0, 2)):
            y[r.randrange(len(y))] = r.choice(["", "a", "bc"])
        asked.append("".join(y).strip() or "a")
    asked = sorted(set(asked))
    score = {"ratio": lambda a, b: SequenceMatcher(None, a, b).ratio(), "levenshtein": lambda a, b: 1 - distance(a, b) / max(len(a), len(b), 1), "token_set": resolve.token_set}[measure]
    want = {}
    for a in asked:
        good = sorted((-score(a, b), b) for b in names if (score(a, b) >= threshold if measure == "token_set" else score(a, b) > threshold))
        if good:
            want[a] = good[0][1]
    out = resolve.fuzzy_best(spark.createDataFrame([(x,) for x in asked], "query string"), spark.createDataFrame([(x,) for x in names], "candidate string"), threshold=threshold, measure=measure, normalise=False)
    assert {x["query"]: x["candidate"] for x in out.collect()} == want and len(want) > 5


def test_token_set_and_second_names(spark):
    assert resolve.token_set("a b", "b a c") == 100 and resolve.token_set("", "a") == 0 and resolve.common_subsequence("abcbdab", "bdcaba") == 4
    assert abs(resolve.token_set("new york mets", "new york yankees") - 200 * 8 / (8 + 13)) < 1e-9
    catalogue = spark.createDataFrame([(1, "Alpha College", "eins", 3), (2, "Beta College", "zwei", 5)], "row_id int, name string, other string, world int")
    queries = spark.createDataFrame([("Alpha College", "zwei"), ("Gamma Q", "zwei"), ("Gamma Q", "drei"), (None, "eins")], "query string, label string")
    out = resolve.overall_ranks(resolve.resolve(queries, catalogue, second=("label", "other")), catalogue, ["world"])
    assert sorted(map(tuple, out.select("label", "match_type", "world_rank").collect()), key=repr) == [("drei", "failed", None), ("eins", "failed", None), ("zwei", "lower", 3), ("zwei", "secondary", 5)]
