from sparkloom.llm import html_text
import time

import pytest

from sparkloom.llm.html_text import extract, render

CASES = [
    ("", ""), ("plain  text\n here", "plain text here"), ("a&amp;b &lt;x&gt; &copy;", "a&b <x> ©"),
    ("<p>one<p>two<br>three", "one\n\ntwo\nthree"), ("<div>a</div><div>b<div>c</div></div>", "a\nb\nc"), ("x<b>y</b>z <i> w</i>", "xyz w"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"), ("<ol start=3><li>x<li value=7>y<li>z</ol>", "3. x\n7. y\n8. z"),
    ("<table><tr><th>Name<th>No<tr><td>a<td>10<tr><td>long name<td>2</table>", "Name      | No\na         | 10\nlong name | 2"),
    ("<table><tr><td colspan=2>wide cell over both<tr><td>a<td>b</table>", "wide cell over both\na | b"),
    ("<table><tr><td>a<br>b<td>c</table>", "a | c\nb |"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a | b\n  | c"), ("<table><tr><td>1<td rowspan=0>all<td>x<tr><td>2<td>y<tbody><tr><td>3<td>4<td>5</table>", "1 | all | x\n2       | y\n3 | 4   | 5"),
    ("<table><tr><td colspan=2 rowspan=2>ab<td>c<tr><td>d<tr><td>e<td>f<td>g</table>", "ab    | c\n      | d\ne | f | g"), ("<table><tr><td>漢字<td>x<tr><td>abcde<td>y</table>", "漢字  | x\nabcde | y"),
    ("a<dialog>no</dialog><dialog open>yes</dialog>", "a\nyes"),
    ("<head><title>T</title></head><body>x<script>var a='<p>';</script><style>p{}</style><!-- no --><template>t</template>y</body>", "xy"),
    ("a<span hidden>b</span><span style='display: none'>c</span>d", "ad"), ("<div style='visibility:hidden'>a<i style='visibility:visible'>b</i>c</div>", "b"),
    ("<details><summary>s</summary>more</details><details open><summary>s</summary>more</details>", "s\ns\nmore"),
    ("<pre>  a\n    b\t|</pre>c", "  a\n    b   |\n\nc"), ("<p>a</b></div>b</p>", "ab"), ("a < b <c", "a < b <c"), ("<p title='a>b'>x", "x"),
    ("<select><option>a<option>b</select><textarea>t</textarea><input type=submit value=Go>", "a\nb\nt\nGo"), ("<dl><dt>t<dd>d</dl>", "t\n    d"), ("<blockquote>q<p>r</blockquote>", "    q\n\n    r"),
]


@pytest.mark.parametrize(("html", "want"), CASES)
def test_render(html, want):
    assert render(html) == want


def test_hostile_pages_take_linear_time():
    for page in ("<div>" * 200000 + "x", "<a '" * 100000, "<" * 200000, "<!--" * 50000, "<table><tr><td>" * 3000 + "x", "</p>" * 100000, "<p a=\"" * 50000, "<script>" * 20000, "<li>" * 50000):
        began = time.time()
        render(page)
        assert time.time() - began < 10
    assert render("<div>" * 5000 + "deep").strip() == "deep"


def test_pages(spark, sf_dir):
    import re

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = {r["page_id"]: r["html"] for r in pages.collect()}
    out = extract(pages).collect()
    assert len(out) == len(rows) and "html" not in out[0].asDict()
    from html import unescape

    for r in out:  # every visible word is there, in order, and no other
        body = re.sub(r"(?s)<(script|style|title).*?</\1>|<!--.*?-->", " ", rows[r["page_id"]])
        want = unescape(re.sub(r"<[^>]*>", lambda m: "" if re.match(r"</?[ab]\b", m[0]) else " ", body)).split()
        got = [w for w in r["text"].split() if w != "-"]
        assert got == [w for w in want if w != "-"]


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, "", "x"), (1, "<p>a", "x"), (1, "<p>a", "x")], "page_id int, html string, text string")
    assert [r["text"] for r in extract(df).collect()] == [None, "", "a", "a"] and extract(df.limit(0)).count() == 0


def test_text_areas_drawings_and_formulas():
    page = "<p>a</p><textarea>\nx &lt; y\n  z</textarea><svg><title>no</title><defs><text>no</text></defs><g><text>up <tspan>there</tspan></text></g><desc>no</desc><text>down</text></svg><p>b <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math></p>"
    assert html_text.render(page) == "a\n\nx < y\n  z\nup there\ndown\n\nb x=2"


def test_beyond_the_depth_limit():
    deep = "<div>" * (html_text.DEEPEST + 20)
    assert html_text.render(deep + "<span hidden>no</span><b>yes</b>") == "yes"
    assert html_text.render(deep + "yes" + "</div>" * 30 + " on") == "yes\non"
    text = html_text.render("<div>" * (html_text.DEEPEST - 2) + "<p>one<div style='display:none'>no<b>no</b></div>two</p>" + "<div>three</div>")
    assert "no" not in text and [w for w in text.split()] == ["one", "two", "three"]


def test_tables_stay_within_a_multiple_of_the_page():
    pages = [
        "<table><tr><td>" + "w" * 8000 + "<td>end" + "<tr><td>a<td>b" * 8000 + "</table>", "<table>" + "<tr><td colspan=999>a<td>b" * 5000 + "</table>", "<table>" + "<tr>" + "<td>aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 500 + "<tr><td colspan=499><td>x" * 3000 + "</table>",
        "<table><tr>" + "<td rowspan=65534 colspan=1000>z" * 5 + "<tr><td>a" * 5000 + "</table>",
    ]
    for page in pages:
        began = time.time()
        assert len(render(page)) < 12 * len(page) and time.time() - began < 20
    assert "w" * 8000 in render(pages[0]) and render(pages[0]).endswith(" | b")


def test_small_tables_against_a_grid_of_characters():
    """Cells of one line each, with spans: every cell begins in the column's place, found by filling a grid cell by cell."""
    import random

    r = random.Random(12)
    for _ in range(300):
        rows = [[("".join(r.choices("abc", k=r.randint(1, 6))), r.choice([1, 1, 1, 2]), r.choice([1, 1, 1, 2, 3])) for _ in range(r.randint(1, 4))] for _ in range(r.randint(1, 5))]
        grid, placed = {}, []
        for i, row in enumerate(rows):
            for text, across, down in row:
                c = next(c for c in range(99) if (i, c) not in grid)
                placed.append((i, c, across, text))
                grid |= {(i + d, c + a): text for d in range(down) for a in range(across)}
        width = {}
        for _, c, across, text in placed:
            if across == 1:
                width[c] = max(width.get(c, 0), len(text))
        begin = lambda c: sum(width[k] + 3 for k in width if k < c)
        html = "<table>" + "".join("<tr>" + "".join(f"<td colspan={a} rowspan={d}>{t}" for t, a, d in row) for row in rows) + "</table>"
        # text wider than its columns pushes what follows it to the right
        lines, want = render(html).split("\n"), []
        for i in range(len(rows)):
            line = ""
            for _, c, _, text in [p for p in placed if p[0] == i]:
                line = (line.ljust(begin(c) - 3) + " | " if c else "") + text
            want.append(line.rstrip())
        assert lines == want, html
