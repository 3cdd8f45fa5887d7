"""Data tables by their structure, against a reader on the standard HTML parser."""

import html as python_html
import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from gaugeflow.constants import DATA_TABLE_CLASS
from gaugeflow.functions.text import html_unescape
from gaugeflow.sources.html import html_table_rows


class Reader(HTMLParser):
    """Rows of (tag, attributes, text) of the first table with a class; tables
    inside it are text of their cell."""

    def __init__(self, cls):
        super().__init__(convert_charrefs=True)
        self.cls, self.depth, self.done, self.rows, self.cell, self.section = cls, 0, False, [], None, ""

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        if self.done:
            return
        if tag == "table" and (self.depth or self.cls in (attrs.get("class") or "").split()):
            self.depth += 1
            if self.depth > 1 and self.cell:
                self.cell[2] += " "
        elif self.depth == 1 and tag in ("thead", "tbody", "tfoot"):
            self.section = tag
        elif self.depth == 1 and tag == "tr":
            self.rows.append((self.section, []))
            self.cell = None
        elif self.depth == 1 and tag in ("td", "th") and self.rows:
            self.cell = [tag, attrs, ""]
            self.rows[-1][1].append(self.cell)
        elif self.depth > 1 and self.cell:
            self.cell[2] += " "

    def handle_endtag(self, tag):
        if self.done or not self.depth:
            return
        if tag == "table":
            self.depth -= 1
            self.done = self.depth == 0
        elif self.depth == 1 and tag in ("td", "th", "tr"):
            self.cell = None
        elif self.depth == 1 and tag in ("thead", "tbody", "tfoot"):
            self.section = ""
        if self.depth >= 1 and self.cell:
            self.cell[2] += " " if self.depth > 1 or tag == "table" else ""

    def handle_data(self, data):
        if not self.done and self.depth and self.cell:
            self.cell[2] += data


def grid(rows):
    """The usual row by row layout with the cells that reach down from above."""
    out, held = [], []
    for cells in [*rows, *[[]] * 1000]:
        row = {col: (text, left) for col, text, left in held}
        at = 0
        for _, attrs, text in cells:
            for _ in range(max(1, int(attrs.get("colspan") or 1))):
                while at in row:
                    at += 1
                row[at] = (text, max(1, int(attrs.get("rowspan") or 1)))
        held = [(c, t, left - 1) for c, (t, left) in sorted(row.items()) if left > 1]
        if row:
            out.append([" ".join(t.split()) for _, (t, _) in sorted(row.items())])
    return out


def expected(page, cls="CenteredGrid"):
    r = Reader(cls)
    r.feed(page)
    r.close()
    head = [c for s, c in r.rows if s == "thead"]
    body = [c for s, c in r.rows if s != "thead"]
    if not head:
        while body and all(c[0] == "th" for c in body[0]):
            head.append(body.pop(0))
    head, body = grid(head), grid(body)
    return max(map(len, head + body), default=0), body


def read(spark, pages):
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string").repartition(3)
    got = {r.i: (r.t.width, [[" ".join(c.split()) for c in x] for x in r.t.rows])
           for r in rows.select("i", html_table_rows(F.col("html")).alias("t")).collect()}
    return [got[i] for i in range(len(pages))]


def cells(*texts, tag="td"):
    return "".join(f"<{tag}>{t}</{tag}>" for t in texts)


def page(body, attrs=""):
    return f'<html><table><tr><td>menu</td></tr></table><div><table {attrs} class="x CenteredGrid">{body}</table></div><table><tr><td>z</td></tr></table></html>'


CASES = {
    "inner table": "<tr>" + cells("Time", "Level", tag="th") + "</tr><tr>" + cells(
        "1<table class='CenteredGrid'><tr><td>x</td></tr><tr><td>y</td></tr></table>", "2") + "</tr><tr>" + cells("3", "4") + "</tr>",
    "two levels": "<tr>" + cells("<table><tr><td><table><tr><td>deep</td></tr></table></td></tr></table>", "2") + "</tr><tr>" + cells("3", "4") + "</tr>",
    "two inner tables": "<tr>" + cells("a<table><tr><td>b</td></tr></table>c<table><tr><td>d</td></tr></table>e", "f") + "</tr>",
    "commented row": "<tr>" + cells("1", "2") + "</tr><!-- <tr>" + cells("9", "9") + "</tr> --><tr>" + cells("3", "4") + "</tr>",
    "commented end": "<tr>" + cells("1", "2") + "</tr><!-- </table> --><tr>" + cells("3", "4") + "</tr>",
    "colspan": "<tr><td colspan=2>a</td><td>b</td></tr><tr>" + cells("c", "d", "e") + "</tr>",
    "rowspan": "<tr><td rowspan='2'>a</td><td>b</td></tr><tr><td>c</td></tr><tr>" + cells("d", "e") + "</tr>",
    "both": "<tr><td>a</td><td rowspan=3 colspan=2>b</td><td>c</td></tr><tr>" + cells("d", "e") + "</tr><tr>" + cells("f", "g") + "</tr>",
    "below the end": "<tr><td rowspan=3>a</td><td>b</td></tr>",
    "spans in the head": "<thead><tr><th rowspan=2>T</th><th colspan=2>V</th></tr><tr><th>x</th><th>y</th></tr></thead><tr>" + cells("1", "2", "3") + "</tr>",
    "head of td": "<thead><tr>" + cells("Time", "Level") + "</tr></thead><tbody><tr>" + cells("1", "2") + "</tr></tbody>",
    "th in the middle": "<tr>" + cells("h", "i", tag="th") + "</tr><tr>" + cells("1", "2") + "</tr><tr>" + cells("p", "q", tag="th") + "</tr>",
    "no closing tags": "<tr><td>1<td>2<tr><td>3<td>4",
    "empty rows": "<tr></tr><tr>" + cells("1", "") + "</tr><tr></tr>",
    "references": "<tr>" + cells("Caf&eacute; &#233;&deg;", "&lt;b&gt; &amp;lt;") + "</tr>",
    "markup": "<TR><TD align=left><b>1</b></TD>\n<TD\nclass='n'>2<br>3</TD></TR>",
    "empty": "",
}


@pytest.mark.parametrize("name", CASES)
def test_case(spark, name):
    p = page(CASES[name])
    want = expected(p)
    if name == "markup":  # a line break is no text
        want = (2, [["1", "23"]])
    assert read(spark, [p]) == [want]


def random_table(rnd, depth=0):
    rows = []
    for _ in range(rnd.randrange(1, 6)):
        row, tag = "", rnd.choice(["td", "td", "td", "th"])
        for _ in range(rnd.randrange(1, 5)):
            attrs = rnd.choice(["", "", "", " class=a", " colspan=2", ' colspan="3"'])
            text = f"{rnd.randrange(100)}"
            if depth < 2 and rnd.random() < 0.1:
                text += f"<table>{random_table(rnd, depth + 1)}</table>"
            if rnd.random() < 0.1:
                text += "<!-- <td>no</td> -->"
            row += f"<{tag}{attrs}>{text}</{tag}>"
        rows.append(f"<tr>{row}</tr>")
    return "".join(rows)


def test_random_tables(spark):
    rnd = random.Random(11)
    pages = [page(random_table(rnd)) for _ in range(150)]
    assert read(spark, pages) == [expected(p) for p in pages]


def test_random_spans(spark):
    """Cells that reach down, as long as none meets another."""
    rnd, pages = random.Random(12), []
    while len(pages) < 60:
        width, left, body = rnd.randrange(2, 6), {}, ""
        for _ in range(rnd.randrange(2, 7)):
            row, col = "", 0
            while col < width:
                if left.get(col, 0) > 0:
                    left[col] -= 1
                    col += 1
                    continue
                down = rnd.choice([1, 1, 1, 2, 3])
                row += f"<td rowspan={down}>{rnd.randrange(100)}</td>"
                left[col] = down - 1
                col += 1
            body += f"<tr>{row}</tr>"
        pages.append(page(body))
    assert read(spark, pages) == [expected(p) for p in pages]


REFERENCES = [
    "Caf&eacute; &#233; &deg;C", "&amp;lt;", "&#x1F600;&#128512;", "&notit; &notin; &not", "&copy2020",
    "&#0;&#xD800;&#1114112;&#128;&#x80;&#x81;", "&unknown; & a &a; &;", "&#1;&#13;&#11;&#x7f;", "&acE;", "&#99999999999999;",
    "a&nbsp;b", "&lt&gt&quot", "&#xFDD0;&#65534;", "&AMP;&Aacute", "&NotEqualTilde; &fjlig;", "", "none", "&", "&&amp;&"]


def test_references_equal_the_standard_decoder(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*REFERENCES, None])], "i int, t string")
    got = [r.u for r in rows.select("i", html_unescape("t").alias("u")).orderBy("i").collect()]
    assert got == [python_html.unescape(t) for t in REFERENCES] + [None]


def test_spans_of_the_header_leave_the_body_as_it_is(spark):
    head = "<tr><th rowspan=2>Time</th><th colspan=2>Water</th></tr><tr><th>Level</th><th>Depth</th></tr>"
    page = '<table class="%s">%s{}</table>' % (DATA_TABLE_CLASS, head)
    bodies = ["<tr><td>t</td><td>1</td><td>spans</td></tr><tr></tr><tr><td>u</td></tr>",
              "<tr><td>t</td><td ROWSPAN=2>1</td></tr><tr><td>u</td><td>2</td></tr>", "", "<tr><td colspan=4>t</td></tr>"]
    df = spark.createDataFrame([(i, page.format(b)) for i, b in enumerate(bodies)], "i int, html string")
    got = [(r.t.width, r.t.rows) for r in df.select("i", html_table_rows(F.col("html")).alias("t")).orderBy("i").collect()]
    assert got == [(3, [["t", "1", "spans"], ["u"]]), (3, [["t", "1"], ["u", "1", "2"]]), (3, []), (4, [["t"] * 4])]
