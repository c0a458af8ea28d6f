"""Tables of HTML pages as grids: spans, nested tables, missing tags, against a plain reading."""

import random

from pyspark.sql import functions as F

from shelfwise.sources import files as FS
from shelfwise.sources import grids as G


def grids(spark, html):
    df = spark.createDataFrame([(html,)], "html string")
    return df.select(F.transform(G.tables(F.col("html")), lambda t: G.grid(G.cells(t)))).first()[0]


def test_spans_fill_every_place(spark):
    html = """<TABLE border=1><tr><th rowspan=2>A<th colspan='2'>B</th><th>C</th></tr>
      <tr><td>b1</td><td>b2</td><td rowspan="3"> c &amp; d </td></tr>
      <tr><td>1</td><td colspan=2>2</td></tr><tr><td>3<td>4<td>5</table>"""
    assert grids(spark, html) == [[["A", "B", "B", "C"], ["A", "b1", "b2", "c & d"], ["1", "2", "2", "c & d"], ["3", "4", "5", "c & d"]]]


def test_rows_made_of_spans_only_and_gaps(spark):
    html = "<table><tr><td rowspan=3>a</td><td>b</td><td rowspan=2>c</td></tr><tr></tr><tr><td>d</td></tr><tr><td>e</td></tr></table>"
    assert grids(spark, html) == [[["a", "b", "c"], ["a", "", "c"], ["a", "d"], ["e"]]]


def test_tables_in_document_order_nested_ones_too(spark):
    html = ("<table><tr><td>x</td></tr></table><table><tr><td>o<table><tr><td>n1</td><td>n2</td></tr></table>p</td>"
            "<td><table><tr><td>m<table><tr><td>deep</td></tr></table></td></tr></table></td></tr></table><table><tr><td>z</table><table><tr><td>open")
    assert grids(spark, html) == [[["x"]], [["on1n2p", "mdeep"]], [["n1", "n2"]], [["mdeep"]], [["deep"]], [["z"]]]


def test_no_tables(spark):
    assert grids(spark, "no table") == [] and grids(spark, "") == [] and grids(spark, None) == []
    assert grids(spark, "<table></table>") == [[]]


def plain_grid(rows):
    out, carry = [], {}
    for row in rows:
        line, c = {}, 0
        now = {k: v for k, v in carry.items() if v[1] > 0}
        carry = {k: (t, n - 1) for k, (t, n) in now.items()}
        line.update({k: t for k, (t, _) in now.items()})
        for text, cs, rs in row:
            while c in now:
                c += 1
            for _ in range(cs):
                line[c] = text
                if rs > 1:
                    carry[c] = (text, rs - 1)
                c += 1
        out.append([line.get(i, "") for i in range(max(line, default=-1) + 1)])
    return out


def test_random_tables_equal_a_plain_reading(spark):
    r = random.Random(7)
    data, want = [], []
    for k in range(60):
        # column spans only where no earlier row reaches below, as overlapping cells have no defined place
        rows = [[(f"{k}.{i}.{j}", r.choice([1, 1, 2]) if k % 2 else 1, 1 if k % 2 else r.choice([1, 1, 1, 2, 3])) for j in range(r.randrange(0, 5))]
                for i in range(r.randrange(1, 7))]
        data.append((k, "<table>" + "".join("<tr>" + "".join(f'<td colspan="{c}" rowspan="{n}">{t}</td>' for t, c, n in row) + "</tr>"
                                             for row in rows) + "</table>"))
        want.append(plain_grid(rows))
    df = spark.createDataFrame(data, "k int, html string")
    got = df.select("k", G.grid(G.cells(F.get(G.tables(F.col("html")), F.lit(0)))).alias("g")).orderBy("k").collect()
    assert [r["g"] for r in got] == want


def test_values_stand_under_their_header(spark):
    html = ("<table><tr><th>Other</th></tr></table><table><tr><th> UPC </th><th>Item</th><th colspan=2>Pack</th><th></th></tr>"
            "<tr><td rowspan=2>1</td><td>i</td><td colspan=2>p</td><td>q</td></tr><tr><td>j</td><td>r</td><td>s</td></tr></table>")
    df = spark.createDataFrame([(1, html), (2, "<p>UPC Item</p>"), (3, None)], "id int, html string")
    rows = [r.asDict() for r in FS.html_rows(df, "id", "html", ["UPC", "Item", "Pack", "Pack.1", "Absent"]).orderBy("row_no").collect()]
    assert rows == [{"id": 1, "row_no": 1, "UPC": "1", "Item": "i", "Pack": "p", "Pack.1": "p", "Absent": None},
                    {"id": 1, "row_no": 2, "UPC": "1", "Item": "j", "Pack": "r", "Pack.1": "s", "Absent": None}]
    maps = [r["cells"] for r in FS.html_row_maps(df, "id", "html").orderBy("row_no").collect()]
    assert maps[0]["Unnamed: 4"] == "q" and "Unnamed: 4" not in maps[1]
