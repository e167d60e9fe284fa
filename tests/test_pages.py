import random
from datetime import date, timedelta
from html.parser import HTMLParser

import pytest
from helpers import rows
from pyspark.sql import functions as F

from quoteloom.operators import pages, ratio
from quoteloom.schemas import RATIO_SERIES
from quoteloom.sources.files import read_table
from quoteloom.operators.directory import directory_symbols
from quoteloom.plans.ratio import published_ratios, run_ratio

RATIO = '<tr><td>EQUITY PUT/CALL RATIO</td><td class="r">{}</td></tr>'
TODAY = date(2024, 3, 20)


def series(spark, data):
    return spark.createDataFrame(data, "date date, ratio double")


def test_ratio_from_page(spark):
    df = spark.createDataFrame(
        [("a", RATIO.format("0.62")), ("b", "<td>EQUITY PUT/CALL RATIO</td>"), ("c", RATIO.format(".")), ("d", None)],
        "url string, html string",
    )
    assert rows(ratio.ratio_from_page(df)) == [("a", 0.62)]


def walk_back(known, published, today, lookback):
    """Day by day from today, as a plain loop."""
    out, day, looked = {}, today, 0
    while looked < 3 * lookback and len(out) < lookback:
        if day in known:
            break
        looked += 1
        if day in published:
            out[day] = published[day]
        day -= timedelta(days=1)
    return out


@pytest.mark.parametrize("last", [None, 0, 1, 5, 12, 40])
@pytest.mark.parametrize("lookback", [2, 10])
def test_refresh_equals_the_walk(spark, last, lookback):
    published = {TODAY - timedelta(days=k): float(k) for k in range(60) if (TODAY - timedelta(days=k)).weekday() < 5}
    known = {} if last is None else {d: -v for d, v in published.items() if d <= TODAY - timedelta(days=last)}
    known[TODAY + timedelta(days=9)] = 5.0
    expected = {**known, **walk_back(known, published, TODAY, lookback)}
    got = ratio.refresh(series(spark, list(known.items())), series(spark, list(published.items())), TODAY, lookback)
    collected = [tuple(r) for r in got.collect()]
    assert dict(collected) == expected
    assert [d for d, _ in collected] == sorted(expected)


def test_run_ratio_twice_changes_nothing(spark, tmp_path):
    html = [(f"http://x/daily/?dt={TODAY - timedelta(days=k)}", RATIO.format(f"0.{k + 1}")) for k in range(3)]
    landed = spark.createDataFrame(html, "url string, html string")
    assert published_ratios(landed).count() == 3
    path = str(tmp_path / "ratio")
    assert tuple(run_ratio(spark, landed, path, TODAY).first()) == (TODAY, 0.1)
    first = rows(read_table(spark, path, RATIO_SERIES))
    assert len(first) == 3
    run_ratio(spark, landed, path, TODAY)
    assert rows(read_table(spark, path, RATIO_SERIES)) == first


HTML = """<html><TABLE class="a"><tr><th>x</th></tr></TABLE>
<table id="constituents"><thead><tr><th>Name</th><th scope="col"> <a href="#">Symbol</a> </th></tr></thead>
<tbody><tr><td>Berkshire &amp; Co</td><td><b>BRK.B</b></td></tr>
<tr><td>No symbol</td></tr>
<TR><TD>AT&amp;T</TD><TD>T&nbsp;</TD></TR></tbody></table></html>"""


def test_html_tables(spark):
    df = spark.createDataFrame([("u", HTML), ("v", "<p>none</p>"), ("w", None)], "url string, html string")
    assert rows(pages.html_table_column(df, 1, "Symbol")) == [("u", 1, "BRK.B"), ("u", 3, "T")]
    assert pages.html_table_column(df, 1, "Ticker").count() == 0
    assert pages.html_table_column(df, 5, "Symbol").count() == 0
    cells = {r["row_no"]: r["cells"] for r in pages.table_cells(df, 1).collect()}
    assert cells == {0: ["Name", "Symbol"], 1: ["Berkshire & Co", "BRK.B"], 2: ["No symbol"], 3: ["AT&T", "T"]}


def test_index_members(spark):
    page = HTML.replace("<html>", "<html>" + "<table></table>" * 2)
    df = spark.createDataFrame([("https://x/wiki/Russell_1000_Index", page)], "url string, html string")
    got = pages.index_members(df, "iwm1000").orderBy("pos")
    assert [r["symbol"] for r in got.collect()] == ["BRK.B", "T"]
    assert pages.index_members(df, "sp500").count() == 0


def test_html_list_items(spark):
    df = spark.createDataFrame([("u", '<li><a href="/a">A</a></li><li>no</li><li><a href="/b">B</a></li>')], "url string, html string")
    assert rows(pages.html_list_items(df)) == [("u", 0, "A"), ("u", 1, "B")]


def test_directory(spark):
    lines = [
        "Y|AAPL|Apple|Q|Q|N|100|N||", "Y|IBM|Ibm|N| |N|100|N||", "Y|BRK.A|B|N| |N|1|N||", "Y|SPY|Fund|P| |Y|100|N||",
        "Y|ZVZZT|Test|Q|G|N|100|Y||", "Y|lower|x|Q|G|N|100|N||", "Y|SHORT|x|Q", "Y|AAPL|Apple|P|Q|N|100|N||", "",
    ]
    df = spark.createDataFrame([(v, k) for k, v in enumerate(lines)], "value string, pos bigint")
    assert rows(directory_symbols(df)) == [("AAPL", "OTHER"), ("IBM", "NYSE")]
    assert rows(directory_symbols(df.drop("pos")).select("symbol")) == [("AAPL",), ("IBM",)]


def test_numeric_entities(spark):
    from quoteloom.operators.pages import cell_text

    df = spark.createDataFrame([("BF&#46;B",), ("&#x42;RK&#46;A &#38;amp; &#20013;&#128578;",), ("&#0; &#xD800;",)], "c string")
    got = [r[0] for r in df.select(cell_text(F.col("c"))).collect()]
    assert got == ["BF.B", "BRK.A & 中🙂", "&#0; &#xD800;"]


class Grid(HTMLParser):
    """All tables of a page, read by a stack, as grids; a plain reading of the rules for spans."""

    def __init__(self, html):
        super().__init__()
        self.tables, self.open = [], []
        self.feed(html)

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.tables.append([])
            self.open.append(self.tables[-1])
        elif tag == "tr" and self.open:
            self.open[-1].append([])
        elif tag in ("td", "th") and self.open and self.open[-1]:
            a = dict(attrs)
            self.open[-1][-1].append([[], int(a.get("colspan", 1)), int(a.get("rowspan", 1)), True])

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.open and self.open[-1] and self.open[-1][-1]:
            self.open[-1][-1][-1][3] = False
        if tag == "table" and self.open:
            self.open.pop()

    def handle_data(self, data):
        for table in self.open:
            if table and table[-1] and table[-1][-1][3]:
                table[-1][-1][0].append(data)

    def grid(self, n):
        hanging, out = [], []  # (column, text, rows left), by column
        for row in self.tables[n]:
            line, still = [], []

            def hang(column, text, left):
                line.append(text)
                if left > 1:
                    still.append((column, text, left - 1))

            for parts, columns, rows_, _ in row:
                while hanging and hanging[0][0] <= len(line):
                    hang(*hanging.pop(0))
                for _ in range(columns):
                    hang(len(line), "".join(parts), rows_)
            for cell in hanging:
                hang(*cell)
            hanging = still
            out.append([t.strip() or None for t in line])
        return out


def random_table(rng, depth=0):
    def cell():
        spans = "".join(f' {n}span="{rng.randint(1, 3)}"' for n in ("row", "col") if rng.random() < 0.3)
        inner = random_table(rng, depth + 1) if depth < 2 and rng.random() < 0.15 else ""
        return f"<t{rng.choice('hd')}{spans}> c{rng.randint(0, 999)} <b>x</b>{inner}</t{'d'}>"

    body = "".join(f"<TR>{''.join(cell() for _ in range(rng.randint(1, 4)))}</TR>" for _ in range(rng.randint(1, 5)))
    return f"<p>text<table class=x><tbody>{body}</tbody></table>"


def test_spans_and_nested_tables_against_a_stack(spark):
    rng = random.Random(6)
    htmls = ["".join(random_table(rng) for _ in range(3)) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(htmls)), "url long, html string")
    checked = 0
    for n in range(4):
        got = {}
        for r in pages.table_cells(df, n).collect():
            got.setdefault(r.url, {})[r.row_no] = list(r.cells)
        for k, html in enumerate(htmls):
            parsed = Grid(html)
            if n < len(parsed.tables):
                assert [got[k][r] for r in range(len(got[k]))] == parsed.grid(n), html
                checked += 1
    assert checked > 130


def test_symbol_below_a_rowspan(spark):
    html = (
        "<table><tr><th colspan=2>Name<th>Symbol</tr><tr><td rowspan=2>G<td>a<td>AAA<tr><td>b<td>BBB</tr>"
        "<tr><td colspan='2'>c</td><td rowspan=9>CCC</td></tr><tr><td>d</td><td>e</td></tr></table>"
    )
    df = spark.createDataFrame([("u", html), ("none", None), ("empty", ""), ("plain", "<table></table>")], "url string, html string")
    got = rows(pages.html_table_column(df, 0, "Symbol"))
    assert got == [("u", 1, "AAA"), ("u", 2, "BBB"), ("u", 3, "CCC"), ("u", 4, "CCC")]
