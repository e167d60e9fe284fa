"""Queries over landed pages, the exchange directory and the ratio series."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from quoteloom.operators.directory import directory_symbols
from quoteloom.operators.pages import html_list_items, html_table_column, table_cells
from quoteloom.operators.ratio import gap_dates, latest_value, new_values, ratio_from_page, refresh
from quoteloom.queries import inputs as i
from quoteloom.queries.registry import query


@query(
    "ratio_extract",
    "S10 F6 M13",
    r"""SELECT page_id, url, CAST(nullif(regexp_extract(html, 'track\(([0-9.]+)\)', 1), '') AS DOUBLE) AS ratio
    FROM pages WHERE regexp_matches(html, 'track\(([0-9.]+)\)')""",
)
def ratio_extract(spark, sf):
    return ratio_from_page(i.table(spark, sf, "pages"), r"track\(([\d.]+)\)")


# The known series ends on the 12th and has no weekends; publication goes on to the end of the month.
TODAY = date(2024, 1, 30)

_RATIO_SQL = """published AS (
  SELECT CAST(ts AS DATE) AS date,
         CAST(count(*) FILTER (event_type = 'purchase') AS DOUBLE) / CAST(count(*) FILTER (event_type = 'click') AS DOUBLE) AS ratio
  FROM events WHERE isodow(ts) < 6 GROUP BY CAST(ts AS DATE)),
known AS (SELECT date, ratio + 1.0 AS ratio FROM published WHERE date <= DATE '2024-01-12'),
calendar AS (SELECT CAST(unnest(range(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS date),
gaps AS (SELECT date FROM calendar WHERE date > (SELECT max(date) FROM known)),
fresh AS (SELECT date, ratio FROM published WHERE date IN (SELECT date FROM gaps) ORDER BY date DESC LIMIT 10),
series AS (SELECT * FROM known WHERE date NOT IN (SELECT date FROM fresh) UNION ALL SELECT * FROM fresh)"""


def _published(spark, sf):
    kind = F.col("event_type")
    counts = (
        i.table(spark, sf, "events").select(i.day("ts").alias("date"), "event_type")
        .filter(F.weekday("date") < 5).groupBy("date")
        .agg(F.count_if(kind == "purchase").alias("p"), F.count_if(kind == "click").alias("c"))
    )
    return counts.select("date", F.try_divide(F.col("p").cast("double"), F.col("c").cast("double")).alias("ratio"))


def _known(spark, sf):
    return _published(spark, sf).filter("date <= DATE '2024-01-12'").withColumn("ratio", F.col("ratio") + 1.0)


@query("ratio_series", "M9", f"WITH {_RATIO_SQL} SELECT * FROM published")
def ratio_series(spark, sf):
    return _published(spark, sf)


@query("ratio_gap_dates", "J9 O8", f"WITH {_RATIO_SQL} SELECT * FROM gaps")
def ratio_gap_dates(spark, sf):
    return gap_dates(_known(spark, sf), TODAY)


@query("ratio_new_values", "O8 J9", f"WITH {_RATIO_SQL} SELECT * FROM fresh")
def ratio_new_values(spark, sf):
    return new_values(_published(spark, sf), _known(spark, sf), TODAY)


@query("ratio_upsert", "U3 O2 Q7 K10", f"WITH {_RATIO_SQL} SELECT * FROM series ORDER BY date")
def ratio_upsert(spark, sf):
    return refresh(_known(spark, sf), _published(spark, sf), TODAY)


@query("ratio_latest", "O7", f"WITH {_RATIO_SQL} SELECT max(date) AS date, arg_max(ratio, date) AS ratio FROM series")
def ratio_latest(spark, sf):
    return latest_value(refresh(_known(spark, sf), _published(spark, sf), TODAY))


_ITEMS_SQL = """items AS (
  SELECT page_id, unnest(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1)) AS value,
         generate_subscripts(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1), 1) AS n FROM pages)"""


@query("html_list_rows", "S11", f"WITH {_ITEMS_SQL} SELECT page_id, CAST(n - 1 AS INTEGER) AS item_no, value FROM items")
def html_list_rows(spark, sf):
    return html_list_items(i.table(spark, sf, "pages"), key="page_id")


@query(
    "html_table_rows",
    "S11 Q9",
    f"""WITH {_ITEMS_SQL} SELECT page_id, CAST(n AS INTEGER) AS row_no, trim(value) AS value
    FROM items WHERE trim(value) <> ''""",
)
def html_table_rows(spark, sf):
    """The pages' link lists are laid out as the second table of each page and read back by column name."""
    html = F.regexp_replace("html", r'<li><a href="[^"]*">([^<]*)</a></li>', "<TR class=x><td>n</td>\n<td><b>$1</b></td></TR>")
    html = F.replace(html, F.lit("<ul>"), F.lit("<table><tr><td>first</td></tr></table><table id=t><tr><th>No</th><th> Symbol</th></tr>"))
    html = F.replace(html, F.lit("</ul>"), F.lit("</table>"))
    pages = i.table(spark, sf, "pages").select("page_id", html.alias("html"))
    return html_table_column(pages, 1, "Symbol", key="page_id")


@query(
    "html_table_spans",
    "S11 Q9",
    f"""WITH {_ITEMS_SQL}, cells AS (
      SELECT page_id, CAST(n AS INTEGER) AS row_no, trim(value) AS value, CASE WHEN n % 3 = 1 THEN n ELSE n - (n + 2) % 3 END AS top
      FROM items)
    SELECT page_id, row_no, value, CAST(top AS VARCHAR) AS group_value FROM cells WHERE value <> ''""",
)
def html_table_spans(spark, sf):
    """The link lists as tables behind a table in a table: three links share one cell of the first column, names span two."""
    items = F.regexp_extract_all("html", F.lit('<li><a href="[^"]*">([^<]*)</a></li>'), F.lit(1))
    row = lambda value, k: F.concat(
        F.when(k % 3 == 0, F.concat(F.lit("<tr><td rowspan='3'>"), (k + 1).cast("string"), F.lit("</td>"))).otherwise(F.lit("<tr>")),
        F.lit("<td colspan=2 title='a > b'>"), value, F.lit("<td><table><tr><td>inner</td></tr></table></td></tr>"),
    )
    head = "<TABLE><tr><td>a<table><tr><td>b</td></tr></table></td></tr></TABLE><table><tr><th>Group</th><th>Wide</th><th>Symbol</th><th>x</th></tr>"
    html = F.concat(F.lit(head), F.array_join(F.transform(items, row), ""), F.lit("</table>"))
    pages = i.table(spark, sf, "pages").select("page_id", html.alias("html"))
    cells = table_cells(pages, 2, key="page_id").filter("row_no > 0 AND cells[2] IS NOT NULL")
    return cells.select("page_id", "row_no", F.col("cells")[2].alias("value"), F.col("cells")[0].alias("group_value"))


@query(
    "directory_symbols",
    "S5 P8 P9 B2",
    """WITH lines AS (
      SELECT p_partkey AS pos, upper(replace(p_name, ' ', CASE WHEN p_size > 40 THEN '.' ELSE '' END)) AS symbol,
             CASE WHEN p_brand < 'Brand#2' THEN 'Q' WHEN p_type = 'SMALL' THEN 'N' ELSE 'Z' END AS letter,
             CASE WHEN p_type = 'PROMO' THEN 'Y' ELSE 'N' END AS fund,
             CASE WHEN p_size < 5 THEN 'Y' ELSE 'N' END AS test, p_size FROM part)
    SELECT symbol, arg_max(CASE letter WHEN 'Q' THEN 'NASDAQ' WHEN 'N' THEN 'NYSE' ELSE 'OTHER' END, pos) AS exchange
    FROM lines WHERE fund = 'N' AND test = 'N' AND p_size <> 20 AND regexp_full_match(symbol, '[A-Z]+') GROUP BY symbol""",
)
def directory_symbols_query(spark, sf):
    """Parts as directory lines; those of size 20 are cut short."""
    size = F.col("p_size")
    name = F.replace("p_name", F.lit(" "), F.when(size > 40, F.lit(".")).otherwise(F.lit("")))
    letter = F.when(F.col("p_brand") < "Brand#2", "Q").when(F.col("p_type") == "SMALL", "N").otherwise("Z")
    full = F.concat_ws(
        "|", F.lit("Y"), F.upper(name), "p_name", letter, F.lit("S"),
        F.when(F.col("p_type") == "PROMO", "Y").otherwise("N"), F.lit("100"),
        F.when(size < 5, "Y").otherwise("N"), F.lit(""),
    )
    line = F.when(size == 20, F.substring_index(full, "|", 5)).otherwise(full)
    return directory_symbols(i.table(spark, sf, "part").select(line.alias("value"), F.col("p_partkey").alias("pos")))
