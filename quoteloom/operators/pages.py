"""Tables and lists in landed HTML pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quoteloom.functions.text import blank_to_null

# The tables that hold index members, as (page ending, table number, column).
INDEX_TABLES = {
    "sp500": ("List_of_S%26P_500_companies", 0, "Symbol"),
    "sp600": ("List_of_S%26P_600_companies", 0, "Symbol"),
    "nasdaq100": ("Nasdaq-100", 4, "Ticker"),
    "iwm1000": ("Russell_1000_Index", 3, "Symbol"),
}

TABLE = r"(?is)<table\b.*?</table\s*>"
ROW = r"(?is)<tr\b.*?</tr\s*>"
CELL = r"(?is)<t[hd]\b[^>]*>(.*?)</t[hd]\s*>"
TAG = r"<[^>]*>"
LIST_ITEM = r"<li><a href=\"[^\"]*\">([^<]*)</a></li>"

NUMERIC_ENTITY = r"&#([0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});"
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


def _character(number: Column) -> Column:
    """Character of a decimal number, or of a hexadecimal one behind an x; an impossible one stays as it is."""
    code = F.when(
        F.lower(F.substring(number, 1, 1)) == "x", F.conv(F.substring(number, F.lit(2), F.length(number)), 16, 10)
    ).otherwise(number)
    code = code.try_cast("bigint")
    whole = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code < 0x110000))
    char = F.decode(F.unhex(F.lpad(F.hex(F.when(whole, code)), 8, "0")), "UTF-32")
    return F.coalesce(char, F.concat(F.lit("&#"), number, F.lit(";")))


def cell_text(c: Column) -> Column:
    """Text of a cell: tags out, the common and all numeric entities resolved, blanks trimmed."""
    text = F.regexp_replace(c, TAG, "")
    numbers = F.array_distinct(F.regexp_extract_all(text, F.lit(NUMERIC_ENTITY), F.lit(1)))
    text = F.aggregate(numbers, text, lambda t, n: F.replace(t, F.concat(F.lit("&#"), n, F.lit(";")), _character(n)))
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return blank_to_null(text)


# Widths and heights that a cell can have, as in the HTML standard.
MOST_COLUMNS, MOST_ROWS = 1000, 65534
STRUCTURE = r"(?i)(?=</?(?:table|tr|t[hd])\b)"
SPANS = r"(?i)<t[hd]\b[^>]*\b(?:row|col)span\b"
_CELLS = "array<struct<text:string,columns:int,rows:int>>"
_PLACED = "array<struct<text:string,left:int,at:int>>"


def _span(tag: Column, name: str, most: int) -> Column:
    number = F.regexp_extract(tag, rf"(?i)\b{name}\s*=\s*[\"']?\s*0*([0-9]{{1,5}})", 1).try_cast("int")
    return F.when(number > 0, F.least(number, F.lit(most))).otherwise(1)


def _tokens(html: Column) -> Column:
    """The page cut before each table, row and cell tag: kind of the tag, text behind it, spans."""

    def token(piece: Column) -> Column:
        tag = F.regexp_extract(piece, r"(?s)^<(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>", 0)
        kind = F.lower(F.regexp_extract(tag, r"(?i)^<(/?[a-z]+)", 1))
        cell = kind.isin("td", "th")
        return F.struct(
            kind.alias("kind"),
            F.substr(piece, F.length(tag) + 1).alias("text"),
            F.when(cell, _span(tag, "colspan", MOST_COLUMNS)).otherwise(1).alias("columns"),
            F.when(cell, _span(tag, "rowspan", MOST_ROWS)).otherwise(1).alias("rows"),
        )

    return F.transform(F.split(html, STRUCTURE), token)


def _inside(tokens: Column, table_no: Column) -> Column:
    """The tokens of the table with that number, which counts nested tables where they begin."""
    zero = F.struct(*[F.lit(v).cast("int").alias(n) for n, v in (("at", 0), ("seen", 0), ("depth", 0), ("first", None), ("end", None))])

    def step(s: Column, t: Column) -> Column:
        begins, ends = t["kind"] == "table", t["kind"] == "/table"
        here = begins & (s["seen"] == table_no)
        within = s["first"].isNotNull() & s["end"].isNull()
        depth = F.when(here, 1).when(within & begins, s["depth"] + 1).when(within & ends, s["depth"] - 1).otherwise(s["depth"])
        return F.struct(
            (s["at"] + 1).alias("at"),
            (s["seen"] + begins.cast("int")).alias("seen"),
            depth.alias("depth"),
            F.when(here, s["at"]).otherwise(s["first"]).alias("first"),
            F.when(within & ends & (s["depth"] == 1), s["at"]).otherwise(s["end"]).alias("end"),
        )

    cut = lambda s: F.slice(tokens, s["first"] + 2, F.coalesce(s["end"], s["at"]) - s["first"] - 1)
    return F.aggregate(tokens, zero, step, cut)


def _rows(tokens: Column) -> Column:
    """Rows of cells from the tokens inside a table; what is nested deeper is text of the cell around it."""
    none = F.expr(f"CAST(array() AS {_CELLS})")
    zero = F.struct(
        F.lit(0).alias("depth"),
        F.expr(f"CAST(array() AS array<{_CELLS}>)").alias("done"),
        none.alias("row"),
        F.lit(False).alias("in_row"),
        F.lit(False).alias("in_cell"),
        F.struct(F.lit("").alias("text"), F.lit(1).alias("columns"), F.lit(1).alias("rows")).alias("cell"),
    )

    def step(s: Column, t: Column) -> Column:
        kind = t["kind"]
        own = (s["depth"] == 0) & ~kind.isin("table", "/table", "")
        row_edge, starts = own & kind.isin("tr", "/tr"), own & kind.isin("td", "th")
        row = F.when(own & s["in_cell"], F.concat(s["row"], F.array(s["cell"]))).otherwise(s["row"])
        longer = s["cell"].withField("text", F.concat(s["cell"]["text"], t["text"]))
        return F.struct(
            F.when(kind == "table", s["depth"] + 1).when(kind == "/table", s["depth"] - 1).otherwise(s["depth"]).alias("depth"),
            F.when(row_edge & s["in_row"], F.concat(s["done"], F.array(row))).otherwise(s["done"]).alias("done"),
            F.when(row_edge, none).otherwise(row).alias("row"),
            F.when(row_edge, kind == "tr").otherwise(s["in_row"] | starts).alias("in_row"),
            F.when(own, starts).otherwise(s["in_cell"]).alias("in_cell"),
            F.when(starts, F.struct(t["text"].alias("text"), t["columns"].alias("columns"), t["rows"].alias("rows"))).otherwise(longer).alias("cell"),
        )

    # A row edge at the end closes what is open.
    edge = F.struct(F.lit("tr").alias("kind"), F.lit("").alias("text"), F.lit(1).alias("columns"), F.lit(1).alias("rows"))
    return F.aggregate(F.concat(tokens, F.array(edge)), zero, step, lambda s: s["done"])


def _grid(rows: Column) -> Column:
    """Cell texts by row and column: a cell fills as many columns and rows as it spans, but none below the table.

    A cell that hangs down from the row above comes before the first own cell at or behind its column, so none is lost
    where a table's spans overlap.
    """
    none = F.expr(f"CAST(array() AS {_PLACED})")

    def place(above: Column, row: Column) -> Column:
        hanging = F.transform(
            F.filter(above, lambda c: c["left"] > 1),
            lambda c: F.struct(c["text"].alias("text"), (c["left"] - 1).alias("left"), c["at"].alias("at")),
        )

        def put(s: Column, cell: Column) -> Column:
            size, next_ = F.size(s["placed"]), s["next"]
            late = lambda k: F.coalesce(F.get(s["hanging"], next_ + k)["at"] > size + k, F.lit(True))
            n = F.get(F.filter(F.sequence(F.lit(0), F.size(s["hanging"]) - next_), late), F.lit(0))
            own = F.transform(
                F.sequence(F.lit(0), cell["columns"] - 1),
                lambda k: F.struct(cell["text"].alias("text"), cell["rows"].alias("left"), (size + n + k).alias("at")),
            )
            return F.struct(
                F.concat(s["placed"], F.slice(s["hanging"], next_ + 1, n), own).alias("placed"),
                (next_ + n).alias("next"),
                s["hanging"].alias("hanging"),
            )

        start = F.struct(none.alias("placed"), F.lit(0).alias("next"), hanging.alias("hanging"))
        return F.aggregate(row, start, put, lambda s: F.concat(s["placed"], F.slice(s["hanging"], s["next"] + 1, F.size(s["hanging"]))))

    zero = F.expr(f"CAST(array() AS array<{_PLACED}>)")
    above = lambda done: F.coalesce(F.get(done, F.size(done) - 1), none)
    whole = F.aggregate(rows, zero, lambda done, row: F.concat(done, F.array(place(above(done), row))))
    return F.transform(whole, lambda row: F.transform(row, lambda c: c["text"]))


def table_grid(html: Column, table_no: Column) -> Column:
    """Raw cell texts of a table by row and column; NULL without that table.

    A page of plain tables is cut by regular expressions. One with spans or with a table inside a table is folded tag
    by tag; its rows, cells and tables may lack their end tags.
    """
    tables = F.regexp_extract_all(html, F.lit(TABLE), F.lit(0))
    nested = F.exists(tables, lambda t: t.rlike(r"(?is)^.+<table\b"))
    plain = F.transform(
        F.regexp_extract_all(F.get(tables, table_no), F.lit(ROW), F.lit(0)),
        lambda row: F.regexp_extract_all(row, F.lit(CELL), F.lit(1)),
    )
    return F.when(nested | html.rlike(SPANS), _grid(_rows(_inside(_tokens(html), table_no)))).otherwise(plain)


def table_cells(pages: DataFrame, table_no: int, key: str = "url") -> DataFrame:
    """Rows of the ``table_no``-th table of each page as an array of cell texts; a page without it gives no row."""
    rows = table_grid(F.col("html"), F.lit(table_no))
    return pages.select(key, F.posexplode(rows).alias("row_no", "raw")).select(key, "row_no", F.transform("raw", cell_text).alias("cells"))


def html_table_column(pages: DataFrame, table_no: int | Column, column: str | Column, key: str = "url") -> DataFrame:
    """One named column of a page's table, below its header row, as (key, row_no, value).

    Table number and name may depend on the page; nested tables are counted where they begin. A cell that spans rows
    or columns stands in each of them. The wanted cells are picked inside the array of rows, and only they are
    exploded: no join, and no grouping by page.
    """
    number = table_no if isinstance(table_no, Column) else F.lit(table_no)
    wanted = (column if isinstance(column, Column) else F.lit(column)).alias("wanted")
    with_rows = pages.select(key, table_grid(F.col("html"), number).alias("rows"), wanted)
    header = F.transform(F.get("rows", F.lit(0)), cell_text)
    located = with_rows.select(key, "rows", F.array_position(header, F.col("wanted")).cast("int").alias("at"))
    values = F.transform("rows", lambda row: cell_text(F.get(row, F.col("at") - 1)))
    found = located.select(key, F.posexplode(F.when(F.col("at") > 0, values)).alias("row_no", "value"))
    return found.filter((F.col("row_no") > 0) & F.col("value").isNotNull())


def html_list_items(pages: DataFrame, item: str = LIST_ITEM, key: str = "url") -> DataFrame:
    """S11 for lists: every match of ``item`` in page order as (key, item_no, value)."""
    found = F.regexp_extract_all("html", F.lit(item), F.lit(1))
    return pages.select(key, F.posexplode(found).alias("item_no", "value"))


def index_members(pages: DataFrame, index: str) -> DataFrame:
    """Symbols of one index from its landed page, in table order."""
    ending, table_no, column = INDEX_TABLES[index]
    page = pages.filter(F.endswith("url", F.lit(ending)))
    found = html_table_column(page, table_no, column)
    return found.select(F.col("value").alias("symbol"), F.col("row_no").cast("bigint").alias("pos"))


def all_index_members(pages: DataFrame) -> DataFrame:
    """(group, symbol, pos) of all known indexes in one pass over the pages."""
    name = table_no = column = F.lit(None)
    for group, (ending, number, header) in INDEX_TABLES.items():
        here = F.endswith("url", F.lit(ending))
        name, table_no, column = (
            F.when(here, F.lit(v)).otherwise(old) for v, old in ((group, name), (number, table_no), (header, column))
        )
    known = pages.select("html", name.alias("group"), table_no.cast("int").alias("_no"), column.alias("_column"))
    known = known.filter(F.col("group").isNotNull())
    found = html_table_column(known, F.col("_no"), F.col("_column"), key="group")
    return found.select("group", F.col("value").alias("symbol"), F.col("row_no").cast("bigint").alias("pos"))
