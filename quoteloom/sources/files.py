"""File listing and CSV reading shared by all readers."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from quoteloom.functions.text import WHITESPACE, strip
from quoteloom.schemas import empty
from quoteloom.session import glob, stage

CSV_ROWS = "path string, file_name string, row_order decimal(24,0), fields map<string,string>"
# The files whose rows are read: the path as the scan has it and as it is listed, header names and row of the header.
FILES = "file string, path string, file_name string, names array<string>, header_row bigint"
OfFiles = Callable[[DataFrame], DataFrame]
NOT_BLANK = f"[^{WHITESPACE}]"

# ``monotonically_increasing_id`` counts the rows of a partition in its lower 33 bits.
ROW_BITS = 33


def exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` can be listed; looks at no data."""
    try:
        spark.read.format("binaryFile").load(path)
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def first_existing(spark: SparkSession, paths: list[str]) -> str:
    """The first of several places that exists."""
    for path in paths:
        if exists(spark, path):
            return path
    raise FileNotFoundError(f"none of these exists: {paths}")


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored Parquet table with a fixed schema; a missing path is an empty table.

    Of a table that is replaced as a whole (``replace_table``) this is the newest complete version.
    """
    numbers = versions(spark, path)
    if numbers:
        return spark.read.schema(schema).parquet(f"{path}/version={numbers[-1]}")
    return read_partitions(spark, path, path, schema)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions of a table that is replaced as a whole; incomplete ones have no marker."""
    marks = glob(spark, f"{literal(path)}/version=*/_SUCCESS")
    return sorted(int(re.search(r"/version=(\d+)/", m).group(1)) for m in marks)


def read_partitions(spark: SparkSession, root: str, below: str, schema: str) -> DataFrame:
    """The part ``below`` of a partitioned table at ``root``; only that part is listed."""
    try:
        return spark.read.schema(schema).option("basePath", root).parquet(below)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return empty(spark, schema)
        raise


def row_number() -> Column:
    """Number of a scanned row, which grows inside each split of a file."""
    return F.monotonically_increasing_id().bitwiseAND((1 << ROW_BITS) - 1)


def row_order(at: Column | None = None, row: Column | None = None) -> Column:
    """Position of a row in the scanned file: split offset, then row in the split.

    The same file gives the same order whenever a task is run again. 24 digits hold offsets of files up to
    100 TB.
    """
    at = F.col("_metadata.file_block_start") if at is None else at
    step = F.lit(10_000_000_000).cast("decimal(11,0)")
    return (at.cast("decimal(12,0)") * step + (row_number() if row is None else row)).cast("decimal(24,0)")


def decoded(path: Column) -> Column:
    """Path as it is listed; metadata columns have it percent-encoded."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def file_path() -> Column:
    """Path of the scanned file as it is listed."""
    return decoded(F.col("_metadata.file_path"))


def name_of(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def literal(path: str) -> str:
    """``path`` with the characters escaped that readers take for patterns."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def list_files(spark: SparkSession, folder: str, glob: str = "*.csv") -> DataFrame:
    """(path, name) of the files of a folder, not of its subfolders; their content is not read."""
    pattern = f"{folder.rstrip('/')}/{glob}"
    if not exists(spark, pattern):
        return empty(spark, "path string, name string")
    files = spark.read.format("binaryFile").load(pattern)
    return files.select("path", name_of(F.col("path")).alias("name"))


def csv_values(line: Column) -> Column:
    """The fields of a line; quotes around a field go, doubled quotes inside it are one."""
    field = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',("(?:[^"]++|"")*+"|[^,]*)'), 1)
    inner = lambda x: F.substring(x, F.lit(2), F.length(x) - F.when(F.length(x) > 1, x.endswith('"').cast("int")).otherwise(0) - 1)
    unquote = lambda x: F.when(x.startswith('"'), F.replace(inner(x), F.lit('""'), F.lit('"'))).otherwise(x)
    return F.when(line.contains('"'), F.transform(field, unquote)).otherwise(F.split(line, ",", -1))


def header_names(line: Column) -> Column:
    """Names of a header line without blanks around them; unnamed and repeated ones get their position."""
    names = F.transform(csv_values(F.translate(line, "\r﻿", "")), strip)
    known = lambda x, i: (x == "") | (F.array_position(names, x) <= i)
    return F.transform(names, lambda x, i: F.when(known(x, i), F.concat(F.lit("_c"), i.cast("string"))).otherwise(x))


# A comma and the whole field behind it; a field that begins with a quote and has no closing one does not match.
WHOLE_FIELD = r',(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+|(?=,|$))'
# Whole fields, and one that is left open: of a line with a comma before it, and of one that begins inside quotes.
OPENS = rf'^(?:{WHOLE_FIELD})*+,"'
STAYS_OPEN = rf'^(?:[^"]++|"")*+(?:\z|"[^,]*+(?:{WHOLE_FIELD})*+,")'


def _quote_states(line: Column) -> tuple[Column, Column]:
    """State behind a line (1: inside a quoted field) if it begins outside, and if it begins inside one."""
    quoted = line.contains('"')
    from_outside = F.when(quoted, F.concat(F.lit(","), line).rlike(OPENS)).otherwise(False)
    return from_outside.cast("int"), F.when(quoted, line.rlike(STAYS_OPEN)).otherwise(True).cast("int")


def _composed(df: DataFrame, order: WindowSpec, zero: str, one: str) -> DataFrame:
    """Adds what the state functions ``zero, one`` (state behind 0 and 1) do one after another before and up to each row.

    A function that is constant ends what came before; of the others only swaps change the state. So the state behind
    a row is that of the newest constant function, or the one at the start, changed by the parity of the swaps since.
    """
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    above = order.rowsBetween(Window.unboundedPreceding, -1)
    swap = ((F.col(zero) == 1) & (F.col(one) == 0)).cast("int")
    df = df.withColumn("_odd", F.pmod(F.sum(swap).over(upto), F.lit(2)).cast("int"))
    # The state that a constant function leaves behind, as if the swaps up to there were still to be undone.
    fixed = F.when(F.col(zero) == F.col(one), F.col(zero).bitwiseXOR(F.col("_odd")))
    df = df.withColumns({"_fixed": F.last(fixed, ignorenulls=True).over(upto), "_fixed_above": F.last(fixed, ignorenulls=True).over(above)})
    behind = lambda k: F.coalesce("_fixed", F.lit(k)).bitwiseXOR(F.col("_odd"))
    before = lambda k: F.coalesce("_fixed_above", F.lit(k)).bitwiseXOR(F.col("_odd")).bitwiseXOR(swap)
    found = {f"_behind{k}": behind(k) for k in (0, 1)} | {f"_before{k}": before(k) for k in (0, 1)}
    return df.withColumns(found).drop("_odd", "_fixed", "_fixed_above")


def records(lines: DataFrame) -> DataFrame:
    """Lines ``(file, at, row, value)`` as records: a quoted field may go on over several lines.

    Files in which no line ends inside quotes pass as they are. In the others each line is a function from the state
    before it to the state behind it. Functions are composed inside each split, then over the splits of a file, which
    gives each split its start; from there lines become records in parallel. Split sizes don't change the result. A
    quote that is never closed up to the end of its file opens nothing: the lines from its record on stay single.
    """
    zero, one = _quote_states(F.col("value"))
    files = stage(lines.groupBy("file").agg(F.max(zero).alias("ragged")), "files-of-lines")
    ragged = files.where("ragged = 1").select("file")
    if ragged.isEmpty():
        return lines
    inside = Window.partitionBy("file", "at").orderBy("row")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    broken = lines.join(ragged, "file", "left_semi").select("*", zero.alias("_0"), one.alias("_1"))
    broken = _composed(broken, inside, "_0", "_1")
    # Row of the split in which the record of a line begins; NULL if it begins in a split before.
    begins = {f"_begin{k}": F.last(F.when(F.col(f"_before{k}") == 0, F.col("row")), ignorenulls=True).over(upto) for k in (0, 1)}
    # Written once: splits and records both read it.
    broken = stage(broken.withColumns(begins).drop("_0", "_1", "_before0", "_before1"), "lines")
    order = Window.partitionBy("file").orderBy("at")
    splits = broken.groupBy("file", "at").agg(
        *[F.max_by(c, "row").alias(c) for c in ("_behind0", "_behind1")], *[F.max(c).alias(c) for c in ("_begin0", "_begin1")]
    )
    splits = _composed(splits.withColumnsRenamed({"_behind0": "_0", "_behind1": "_1"}), order, "_0", "_1")
    own = F.when(F.col("_before0") == 0, F.col("_begin0")).otherwise(F.col("_begin1"))
    splits = splits.withColumn("_own", F.when(own.isNotNull(), F.struct("at", own.alias("row"))))
    carried = F.last("_own", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.withColumn("_carried", carried).withColumn("_own", F.coalesce("_own", "_carried"))
    ends = splits.groupBy("file").agg(F.max_by("_behind0", "at").alias("_unclosed"), F.max_by("_own", "at").alias("_last"))
    splits = splits.join(ends, "file").select("file", "at", F.col("_before0").alias("_start"), "_carried", "_unclosed", "_last")
    placed = broken.join(stage(splits, "splits"), ["file", "at"])
    own = F.when(F.col("_start") == 0, F.col("_begin0")).otherwise(F.col("_begin1"))
    begin = F.when(own.isNotNull(), F.struct("at", own.alias("row"))).otherwise(F.col("_carried"))
    begin = F.when((F.col("_unclosed") == 1) & (begin >= F.col("_last")), F.struct("at", "row")).otherwise(begin)
    parts = placed.select("file", begin.alias("begin"), F.struct("at", "row", "value").alias("line"))
    parts = parts.select("file", "begin.at", "begin.row", "line")
    whole = parts.groupBy("file", "at", "row").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    text = F.array_join(F.transform("lines", lambda x: x["value"]), "\n")
    # Written once: headers and rows both read it, and each would put all records together again.
    whole = stage(whole.select("file", "at", "row", text.alias("value")), "records")
    if files.where("ragged = 0").isEmpty():  # nothing is left in the lines
        return whole
    return lines.join(ragged, "file", "left_anti").unionByName(whole)


def lines_of(text: DataFrame) -> DataFrame:
    """Scanned text lines with the places that :func:`csv_rows` needs; ``file`` is the path as the scan has it, encoded."""
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), row_number().alias("row"), "value"
    )


def computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with one more column, which is computed once a row.

    A plain column that is dear would be put into each place that uses it, inside of lambdas and filters too, and so be
    computed for each of them; Spark moves nothing across a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def read_csv(spark: SparkSession, paths: list[str], of_files: OfFiles | None = None) -> DataFrame:
    """Rows of a few files, see :func:`csv_rows`."""
    if not paths:
        return no_rows(spark, of_files)
    return csv_rows(lines_of(spark.read.text([literal(p) for p in paths])), of_files)


def read_csv_folder(
    spark: SparkSession, folder: str, where: Column | None = None, only: DataFrame | None = None, glob: str = "*.csv",
    of_files: OfFiles | None = None,
) -> DataFrame:
    """Rows of the files of a folder as one scan; their paths never pass through the driver's program.

    ``where`` is a condition on ``_metadata`` alone, by which Spark leaves files out before it reads them; ``only`` has
    the column ``path`` of the files that are kept besides.
    """
    pattern = f"{literal(folder.rstrip('/'))}/{glob}"
    if not exists(spark, pattern):
        return no_rows(spark, of_files)
    text = spark.read.text(pattern)
    lines = lines_of(text if where is None else text.where(where))
    if only is not None:  # paths are decoded once a file, not for each line
        files = spark.read.format("binaryFile").load(pattern).select(file_path().alias("path"), F.col("_metadata.file_path").alias("file"))
        lines = lines.join(stage(files.join(only.select("path"), "path", "left_semi").select("file"), "files"), "file", "left_semi")
    return csv_rows(lines, of_files)


def no_rows(spark: SparkSession, of_files: OfFiles | None = None) -> DataFrame:
    """The rows of no file at all."""
    files = empty(spark, FILES)
    more = (of_files(files) if of_files else files).drop(*files.columns)
    return empty(spark, CSV_ROWS).join(more, F.lit(False)) if more.columns else empty(spark, CSV_ROWS)


def csv_rows(lines: DataFrame, of_files: OfFiles | None = None) -> DataFrame:
    """Rows of files with any mix of headers, as ``fields`` by header name; a missing field is NULL.

    The first record of a file that is not blank is its header, whatever the size of file or header. Records and
    headers meet by path: one job for all files, and nothing of them passes through the driver. A quoted field may
    hold line breaks, see :func:`records`.

    ``of_files`` is given the files, one row each with the columns of :data:`FILES`; it may leave some out and add
    columns, which all rows of the file get.
    """
    text = records(lines).where(F.col("value").rlike(NOT_BLANK))
    first = stage(text.where("at = 0").groupBy("file").agg(F.min("row").alias("row")), "header-rows")
    first = text.where("at = 0").join(first, ["file", "row"])
    path = decoded(F.col("file"))
    names = header_names(F.col("value")).alias("names")
    files = stage(first.select("file", path.alias("path"), name_of(path).alias("file_name"), names, F.col("row").alias("header_row")), "headers")
    if of_files is not None:
        files = stage(of_files(files), "files")
    rows = text.join(files, "file").where("at > 0 OR row > header_row")
    rows = computed(rows, "_values", csv_values(F.col("value")))
    values = F.transform(
        F.sequence(F.lit(0), F.size("names") - 1), lambda i: F.nullif(F.get("_values", i), F.lit(""))
    )
    rows = computed(rows, "fields", F.map_from_arrays("names", values))
    more = files.drop(*[f.split()[0] for f in FILES.split(", ")]).columns
    return rows.select("path", "file_name", row_order(F.col("at"), F.col("row")).alias("row_order"), "fields", *more)


def field(*names: str) -> Column:
    """The first of several fields that a row's file has, as text."""
    out = F.lit(None).cast("string")
    for name in reversed(names):
        out = F.when(F.map_contains_key("fields", name), F.element_at("fields", name)).otherwise(out)
    return out


def columns_of(spark: SparkSession, path: str) -> list[str]:
    """Header names of one file."""
    lines = spark.read.text(literal(path)).where(F.length(strip(F.col("value"))) > 0)
    line = lines.where("_metadata.file_block_start = 0").limit(1).select("value", header_names(F.col("value")).alias("names"))
    line = line.withColumn("opens", _quote_states(F.col("value"))[0]).first()
    if line and line["opens"]:  # the header goes on in the next line
        first = records(lines_of(spark.read.text(literal(path)))).where(F.length(strip(F.col("value"))) > 0).orderBy("at", "row").limit(1)
        line = first.select(header_names(F.col("value")).alias("names")).first()
    return line["names"] if line else []


def read_wide_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns of one file as text, with ``row_order``."""
    rows = read_csv(spark, [path])
    return rows.select(*[F.element_at("fields", n).alias(n) for n in columns_of(spark, path)], "row_order")
