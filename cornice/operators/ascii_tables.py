"""Tables drawn in plain text: columns apart by gaps of two blanks or more; and headers found again in the rows of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.headers import any_of
from ..functions.lines import text_lines
from ..functions.text import squeeze, strip
from .cells import KEY

GAP = r"(?U)\s{2,}"
RULE = r"(?U)^[-\s_]+$"
#: Fixed sizes and words: lines in which a header is looked for; rows in which it is looked for again, and its words.
HEADER_LINES, HEADER_ROWS = 30, 6
WORDS = ["name", "position", "year", "salary", "bonus", "total", "stock", "option", "compensation"]


def _parts(line: Column) -> Column:
    return F.transform(F.split(strip(line), GAP), strip)


def _is_header(low: Column) -> Column:
    return (low.contains("position") & low.contains("year")) | (low.contains("name") & low.contains("principal") & low.contains("position"))


def ascii_cells(texts: DataFrame, key: str, text: str) -> DataFrame:
    """doc, table_idx 0, row_idx, col_idx, head, text of each text that is a table.

    The header is the first line, of the first filled ones, with a position and a year or
    a whole name cue, else the first filled line; it needs two columns.  Rules and
    lines of one cell go, and other lines are filled up or cut to the header's columns.
    """
    lines = text_lines(texts, key, text).where(strip(F.col("line")) != "")
    w = Window.partitionBy(key)
    lines = lines.withColumn("n", F.row_number().over(w.orderBy("i")))
    low = F.lower("line")
    first = F.min(F.when((F.col("n") <= HEADER_LINES) & _is_header(low), F.col("n"))).over(w)
    lines = lines.withColumn("_h", F.coalesce(first, F.lit(1)))
    names = F.max(F.when(F.col("n") == F.col("_h"), F.filter(_parts(F.col("line")), lambda x: x != ""))).over(w)
    rows = lines.withColumn("_names", names).withColumn("_cells", _parts(F.col("line")))
    rows = rows.where((F.col("n") > F.col("_h")) & (F.size("_names") > 1) & (F.size("_cells") > 1) & ~strip(F.col("line")).rlike(RULE))
    cells = F.transform("_names", lambda name, i: F.struct(i.alias("col_idx"), name.alias("head"), F.coalesce(F.get("_cells", i), F.lit("")).alias("text")))
    # Numbered before the cells come apart.
    rows = rows.withColumn("row_idx", F.row_number().over(w.orderBy("n")) - 1)
    return rows.select(F.col(key).alias("doc"), F.lit(0).alias("table_idx"), "row_idx", F.inline(cells))


def with_found_header(cells: DataFrame) -> DataFrame:
    """cells (doc, table_idx, row_idx, col_idx, head, text) with `name` in place of head.

    The first of the first rows with words of headers in two cells becomes the header,
    and rows up to it go.  Columns of nulls alone go, and of columns with one name the
    first stays; white space in names is squeezed.
    """
    numbered = cells.withColumn("_r", F.dense_rank().over(Window.partitionBy(*KEY).orderBy("row_idx")))
    row = Window.partitionBy(*KEY, "_r")
    numbered = numbered.withColumn("_n", F.count_if(any_of(F.lower("text"), WORDS)).over(row))
    found = F.min(F.when((F.col("_r") <= HEADER_ROWS) & (F.col("_n") >= 2), F.col("_r"))).over(Window.partitionBy(*KEY))
    numbered = numbered.withColumn("_h", F.coalesce(found, F.lit(0)))
    column = Window.partitionBy(*KEY, "col_idx")
    head = F.coalesce(F.max(F.when(F.col("_r") == F.col("_h"), F.coalesce("text", F.lit("nan")))).over(column), F.col("head"))
    body = numbered.withColumn("name", strip(squeeze(head))).where(F.col("_r") > F.col("_h"))
    body = body.withColumn("_filled", F.count("text").over(column)).where("_filled > 0")
    first = F.min("col_idx").over(Window.partitionBy(*KEY, "name"))
    return body.withColumn("_first", first).where("col_idx = _first").select(*KEY, "row_idx", "col_idx", "name", "text")
