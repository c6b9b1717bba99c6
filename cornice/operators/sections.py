"""Rows of data in the running text of a filing's section."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lines import text_lines
from ..functions.text import strip

#: Fixed phrases that begin a section on ownership, and that end one.
BEGINS = "(?i)security ownership|beneficial ownership"
ENDS = "(?i)executive compensation|director compensation|audit committee"
#: Fixed layout of a holder's line: name, shares, percent.
HOLDER = r"(?U)^(.*?)\s+([\d,]+)\s+(\d{1,2}\.\d{1,2}%?)"


def section_lines(docs: DataFrame, key: str, text: str, begins: str = BEGINS, ends: str = ENDS) -> DataFrame:
    """key, i, line of the text's first section: from the first line that begins one to the first that ends it, both included.

    Whether a section was begun, and one was ended, before a line is a running state over the lines.
    """
    before = Window.partitionBy(key).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    lines = text_lines(docs, key, text).withColumn("_in", F.max(F.col("line").rlike(begins)).over(before))
    ended = F.max(F.col("_in") & F.col("line").rlike(ends)).over(before.rowsBetween(Window.unboundedPreceding, -1))
    return lines.withColumn("_out", F.coalesce(ended, F.lit(False))).where("_in and not _out").drop("_in", "_out")


def ownership_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, i, name, shares, percent of the lines in the ownership section that begin with these three.

    A number of commas alone is no line of data.
    """
    parts = [F.regexp_extract(strip(F.col("line")), HOLDER, n) for n in (1, 2, 3)]
    rows = section_lines(docs, key, text).where(strip(F.col("line")).rlike(HOLDER))
    rows = rows.select(key, "i", strip(parts[0]).alias("name"), F.replace(parts[1], F.lit(","), F.lit("")).try_cast("long").alias("shares"), F.replace(parts[2], F.lit("%"), F.lit("")).cast("double").alias("percent"))
    return rows.where("shares is not null")
