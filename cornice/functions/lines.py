"""Texts as tables of numbered lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import spread

#: Ends of lines as Unicode has them.
LINE_END = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029]"


def lines_of(text: Column) -> Column:
    """The lines of a text; an end of line at its end begins no further one, and an empty text has none."""
    whole = F.regexp_replace(text, rf"(?:{LINE_END})\z", "")
    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(whole, LINE_END))


def text_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, i, line: a row for each line, numbered from 0; dealt out by key before, as texts are fewer and smaller than lines."""
    return spread(docs.select(key, text), key).select(key, F.posexplode(lines_of(F.col(text))).alias("i", "line"))
