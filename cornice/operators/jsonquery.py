"""A small JSON query language over records, compiled to Columns, and record search."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPERATORS = ("$eq", "$neq", "$in", "$contains", "$gt", "$lt")
_NUMERIC = r"^\d+$"


def _text(x: Any) -> str:
    if x is None:
        return ""
    if isinstance(x, bool):
        return str(x).lower()
    if isinstance(x, list):
        return ",".join(_text(y) for y in x)
    return str(int(x)) if isinstance(x, float) and x.is_integer() else str(x)


def _norm(c: Column) -> Column:
    return F.trim(F.coalesce(c.cast("string"), F.lit("")))


def equal(c: Column, value: Any) -> Column:
    """Null is blank; digits compare as numbers; else without case."""
    a, b = _norm(c), F.trim(F.lit(_text(value)))
    digits = a.rlike(_NUMERIC) & b.rlike(_NUMERIC)
    return F.when(digits, a.try_cast("decimal(38,0)") == b.try_cast("decimal(38,0)")).otherwise(F.upper(a) == F.upper(b))


def _number(c: Column) -> Column:
    """Blank is 0; what isn't a number is null, so that comparisons fail."""
    s = _norm(c)
    return F.when(s == "", F.lit(0.0)).when(s.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), s.try_cast("double"))


def _field(c: Column, condition: Any) -> Column:
    if not isinstance(condition, dict):
        return equal(c, condition)
    op = next((o for o in OPERATORS if o in condition), None)  # one operator counts, in fixed order
    if op is None:
        return F.lit(False)
    value = condition[op]
    if op == "$eq":
        return equal(c, value)
    if op == "$neq":
        return ~equal(c, value)
    if op == "$in":
        out = F.lit(False)
        for v in value if isinstance(value, list) else []:
            out = out | equal(c, v)
        return out
    if op == "$contains":
        return F.upper(_norm(c)).contains(F.upper(F.trim(F.lit(_text(value)))))
    a, b = _number(c), _number(F.lit(_text(value)))
    return F.coalesce(a > b if op == "$gt" else a < b, F.lit(False))


def compile_expr(expr: Any, columns: list[str]) -> Column:
    """A Column for the expression; fields that aren't among the columns are blank."""
    if isinstance(expr, list):
        out = F.lit(True)
        for e in expr:
            out = out & compile_expr(e, columns)
        return out
    if not isinstance(expr, dict):
        return F.lit(False)
    if isinstance(expr.get("$and"), list):
        return compile_expr(expr["$and"], columns)
    if isinstance(expr.get("$or"), list):
        out = F.lit(False)
        for e in expr["$or"]:
            out = out | compile_expr(e, columns)
        return out
    out = F.lit(True)
    for name, condition in expr.items():
        out = out & _field(F.col(f"`{name}`") if name in columns else F.lit(None).cast("string"), condition)
    return out


def json_query(records: DataFrame, query: str, limit: int | None = 500, order: str = "id") -> DataFrame:
    found = records.where(compile_expr(json.loads(query), records.columns))
    return found if limit is None else found.orderBy(order).limit(limit)


def search(records: DataFrame, text: str, field: str = "auto", limit: int | None = 200, order: str = "id") -> DataFrame:
    """Exact on identifiers, substring on title; auto tries numbers on numeric fields, else text fields."""
    q = text.strip()
    exact = lambda c: F.upper(_norm(F.col(c))) == q.upper()
    permno = F.coalesce(F.trim(F.col("permno").cast("string")), F.lit("null")) == q
    raw = _norm(F.col("cik_str"))
    padded = F.when(F.length(raw) < 10, F.lpad(raw, 10, "0")).otherwise(raw)
    cik = (raw != "") & ((raw == q) | (padded == q.zfill(10)))
    title = F.upper(_norm(F.col("title"))).contains(q.upper())
    tests = {"permno": permno, "cik": cik, "title": title}
    if field == "auto":
        test = (permno | exact("gvkey") | cik) if q.isdigit() else (exact("ticker") | exact("cusip") | title)
    else:
        test = tests.get(field, exact(field) if field in records.columns else F.lit(False))
    found = records.where(test)
    return found if limit is None else found.orderBy(order).limit(limit)
