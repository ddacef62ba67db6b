"""Output columns of every SQL-checked query, shared by both engines.

A shape is ``name:kind`` per column.  Kinds: s text, i integer, d amount with 4
decimals, r ratio with 6 decimals, t day as text, m month as text.  Amounts and
ratios are nudged by less than the precision before rounding, so that values
lying exactly between two roundings do not depend on the order of a sum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewatch.functions.columns import name_sql


def parse(shape: str) -> list[tuple[str, str]]:
    return [tuple(part.rsplit(":", 1)) for part in shape.split()]


def _spark(name: str, kind: str) -> str:
    c = name_sql(name)
    text = {
        "s": c,
        "i": f"CAST({c} AS BIGINT)",
        "d": f"round(CAST({c} AS DOUBLE) + 1e-7D, 4)",
        "r": f"round(CAST({c} AS DOUBLE) + 1e-9D, 6)",
        "t": f"date_format({c}, 'yyyy-MM-dd')",
        "m": f"date_format({c}, 'yyyy-MM')",
    }[kind]
    return f"{text} AS {c}"


def _duck(name: str, kind: str) -> str:
    c = f'"{name}"'
    if kind == "i":
        c = f"CAST({c} AS BIGINT)"
    elif kind == "d":
        c = f"round(CAST({c} AS DOUBLE) + 1e-7, 4)"
    elif kind == "r":
        c = f"round(CAST({c} AS DOUBLE) + 1e-9, 6)"
    elif kind == "t":
        c = f"strftime({c}, '%Y-%m-%d')"
    return f'{c} AS "{name}"'


def shaped(df: DataFrame, shape: str) -> DataFrame:
    """Spark result in its checked shape."""
    return df.selectExpr(*[_spark(n, k) for n, k in parse(shape)])


def shaped_sql(body: str, shape: str) -> str:
    """The outer SELECT of the SQL counterpart (months are text there already)."""
    columns = ", ".join(_duck(n, k) for n, k in parse(shape))
    return f"SELECT {columns} FROM ({body}) _q"


def shaped_by_name(df: DataFrame) -> DataFrame:
    """Model input, whose columns depend on the data: all numbers are doubles."""
    def kind(c: str) -> str:
        return {"dealer_code": "s", "churn_status": "i"}.get(c, "r" if "rotation" in c else "d")

    return df.selectExpr(*[_spark(c, kind(c)) for c in df.columns])
