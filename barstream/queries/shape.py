"""Output shape shared by a query and its SQL twin.

A shape is a list of words: ``name`` passes through, ``name~6`` is rounded to six
digits, ``name@`` is a date shown as text, ``name#`` is a whole number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


def _parts(shape: str):
    for word in shape.split():
        if "~" in word:
            name, digits = word.split("~")
            yield name, "round", int(digits)
        elif word[-1] in "@#":
            yield word[:-1], word[-1], None
        else:
            yield word, "", None


def shaped(df: DataFrame, shape: str) -> DataFrame:
    out = []
    for name, kind, digits in _parts(shape):
        column = F.col(name)
        if kind == "round":
            # Adding zero turns a negative zero into a plain one.
            column = F.round(column.cast("double"), digits) + F.lit(0.0)
        elif kind == "@":
            column = F.date_format(column, "yyyy-MM-dd")
        elif kind == "#":
            column = column.cast("bigint")
        out.append(column.alias(name))
    return df.select(*out)


def half_up(expression: str, digits: int) -> str:
    """SQL that rounds a double as Spark does: half up on its shortest decimal form."""
    return (f"CAST(round(CAST(CAST(CAST({expression} AS DOUBLE) AS VARCHAR) AS DECIMAL(38, 15)), "
            f"{digits}) AS DOUBLE)")


def shaped_sql(ctes: str, source: str, shape: str, tail: str = "") -> str:
    out = []
    for name, kind, digits in _parts(shape):
        column = f'"{name}"'
        if kind == "round":
            column = f"{half_up(column, digits)} + 0.0"
        elif kind == "@":
            column = f"strftime({column}, '%Y-%m-%d')"
        elif kind == "#":
            column = f"CAST({column} AS BIGINT)"
        out.append(f'{column} AS "{name}"')
    head = f"WITH RECURSIVE {ctes} " if ctes else ""
    return f"{head}SELECT {', '.join(out)} FROM {source} {tail}".strip()
