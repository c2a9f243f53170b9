"""Column helpers are written once, as Spark SQL text.

Each public helper takes column names or SQL snippets (strings) and returns
``F.expr(text)``; its ``*_sql`` twin returns the text itself for
``selectExpr``, SQL queries or SQL function bodies. Building one expression
from text costs one call into the JVM, where composing it from ``Column``
objects costs one call per node.
"""

from pyspark.sql import Column, functions as F


def expr(text: str, alias: str | None = None) -> Column:
    c = F.expr(text)
    return c.alias(alias) if alias else c


def as_sql(c) -> str:
    if not isinstance(c, str):
        raise TypeError("pass a column name or SQL expression text, not a Column")
    return c
