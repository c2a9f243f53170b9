"""Numeric helpers."""

from pyspark.sql import Column

from rides.functions._util import as_sql, expr


def round_half_away_sql(c, places: int) -> str:
    """Round a DOUBLE to ``places`` decimals as SQL engines that scale, round
    half away from zero and scale back do: ``round(x * 10^p) / 10^p``.

    Spark's own ``round(x, p)`` rounds the shortest decimal text of ``x``
    instead, which can differ when that text ends in 5 at place p+1 while
    the scaled double does not. Scaling first keeps both engines on the same
    IEEE operations, so equal inputs give equal outputs.
    """
    m = f"{float(10 ** places)!r}D"
    return f"round(({as_sql(c)}) * {m}, 0) / {m}"


def round_half_away(c, places: int) -> Column:
    return expr(round_half_away_sql(c, places))
