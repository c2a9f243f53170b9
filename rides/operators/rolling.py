"""Row-framed rolling statistics over an ordered series.

Frames count rows, not calendar days: a missing date makes a "7-day" frame
reach further back, and the first rows average whatever rows exist.

Without ``partition_cols`` the window runs in one task. Apply it only to a
series already aggregated to one row per period (days, months): its size is
bounded by the calendar span, never by the number of trips.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from rides.functions._util import as_sql


def trailing_sql(order_col: str, rows: int, partition_cols: list[str] | None = None) -> str:
    part = f"partition by {', '.join(partition_cols)} " if partition_cols else ""
    return f"({part}order by {order_col} rows between {rows - 1} preceding and current row)"


def rolling_stats(series: DataFrame, order_col: str, value_col: str,
                  avg_windows: dict[str, int], stddev_windows: dict[str, int] | None = None,
                  partition_cols: list[str] | None = None) -> DataFrame:
    """Add trailing AVG columns (name -> rows) and population STDDEV columns."""
    cols = [f"avg({value_col}) over {trailing_sql(order_col, n, partition_cols)} as {name}"
            for name, n in avg_windows.items()]
    cols += [f"stddev_pop({value_col}) over {trailing_sql(order_col, n, partition_cols)} as {name}"
             for name, n in (stddev_windows or {}).items()]
    return series.selectExpr("*", *cols)


def zscore_flag_sql(value, mean, sd, threshold: float = 3.0) -> str:
    """1 when sd > 0 and |value - mean| / sd > threshold, else 0.

    The guard keeps a zero deviation from dividing by zero; ``try_divide``
    keeps ANSI mode from raising where the guard is false.
    """
    v, m, s = as_sql(value), as_sql(mean), as_sql(sd)
    return (f"case when ({s}) > 0 and try_divide(abs(({v}) - ({m})), {s}) > {threshold!r} "
            f"then 1 else 0 end")
