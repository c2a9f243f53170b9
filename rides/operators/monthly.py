"""Monthly totals with the previous observed month and percent change."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def month_over_month(daily: DataFrame, date_col: str, value_col: str,
                     month_col: str = "month_start") -> DataFrame:
    """One row per observed month: ``month_total``, ``prev_month_total``
    (the previous *observed* month, so a missing month is skipped) and
    ``mom_percent_change`` = (total - prev) * 100.0 / NULLIF(prev, 0), a
    DOUBLE (the literal is a double, not a decimal).

    The lag window has no PARTITION BY; its input is one row per month.
    """
    monthly = (daily.groupBy(F.expr(f"trunc({date_col}, 'month') as {month_col}"))
                    .agg(F.expr(f"cast(sum({value_col}) as bigint) as month_total")))
    return monthly.selectExpr(
        "*", f"lag(month_total) over (order by {month_col}) as prev_month_total").selectExpr(
        "*", "(month_total - prev_month_total) * 100.0D / nullif(prev_month_total, 0) "
             "as mom_percent_change")
