"""Exact count / mean / interpolated percentiles per group.

Plan (aggregations with map-side partial aggregation, and two windows):

1. histogram: (group, value) -> count. The shuffle key includes the value, so
   a group that holds a third of all rows is still spread over many reducers.
2. the histogram is counted again per coarse bucket of values; running sums
   over the buckets give each group's size, and the bucket and place of every
   rank a percentile needs;
3. only the values of those buckets are put in order. No task keeps a table
   of a group's values in memory: windows spill.

Values are carried as an exact integer (for durations, microseconds) and
converted to the reported unit only at the end: the mean is sum(integer) / n
and each percentile interpolates between integers (exact for quarter
positions), so the result does not depend on summation order or on the
interpolation formula an engine uses. Percentiles commute with the monotone
linear unit conversion, so the values are those of the unit column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def value_histogram(df: DataFrame, group_cols: list[str], int_value: str,
                    value_name: str = "_v", count_name: str = "_c") -> DataFrame:
    """(group, value) -> count, with map-side partial aggregation.
    ``int_value`` is a column name or SQL expression."""
    return (df.selectExpr(*group_cols, f"{int_value} as {value_name}")
              .groupBy(*group_cols, value_name).agg(F.expr(f"count(1) as {count_name}")))


# Values that share all but this many low bits form a bucket (about a second
# of microseconds).
BUCKET_BITS = 20


def stats_from_histogram(hist: DataFrame, group_cols: list[str], value_col: str, freq_col: str,
                         to_unit_sql, percentiles: dict[str, float], count_name: str = "n",
                         mean_name: str = "mean") -> DataFrame:
    """Count, exact mean and interpolated percentiles per group from a
    (group, integer value, frequency) histogram. ``to_unit_sql`` maps SQL
    text of the integer unit to SQL text of the reported unit; it must be
    monotone and linear (it is applied after interpolation)."""
    group = ", ".join(group_cols)
    bucket = f"shiftright({value_col}, {BUCKET_BITS})"
    place = {n: f"(_n - 1) * {float(p)!r}D" for n, p in percentiles.items()}
    ranks = ", ".join(f"cast({side}({at}) as bigint)" for at in place.values() for side in ("floor", "ceil"))
    coarse = (hist.where(f"{value_col} is not null").selectExpr(*group_cols, f"{bucket} as _b", f"{freq_col} as _c",
                                                                 f"cast({value_col} as decimal(38,0)) * {freq_col} as _s")
                  .groupBy(*group_cols, "_b").agg(F.expr("sum(_c) as _c"), F.expr("sum(_s) as _s")))
    sums = coarse.selectExpr(
        "*", f"sum(_c) over (partition by {group}) as _n", f"sum(_s) over (partition by {group}) as _sum",
        f"sum(_c) over (partition by {group} order by _b) - _c as _before")
    wanted = sums.selectExpr(
        *[f"{c} as _g{i}" for i, c in enumerate(group_cols)], "_b", "_n", "_sum", "_before",
        f"explode(filter(array_distinct(array({ranks})), r -> r >= _before and r < _before + _c)) as _rank")
    values = hist.selectExpr(*group_cols, f"{value_col} as _value", f"{freq_col} as _f", f"{bucket} as _vb")
    same = F.col("_b") == F.col("_vb")
    for i, c in enumerate(group_cols):
        same = same & F.col(f"_g{i}").eqNullSafe(F.col(c))
    found = values.join(wanted, same).selectExpr(
        "*", f"sum(_f) over (partition by {group}, _vb, _rank order by _value) as _upto").where(
            "_rank - _before < _upto and _rank - _before >= _upto - _f")
    at = {n: [F.expr(f"max(case when _rank = cast({side}({p}) as bigint) then _value end) as _{side}{i}")
              for side in ("floor", "ceil")] for i, (n, p) in enumerate(place.items())}
    agg = found.groupBy(*group_cols).agg(F.expr("max(_n) as _n"), F.expr("max(_sum) as _sum"),
                                         *[e for pair in at.values() for e in pair])

    def between(i: int, p: str) -> str:
        return (f"case when _floor{i} = _ceil{i} then cast(_floor{i} as double) else "
                f"(ceil({p}) - {p}) * _floor{i} + ({p} - floor({p})) * _ceil{i} end")

    return agg.selectExpr(
        *group_cols, f"_n as {count_name}",
        f"{to_unit_sql('cast(_sum as double) / _n')} as {mean_name}",
        *[f"{to_unit_sql(between(i, p))} as {n}" for i, (n, p) in enumerate(place.items())])


def exact_stats(df: DataFrame, group_cols: list[str], int_value: str, to_unit_sql,
                percentiles: dict[str, float], count_name: str = "n",
                mean_name: str = "mean") -> DataFrame:
    """Histogram then per-group statistics (see the module notes)."""
    hist = value_histogram(df, group_cols, int_value)
    return stats_from_histogram(hist, group_cols, "_v", "_c", to_unit_sql, percentiles,
                                count_name, mean_name)
