"""Data-quality checks as ordinary DataFrame queries.

Every check returns rows ``(check_name, table_name, column_name, violations)``
where ``violations`` is the number of rows the failing-rows query of that
check would return; a check passes when it is 0. NULL values never fail
``unique``, ``accepted_values`` or ``relationships``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

RESULT_COLS = ["check_name", "table_name", "column_name", "violations"]


def _rows(check: str, table: str, counts: dict[str, str], df: DataFrame) -> DataFrame:
    """One aggregation pass over ``df`` computing every count (SQL text per
    column), then unpivoted to one row per column."""
    agg = df.agg(*[F.expr(f"cast({c} as bigint) as c{i}") for i, c in enumerate(counts.values())])
    stack = ", ".join(f"'{name}', c{i}" for i, name in enumerate(counts))
    return agg.selectExpr(f"'{check}' as check_name", f"'{table}' as table_name",
                          f"stack({len(counts)}, {stack}) as (column_name, violations)")


def _lit(v) -> str:
    return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v)


def _outside(column: str, values: list) -> str:
    return f"{column} is not null and {column} not in ({', '.join(_lit(v) for v in values)})"


def not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """All columns of one table in a single pass."""
    return _rows("not_null", table, {c: f"count_if({c} is null)" for c in columns}, df)


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Number of non-NULL values that occur more than once (one shuffle on
    the key; partial aggregation absorbs a heavily repeated value)."""
    dup = (df.where(f"{column} is not null").groupBy(column).agg(F.expr("count(1) as n"))
             .where("n > 1"))
    return _rows("unique", table, {column: "count(1)"}, dup)


def unique_with_key(df: DataFrame, table: str, key: str, column: str) -> DataFrame:
    """``unique`` of both ``key`` and ``column`` where ``key`` is made from
    ``column``: equal columns have equal keys, so one shuffle on the key brings
    the rows of either together."""
    each = (df.select(key, column).repartition(F.col(key)).groupBy(key, column)
              .agg(F.expr("count(1) as n")))
    per_key = each.where(f"{key} is not null").groupBy(key).agg(
        F.expr("sum(n) as n"), F.expr(f"count_if({column} is not null and n > 1) as again"))
    return _rows("unique", table, {key: "count_if(n > 1)", column: "coalesce(sum(again), 0)"}, per_key)


def accepted_values(df: DataFrame, table: str, column: str, values: list) -> DataFrame:
    """Number of distinct non-NULL values outside the accepted list."""
    bad = df.where(_outside(column, values)).select(column).distinct()
    return _rows("accepted_values", table, {column: "count(1)"}, bad)


def values_in_set(df: DataFrame, table: str, column: str, values: list) -> DataFrame:
    """Number of non-NULL rows whose value is outside the set (row level)."""
    return _rows("values_in_set", table, {column: f"count_if({_outside(column, values)})"}, df)


def relationships(child: DataFrame, table: str, column: str, parent: DataFrame,
                  parent_column: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row (left anti join)."""
    keys = parent.selectExpr(f"{parent_column} as {column}").distinct()
    orphans = child.where(f"{column} is not null").join(keys, column, "left_anti")
    return _rows("relationships", table, {column: "count(1)"}, orphans)


def expression_is_false(df: DataFrame, table: str, column: str, condition: str,
                        check: str = "nonnegative") -> DataFrame:
    """Rows for which ``condition`` (SQL text of the violation) holds."""
    return _rows(check, table, {column: f"count_if({condition})"}, df)


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def freshness(source: DataFrame, table: str, loaded_at: str, as_of,
              warn_after_s: int = 86400, error_after_s: int = 2 * 86400) -> DataFrame:
    """Age of the newest ``loaded_at`` against ``as_of``: pass / warn / error.

    ``as_of`` is a timestamp literal or Column (use a fixed one for repeatable
    results; ``F.current_timestamp()`` at run time).
    """
    as_of_c = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")
    newest = source.agg(F.expr(f"max({loaded_at}) as max_loaded_at")).withColumn("as_of", as_of_c)
    age = "timestampdiff(SECOND, max_loaded_at, as_of)"
    return newest.selectExpr(
        f"'{table}' as table_name", "max_loaded_at", "as_of",
        f"cast({age} as bigint) as age_seconds",
        f"case when max_loaded_at is null then 'error' when {age} > {error_after_s} then 'error'"
        f" when {age} > {warn_after_s} then 'warn' else 'pass' end as status")
