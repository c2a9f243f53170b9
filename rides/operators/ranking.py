"""Ranking within groups (ties share a rank, the next rank skips)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def rank_within(df: DataFrame, partition_cols: list[str], order_col: str,
                name: str = "rank", descending: bool = True) -> DataFrame:
    """RANK() per partition; descending puts NULLs last, ascending too."""
    order = f"{order_col} desc nulls last" if descending else f"{order_col} asc nulls last"
    part = ", ".join(partition_cols)
    return df.selectExpr("*", f"cast(rank() over (partition by {part} order by {order}) as bigint)"
                              f" as {name}")
