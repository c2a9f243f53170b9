"""Figures of a load, taken while its rows are written.

The counts ride along with the one action that writes the rows, as observed
metrics, so nothing is scanned for them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, functions as F


def observed(rows: DataFrame, counts: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """``rows``, and the counts of its conditions once an action has run. Every
    row is counted where this stands in the plan, whatever is filtered later."""
    watch = Observation(f"load-{uuid.uuid4().hex}")
    return rows.observe(watch, *(c.alias(name) for name, c in counts.items())), watch


def raw_counts() -> dict[str, Column]:
    """Counts over raw trips: all rows, those that staging will drop and why,
    and those without an id."""
    start, end = F.col("started_at"), F.col("ended_at")
    return {
        "rows_in": F.count(F.lit(1)),
        "negative_duration": F.count_if(end < start),
        "no_start_or_end": F.count_if(start.isNull() | end.isNull()),
        "no_ride_id": F.count_if(F.col("ride_id").isNull()),
        "no_start_station": F.count_if(F.col("start_station_id").isNull()),
    }
