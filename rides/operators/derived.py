"""Tables derived month by month from a versioned table.

A derived table is versioned too, and its manifest says from which snapshot of
the source each of its months was made. A refresh reads only the months whose
snapshot is another one now, so it costs what changed, whatever stopped before
or how many loads came between.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rides.sources import parquet as PQ, versions as V


def refresh(spark: SparkSession, path: str, source: dict, read: Callable[[list[str]], DataFrame],
            transform: Callable[[DataFrame], DataFrame]) -> dict:
    """Bring the table at ``path`` up to the version ``source`` and return its
    manifest, with ``refreshed``, the months made anew.

    ``read(months)`` gives the source's rows with their trip month;
    ``transform`` keeps that column and maps rows of a month to rows of it."""
    now = V.current(path) or {"months": {}, "source": {}}
    stale = sorted(m for m, snap in source["months"].items() if now["source"].get(m) != snap)
    gone = set(now["months"]) - set(source["months"])
    if not stale and not gone and "version" in now:
        return {**now, "refreshed": []}
    snap = V.new_snapshot()
    folder = f"{path}/{V.SNAP_COL}={snap}"
    rows = transform(read(stale))
    rows.hint("rebalance", F.col(PQ.MONTH_COL)).write.partitionBy(PQ.MONTH_COL).parquet(folder)
    made = {m: snap for m in PQ.partition_values(folder)}       # a month may have come out empty
    kept = {m: s for m, s in now["months"].items() if m in source["months"] and m not in stale}
    done = V.publish(path, {"months": {**kept, **made}, "source": source["months"]})
    return {**done, "refreshed": stale}


def read(spark: SparkSession, path: str, schema: T.StructType, months: list[str] | None = None) -> DataFrame:
    """The version in force, with the trip month."""
    return V.read(spark, path, schema, V.current(path), months)
