"""Versions of a month-partitioned Parquet table.

Data files are never replaced: every load writes a snapshot folder of its own,
``<path>/snap=<id>/trip_month=<month>/``. A version is a manifest,
``<path>/_versions/<number>.json``, that names the snapshot of each month and
carries what is known of the load; the file ``<path>/_current`` holds the
number of the version in force. Writing it is the one step that publishes a
load, so a load that stops anywhere leaves the version before it whole, and a
reader that was opened on a version keeps reading its files. ``vacuum`` deletes
what no kept version names.

One writer at a time; any number of readers.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, types as T

from rides.sources import parquet as PQ

SNAP_COL = "snap"


class UnversionedTable(ValueError):
    """A folder of months without versions, as older releases wrote it."""


def new_snapshot() -> str:
    return "s" + uuid.uuid4().hex


def _pointer(path: str) -> str:
    return f"{path}/_current"


def _manifest(path: str, number: int) -> str:
    return f"{path}/_versions/{number:08d}.json"


def current(path: str) -> dict | None:
    """The manifest in force, None for a table without a version."""
    number = PQ.read_text(_pointer(path))
    if number is None:
        if PQ.path_exists(path) and PQ.partition_values(path):
            raise UnversionedTable(f"{path} holds months but no version: load it with full_refresh")
        return None
    return version(path, int(number))


def version(path: str, number: int) -> dict:
    return json.loads(PQ.read_text(_manifest(path, number)))


def publish(path: str, manifest: dict) -> dict:
    """Put ``manifest`` (``months``: month -> snapshot, and any facts) in force
    as the next version."""
    before = PQ.read_text(_pointer(path))
    manifest = {**manifest, "version": int(before) + 1 if before else 1}
    PQ.write_text(_manifest(path, manifest["version"]), json.dumps(manifest))
    PQ.write_text(_pointer(path), str(manifest["version"]))
    return manifest


def read(spark: SparkSession, path: str, schema: T.StructType, manifest: dict,
         months: list[str] | None = None) -> DataFrame:
    """Rows of a version with their trip month, of ``months`` only where given:
    other months' folders are not even listed."""
    full = PQ.with_month_field(schema)
    folders = [f"{path}/{SNAP_COL}={snap}/{PQ.MONTH_COL}={month}"
               for month, snap in sorted(manifest["months"].items()) if months is None or month in months]
    if not folders:
        return spark.createDataFrame([], full)
    fields = T.StructType([*full.fields, T.StructField(SNAP_COL, T.StringType(), True)])
    return spark.read.schema(fields).option("basePath", path).parquet(*folders).drop(SNAP_COL)


def folders(path: str) -> list[str]:
    """The month folders of the version in force."""
    return [f"{path}/{SNAP_COL}={snap}/{PQ.MONTH_COL}={month}"
            for month, snap in sorted(current(path)["months"].items())]


def vacuum(path: str, keep: int = 2) -> list[str]:
    """Delete snapshots and manifests that none of the ``keep`` newest versions
    names, those of stopped loads included. Returns the deleted snapshots."""
    now = current(path)
    if now is None:
        return []
    oldest = max(now["version"] - keep + 1, 1)
    named = {s for n in range(oldest, now["version"] + 1) for s in version(path, n)["months"].values()}
    gone = [s for s in PQ.partition_values(path, SNAP_COL) if s not in named]
    for n in range(oldest - 1, 0, -1):
        if not PQ.path_exists(_manifest(path, n)):
            break
        PQ.delete_path(_manifest(path, n))
    for s in gone:
        PQ.delete_dir(f"{path}/{SNAP_COL}={s}")
    return gone
