"""Catalog sinks: schemas, tables, views and statistics.

Tables are *external*: their files live at an explicit location in the
shared folder, so they survive the session and any executor loss.
"""

from __future__ import annotations

import hashlib
import json
import time

from pyspark.sql import DataFrame, SparkSession

from rides.sources.parquet import delete_path


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a database if absent; give ``location`` on a cluster so its
    folder is on shared storage rather than a machine-local warehouse."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def save_table(df: DataFrame, name: str, path: str, keep: int = 2) -> None:
    """Create-table-as-select: the rows go to a fresh folder under ``path``, and
    the table ``name`` then gets that location in one step. Until then, and for
    readers opened before, it is the table it was; ``keep`` folders stay. A
    table whose columns changed is registered anew."""
    spark, folder = df.sparkSession, f"{path.rstrip('/')}/v{time.time_ns():020d}"
    df.write.parquet(folder)
    known = _kind(spark, name)
    if known == "EXTERNAL" and spark.table(name).schema == df.schema:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    else:
        _drop(spark, name, known)
        spark.catalog.createTable(name, path=folder, source="parquet", schema=df.schema)
    spark.catalog.refreshTable(name)
    _delete_old(path, keep)


def _delete_old(path: str, keep: int) -> None:
    import pyarrow.fs as pafs

    from rides.sources.files import filesystem

    fs, p = filesystem(path)
    names = sorted(f.base_name for f in fs.get_file_info(pafs.FileSelector(p))
                   if f.type == pafs.FileType.Directory and f.base_name.startswith("v"))
    for old in names[:-keep]:
        delete_path(f"{path.rstrip('/')}/{old}")


def _kind(spark: SparkSession, name: str) -> str | None:
    return spark.catalog.getTable(name).tableType if spark.catalog.tableExists(name) else None


def _drop(spark: SparkSession, name: str, kind: str | None) -> None:
    if kind:
        spark.sql(f"DROP {'VIEW' if kind == 'VIEW' else 'TABLE'} {name}")


POINTER = "rides.table"         # the property of a published view that names its table
CONTENT = "rides.content"       # the property of a version's table that tells its months' snapshots


def publish_months(spark: SparkSession, name: str, path: str, schema, manifest: dict, keep: int = 2) -> str:
    """Make a version of a month-partitioned table readable as ``name``.

    The version is registered as a table of its own, each month at the folder
    that the manifest gives; replacing the view ``name`` then publishes it in
    one step. Queries analyzed before go on with the version they saw, of
    which ``keep`` stay. Returns the name of the version's table."""
    from rides.sources.parquet import MONTH_COL, with_month_field
    from rides.sources.versions import SNAP_COL

    table = f"{name}__v{manifest['version']}"
    content = hashlib.sha256(json.dumps([path, manifest["months"]], sort_keys=True).encode()).hexdigest()
    if _kind(spark, table):
        known = spark.sql(f"SHOW TBLPROPERTIES {table} ('{CONTENT}')").first()["value"]
        if known == content and _kind(spark, name) == "VIEW" and current_table(spark, name) == table:
            return table                # published already
        _drop(spark, table, "EXTERNAL")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in with_month_field(schema).fields)
    spark.sql(f"CREATE TABLE {table} ({fields}) USING parquet PARTITIONED BY ({MONTH_COL}) "
              f"TBLPROPERTIES ('{CONTENT}' = '{content}') LOCATION '{path}'")
    months = sorted(manifest["months"].items())
    for at in range(0, len(months), 200):
        parts = " ".join(f"PARTITION ({MONTH_COL}={_partition(m)}) LOCATION "
                         f"'{path}/{SNAP_COL}={snap}/{MONTH_COL}={m}'" for m, snap in months[at:at + 200])
        spark.sql(f"ALTER TABLE {table} ADD {parts}")
    kind = _kind(spark, name)
    if kind and kind != "VIEW":         # a table of an older release
        _drop(spark, name, kind)
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{POINTER}' = '{table}') AS SELECT * FROM {table}")
    for old in range(manifest["version"] - keep, 0, -1):
        if not _kind(spark, f"{name}__v{old}"):
            break
        spark.sql(f"DROP TABLE {name}__v{old}")
    return table


def _partition(value: str) -> str:
    return "NULL" if value == "__HIVE_DEFAULT_PARTITION__" else f"'{value}'"


def current_table(spark: SparkSession, name: str) -> str:
    """The table behind ``name``: of a published view the version in force."""
    if _kind(spark, name) != "VIEW":
        return name
    row = spark.sql(f"SHOW TBLPROPERTIES {name} ('{POINTER}')").first()
    return row["value"]


def register_parquet(spark: SparkSession, name: str, path: str, schema=None) -> DataFrame:
    """Register existing Parquet files (partition folders included) as a table.

    With ``schema`` given (a StructType including partition columns), no file
    footer is read to infer it. Partition folders are added to the catalog."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if schema is not None:
        spark.catalog.createTable(name, path=path, source="parquet", schema=schema)
    else:
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    if _is_partitioned(spark, name):
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def _is_partitioned(spark: SparkSession, name: str) -> bool:
    return any(c.isPartition for c in spark.catalog.listColumns(name))


def create_view(df: DataFrame, name: str) -> DataFrame:
    """A session view: the query runs again on every read."""
    df.createOrReplaceTempView(name)
    return df


def analyze(spark: SparkSession, name: str, columns: bool = True) -> None:
    """Statistics for the optimizer: with ``columns``, row count plus per-
    column min/max/distinct/null counts (one scan); without, size and row
    count, for which a scan of no columns reads the file footers only."""
    what = "COMPUTE STATISTICS FOR ALL COLUMNS" if columns else "COMPUTE STATISTICS"
    spark.sql(f"ANALYZE TABLE {current_table(spark, name)} {what}")


def columns(spark: SparkSession, name: str) -> list[str]:
    return spark.table(name).columns
