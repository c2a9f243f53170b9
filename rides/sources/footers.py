"""Statistics of Parquet tables from their file footers.

A job reads the footers in tasks, many files each; no column is scanned. Row
groups give rows, null counts, least and greatest values, which are summed up
by Spark per column. Numbers are compared as doubles; times and dates as text
of one width, which sorts as they do.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

FOOTER = ("table_name string, column_name string, row_count long, null_count long, known boolean, "
          "min_number double, max_number double, min_text string, max_text string")


def _text(value) -> str:
    import datetime as dt

    if isinstance(value, dt.datetime):
        return value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return value.isoformat() if isinstance(value, dt.date) else str(value)


def _read_footers(batches):
    import pandas as pd
    import pyarrow.parquet as pq

    from rides.sources.files import open_path

    for pdf in batches:
        rows = []
        for table, path in zip(pdf["table_name"], pdf["path"], strict=True):
            with open_path(path) as f:
                meta = pq.read_metadata(f)
            for g in range(meta.num_row_groups):
                group = meta.row_group(g)
                for c in range(group.num_columns):
                    column = group.column(c)
                    s = column.statistics if column.physical_type != "INT96" else None     # old timestamps
                    nulls = s.null_count if s is not None and s.has_null_count else None
                    known = s is not None and (s.has_min_max or nulls == group.num_rows)
                    low, high = (s.min, s.max) if s is not None and s.has_min_max else (None, None)
                    number = isinstance(low, (int, float)) and not isinstance(low, bool)
                    text = low is not None and not number
                    rows.append((table, column.path_in_schema, group.num_rows, nulls, known,
                                 float(low) if number else None, float(high) if number else None,
                                 _text(low) if text else None, _text(high) if text else None))
        yield pd.DataFrame(rows, columns=[f.split()[0] for f in FOOTER.split(", ")])


def column_statistics(spark: SparkSession, tables: dict[str, list[str]]) -> DataFrame:
    """(table_name, column_name, row_count, null_count, min_number, max_number,
    min_text, max_text) of the Parquet folders or files given for each table. A
    value that any row group leaves open is null; a table without files has no
    rows here."""
    from rides.sources.files import admit

    files = [(t, p) for t, folders in tables.items() if folders
             for p in admit(spark, folders, "*.parquet").paths]
    n = max(1, min(len(files), spark.sparkContext.defaultParallelism * 4))
    footers = (spark.createDataFrame(files, "table_name string, path string").repartition(n)
                    .mapInPandas(_read_footers, FOOTER))
    known = F.bool_and("known")
    return footers.groupBy("table_name", "column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.when(F.bool_and(F.col("null_count").isNotNull()), F.sum("null_count")).alias("null_count"),
        *(F.when(known, fn(c)).alias(c) for c, fn in (("min_number", F.min), ("max_number", F.max),
                                                      ("min_text", F.min), ("max_text", F.max))))


def table_files(spark: SparkSession, name: str) -> list[str]:
    """The files that a catalog table, or the view on a version, reads now."""
    from urllib.parse import unquote

    return [unquote(f).replace("file:///", "/") for f in spark.table(name).inputFiles()]


def set_in_catalog(spark: SparkSession, name: str, statistics: DataFrame) -> None:
    """Keep the column statistics with the table ``name``, one property a column
    (``rides.column.<name>``); the number of columns bounds what is collected."""
    from rides.sources.tables import current_table

    rows = [r.asDict() for r in statistics.collect()]
    if rows:
        props = ", ".join("'rides.column.{}' = '{}'".format(
            r["column_name"], json.dumps({k: v for k, v in r.items() if k not in ("table_name", "column_name")})
            .replace("\\", "\\\\").replace("'", "\\'")) for r in rows)
        spark.sql(f"ALTER TABLE {current_table(spark, name)} SET TBLPROPERTIES ({props})")
