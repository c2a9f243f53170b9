"""Parquet tables partitioned by trip month, and small storage helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

MONTH_COL = "trip_month"


def month_key(ts_or_date: str = "start_ts"):
    """'yyyy-MM' text of the trip start, the partition value."""
    return F.date_format(F.col(ts_or_date), "yyyy-MM")


def write_trips_by_month(df: DataFrame, path: str, mode: str = "overwrite",
                         max_records_per_file: int = 5_000_000,
                         source_col: str = "start_ts", replace_all: bool = False) -> None:
    """One partitioned write (never one write per input file, which would let
    the last file of a month replace the others).

    The rows are rebalanced by month: adaptive execution gives small months
    to one task together and splits a large month over several, from measured
    sizes, so neither a hot month nor many tiny files come out.
    ``maxRecordsPerFile`` caps file size. An overwrite replaces only the
    months present in ``df`` unless ``replace_all`` (a full refresh) is set."""
    (by_month(df, source_col)
        .write.mode(mode)
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
        .option("compression", "zstd")
        .partitionBy(MONTH_COL)
        .parquet(path))


def by_month(df: DataFrame, source_col: str = "start_ts") -> DataFrame:
    """``df`` with its trip month, rebalanced by it for a partitioned write."""
    return df.withColumn(MONTH_COL, month_key(source_col)).hint("rebalance", F.col(MONTH_COL))


def with_month_field(schema: T.StructType) -> T.StructType:
    if MONTH_COL in schema.fieldNames():
        return schema
    return T.StructType(schema.fields + [T.StructField(MONTH_COL, T.StringType(), True)])


def read_trips_by_month(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a month-partitioned table with a declared schema (the partition
    value stays text; nothing is inferred). Filters on ``trip_month`` prune
    directories. Of a versioned table the version in force is read."""
    from rides.sources import versions as V

    if read_text(f"{path}/_current") is not None:
        return V.read(spark, path, schema, V.current(path))
    return spark.read.schema(with_month_field(schema)).parquet(path)


def partition_values(path: str, column: str = MONTH_COL) -> list[str]:
    """Values of a partition column from the folder names (metadata only)."""
    import pyarrow.fs as pafs

    from rides.sources.files import filesystem

    fs, p = filesystem(path)
    prefix = f"{column}="
    return sorted(f.base_name[len(prefix):] for f in fs.get_file_info(pafs.FileSelector(p))
                  if f.type == pafs.FileType.Directory and f.base_name.startswith(prefix))


def path_exists(path: str) -> bool:
    import pyarrow.fs as pafs

    from rides.sources.files import filesystem

    fs, p = filesystem(path)
    return fs.get_file_info(p).type != pafs.FileType.NotFound


def delete_path(path: str) -> None:
    """Delete a file or a folder, if it is there."""
    import pyarrow.fs as pafs

    from rides.sources.files import filesystem

    fs, p = filesystem(path)
    kind = fs.get_file_info(p).type
    if kind == pafs.FileType.Directory:
        fs.delete_dir(p)
    elif kind != pafs.FileType.NotFound:
        fs.delete_file(p)


delete_dir = delete_path


def read_text(path: str) -> str | None:
    """Content of a small state file, None where there is none."""
    import pyarrow.fs as pafs

    from rides.sources.files import filesystem

    fs, p = filesystem(path)
    if fs.get_file_info(p).type != pafs.FileType.File:
        return None
    with fs.open_input_file(p) as f:
        return f.read().decode()


def write_text(path: str, text: str) -> None:
    """Write a small state file under a temporary name, then move it."""
    from rides.sources.files import filesystem

    fs, p = filesystem(path)
    fs.create_dir(p.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(p + ".tmp") as f:
        f.write(text.encode())
    fs.move(p + ".tmp", p)
