"""Raw trip CSVs read by column name against the declared schema.

Spark's CSV reader maps a given schema to columns by *position*: a file whose
header is ``b,a`` would silently swap ``a`` and ``b``. So files are grouped
by their header line, each group is read with a text schema in its own
header order (no inference), columns are picked by name and cast to the
declared types, and the groups are combined with ``unionByName``; a column a
file lacks becomes NULL, a column the schema lacks is ignored.

Headers are read by a small Spark job (one task per batch of files, first
line only); only the (file, header) pairs reach the driver.
"""

from __future__ import annotations

import time
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rides.schema import RAW_SCHEMA
from rides.sources.files import Admission, admit, no_glob, open_path, plain_file_path


def _first_line(path: str, chunk: int = 1 << 16) -> str:
    buf = b""
    with open_path(path) as f:
        while b"\n" not in buf:
            more = f.read(chunk)
            if not more:
                break
            buf += more
    return buf.split(b"\n", 1)[0].decode("utf-8-sig").rstrip("\r")


def _first_lines(batches):
    for pdf in batches:
        heads = []
        for p in pdf["path"]:
            heads.append(_first_line(p))
        yield pd.DataFrame({"path": pdf["path"], "header": heads})


def read_headers(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """header -> files that have it."""
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    n = max(1, min(len(paths), spark.sparkContext.defaultParallelism))
    heads = files.repartition(n).mapInPandas(_first_lines, "path string, header string")
    groups: dict[str, list[str]] = {}
    for r in heads.collect():           # one row a file, as the admitted list has
        groups.setdefault(r["header"], []).append(r["path"])
    return {h: sorted(p) for h, p in groups.items()}


def split_header(line: str, sep: str = ",") -> list[str]:
    """Column names of a header line (quotes stripped)."""
    import csv
    import io

    return [c.strip() for c in next(csv.reader(io.StringIO(line), delimiter=sep))]


def read_group(spark: SparkSession, files: list[str], names: list[str],
               schema: T.StructType = RAW_SCHEMA, strict: bool = True,
               sep: str = ",") -> DataFrame:
    """Read files sharing one header, select ``schema`` columns by name."""
    text = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    df = (spark.read.schema(text).option("header", True).option("sep", sep)
               .option("quote", '"').option("escape", '"')
               .option("mode", "FAILFAST" if strict else "PERMISSIVE")
               .csv([no_glob(f) for f in files]))
    present = set(names)
    cols = []
    for f in schema.fields:
        if f.name in present:
            src = F.col(f.name)
            c = src.cast(f.dataType) if strict else src.try_cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols, plain_file_path().alias("filename"))


def read_group_checked(spark: SparkSession, files: list[str], names: list[str],
                       schema: T.StructType = RAW_SCHEMA, sep: str = ",") -> DataFrame:
    """As ``read_group``, with the reasons against rows that do not fit
    (``rides.operators.quarantine``)."""
    from rides.operators.quarantine import checked

    line = "_line"
    text = T.StructType([T.StructField(n, T.StringType(), True) for n in [*names, line]])
    df = (spark.read.schema(text).option("header", True).option("sep", sep)
               .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
               .option("columnNameOfCorruptRecord", line).option("columnPruning", False)
               .csv([no_glob(f) for f in files])
               .withColumn("filename", plain_file_path()))
    return checked(df, schema, ["filename"], F.col(line))


def read_trips_csv_checked(spark: SparkSession, paths: str | list[str], schema: T.StructType = RAW_SCHEMA,
                           glob: str = "*.csv", admission: Admission | None = None) -> DataFrame:
    """Every row of the admitted CSVs, fit or not, with the reasons against it;
    ``quarantine.accepted`` and ``quarantine.rejected`` tell them apart."""
    adm = admission or admit(spark, paths, glob)
    groups: dict[tuple, list[str]] = {}
    for header, files in read_headers(spark, adm.paths).items():
        groups.setdefault(tuple(split_header(header)), []).extend(files)
    parts = [read_group_checked(spark, files, list(names), schema) for names, files in groups.items()]
    return reduce(DataFrame.unionByName, parts)


def read_trips_csv(spark: SparkSession, paths: str | list[str], schema: T.StructType = RAW_SCHEMA,
                   strict: bool = True, glob: str = "*.csv",
                   admission: Admission | None = None) -> DataFrame:
    """Raw trips from every admitted CSV under ``paths``, plus ``filename``.

    ``strict`` keeps the cast errors of ANSI mode (a bad timestamp fails the
    load); ``strict=False`` turns unparsable values into NULL instead.
    """
    adm = admission or admit(spark, paths, glob)
    groups: dict[tuple, list[str]] = {}
    for header, files in read_headers(spark, adm.paths).items():
        groups.setdefault(tuple(split_header(header)), []).extend(files)
    parts = [read_group(spark, files, list(names), schema, strict)
             for names, files in groups.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def ingest_stats(raw: DataFrame, admission: Admission) -> DataFrame:
    """Per file: rows loaded, those among them that staging will drop (no start
    or end, or a negative duration) and size in MB (files load in parallel, so
    time is reported for the whole load by ``ingest``)."""
    spark = raw.sparkSession
    sizes = spark.createDataFrame(admission.admitted, "file string, bytes long")
    fits = F.coalesce(F.col("ended_at") >= F.col("started_at"), F.lit(False))
    counts = raw.groupBy(F.col("filename").alias("file")).agg(
        F.count(F.lit(1)).alias("rows_added"), F.count_if(~fits).alias("rows_unfit"))
    return (sizes.join(counts, "file", "left")
                 .select("file", F.coalesce("rows_added", F.lit(0)).alias("rows_added"),
                         F.coalesce("rows_unfit", F.lit(0)).alias("rows_unfit"),
                         (F.col("bytes") / F.lit(1e6)).alias("bytes_mb")))


LOAD_ID = "load_id"


def write_load(raw: DataFrame, target_path: str, mode: str) -> DataFrame:
    """Write one load into the month-partitioned raw table (``append``, or
    ``replace`` for the whole table) and return its rows as written. Every row
    carries the id of its load, so reports count this load alone."""
    import uuid

    from rides.sources.parquet import write_trips_by_month

    load_id = uuid.uuid4().hex
    stamped = raw.withColumn(LOAD_ID, F.lit(load_id))
    if mode not in ("append", "replace"):
        raise ValueError(f"mode must be append or replace, not {mode!r}")
    write_trips_by_month(stamped, target_path, mode="append" if mode == "append" else "overwrite",
                         source_col="started_at", replace_all=mode == "replace")
    written = raw.sparkSession.read.schema(stamped.schema).parquet(target_path)
    return written.where(F.col(LOAD_ID) == load_id)


def write_watched(rows: DataFrame, target_path: str, mode: str, rejects: str | None) -> tuple[DataFrame, dict]:
    """``write_load`` with the counts of the rows, taken by the write. With
    ``rejects`` the rows carry the reasons against them, and those that have
    any go there."""
    from rides.operators.metrics import observed, raw_counts
    from rides.operators.quarantine import REASONS, accepted, rejected

    if rejects is None:
        raw, watch = observed(rows, raw_counts())
        return write_load(raw, target_path, mode), watch.get
    marked, refused = observed(rows, {"rows_rejected": F.count_if(F.size(REASONS) > 0)})
    raw, watch = observed(accepted(marked), raw_counts())
    written = write_load(raw, target_path, mode)
    counts = watch.get | refused.get
    if counts["rows_rejected"]:
        rejected(rows, ["filename"]).write.mode("append").parquet(rejects)
    return written, counts


def ingest(spark: SparkSession, paths, target_path: str, mode: str = "append",
           strict: bool = True, rejects: str | None = None) -> dict:
    """Read admitted CSVs by name and write them to a month-partitioned raw
    table in one parallel write. Returns files, skipped files, rows, MB,
    seconds and MB/s; rows per file are counted from what was written, the
    other counts while it was.

    With ``rejects`` a row that does not fit the schema neither fails the load
    nor loses its field: it goes to that folder, with file, reasons and text.
    Only a load that has such rows reads its files again, for them alone."""
    t0 = time.perf_counter()
    adm = admit(spark, paths)
    if rejects is None:
        rows = read_trips_csv(spark, paths, strict=strict, admission=adm)
    else:
        rows = read_trips_csv_checked(spark, paths, admission=adm)
    written, counts = write_watched(rows, target_path, mode, rejects)
    per_file = [r.asDict() for r in ingest_stats(written, adm).orderBy("file").collect()]
    secs = time.perf_counter() - t0
    total_mb = sum(b for _, b in adm.admitted) / 1e6
    return {"files": per_file, "skipped": adm.skipped,
            "rows": sum(r["rows_added"] for r in per_file), "mb": total_mb,
            "seconds": secs, "mb_per_s": total_mb / secs if secs else None, "counts": counts}


def empty_raw(spark: SparkSession, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """A schema-only raw table (no rows): the declared columns plus ``filename``."""
    full = T.StructType(schema.fields + [T.StructField("filename", T.StringType(), True)])
    return spark.createDataFrame([], full)


def month_from_file_name(path_col: str = "filename"):
    """'yyyyMM' prefix of a file's base name ('202301-trips.csv'
    -> '202301'); NULL when the name has no such prefix. The trip month used
    for partitioning comes from ``started_at`` instead, which does not depend
    on how files are named."""
    base = F.regexp_extract(F.col(path_col), r"([^/]+)$", 1)
    m = F.regexp_extract(base, r"^(\d{6})", 1)
    return F.when(m != "", m)
